"""The training-data operators against brute force, round trips and edge cases."""

import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from mapfold.llm import chat, common, decontam, exact_dedup, packing, pii, queries, sharding, sigtree, toxicity, urlrules, warc

SF = "/root/testdata/sf0.001"
COLS = "doc_id long, text string, lang string, kept string, n long"


def docs_of(spark, texts):
    """Small table with further columns whose names clash with those of results."""
    return spark.createDataFrame([(i, t, "en", "x", 7) for i, t in texts], COLS)


@pytest.fixture(scope="module")
def edge(spark):
    long = " ".join(f"w{i}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one two"), (5, "One  two"), (6, "one two"), (7, long), (8, long + " end"), (9, "."), (9, "."), (10, "é" * 5000)]
    return docs_of(spark, rows)


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


# ------------------------------------------------------------------ common


def test_membership_has_no_false_negatives(spark):
    df = spark.range(5000).select((F.col("id") * 7919 - 300).alias("x"))
    m = common.Membership.build(df, "x", 1 << 20)
    assert m.test(np.arange(5000, dtype=np.int64) * 7919 - 300).all()
    assert m.test(np.arange(10**9, 10**9 + 10000, dtype=np.int64)).mean() < 0.01


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60) if i != 30] + [(500, k) for k in range(600, 700)]
    got = {r.node: r.comp for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(31)} == {0} and {got[i] for i in range(31, 61)} == {31} and got[699] == 500


def test_components_of_long_chains_in_random_id_order(spark):
    rng = np.random.default_rng(11)
    ids = rng.permutation(5000).tolist()
    one, two = ids[:4000], ids[4000:]
    edges = [*zip(one[:-1], one[1:]), *zip(two[:-1], two[1:]), (6000, 6000), (6001, None)]
    got = sorted(tuple(r) for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == sorted([(i, min(one)) for i in one] + [(i, min(two)) for i in two])
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --------------------------------------------------------------------- pii


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def test_pii_keeps_format_links_values_and_leaves_the_rest(spark):
    text = (
        "Mail ann.b7@mail8.example.com and +1 (988) 555-2485 4041894974608795 4111-1111-1111-1111 70.123.182.155 94.1 "
        "1984-02-29 3.4.1971 219-09-9999 DE89 3704 0044 0532 0130 00 +493012345678 7 "
    )
    same = "4111-1111-1111-1112 999.1.1.1 2024-13-45 v1.2.3 666-12-1234 0000000000000000 12345"
    rows = pii.pseudonymise(docs_of(spark, [(1, text + same), (2, "again 4041894974608795 x"), (3, None), (4, ""), (5, "none")]), "k").orderBy("doc_id").collect()
    one = rows[0]
    assert one.text.endswith(same) and one.lang == "en" and one.n == 7
    for old in ("ann.b7@", "555-2485", "4041894974608795", "4111-1111-1111-1111", "70.123.182.155", "1984-02-29", "3.4.1971", "219-09-9999", "3704 0044", "3012345678"):
        assert old not in one.text
    kinds = [p.kind for p in one.pii]
    assert kinds == ["email", "phone", "card", "card", "ip", "day", "day", "ssn", "iban", "phone"]
    value = [p.value for p in one.pii]
    assert re.fullmatch(r"[a-z]{3}\.[a-z][0-9]@mail8\.example\.com", value[0]) and re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", value[1])
    assert luhn(value[2]) and luhn(value[3].replace("-", "")) and re.fullmatch(r"4\d{3}-\d{4}-\d{4}-\d{4}", value[3])
    turned = (value[8].replace(" ", ""))[4:] + "DE" + value[8][2:4]
    assert int("".join(str(int(c, 36)) for c in turned)) % 97 == 1
    assert value[2] in rows[1].text  # equal values stay linked across documents
    assert rows[2].text is None and rows[2].pii == [] and rows[3].text == "" and rows[4].text == "none"


def test_pii_feistel_is_a_permutation(spark):
    df = spark.range(17 * 43).select(pii.feistel("k", "t", F.floor(F.col("id") / 43), F.col("id") % 43, F.lit(17), F.lit(43)).alias("v"), "id")
    back = df.select("id", "v", pii.feistel("k", "t", F.col("v.l"), F.col("v.r"), F.lit(17), F.lit(43), back=True).alias("b")).collect()
    assert len({(r.v.l, r.v.r) for r in back}) == 17 * 43
    assert all(r.b.l * 43 + r.b.r == r.id for r in back)


# ----------------------------------------------------------------- packing


def test_cuts_equal_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(40):
        places = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 14))])
        pen = rng.choice([0, 3, 11], len(places))
        best = {0: 0}
        for i in range(1, len(places)):
            best[i] = min(best[j] + pen[i] + 16 - (places[i] - places[j]) for j in range(i) if places[i] - places[j] <= 16)
        got = packing.cuts(places, pen, 16)
        cost = sum(pen[b] + 16 - (places[b] - places[a]) for a, b in zip(got[:-1], got[1:]))
        assert cost == best[len(places) - 1]


def test_packing_covers_every_token_once(spark, edge):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    docs = common.table(spark, SF, "documents").select("doc_id", "text").union(edge.where("doc_id < 9").selectExpr("doc_id + 10000", "text"))
    want = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [1] for r in docs.collect()}
    got, seqs = defaultdict(list), defaultdict(list)
    for r in packing.pack(docs, stretch=20000).collect():
        got[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(got) == set(want)
    for k, ids in want.items():
        assert [x for _, part, _ in sorted(got[k]) for x in part] == ids
        assert all(n == len(ids) for *_, n in got[k])
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(docs.limit(0)).count() == 0


def test_packing_of_very_long_runs_of_blanks_equals_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = np.random.default_rng(2)
    mixed = "".join(rng.choice(list(" \n\t\r\x0b\x85\xa0\u2003\u3000"), 70000))
    texts = ["\n" * 2_000_000, "a" + " " * 1_200_000 + "b", " " * 1_200_000 + "\n.", mixed, f"x{mixed}1{mixed}.{mixed}", "\u3000" * 70000 + "'s", "\x1c" * 70000 + " a"]
    got = defaultdict(list)
    for r in packing.pack(docs_of(spark, list(enumerate(texts)))).collect():
        got[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4")))
    for i, t in enumerate(texts):
        ids = np.concatenate([part for _, part in sorted(got[i], key=lambda p: p[0])]).tolist()
        assert ids == tok.encode(t, add_special_tokens=False).ids + [1]


def test_packing_splits_at_added_tokens_like_the_default_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end}", f" x\n\n {end}\n\n y  {end}  z", f"<|endoftext{end}|>", "<|EndOfText|> <|endoftext|", " ".join(["word. "] * 3000 + [end] + ["more, "] * 3000)]
    got = defaultdict(list)
    for r in packing.pack(docs_of(spark, list(enumerate(texts)))).collect():
        got[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
    for i, t in enumerate(texts):
        want = tok.encode(t, add_special_tokens=False).ids + [1]
        assert [x for _, part, _ in sorted(got[i]) for x in part] == want and {n for *_, n in got[i]} == {len(want)}
    assert got[0][0][1] == [64, 220, 50256, 275, 1]


def test_op2_digest(spark):
    r = packing.op2_packing(spark, SF).where("start = 0").first()
    ids = next(np.frombuffer(p.ids, "<u4") for p in packing.pack(common.table(spark, SF, "documents").where(F.col("doc_id") == r.doc_id)).where("start = 0").collect())
    assert r.length <= r.doc_tokens and (len(ids) != r.length or zlib.crc32(ids.tobytes()) == r.ids_crc32)


# ------------------------------------------------------------- exact dedup


def test_fingerprints_compose():
    t = bytes(range(256)) * 700
    for cut in (0, 1, 65536, len(t)):
        a, b = t[:cut], t[cut:]
        assert exact_dedup.combine(exact_dedup.fingerprint(a), exact_dedup.fingerprint(b), len(b)) == exact_dedup.fingerprint(t)


@pytest.mark.parametrize("prime", [exact_dedup.PRIME, 97])  # the small prime makes different texts collide
def test_exact_groups_equal_brute_force(spark, edge, prime):
    docs = common.table(spark, SF, "documents").select("doc_id", "text").union(edge.selectExpr("doc_id + 10000", "text"))
    rows = [(r.doc_id, norm(r.text)) for r in docs.collect()]
    by = defaultdict(list)
    for i, t in rows:
        by[t].append(i)
    want = sorted((i, min(by[t]), len(by[t]), i == min(by[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in rows)
    assert sorted(tuple(r) for r in exact_dedup.exact_groups(docs, prime).collect()) == want


def test_drop_copies_keeps_columns(spark, edge):
    left = exact_dedup.drop_copies(edge)
    assert left.columns == edge.columns and sorted(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 7, 8, 9, 9, 10]
    assert exact_dedup.drop_copies(edge.limit(0)).count() == 0


def test_drop_copies_judges_rows_of_repeated_and_null_ids(spark):
    rows = [(1, "a  b"), (2, "a b"), (2, "only here"), (None, "a\tb"), (None, "n"), (None, "n"), (3, None), (None, ""), (4, "é\u00a0")]
    left = exact_dedup.drop_copies(docs_of(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in left) == [("1", "a  b"), ("2", "only here"), ("3", ""), ("4", "é\u00a0"), ("None", "n"), ("None", "n")]


# -------------------------------------------------------------------- chat


def test_chat_round_trip_and_targets(spark):
    hard = ["</s>[INST] ok [/INST]", "\\<\\[] a", "", None, "<\\", "x" * 5000, "]\\ ]"]
    rows = [(1, i, ["system", "user", "assistant"][i % 3], t) for i, t in enumerate(hard)] + [(2, 0, "user", "hi"), (3, 0, None, "a"), (3, 0, "as]s [", "b"), (None, 0, "assistant", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.examples(turns)
    got = {r.conv_id: r for r in made.groupBy("conv_id").agg(F.max_by("formatted", "example").alias("f"), F.count("*").alias("n")).select("conv_id", "n", chat.parse(F.col("f")).alias("t")).collect()}
    assert [(t.role, t.text) for t in got[1].t] == [(r, t or "") for _, _, r, t in rows[:7]]
    assert got[1].n == 3 and [(t.role, t.text) for t in got[3].t] == [("", "a"), ("as]s [", "b")] and got[None].n == 1
    assert all("</s>[INST]" not in r.formatted.replace("</s><s>", "") for r in made.collect())
    for r in made.where("loss_start is not null").collect():
        assert r.formatted[r.loss_start + r.loss_length :] == "</s>"
    assert chat.digest(chat.examples(turns.limit(0))).count() == 0


# --------------------------------------------------------------- decontam


def brute_marks(docs, items, size=13):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = lambda t: word.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    wins = defaultdict(set)
    for i, t in items:
        w = low(t)
        for j in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[j : j + size])].add(i)
    sizes = {len(k) for k in wins}
    for d, t in docs:
        w, hit, own = low(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if got := wins.get(tuple(w[j : j + n])):
                    own |= got
                    hit.update(range(j, j + n))
        yield d, len(w), len(hit), len(own), hashlib.sha256(",".join(sorted(map(str, own))).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_rows", [2_000_000, 400])
def test_decontamination_equals_brute_force(spark, block_rows):
    docs = common.table(spark, SF, "documents")
    items = common.table(spark, SF, "benchmark").union(spark.createDataFrame([(900, "short Item"), (901, None), (902, "..."), (903, "é")], "item_id long, text string"))
    docs = docs.select("doc_id", "text").union(spark.createDataFrame([(9001, None), (9002, ""), (9003, "A short item, é!"), (9004, "short. item short item")], "doc_id long, text string"))
    m = decontam.marks(docs, items, block_rows=block_rows)
    hit = decontam.hit_words()
    got = m.select("doc_id", "n_words", hit.alias("h"), F.size("items"), F.sha2(F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ","), 256), (hit > 0) & (hit * 20 >= F.col("n_words")))
    want = sorted(brute_marks([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()]))
    assert sorted(tuple(r) for r in got.collect()) == want
    left = decontam.decontaminate(docs, items, block_rows=block_rows)
    assert sorted(r.doc_id for r in left.collect()) == [w[0] for w in want if not w[5]]
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, items, action="cut", block_rows=block_rows).collect()}
    assert cut[9003] == "A !" and cut[9004] == "" and cut[9001] is None and len(cut) == len(want)


@pytest.mark.parametrize("block_rows", [2_000_000, 7])
def test_decontamination_is_by_row_for_any_benchmark_size(spark, block_rows, monkeypatch):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, passage), (1, "clean text"), (None, "some " + passage), (None, "clean too"), (None, "clean too"), (2, None), (3, passage + " tail" * 700)]
    docs, items = docs_of(spark, rows), spark.createDataFrame([(1, passage), (2, "short one")], "item_id long, text string")
    sizes, init = [], decontam.Windows.__init__
    monkeypatch.setattr(decontam.Windows, "__init__", lambda self, r: (sizes.append(len(r)), init(self, r))[1])
    got = decontam.marks(docs, items, block_rows=block_rows).select("doc_id", "n_words", decontam.hit_words(), F.size("items")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(1, 30, 30, 1), (1, 2, 0, 0), (None, 31, 30, 1), (None, 2, 0, 0), (None, 2, 0, 0), (2, 0, 0, 0), (3, 730, 30, 1)]))
    left = decontam.decontaminate(docs, items, block_rows=block_rows)
    assert left.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in left.where("text is not null").collect()) == [("1", "clean text"), ("3", rows[6][1]), ("None", "clean too"), ("None", "clean too")]
    cut = decontam.decontaminate(docs, items, action="cut", block_rows=block_rows)
    assert cut.schema == docs.schema
    assert sorted((str(r.doc_id), r.text or "") for r in cut.collect()) == sorted([("1", ""), ("1", "clean text"), ("None", "some "), ("None", "clean too"), ("None", "clean too"), ("2", ""), ("3", " tail" * 700)])
    assert len(sizes) == 3 * max(1, -(-19 // block_rows)) and sum(sizes) == 3 * 19


# ---------------------------------------------------------------- toxicity


def test_toxicity_catches_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    found = toxicity.op6_toxicity(spark, sf).join(common.table(spark, sf, "labels"), "doc_id").where("held_out")
    rates = {r.toxic: r.p for r in found.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert rates[1] > 0.8 and rates[0] < 0.01


def test_toxicity_edges(spark, edge):
    labels = spark.createDataFrame([(4, 1), (5, 0), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(edge, labels)
    got = toxicity.scores(edge, model).collect()
    assert len(got) == 11 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.fit(edge.limit(0), labels).score(np.zeros(0, np.uint8), np.zeros(2, np.int64)).tolist() == [0.5]
    assert toxicity.keep_clean(edge, model).columns == edge.columns


# ---------------------------------------------------------------- sharding


def test_sharding_is_gapless_and_even(spark, edge):
    docs = common.table(spark, "/root/testdata/sf0.01", "documents")
    got = sharding.op7_sharding(spark, "/root/testdata/sf0.01").collect()
    size, slots = defaultdict(int), defaultdict(list)
    for r in got:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(got) == docs.count() and len(size) == 40
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(size.values()) < 1.02 * min(size.values())
    small = sharding.assign(edge, shards=3).collect()
    assert len(small) == 11 and {r["size"] for r in small if r.doc_id in (1, 2)} == {16}
    assert sharding.assign(edge.limit(0)).count() == 0


def test_rebalance_only_moves_what_helps():
    load = [10, 10, 10, 10, 50, 1]
    new = sharding.rebalance([0, 0, 0, 0, 1, 1], load, 3)
    total = [sum(w for w, o in zip(load, new) if o == s) for s in range(3)]
    assert max(total) == 50 and min(total) >= 20 and new[4] == 1


def test_stored_map_is_rebalanced_from_its_newest_version(spark, tmp_path):
    path = f"{tmp_path}/map"
    docs = common.table(spark, SF, "documents").select("doc_id", "text")
    sharding.assign(docs, shards=3, map_path=path).count()
    again = sharding.assign(docs, shards=3, map_path=path)
    assert again.count() == docs.count() and sharding.newest_version(spark, path) == 3
    two, three = (sharding.read_version(spark, path, k) for k in (2, 3))
    assert len(two) == len(three) == sharding.SLOTS and two == three  # the same loads move nothing
    grown = docs.union(docs.selectExpr("doc_id + 100000", "repeat(text, 3)").where("doc_id % 3 = 0"))
    for shards, version in ((3, 4), (5, 5), (2, 6)):
        size = defaultdict(int)
        for r in sharding.assign(grown, shards=shards, map_path=path).collect():
            size[r.shard] += r["size"]
        assert sorted(size) == list(range(shards)) and max(size.values()) < 1.05 * min(size.values())
        assert sharding.newest_version(spark, path) == version
    four, five = (sharding.read_version(spark, path, k) for k in (4, 5))
    assert sum(a == b for a, b in zip(four, five)) > 0.5 * sharding.SLOTS  # most slots stay
    with pytest.raises(ValueError):
        sharding.assign(grown, shards=3, slots=64, map_path=path)


# ------------------------------------------------------------ n-gram join


def brute_components(rows, size=4):
    sets, held = {}, defaultdict(list)
    for i, t in rows:
        w = [x for x in re.split("[\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) if x]
        sets[i] = {tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))} if w else set()
        for s in sets[i]:
            held[s].append(i)
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, s in sets.items():
        for j in {j for x in s for j in held[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i)) for i, s in sets.items())


@pytest.mark.parametrize("limits", [{}, {"chunk_bytes": 4000, "chunk_rows": 5}])  # small limits split every block
def test_join_equals_brute_force(spark, limits):
    rng = np.random.default_rng(5)
    base = [f"v{i}" for i in rng.integers(0, 400, 300)]
    rows = [(1, None), (2, ""), (3, "a b"), (4, "A  b"), (5, "a b c"), (6, "x y z q"), (7, " ".join(base))]
    for k in range(60):  # one large group of near copies, some too far away
        w = list(base)
        for p in rng.integers(0, 300, int(rng.integers(1, 9))):
            w[p] = f"n{k}"
        rows.append((100 + k, " ".join(w)))
    for k in range(40):  # a passage that many documents share
        rows.append((300 + k, " ".join(base[:60] + [f"u{k}_{i}" for i in range(5 + 3 * k)])))
    rows += [(r.doc_id + 1000, r.text) for r in common.table(spark, SF, "documents").collect()]
    got = sigtree.similarity_components(docs_of(spark, rows), **limits).collect()
    assert sorted(tuple(r) for r in got) == brute_components(rows)


def test_join_counts_shingles_of_the_given_size(spark):
    rows = [(1, "a b c d e f g"), (2, "a b"), (3, "b a"), (4, "a b a b"), (5, None), (6, "A b C d E f g")]
    got = sigtree.similarity_components(docs_of(spark, rows), size=2).collect()
    assert sorted(tuple(r) for r in got) == brute_components(rows, 2)


def test_join_edges(spark, edge):
    assert sigtree.similarity_components(edge.limit(0)).count() == 0
    got = {r.doc_id: r.component_id for r in sigtree.similarity_components(edge).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 7, 9: 9, 10: 10}
    assert sigtree.drop_near_copies(edge).columns == edge.columns


def test_join_keeps_the_texts_of_repeated_and_null_ids_apart(spark):
    base, other = (" ".join(f"{c}{i}" for i in range(100)) for c in "bo")
    rows = [(5, base), (7, base + " x1"), (7, other), (8, other + " y"), (None, base + " x2"), (None, "third one of its own"), (4, None), (4, base + " x3")]
    got = sigtree.similarity_components(docs_of(spark, rows)).collect()
    want = [(5, 97, 4), (7, 98, 4), (7, 97, 7), (8, 98, 7), (None, 98, 4), (None, 2, None), (4, 0, 4), (4, 98, 4)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    left = sigtree.drop_near_copies(docs_of(spark, rows))
    assert left.columns == docs_of(spark, rows).columns
    assert sorted((str(r.doc_id), str(r.text)) for r in left.collect()) == sorted([("4", "None"), ("4", base + " x3"), ("7", other), ("None", "third one of its own")])


# -------------------------------------------------------------------- warc


def test_warc_round_trip(spark, tmp_path):
    rows = [(1, "u\nx", "a" * 100, "e"), (2, None, None, "e"), (3, "u", "a" * 100, "e"), (3, "u", "a" * 100, "e"), (None, "n", "z", "e"), (5, "v", "", "e"), (6, "w", "bé" * 300000, "e")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, kind string")
    one, two = f"{tmp_path}/one", f"{tmp_path}/two"
    manifest = warc.write(pages, one, ranges=3, roll_bytes=300)
    got = warc.read(manifest, one).collect()
    assert sorted((str(r.page_id), r.record_type, r.refers_to, r.payload_bytes) for r in got) == [
        ("1", "revisit", 3, 100), ("2", "revisit", 5, 0), ("3", "response", None, 100), ("3", "revisit", 3, 100), ("5", "response", None, 0), ("6", "response", None, 900000), ("None", "response", None, 1)
    ]
    assert next(r.payload for r in got if r.page_id == 6).decode() == "bé" * 300000
    again = warc.write(pages, two, ranges=3, roll_bytes=300)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, again.collect()))  # same bytes on every run
    empty = warc.write(pages.limit(0), f"{tmp_path}/three")
    assert warc.read(empty, f"{tmp_path}/three").count() == 0


def test_op9_equals_brute_force(spark):
    pages = common.table(spark, SF, "pages").collect()
    last = {}
    for r in pages:
        body = (r.html or "").encode()
        last[body] = max(r.page_id, last.get(body, -1))
    want = []
    for r in pages:
        body = (r.html or "").encode()
        first = last[body] == r.page_id
        want.append((r.page_id, len(body), warc.digest32(body), "response" if first else "revisit", None if first else last[body]))
    assert sorted(map(tuple, warc.op9_warc(spark, SF).collect())) == sorted(want)


# --------------------------------------------------------------- url rules


def test_url_rules_inline_and_joined(spark, monkeypatch):
    urls = [None, "", "no scheme/es/", "http://example.org/es/1", "HTTP://A.Example.ORG/en/12?x#y", "https://example.org", "http://xexample.org/es/", "http://a.com/de/", "http://com/fr/x", "s://a.net/", "x://b.com:8/de/", "http://example.org/en/2", "a://" + "b." * 3000 + "org/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    want = [None, None, None, "example.org/es/", "example.org/en/1", None, "org/", "com/de/", "com/fr/", None, None, "org/", "org/"]
    for limit in (urlrules.MAX_INLINE, 0):
        monkeypatch.setattr(urlrules, "MAX_INLINE", limit)
        got = {r.page_id: r for r in urlrules.judge(pages).collect()}
        assert [got[i].rule for i in range(len(urls))] == want
        assert [got[i].verdict for i in range(5)] == ["allow", "allow", "allow", "block", "block"]
    assert urlrules.judge(pages.limit(0)).count() == 0


# ---------------------------------------------------------------- pipeline


def test_registry():
    numbers = sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES)
    assert numbers == list(range(1, 14)) and set(queries.ORACLE) <= set(queries.QUERIES)


def test_pipeline_equals_brute_force(spark):
    docs = common.table(spark, SF, "documents")
    model = toxicity.fit(docs, common.table(spark, SF, "labels"))
    rows = docs.collect()
    raw, offs = common.byte_view(pa.array([r.text for r in rows], pa.string()))
    left = [(r.doc_id, r.text) for r, s in zip(rows, model.score(raw, offs)) if s < 0.5]
    first = {}
    for i, t in sorted(left):
        first.setdefault(norm(t), i)
    left = [(i, t) for i, t in left if first[norm(t)] == i]
    left = [(i, t) for (i, t), c in zip(sorted(left), brute_components(left)) if c[2] == i]
    items = [tuple(r) for r in common.table(spark, SF, "benchmark").collect()]
    clean = {m[0] for m in brute_marks(left, items) if not m[5]}
    got = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in got.collect()} == clean and 0 < len(clean) < len(rows)
