"""Spot signatures, source divergence and spelling variants against brute force;
clashing names, null and repeated ids, long words; whole queries in plain Python."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapfold.llm import common, decontam, divergence, packing, pii, sharding, sigtree, spelling, spotsigs, toxicity, urlrules

SF = "/root/testdata/sf0.001"


def rows_of(path, *cols):
    import pyarrow.parquet as pq

    t = pq.read_table(f"{SF}/{path}.parquet", columns=list(cols)).to_pydict()
    return list(zip(*(t[c] for c in cols)))


# ------------------------------------------------------------ fingerprints


def spot_bag(text, common_words):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = []
    for i, w in enumerate(words):
        if w in common_words or not any(x in common_words for x in words[max(i - 6, 0) : i]):
            found.append(" ".join([w] + [x for x in words[i + 1 : i + 7] if x not in common_words][:2]))
    if len(words) <= 16:
        found += words
    if not words and text:
        found = [text]
    out = set()
    for s, n in Counter(found).items():
        out |= {hashlib.md5((s if j == 1 else f"{s}#{j}").encode()).hexdigest()[:12] for j in range(1, n + 1)}
    return out


def jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


TEXTS = [None, "", " .", "one", "The cat sat on the mat and the dog ran", "the cat SAT on the mat, and the dog ran", "x " * 40, "alpha beta gamma delta " * 30, "é ü the ß and œ" * 9, "the " * 30]


def test_spot_sets_and_likeness_equal_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r.doc_id: r for r in spotsigs.with_set(docs.na.fill({"text": ""}), ["and", "the"]).collect()}
    sets = [spot_bag(t, {"and", "the"}) for t in TEXTS]
    for i, s in enumerate(sets):
        assert got[i].spots == sorted(s), TEXTS[i]
    assert sets[4] == sets[5]
    pairs = spark.createDataFrame([(i, j, got[i].spots, got[j].spots) for i in range(10) for j in range(10)], "i int, j int, a array<string>, b array<string>")
    for r in pairs.select("i", "j", spotsigs.likeness("a", "b").alias("l")).collect():
        assert r.l == jaccard(sets[r.i], sets[r.j])


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_near_pairs_equal_brute_force(spark, threshold):
    rng = np.random.default_rng(4)
    base = [[f"s{x}" for x in rng.choice(400, n, replace=False)] for n in (1, 3, 8, 8, 20, 40, 41, 90)]
    made = []
    for b in base:
        for k in (0, 1, 2, 5, 12):
            drop = min(k, len(b) - 1)
            made.append(sorted(set(b[drop:]) | {f"t{x}" for x in rng.choice(400, drop)}))
    made.append([])
    sets = spark.createDataFrame(list(enumerate(made)), "doc_id long, spots array<string>")
    got = {(r.query, r.doc): r.likeness for r in spotsigs.near_pairs(sets.where("doc_id % 3 = 0"), sets, threshold).collect()}
    want = {(i, j): jaccard(set(a), set(b)) for i, a in enumerate(made) if i % 3 == 0 for j, b in enumerate(made) if a and b and jaccard(set(a), set(b)) >= threshold}
    assert got == want and len(want) > 30


def test_next_documents_with_null_and_repeated_ids(spark):
    docs = [(5, "e"), (900, "z"), (5, "f"), (None, "n"), (-7, None), (1 << 62, "top"), (128, "g"), (None, "m"), (127, "h")]
    rows = spotsigs.with_next(spark.createDataFrame(docs, "doc_id long, text string"), []).collect()
    after = {(r.doc_id, r.text): r.next_text for r in rows}
    assert len(rows) == len(docs) and sorted(after.values()) == sorted(t or "" for _, t in docs)  # a ring through all rows
    fives = {t: after[(5, t)] for t in "ef"}
    assert sorted(fives.values()) in (["e", "h"], ["f", "h"]) and after[(127, "h")] == "g" and after[(128, "g")] == "z" and after[(900, "z")] == "top"
    assert {after[(1 << 62, "top")]} <= {"m", "n"} and after[(-7, "")] in ("e", "f")
    one = spotsigs.with_next(spark.createDataFrame([(3, "only")], "doc_id long, text string"), []).collect()
    assert [(r.text, r.next_text) for r in one] == [("only", "only")]
    assert spotsigs.with_next(spark.createDataFrame([], "doc_id long, text string"), []).count() == 0


def test_successors_over_wide_gaps(spark):
    keys = [-(1 << 62), -5, 0, 1, 4095, 4096, 1 << 30, (1 << 30) + 1, 1 << 61]
    got = dict(tuple(r) for r in spotsigs.successors(spark.createDataFrame([(k,) for k in keys], "k long")).collect())
    assert got == dict(zip(keys, keys[1:] + keys[:1]))


def test_op11_equals_plain_python(spark):
    docs = sorted(rows_of("documents", "doc_id", "lang", "text"))
    per = defaultdict(Counter)
    for _, lang, text in docs:
        per[lang].update(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))))
    common_words = {w for c in per.values() for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:16]}
    got = {r.doc_id: r for r in spotsigs.op11_spotsigs(spark, SF).collect()}
    assert len(got) == len(docs)
    for (i, _, text), (_, _, after) in list(zip(docs, docs[1:] + docs[:1]))[::3]:
        text, after = text or "", after or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = (spot_bag(t, common_words) for t in (text, edited, after))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == ("".join(sorted(a)), "".join(sorted(b)))
        assert (r.near_edited, r.near_next) == (jaccard(a, b), jaccard(a, c))


# -------------------------------------------------------------- divergence


def audit_of(docs, min_docs, top):
    """(lang, source, part, item, value, rank) by the definition."""
    uses, seen = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for lang, source, text in docs:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        uses[lang, source].update(terms)
        seen[lang].update(set(terms))
    out = set()
    for lang, source in groups:
        kept = sorted(t for t, n in seen[lang].items() if n >= min_docs)
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(uses[g])

        def p(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(x, y):
            return (x - y) ** 2 // (x + y)

        own, all_ = p(uses[lang, source]), p(whole)
        pairs = [(sum(f(own[t], q[t]) for t in kept), s) for s, q in ((s, p(uses[lang, s])) for la, s in groups if la == lang and s != source)]
        terms = [(f(own[t], all_[t]), t) for t in kept if uses[lang, source][t] > 0 and own[t] > all_[t]]
        for part, items, last in (("pair", pairs, None), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:last]
            out |= {(lang, source, part, item, v, k) for k, (v, item) in enumerate(ranked, 1)}
    return out


@pytest.mark.parametrize("blocks", [(32, 4096), (2, 5), (1, 1)])
def test_audit_equals_definition(spark, blocks):
    rng = np.random.default_rng(8)
    words = [f"w{chr(97 + i)}{'é' * (i % 3)}" for i in range(24)] + ["A", "a1b", "z" * 3000]
    docs = [(("de", "en", None)[i % 3], f"src{i % 5}" if i % 7 else None, " ".join(rng.choice(words, 12))) for i in range(90)]
    docs += [("xx", "lone", None), ("xx", "two", ""), ("yy", "only", "few words"), ("en", "silent", "1 2 3")]
    df = spark.createDataFrame([(1, *d, "c") for d in docs], "doc_id long, lang string, source string, text string, term string")
    got = [tuple(r) for r in divergence.audit(df, 10, 3, *blocks).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == audit_of(docs, 10, 3)


def test_audit_of_nothing_and_flushed_counts(spark, monkeypatch):
    assert divergence.audit(spark.createDataFrame([], "lang string, source string, text string")).count() == 0
    batch = [("a", "s", "x y X " * 5), ("a", "t", None), ("b", "s", "y")] * 4
    monkeypatch.setattr(divergence, "FLUSH", 1)
    monkeypatch.setattr(divergence, "CHUNK", 4)
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array([r[k] or "" for r in batch]) for k in range(3)], names=["lang", "source", "text"])
    total = Counter()
    for out in divergence._count(iter([b])):
        for r in out.to_pylist():
            total[r["lang"], r["source"], r["term"], "n"] += r["n"]
            total[r["lang"], r["source"], r["term"], "docs"] += r["docs"]
    assert total == {("a", "s", "x", "n"): 40, ("a", "s", "x", "docs"): 4, ("a", "s", "y", "n"): 20, ("a", "s", "y", "docs"): 4, ("b", "s", "y", "n"): 4, ("b", "s", "y", "docs"): 4}


def test_shares_are_exact():
    count = np.array([0, 1, 7, 10**12, 8 * 10**13], np.int64)
    total, v = 8 * 10**13, 12345
    want = [1 + 10**9 * (int(c) + 2) // (total + 2 * v) for c in count]
    assert divergence.shares(count, np.int64(total), v).tolist() == want


# ---------------------------------------------------------------- spelling


def variants_of(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    words = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = defaultdict(set)
    wild = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            wild[w[:i] + "\0" + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                near[w].add(w[:i] + w[i + 1 :])
                near[w[:i] + w[i + 1 :]].add(w)
    for g in wild.values():
        for w in g:
            near[w] |= g - {w}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best is not None and words[best] >= 10 * words[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words}


def test_spelling_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    letters = list("abcÀÿ")
    some = ["".join(rng.choice(letters, k)) for k in (7, 7, 8, 9, 10, 11, 18, 19, 20, 21, 40)]
    pool = []
    for w in some:
        pool += [w, w[:3] + w[4:], w[:2] + "b" + w[2:], w[:5] + "c" + w[6:], w + w[-1], w[0] + w]
    docs = []
    for i in range(900):
        docs.append((i, ", ".join(x for x in rng.choice(pool, 6, p=np.array([20.0 if k % 6 == 0 else 1.0 for k in range(len(pool))]) / sum(20.0 if k % 6 == 0 else 1.0 for k in range(len(pool)))))))
    docs += [(5000 + k, "aaaaaaab " * (300 // (k + 1))) for k in range(3)] + [(6000, "aaaaaaa aaaaaaa aaaaaab aaaaaab"), (6001, "AAAAAAAB aaaaaaab"), (None, "aaaaaaa"), (6002, None), (6003, "short É")]
    docs += [(7000 + k, " ".join(["q" * 4000, "q" * 4001, "q" * 1999 + "r" + "q" * 2000])) for k in range(2)]
    df = spark.createDataFrame([(*d, "w") for d in docs], "doc_id long, text string, word string")
    got = [tuple(r) for r in spelling.group_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = variants_of(docs)
    assert len(got) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in want) > 10 and max(r[4] for r in want) > 3


def test_roots_follow_forms(spark):
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb"]
    docs = [(i, f"{w} " * (2 * 12**k)) for i, (k, w) in enumerate(enumerate(chain))]
    got = {r.word: r for r in spelling.group_variants(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {tuple(r) for r in map(lambda r: (r.word, r.form, r.root, r.n, r.n_near, r.form_n), got.values())} == variants_of(docs)
    assert spelling.group_variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# ------------------------------------------------- names, nulls, long words


def test_working_columns_leave_the_tables_own_alone(spark):
    docs = spark.createDataFrame(
        [(111, "alpha beta gamma delta epsilon", 1, "s", 8, "p", "f"), (222, "alpha beta gamma delta zeta", 2, "t", 9, "q", "g"), (222, "other words here now", 3, "u", 7, "r", "h")],
        "_row long, text string, doc_id long, _spans string, _id long, pii string, _gone string",
    )
    bench = spark.createDataFrame([(1, "gamma delta zeta"), (2, "not here")], "item_id long, text string")
    for size in (1, 1000):
        kept = decontam.decontaminate(docs, bench, "drop", size=3, block_rows=size)
        assert sorted((r._row, r.doc_id, r._spans, r._id) for r in kept.collect()) == [(111, 1, "s", 8), (222, 3, "u", 7)]
        cut = decontam.decontaminate(docs, bench, "cut", size=3, block_rows=size)
        assert cut.columns == docs.columns and sorted((r._row, r._spans, r._gone) for r in cut.collect()) == [(111, "s", "f"), (222, "t", "g"), (222, "u", "h")]
    same = docs.withColumn("doc_id", F.lit(4).cast("long"))
    assert sorted(r._row for r in sigtree.drop_near_copies(same).collect()) == [111, 222, 222]
    assert sorted((r._row, r._gone) for r in sigtree.drop_near_copies(docs).collect()) == [(111, "f"), (222, "g"), (222, "h")]
    found = pii.pseudonymise(docs.withColumn("text", F.lit("mail a.b@c.de")), "k")
    assert [r.pii for r in found.orderBy("doc_id").collect()] == ["p", "q", "r"] and found.columns[-1] == "_pii"
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.keep_clean(docs, model).columns == docs.columns


def test_null_items_are_hit_and_counted(spark):
    docs = spark.createDataFrame([(1, "one two three four"), (2, "five")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, "two three"), (7, "three four"), (None, "five")], "item_id long, text string")
    for size in (1, 1000):
        got = {r.doc_id: r for r in decontam.marks(docs, bench, 2, block_rows=size).collect()}
        assert got[1].items == [7, None] and got[1].spans[0].first == 1 and got[2].items == [None]


def test_patterned_long_words_do_not_collide(spark):
    t = "a"
    for _ in range(10):
        t += t.translate({97: 98, 98: 97})
    other = t.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, t), (2, other), (3, t.upper())], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in sigtree.similarity_components(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_without_ids_is_an_anti_join(spark):
    docs = spark.createDataFrame([(i if i % 10 else None, f"t{i}") for i in range(300)], "doc_id int, text string")
    gone = spark.createDataFrame([(i,) for i in range(0, 300, 3)], "g long")
    got = sorted(r.text for r in common.without_ids(docs, gone, "doc_id").collect())
    assert got == sorted(f"t{i}" for i in range(300) if i % 10 == 0 or i % 3)


def test_rules_take_line_breaks_in_hosts_and_any_number_of_rules(spark):
    urls = ["http://a\nb.org/x", "http://b.org\n/x", "http://org/x", "http://a.com/fr/1", "http://a.b.com/de/x/y", "no scheme", None, "http://x9.com/p9/q", "http://x9.com/p9/qq"]
    pages = spark.createDataFrame([(i % 7, u) for i, u in enumerate(urls)], "page_id long, url string")
    many = urlrules.RULES + tuple(urlrules.Rule("block" if i % 2 else "allow", f"x{i}.com", f"/p{i}/q") for i in range(4000))

    def plain(url, rules):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host) :]).group()
        host = host.lower()
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fit, key=lambda r: len(r.name), default=None)
        return (host, path, best and best.name, best.verdict if best else "allow")

    for rules in (urlrules.RULES, many):
        got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urlrules.judge(pages, rules).collect()), key=str)
        assert got == sorted(((i % 7, *plain(u, rules)) for i, u in enumerate(urls)), key=str)


def test_null_and_repeated_ids_spread_over_shards(spark):
    docs = spark.range(4000).select(F.when(F.col("id") < 2000, F.lit(None)).otherwise(F.lit(9)).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    per = {r.shard: r["sum(size)"] for r in sharding.assign(docs, shards=4).groupBy("shard").sum("size").collect()}
    assert len(per) == 4 and max(per.values()) < 1.01 * min(per.values())


def test_phone_numbers_stay_linked_with_and_without_separators(spark):
    forms = ["+49 30 12345678", "+493012345678", "+44 20 7946 0958", "+442079460958", "+1 (212) 555-0123", "+12125550123", "+358 9 123 4567", "+35891234567"]
    docs = spark.createDataFrame(list(enumerate(f"call {x} now" for x in forms)), "doc_id long, text string")
    out = [re.sub(r"[^0-9+]", "", r.text) for r in pii.pseudonymise(docs, "k").orderBy("doc_id").collect()]
    for a, b, code in zip(out[::2], out[1::2], ("+49", "+44", "+1", "+358")):
        assert a == b and a.startswith(code)
    assert all(re.sub(r"[^0-9+]", "", f) != o for f, o in zip(forms, out))


# --------------------------------------------------- queries in plain Python


def test_op7_equals_the_contract(spark):
    docs = {i: t or "" for i, t in rows_of("documents", "doc_id", "text")}
    got = sharding.op7_sharding(spark, SF).collect()
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in docs.items()}
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(40))


def test_op2_equals_tokenizers(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import sys

    sys.path.insert(0, "/opt/tokenizers")
    public = pytest.importorskip("public_tokenizers")
    tok = tokenizers.Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows_of("documents", "doc_id", "text")}
    got = packing.op2_packing(spark, SF).collect()
    pieces, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for held, want in [(p, len(ids[i])) for i, p in pieces.items()] + [(s, sum(n for _, n in s)) for s in seqs.values()]:
        held.sort()
        assert held[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(held, held[1:])) and sum(n for _, n in held) == want
    assert all(sum(n for _, n in s) <= 2048 for s in seqs.values())


def words_of(text, pattern):
    return re.findall(pattern, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_op5_equals_brute_force(spark):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = defaultdict(set)
    for item, text in rows_of("benchmark", "item_id", "text"):
        w = words_of(text, pattern)
        for k in range(max(len(w) - 12, 1) if w else 0):
            windows[tuple(w[k : k + 13])].add(item)
    sizes = {len(w) for w in windows}
    got = {r.doc_id: r for r in decontam.op5_decontamination(spark, SF).collect()}
    hits = 0
    for i, text in rows_of("documents", "doc_id", "text"):
        w, hit, items = words_of(text, pattern), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    items |= own
        digest = hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()
        assert tuple(got[i])[1:] == (len(w), len(hit), len(items), digest, len(hit) > 0 and 20 * len(hit) >= len(w))
        hits += bool(hit)
    assert hits and len(got) == len(rows_of("documents", "doc_id"))


def test_op8_equals_brute_force(spark):
    sets = {}
    for i, text in rows_of("documents", "doc_id", "text"):
        w = words_of(text, r"[^\x20\x09-\x0D]+")
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(len(w) - 3, 1))} if w else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * min(len(sets[a]), len(sets[b])) >= 85 * max(len(sets[a]), len(sets[b])):
                both = len(sets[a] & sets[b])
                if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in sigtree.op8_jaccard_join(spark, SF).collect()}
    assert got == {i: (len(sets[i]), find(i)) for i in ids}


def test_op1_replaces_the_same_values_everywhere_and_nothing_else(spark):
    docs = dict(rows_of("documents", "doc_id", "text"))
    digest = {r.doc_id: r for r in pii.op1_pii(spark, SF).collect()}
    source = common.table(spark, SF, "documents").select("doc_id", "text")
    told = {}
    for r in pii.pseudonymise(source, "pseudonym-key-of-the-query").collect():
        text, new, values = docs[r.doc_id], r.text, [(p.kind, p.value) for p in r.pii]
        d = digest[r.doc_id]
        assert (d.text, d.n_values, d.kinds) == (new, len(values), ",".join(sorted(k for k, _ in values)))
        if text is None:
            assert new is None
            continue
        at = 0
        for m in re.finditer(pii.FOUND.replace("++@", "+@"), text):
            assert new.startswith(text[at : m.start()])  # nothing changes outside the candidates
            new = new[m.start() - at :]
            value = values[0][1] if values and new.startswith(values[0][1]) else m.group()
            if value != m.group():
                values.pop(0)
            assert new.startswith(value) and told.setdefault(m.group(), value) == value
            new, at = new[len(value) :], m.end()
        assert new == text[at:] and not values
    assert sum(a != b for a, b in told.items()) > 5


def test_ftrl_equals_its_definition():
    rng = np.random.default_rng(1)
    f = toxicity.Ftrl()
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        return 0.0 if abs(z[i]) <= f.l1 and i < toxicity.DIM else -(z[i] - np.sign(z[i]) * f.l1) / ((f.beta + np.sqrt(n[i])) / f.alpha + f.l2)

    for _ in range(60):
        x = np.unique(rng.integers(0, 40, 9))
        y = int(3 in x or 5 in x)
        f.learn(x, y)
        own = [*x.tolist(), toxicity.DIM]
        p = 1 / (1 + np.exp(-np.clip(sum(weight(i) for i in own), -35, 35)))
        g = p - y
        for i in own:
            w = weight(i)
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / f.alpha
            z[i] += g - sigma * w
            n[i] += g * g
    at, w = f.model()
    got = dict(zip(at.tolist(), w.tolist()))
    want = {i: weight(i) for i in z if weight(i) != 0}
    assert set(got) == set(want) and len(want) > 2 and all(got[i] == pytest.approx(want[i], rel=1e-5) for i in want)


def test_blocks_of_one_token_grow_in_proportion(spark):
    def rows(n, comps):
        df = spark.range(n).select(F.lit(5).cast("long").alias("token"), F.col("id").alias("rep"), F.lit(40).cast("long").alias("n"), (F.col("id") % comps).alias("comp"), F.lit(40).cast("long").alias("rest"))
        return sigtree._blocks(df, 2048)

    assert [rows(n, n).count() for n in (10_000, 80_000)] == [10_000, 80_000]
    chunks = rows(20_000, 20_000).where("k > 1")
    probes = chunks.where("rep < 30")
    asked = sigtree._asked(chunks, probes, 2048)
    assert asked.count() == 20_000 + 30 * 9
    met = {(r.p, r.q) for r in asked.where("probe").select(F.col("rep").alias("p"), "token", "i", "j").join(asked.where("not probe").select("token", "i", "j", F.col("rep").alias("q")), ["token", "i", "j"]).where("q < 2000").collect()}
    own = {r.rep: r.i for r in chunks.where("rep < 2000").collect()}
    assert met == {(p, q) for p in range(30) for q in range(2000) if own[p] != own[q]}


def test_large_groups_of_near_copies_over_many_chunks(spark):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(600)]
    base, other = rng.choice(words, 60).tolist(), rng.choice(words, 60).tolist()
    texts = []
    for k in range(160):
        t = list(base if k < 120 else other)
        for at in rng.choice(60, 1):
            t[at] = f"x{k}"
        texts.append(" ".join(t))
    texts += [" ".join(rng.choice(words, 60)) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in sigtree.similarity_components(docs).collect()}
    split = {r.doc_id: r.component_id for r in sigtree.similarity_components(docs, chunk_bytes=4096, chunk_rows=4).collect()}
    assert whole == split and len({whole[i] for i in range(120)}) < 60
