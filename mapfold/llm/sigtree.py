"""Exact n-gram Jaccard join by signature trees.

A document is the set of its distinct 4-word shingles (64-bit hashes).  Two
documents link when their sets' Jaccard similarity is at least 0.85; the result
is the connected components of all links.

Within a block of records a signature tree is built: a leaf holds a record's
token bitmap and size, a node the OR of its children's bitmaps and their size
range.  Two trees (or one with itself) are traversed together, and a pair of
nodes is left out when no pair below it can link: sizes too far apart, or

    overlap <= bits set in both + the most tokens of one record that share a bit

less than the overlap that the smallest sizes need.  Records of one power-of-two
size class share a bitmap width; neighbouring classes are compared at the
narrower width, classes further apart cannot link.  Pairs of leaves that remain
are verified on the full sets, and a union-find leaves out pairs that are
already connected, so a group of near copies costs about one verification per
record instead of one per pair.

Blocks come from the prefix principle: ordered by one global order of tokens
(rare before frequent, then by hash), two linked documents share a token among
the first n - ceil(0.85 n) + 1 of each.  The order needs no exact counts: any
order is right, a good one makes blocks small.  The steps are

1. equal sets become one class with the smallest id as its representative;
2. records of one token are split by power-of-two size class, and a record near the
   end of its class is a guest of the next one too (linked sizes differ by less), so
   short texts never meet the long ones; a (token, class) key that two or more
   representatives' prefixes hold, found by a count, is a block (blocks of the very
   same records count once);
3. light rows (size and bitmap) of every block go through the tree, which marks the
   records that keep a possible partner; only these bring their full sets;
4. every such record goes to one block, that of its first marked token, where pairs
   are verified (blocks over ``chunk_bytes`` are split and four records of each
   component found join again in further levels);
5. what that cannot have seen: every marked token whose records are not yet one
   component is a block once more, first light and then with the sets of the records
   that keep a partner of another component.  This step makes the result exact
   whatever step 4 found.

Blocks over ``chunk_rows`` are split into chunks.  In step 3 a record that finds a
possible partner in its own chunk is settled, and only the others go to the
token's other chunks; in step 5 only records outside the token's largest component
do.  So a token with very many near copies costs rows in proportion to them, and
rows for all pairs of chunks arise only from as many records that are like none of
their own chunk.

Nothing but light rows of bounded size reaches the driver: the most frequent
tokens (at most 2^18, used for the order only) and fixed-size membership bitmaps
whose false positives cost work, never results.

Defined cases: null and empty texts have no shingles and are components of their
own; texts of fewer than four words are one shingle; very long texts are taken
whole (their bitmaps stop growing at 2^16 bits, which only prunes less); equal
texts, ties and repeated rows share a component; rows with a null id are classed
by their text under the other rows' ids; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mapfold.llm.common import BLANK_WORDS, Membership, byte_view, components, distinct, fresh, lists, mix, ngrams, pieces, ship, slices, stored, table, without_ids, words, xxhash64_long

SHINGLE = 4
PERCENT = 85
FREQUENT = 1 << 18
MAX_BITS = 1 << 16
FANOUT = 8


# ------------------------------------------------------------------ the tree


class Node:
    __slots__ = ("lo", "hi", "bits", "spare", "comp", "kids", "at", "rest", "up", "left")

    def __init__(self, lo, hi, bits, spare, comp, kids, at, rest):
        self.lo, self.hi, self.bits, self.spare, self.comp, self.kids, self.at, self.rest = lo, hi, bits, spare, comp, kids, at, rest
        self.up, self.left = None, len(kids) if kids else 1
        for k in kids or ():
            k.up = self

    def mark(self) -> None:
        """This leaf needs no further partner; a node is done when all its kids are."""
        node = self if self.left else None
        while node is not None:
            node.left -= 1
            node = node.up if node.left == 0 else None


def width(n: int) -> int:
    """Bits of the bitmap of a set of n tokens."""
    return min(max(64, 1 << (2 * n - 1).bit_length()), MAX_BITS)


def bitmap(tokens: np.ndarray, m: int) -> bytes:
    flags = np.zeros(m, np.uint8)
    flags[(tokens & np.uint64(m - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def tree(rows: list[tuple[int, int, int, int, int]], fold_to: int | None = None) -> Node:
    """Signature tree over (place, size, bits, component, rest) rows, in their order;
    ``fold_to`` halves the bitmaps to that width."""
    level = []
    for at, n, bits, comp, rest in rows:
        if fold_to:
            bits = (bits >> fold_to) | (bits & ((1 << fold_to) - 1))
        level.append(Node(n, n, bits, n - bits.bit_count(), comp, None, at, rest))
    while len(level) > 1:
        up = []
        for i in range(0, len(level), FANOUT):
            kids = level[i : i + FANOUT]
            bits, comp = 0, kids[0].comp
            for k in kids:
                bits |= k.bits
                if k.comp != comp:
                    comp = None
            up.append(Node(min(k.lo for k in kids), max(k.hi for k in kids), bits, max(k.spare for k in kids), comp, kids, -1, max(k.rest for k in kids)))
        level = up
    return level[0]


def surviving(a: Node, b: Node, percent: int = PERCENT) -> Iterator[tuple[Node, Node]]:
    """Pairs of leaves that the dual traversal of two trees cannot rule out; pairs
    of nodes that are both marked off are left out."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if x.left == 0 and y.left == 0:
            continue
        if x is y:
            if x.kids and (x.comp is None):
                k = x.kids
                stack.extend((k[i], k[j]) for i in range(len(k)) for j in range(i, len(k)))
            continue
        if 100 * x.hi < percent * y.lo or 100 * y.hi < percent * x.lo or (x.comp is not None and x.comp == y.comp):
            continue
        both = (x.bits & y.bits).bit_count()
        most = min(both + x.spare, both + y.spare, x.rest, y.rest)
        if (100 + percent) * most < percent * (x.lo + y.lo):
            continue
        if x.kids is None and y.kids is None:
            yield x, y
        elif y.kids is None or (x.kids is not None and x.hi - x.lo >= y.hi - y.lo):
            stack.extend((k, y) for k in x.kids)
        else:
            stack.extend((x, k) for k in y.kids)


def block_pairs(sizes: list[int], sigs: list[bytes], comps: list, rests: list[int]) -> Iterator[tuple[Node, Node]]:
    """Surviving pairs of a whole block: trees per size class, and neighbouring classes."""
    classes: dict[int, list] = {}
    apart = len(set(comps)) == len(comps)
    for at in sorted(range(len(sizes)), key=lambda i: (0 if apart else comps[i], sizes[i])):
        classes.setdefault(8 * len(sigs[at]), []).append((at, sizes[at], int.from_bytes(sigs[at], "little"), comps[at], rests[at]))
    for m, rows in sorted(classes.items()):
        own = tree(rows)
        yield from surviving(own, own)
        if 2 * m in classes:
            yield from surviving(own, tree(classes[2 * m], m))


class Links:
    """Union-find over the places of a block."""

    def __init__(self, comps: list):
        self.up = list(range(len(comps)))
        first: dict = {}
        for i, c in enumerate(comps):
            self.up[i] = first.setdefault(c, i)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


# ------------------------------------------------------------- sets in Arrow


def sets(raw: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text of a byte view."""
    for i, j in slices(offs):
        _, _, h, first = words(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i], BLANK_WORDS)
        g = ngrams(h, size) if len(h) >= size else None
        for a, b in zip(first[:-1], first[1:]):
            yield distinct(g[a : b - size + 1] if b - a >= size else ngrams(h[a:b], size))


def need(n: int, percent: int = PERCENT) -> int:
    return -(-percent * n // 100)


def size_class(n: int, percent: int = PERCENT) -> tuple[int, bool]:
    """Power-of-two class of a set of n tokens, and whether it can link into the next class."""
    c = max(n, 1).bit_length() - 1
    return c, 100 * n >= percent << (c + 1)


class Order:
    """Global token order: unlisted tokens by hash, then listed ones from rare to frequent."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        by = np.argsort(tokens)
        self.tokens = tokens[by]
        rank = np.lexsort((tokens, counts))
        self.rank = np.empty(len(tokens), np.int64)
        self.rank[rank] = np.arange(len(tokens))
        self.rank = self.rank[by]

    def prefix(self, s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
        n = len(s)
        if n == 0:
            return s
        p = n - need(n, percent) + 1
        if len(self.tokens) == 0:
            return s[:p]
        at = np.searchsorted(self.tokens, s)
        at[at == len(self.tokens)] = 0
        listed = self.tokens[at] == s
        late = np.flatnonzero(listed)
        late = late[np.argsort(self.rank[at[late]])]
        return np.concatenate([s[~listed], s[late]])[:p]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def survey(docs: DataFrame, size: int = SHINGLE, local_min: int = 2, flush: int = 3_000_000) -> DataFrame:
    """kind 0: (id, n, set fingerprint in a and b) of every row; kind 1: tokens (a) that occur in
    ``local_min`` rows or more of some stretch of a task, with that count (n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def frequent() -> pa.RecordBatch:
            t, c = np.unique(np.concatenate(held), return_counts=True)
            t, c = t[c >= local_min], c[c >= local_min]
            return rows(np.ones(len(t), np.int32), pa.nulls(len(t), pa.int64()), c, _signed(t), np.zeros(len(t), np.int64))

        for batch in pieces(batches):
            n, a, b = [], [], []
            for s in sets(*byte_view(batch.column(1)), size):
                n.append(len(s))
                a.append(mix(s).sum(dtype=np.uint64))
                b.append(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                held.append(s)
                n_held += len(s)
                if n_held >= flush:
                    yield frequent()
                    held, n_held = [], 0
            yield rows(np.zeros(len(n), np.int32), batch.column(0), np.array(n, np.int64), _signed(np.array(a, np.uint64)), _signed(np.array(b, np.uint64)))
        if held:
            yield frequent()

    def rows(kind, ids, n, a, b) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), ids, pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["kind", "id", "n", "a", "b"])

    return docs.mapInArrow(run, "kind int, id long, n long, a long, b long")


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """(key, columns) of each run of rows equal in the first ``keys`` columns."""
    at, cols = None, None
    for b in batches:
        data = [c.to_pylist() for c in b.columns]
        if not b.num_rows:
            continue
        marks = list(zip(*data[:keys]))
        i = 0
        while i < len(marks):
            j = i + 1
            while j < len(marks) and marks[j] == marks[i]:
                j += 1
            if marks[i] == at:
                for c, d in zip(cols, data[keys:]):
                    c.extend(d[i:j])
            else:
                if at is not None:
                    yield at, cols
                at, cols = marks[i], [d[i:j] for d in data[keys:]]
            i = j
    if at is not None:
        yield at, cols


def linked(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rep, root) of every record of the blocks ``keys`` of (n, rep, comp, sig, tokens) rows:
    root is one record for all that are connected within the block."""

    def run(batches):
        for key, (n, rep, comp, sig, tok) in groups(batches, len(keys)):
            if len(rep) < 2:
                continue
            full = [np.frombuffer(t, np.uint64) for t in tok]
            links = Links(comp)
            for x, y in block_pairs(n, sig, comp, n):
                i, j = links.find(x.at), links.find(y.at)
                if i != j and similar(full[x.at], full[y.at]):
                    links.up[max(i, j)] = min(i, j)
            root = [rep[links.find(i)] for i in range(len(rep))]
            cols = [pa.array([k] * len(rep), pa.int64()) for k in key] + [pa.array(rep, pa.int64()), pa.array(root, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "rep", "root"])

    ordered = blocks.select(*keys, "n", "rep", "comp", "sig", "toks").repartition(*keys).sortWithinPartitions(*keys, "rep")
    return ordered.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", rep long, root long")


def hopeful(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rep, comp, rest) of the records that keep a partner of another component after the
    traversal of light rows (n, rep, comp, rest, sig)."""

    def run(batches):
        for key, (n, rep, comp, rest, sig) in groups(batches, len(keys)):
            if len(rep) < 2:
                continue
            left: set[int] = set()
            for x, y in block_pairs(n, sig, comp, rest):
                left.update((x.at, y.at))
                x.mark()
                y.mark()
            if left:
                cols = [pa.array([k] * len(left), pa.int64()) for k in key]
                cols += [pa.array([c[i] for i in left], pa.int64()) for c in (rep, comp, rest)]
                yield pa.RecordBatch.from_arrays(cols, names=[*keys, "rep", "comp", "rest"])

    ordered = blocks.select(*keys, "n", "rep", "comp", "rest", "sig").repartition(*keys).sortWithinPartitions(*keys, "rep")
    return ordered.mapInArrow(run, ", ".join(f"{k} long" for k in keys) + ", rep long, comp long, rest long")


# ------------------------------------------------------------------ the join


def similarity_components(docs: DataFrame, size: int = SHINGLE, chunk_bytes: int = 16 << 20, chunk_rows: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row; component_id is the component's smallest doc_id."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = stored(survey(docs, size), "join-survey")
    whole = found.where("kind = 0")
    if _unlike(whole).limit(1).count():
        _, named = _by_row(docs, "doc_id", size=size, chunk_bytes=chunk_bytes, chunk_rows=chunk_rows)
        return named.drop("_row")
    top = found.where("kind = 1").groupBy("a").agg(F.sum("n").alias("n")).where("n >= 8").orderBy(F.desc("n"), "a").limit(FREQUENT).toPandas()  # at most 2^18 rows of 16 bytes
    order = sc.broadcast(Order(top["a"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64)))
    classes = stored(whole.where("n > 0").groupBy("n", "a", "b").agg(F.min("id").alias("rep")), "join-classes")
    is_rep = sc.broadcast(Membership.build(classes, "rep"))

    def reps(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(0)
        return batch.filter(pc.and_(ids.is_valid(), pa.array(is_rep.value.test(ids.fill_null(0).to_numpy(zero_copy_only=False)))))

    def prefixes(batches):
        for b in pieces(batches):
            mine = reps(b)
            own = list(sets(*byte_view(mine.column(1)), size))
            first = [order.value.prefix(s) for s in own]
            sizes = [len(s) for s in own]
            cls, guest = zip(*(size_class(n) for n in sizes)) if sizes else ((), ())
            cols = [mine.column(0), pa.array(sizes, pa.int64()), pa.array(cls, pa.int64()), pa.array(guest, pa.bool_()), pa.array([bitmap(s, width(n)) for s, n in zip(own, sizes)], pa.binary()), lists(first, np.array([len(p) for p in first], np.int64), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["rep", "n", "cls", "guest", "sig", "tokens"])

    light = stored(docs.mapInArrow(prefixes, "rep long, n long, cls long, guest boolean, sig binary, tokens array<long>"), "join-light")
    # a block's key is its token with the class mixed in
    own_key, next_key = (F.col("token").bitwiseXOR(F.xxhash64(F.col("cls") + k)) for k in (0, 1))
    each = light.select("cls", "guest", F.explode("tokens").alias("token"))
    each = each.select(F.explode(F.when(F.col("guest"), F.array(own_key, next_key)).otherwise(F.array(own_key))).alias("token"))
    shared = each.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    is_shared = sc.broadcast(Membership.build(shared, "token"))

    def passing(batches):
        for b in batches:
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False)
            count = b.column(2).value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(b.num_rows), count)
            rest = b.column(1).to_numpy()[row] - (np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count))
            cls = b.column(3).to_numpy()[row]
            guest = b.column(4).to_numpy(zero_copy_only=False).astype(bool)[row]
            for up, here in ((0, np.ones(len(flat), bool)), (1, guest)):
                key = flat[here] ^ xxhash64_long(cls[here] + up).view(np.int64)
                hit = np.flatnonzero(is_shared.value.test(key)) if len(key) else np.zeros(0, np.int64)
                at = pa.array(row[here][hit])
                yield pa.RecordBatch.from_arrays([pa.array(key[hit], pa.int64()), b.column(0).take(at), b.column(1).take(at), pa.array(rest[here][hit], pa.int64())], names=["token", "rep", "n", "rest"])

    rows = stored(light.select("rep", "n", "tokens", "cls", "guest").mapInArrow(passing, "token long, rep long, n long, rest long"), "join-shared")
    sigs = light.select("rep", "sig")
    keys = ["token", "i", "j"]
    chunks = stored(_blocks(rows.withColumn("comp", F.col("rep")), chunk_rows), "join-chunks")
    near = stored(hopeful(chunks.join(sigs, "rep"), keys).select("token", "rep", "rest"), "join-near")
    # only records without a partner in their own chunk ask the other chunks of the token
    large = chunks.where("k > 1")
    probes = stored(large.join(near.select("token", "rep"), ["token", "rep"], "left_anti"), "join-probes")
    asked = _asked(large, probes, chunk_rows)
    # chunk and probes are two components here: pairs within either are settled
    asked = asked.withColumn("comp", F.col("probe").cast("long")).drop("probe")
    far = hopeful(asked.join(sigs, "rep"), keys).select("token", "rep", "rest")
    marked = stored(near.union(far).distinct(), "join-marked")
    home = stored(marked.groupBy("rep").agg(F.max_by("token", "rest").alias("home")), "join-home")
    is_near = sc.broadcast(Membership.build(home, "rep"))

    def records(batches):
        names = ["rep", "n", "sig", "toks"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for b in pieces(batches):
            ids = b.column(0)
            mine = b.filter(pc.and_(ids.is_valid(), pa.array(is_near.value.test(ids.fill_null(0).to_numpy(zero_copy_only=False)))))
            out: list[list] = [[] for _ in names]
            held = 0
            for rep, s in zip(mine.column(0).to_pylist(), sets(*byte_view(mine.column(1)), size)):
                for c, v in zip(out, (rep, len(s), bitmap(s, width(len(s))), s.tobytes())):
                    c.append(v)
                held += 8 * len(s)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)
                    out, held = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    held = stored(docs.mapInArrow(records, "rep long, n long, sig binary, toks binary").join(home, "rep").dropDuplicates(["rep"]), "join-records")
    near = stored(_home_links(held, chunk_bytes), "join-links")
    comps = components(near, "rep", "root")
    more = _rest_links(marked, held, comps, chunk_rows)
    if more.limit(1).count():
        comps = components(near.union(more), "rep", "root")
    whole = whole.join(classes, ["n", "a", "b"], "left")
    whole = whole.join(comps, whole["rep"] == comps["node"], "left")
    return whole.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("comp", "rep", "id").alias("component_id"))


def _unlike(whole: DataFrame) -> DataFrame:
    """Ids that cannot key a record: null, or on rows of different sets."""
    ends = [f(c).alias(f"{c}{k}") for c in ("n", "a", "b") for k, f in ((0, F.min), (1, F.max))]
    return whole.groupBy("id").agg(*ends).where("(id is null and n1 > 0) or n0 != n1 or a0 != a1 or b0 != b1")


def _by_row(docs: DataFrame, id_col: str, key: str = "_row", **how) -> tuple[DataFrame, DataFrame]:
    """The rows of ``docs`` under a ``key`` of their own, and (_row, doc_id, n_shingles, component_id) of each."""
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "join-rows")
    made = similarity_components(rows, id_col=key, **how).select(F.col("doc_id").alias("_row"), "n_shingles", F.col("component_id").alias("root"))
    named = stored(made.join(rows.select(F.col(key).alias("_row"), F.col(id_col).cast("long").alias("doc_id")), "_row"), "join-named")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows, named.join(least, "root").select("_row", "doc_id", "n_shingles", "component_id")


def _home_links(held: DataFrame, chunk_bytes: int, levels: int = 6) -> DataFrame:
    """Step 4: (rep, root) links found in the records' home blocks."""
    members = held.select("home", "rep")
    light = held.select("home", "rep", "n")
    found = None
    for level in range(levels):
        weight = light if level == 0 else light.join(members.select("rep"), "rep", "left_semi")
        per = weight.groupBy("home").agg(F.sum(8 * F.col("n")).alias("bytes"), F.count(F.lit(1)).alias("c")).where("c > 1")
        large = stored(per.where(F.col("bytes") > chunk_bytes).select("home", F.ceil(F.col("bytes") / chunk_bytes).alias("k")), "join-large")
        mine = held if level == 0 else held.join(members.select("rep"), "rep", "left_semi")
        blocks = mine.join(large, "home", "left").withColumn("part", F.pmod(F.xxhash64("rep", F.lit(level)), F.coalesce("k", F.lit(1))))
        out = stored(linked(blocks.withColumn("comp", F.col("rep")), ["home", "part"]), "join-blocks")
        links = out.where("rep != root").select("rep", "root")
        found = links if found is None else found.union(links)
        if large.limit(1).count() == 0:
            return found
        # the components of a split block go on with four records each
        inside = Window.partitionBy("home", "part", "root").orderBy(F.xxhash64("rep"))
        next_members = out.join(large.select("home"), "home", "left_semi").withColumn("i", F.row_number().over(inside)).where("i <= 4").select("home", "rep")
        members = stored(next_members, "join-members")
    return found


def _blocks(rows: DataFrame, chunk_rows: int) -> DataFrame:
    """(token, i, j, k, rep, n, comp, rest) of the blocks of (token, rep, n, comp, rest) rows that may
    hold a link between components, dealt into k chunks i each (j is 0); of blocks with the same
    records one is kept.  Every row is in one chunk of its block."""
    open_tokens = (
        rows.groupBy("token")
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.min("comp").alias("c0"),
            F.max("comp").alias("c1"),
            F.min("n").alias("n0"),
            F.max("n").alias("n1"),
            F.min("rest").alias("r0"),
            F.sum("rest").alias("early"),
            F.bit_xor(F.xxhash64("rep")).alias("x"),
            F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"),
        )
        .where(f"c0 != c1 and (c > 2 or (100 * n0 >= {PERCENT} * n1 and {100 + PERCENT} * r0 >= {PERCENT} * (n0 + n1)))")
        .groupBy("c", "x", "y")
        .agg(F.max_by("token", "early").alias("token"))  # the earliest of the order, for every record of the block
        .select("token", F.ceil(F.col("c") / chunk_rows).alias("k"))
    )
    left = rows.join(open_tokens, "token").withColumn("i", F.pmod(F.xxhash64("rep"), F.col("k")))
    return left.select("token", "i", F.lit(0).cast("long").alias("j"), "k", "rep", "n", "comp", "rest")


def _asked(chunks: DataFrame, probes: DataFrame, chunk_rows: int) -> DataFrame:
    """(token, i, j, probe, rep, n, comp, rest): every chunk i of a token together with the token's
    ``probes`` (some rows of its chunks), which are dealt into chunks j from 1 on; a probe does
    not come to its own chunk again."""
    per = probes.groupBy("token").agg(F.ceil(F.count(F.lit(1)) / chunk_rows).alias("u"))  # a token without probes has no rows
    part = F.explode(F.sequence(F.lit(1).cast("long"), F.col("u")))
    cols = ["token", "i", "j", "probe", "rep", "n", "comp", "rest"]
    still = chunks.drop("j").join(per, "token").withColumn("j", part).withColumn("probe", F.lit(False)).select(*cols)
    moved = probes.drop("j").join(per, "token").withColumn("j", F.pmod(F.xxhash64("rep", F.lit(1)), F.col("u")) + 1)
    other = F.explode(F.filter(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda i: i != F.col("i")))
    moved = moved.withColumn("to", other).drop("i").withColumnRenamed("to", "i").withColumn("probe", F.lit(True)).select(*cols)
    return still.union(moved)


def _rest_links(marked: DataFrame, held: DataFrame, comps: DataFrame, chunk_rows: int) -> DataFrame:
    """Step 5: (rep, root) links between records that are not yet connected."""
    keys = ["token", "i", "j"]
    known = held.select("rep", "n").join(comps, F.col("rep") == comps["node"], "left").select("rep", "n", F.coalesce("comp", "rep").alias("comp"))
    chunks = stored(_blocks(marked.join(known, "rep"), chunk_rows), "join-open")
    # a link between components has an end outside the token's largest one: those ask the other chunks
    large = chunks.where("k > 1")
    main = large.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("c")).groupBy("token").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"))
    probes = stored(large.join(main, "token").where("comp != main").drop("main"), "join-probes")
    left = chunks.drop("k").unionByName(_asked(large, probes, chunk_rows).drop("probe"))
    near = stored(hopeful(left.join(held.select("rep", "sig"), "rep"), keys), "join-hopeful")
    # what is left of many blocks are the very same records; one of these blocks is enough
    per = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("c"), F.bit_xor(F.xxhash64("rep")).alias("x"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("y"))
    one = per.groupBy("c", "x", "y").agg(F.min(F.struct(*keys)).alias("k")).select("k.*")
    near = near.join(one, keys, "left_semi")
    out = stored(linked(near.join(held.select("rep", "n", "sig", "toks"), "rep"), keys), "join-rest")
    # a root stands for its component too: records of one component share a root without a link
    return out.where("rep != root").select("rep", "root")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The smallest id of every component stays, with all its columns (rows that repeat that id in the
    component stay with it; a null id stays only if its whole component has none)."""
    ids = docs.groupBy(F.col(id_col).cast("long").alias("id")).count()
    if ids.where("id is null or count > 1").limit(1).count():
        key = fresh(docs.columns, "_row")
        rows, named = _by_row(docs, id_col, key, text_col=text_col)
        kept = named.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("_row").alias(key))
        return rows.join(kept, key, "left_semi").select(*docs.columns)
    gone = similarity_components(docs, id_col=id_col, text_col=text_col).where("component_id != doc_id").select("doc_id")
    return without_ids(docs, gone, id_col)


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Components of all documents linked at a Jaccard similarity of 0.85."""
    return similarity_components(table(spark, sf_dir, "documents"))
