"""Benchmark decontamination by a broadcast set of normalised word n-grams.

Words are runs of letters and digits with A-Z lower-cased.  A benchmark item's
windows are all its runs of 13 words (an item with fewer is one window).  The
windows' 64-bit hashes are broadcast; every document's word windows are hashed
in numpy and looked up, each hit is verified word by word, and the words covered
by verified windows are hit.

The broadcast is bounded: items are dealt into blocks of at most ``block_rows``
windows (counted by Spark first) and each block is a pass over the documents, so
a test set of any size keeps every task's set bounded.  With more than one block
the documents are stored under a key per row, one block after the other is
broadcast and dropped again, and the passes are merged per row.

Defined cases: null and empty texts have no words and are never contaminated;
items without words have no windows; repeated item ids count once; very long
texts are scanned whole; an empty benchmark leaves every document clean; further
columns of the documents pass through ``decontaminate`` unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import ALNUM_WORDS, byte_view, fresh, ngrams, ship, slices, stored, table, words

WINDOW = 13


class Windows:
    """Benchmark windows by length: sorted hashes and the (words, item) pairs of each."""

    def __init__(self, rows: list[tuple[int, int, int, bytes]]):
        self.by_len: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.own: dict[tuple[int, int], list[tuple[bytes, int]]] = {}
        for item, size, h, body in rows:
            self.own.setdefault((size, h), []).append((body, item))
        for size in sorted({k[0] for k in self.own}):
            hs = np.array(sorted(k[1] for k in self.own if k[0] == size), np.int64).view(np.uint64)
            hs.sort()
            quick = np.zeros(1 << 20, bool)
            quick[(hs & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            self.by_len[size] = (hs, quick)

    def hits(self, h: np.ndarray, size: int) -> np.ndarray:
        """Window starts in the word stream whose hash belongs to an item."""
        if len(h) < size:
            return np.zeros(0, np.int64)
        hs, quick = self.by_len[size]
        g = ngrams(h, size)
        at = np.flatnonzero(quick[(g & np.uint64((1 << 20) - 1)).astype(np.int64)])
        near = np.searchsorted(hs, g[at])
        near[near == len(hs)] = 0
        return at[hs[near] == g[at]]


def _word_list(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    return b" ".join(raw[a:b].tobytes() for a, b in zip(starts, ends)).lower()


def windows(benchmark: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, size, h, body) of every window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: dict[str, list] = {"item_id": [], "size": [], "h": [], "body": []}
            raw, offs = byte_view(b.column(1))
            for i, item in enumerate(b.column(0).to_pylist()):
                part = raw[offs[i] : offs[i + 1]]
                s, e, h, _ = words(part, np.array([0, len(part)]), ALNUM_WORDS)
                k = min(size, len(h))
                for j, g in enumerate(ngrams(h, size).view(np.int64).tolist()):
                    for c, v in zip(out, (item, k, g, _word_list(part, s[j : j + k], e[j : j + k]))):
                        out[c].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("item_id", pa.int64()), ("size", pa.int32()), ("h", pa.int64()), ("body", pa.binary())]))

    return benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).mapInArrow(run, "item_id long, size int, h long, body binary").distinct()


def scan(raw: np.ndarray, offs: np.ndarray, index: Windows) -> Iterator[tuple[int, np.ndarray, np.ndarray, int, list, set]]:
    """(row, word starts, word ends, number of words, hit word ranges, items) of a byte view's rows."""
    for i, j in slices(offs):
        base = offs[i]
        part = raw[base : offs[j]]
        s, e, h, first = words(part, offs[i : j + 1] - base, ALNUM_WORDS)
        owner = np.repeat(np.arange(j - i), np.diff(first))
        ranges: dict[int, list] = {}
        items: dict[int, set] = {}
        for size in index.by_len:
            at = index.hits(h, size)
            at = at[owner[at] == owner[at + size - 1]] if len(at) else at
            gram = ngrams(h, size)
            for a in at.tolist():
                body = _word_list(part, s[a : a + size], e[a : a + size])
                own = [item for text, item in index.own[(size, int(gram[a].view(np.int64)))] if text == body]
                if own:
                    d = int(owner[a])
                    ranges.setdefault(d, []).append((a - int(first[d]), a - int(first[d]) + size))
                    items.setdefault(d, set()).update(own)
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            at = offs[i + d] - base
            yield i + d, s[a:b] - at, e[a:b] - at, int(b - a), merged(ranges.get(d, [])), items.get(d, set())


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _blocks(benchmark: DataFrame, size: int, block_rows: int, id_col: str = "item_id", text_col: str = "text") -> list[DataFrame]:
    """The windows in blocks of about ``block_rows``; always at least one block."""
    all_windows = windows(benchmark, size, id_col, text_col)
    blocks = max(1, -(-all_windows.count() // block_rows))
    if blocks == 1:
        return [all_windows]
    return [all_windows.where(F.pmod(F.xxhash64("item_id", "h"), F.lit(blocks)) == k) for k in range(blocks)]


def _sent(block: DataFrame) -> Broadcast[Windows]:
    return block.sparkSession.sparkContext.broadcast(Windows([tuple(r) for r in block.collect()]))  # bounded by block_rows


MARKS = "n_words long, spans array<struct<first:int,last:int>>, items array<long>"


def _scanned(plain: DataFrame, held: Broadcast[Windows]) -> DataFrame:
    """The long columns of ``plain`` before its text, and MARKS of every row's text."""
    keys = plain.columns[:-1]
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    kinds = [*[(k, pa.int64()) for k in keys], ("n_words", pa.int64()), ("spans", pa.list_(span)), ("items", pa.list_(pa.int64()))]

    def run(batches):
        for b in batches:
            raw, offs = byte_view(b.column(len(keys)))
            found = list(scan(raw, offs, held.value))
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[: len(keys)],
                    pa.array([f[3] for f in found], pa.int64()),
                    pa.array([[{"first": x, "last": y} for x, y in f[4]] for f in found], pa.list_(span)),
                    pa.array([sorted(f[5], key=lambda x: (x is None, x or 0)) for f in found], pa.list_(pa.int64())),
                ],
                schema=pa.schema(kinds),
            )

    return plain.mapInArrow(run, ", ".join([*(f"{k} long" for k in keys), MARKS]))


def _passes(plain: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """As ``_scanned`` with all blocks, one at a time; ``plain`` is stored and its first column a key per row."""
    found = None
    for block in blocks:
        held = _sent(block)
        # the first pass brings every row, the others their hits
        one = stored(_scanned(plain, held).where(F.lit(found is None) | (F.size("spans") > 0)), "decontam-pass")
        held.destroy()
        found = one if found is None else found.union(one)
    # a row's marks only: bounded by its own words and the items that occur in it
    key, *others = plain.columns[:-1]
    return found.groupBy(key).agg(
        *[F.max(c).alias(c) for c in others],
        F.max("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    return stored(docs.withColumn(key, F.monotonically_increasing_id()), "decontam-rows")


def marks(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_rows: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its number of words, the hit word ranges
    (first included, last excluded) and the items whose windows occur."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = _blocks(benchmark, size, block_rows)
    if len(blocks) == 1:
        return _scanned(plain, _sent(blocks[0]))
    return _passes(_keyed(plain, "_row").select("_row", "doc_id", "text"), blocks).drop("_row")


def hit_words(spans: str = "spans"):
    """Number of words covered by a column of ranges sorted by their first word."""
    step = lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"], acc["to"]))).cast("long").alias("n"),
        F.greatest(acc["to"], s["last"]).alias("to"),
    )
    return F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")), step)["n"]


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "drop", size: int = WINDOW, share: int = 20, block_rows: int = 2_000_000, text_col: str = "text") -> DataFrame:
    """The documents with all their columns, contaminated ones removed
    (``drop``: at least one word in ``share`` is hit) or their hit words cut out
    of the text (``cut``)."""
    ship(docs.sparkSession)
    if action not in ("drop", "cut"):
        raise ValueError(action)
    place = docs.columns.index(text_col)
    blocks = _blocks(benchmark, size, block_rows)
    if len(blocks) > 1:
        key, marked = fresh(docs.columns, "_row"), fresh(docs.columns, "_spans")
        rows = _keyed(docs, key)
        found = _passes(rows.select(key, F.col(text_col).alias("text")), blocks)
        hit = hit_words()
        if action == "drop":
            return rows.join(found.where((hit > 0) & (hit * share >= F.col("n_words"))).select(key), key, "left_anti").select(*docs.columns)
        spans = found.where(F.size("spans") > 0).select(key, F.col("spans").alias(marked))
        columns = docs.columns
        rows = rows.join(spans, key, "left").select(*columns, marked)

        def cut_at(batches):
            for b in batches:
                raw, offs = byte_view(b.column(place))
                cut = []
                for k, row in enumerate(b.column(len(columns)).to_pylist()):
                    if row is None:
                        cut.append(None)
                        continue
                    part = raw[offs[k] : offs[k + 1]]
                    s, e, _, _ = words(part, np.array([0, len(part)]), ALNUM_WORDS)
                    cut.append(without(part.tobytes(), s, e, merged([(x["first"], x["last"]) for x in row])))
                yield replaced(b.select(columns), place, cut)

        return rows.mapInArrow(cut_at, docs.schema)
    held = _sent(blocks[0])

    def run(batches):
        for b in batches:
            raw, offs = byte_view(b.column(place))
            keep, cut = [], []
            for k, s, e, n, spans, _ in scan(raw, offs, held.value):
                hit = sum(y - x for x, y in spans)
                keep.append(action == "cut" or not (hit > 0 and share * hit >= n))
                if action == "cut":
                    cut.append(without(raw[offs[k] : offs[k + 1]].tobytes(), s, e, spans) if spans else None)
            if action == "cut":
                b = replaced(b, place, cut)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def without(body: bytes, starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> str:
    """A text without the words of its merged ``spans``."""
    last, parts = 0, []
    for x, y in spans:
        parts.append(body[last : starts[x]])
        last = int(ends[y - 1])
    return (b"".join(parts) + body[last:]).decode()


def replaced(b: pa.RecordBatch, place: int, texts: list[str | None]) -> pa.RecordBatch:
    """The batch with those texts in column ``place`` that are given."""
    if all(t is None for t in texts):
        return b
    col = pa.array([t if t is not None else o for t, o in zip(texts, b.column(place).to_pylist())], b.column(place).type)
    return b.set_column(place, b.schema.field(place), col)


def op5_decontamination(spark, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    m = marks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    hit = hit_words()
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return m.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(ids, 256).alias("items_sha256"), ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"))
