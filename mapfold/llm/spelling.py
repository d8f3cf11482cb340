"""Spelling variant grouping with a trie-node pair dictionary.

Every word is a path in two tries, one of the words and one of the reversed
words.  The nodes of both are numbered: a node of depth 9 or less by its path
(letters are digits 1 to 90, so the number is exact), a deeper one by the next
free number of a dictionary table of the deeper nodes, which are told apart by a
128-bit digest of their path.  A word then is, at each place i, a pair of
integers (prefix node before i, suffix node from i).  Skipping the letter at i
gives the pair (prefix before i, suffix after i):

* two words replace a letter for one another when they share a skipping pair;
* a word has one letter more than another when its skipping pair is the other's
  plain pair at that place.  Within a run of equal letters only the first is
  skipped for this, so a neighbour is met once.

One join on the integer pair so finds all neighbours with exactly one inserted,
deleted or replaced code point, exactly.  A pair belongs to one plain word at
most and to as many skipping words as there are letters (90), so its group is
bounded and is reduced at once to counts and the best neighbour of each member:
no list of all pairs is made.

A word's form is its near word with most occurrences (ties: code-point order) if
it has ``ratio`` times the word's; roots follow forms by pointer doubling (a
count grows ``ratio``-fold a step, so 2^5 steps are beyond any 64-bit count).

Defined cases: a null text has no runs; a null doc_id is written as nothing
before the colon; rows that repeat a doc_id count each; a run may have any
length (its work is linear in it); further columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import ship, stored, table

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
DROP_EVERY = 31
SHALLOW = 9  # 90^9 < 2^63
FLUSH = 300_000
LONG = 1 << 22
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)
#: kinds of rows: a letter skipped, the same not first of its run of equal letters, the plain word
SKIP, SKIP_AGAIN, PLAIN = 0, 1, 2


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def passed_on() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            low = text.as_py().encode("utf-8", "replace").lower().decode()  # bytes lower-case A-Z only
            runs = Counter(_RUN.findall(low)) if len(low) < LONG else Counter(m.group() for m in _RUN.finditer(low))
            start = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), start)
                if h % DROP_EVERY == 0:
                    cut = h % len(run)
                    run = run[:cut] + run[cut + 1 :]
                    if len(run) < MIN_LENGTH:
                        continue
                held[run] += n
            if len(held) > FLUSH:
                yield passed_on()
    yield passed_on()


def vocabulary(docs: DataFrame) -> DataFrame:
    """wid, word, n; wid ascends in the code-point order of the words."""
    ship(docs.sparkSession)
    part = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_variants, "word string, n long")
    words = part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)
    # range partitions ascend and so do the numbers; equal order of numbers and UTF-8 bytes
    return stored(words.orderBy("word").select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "spelling-words")


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(wid, n, code points) of the words of each length, in slices of bounded size."""
    wid, n = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)
    words = batch.column(1).to_pylist()
    size = np.array([len(w) for w in words], np.int64)
    for length in np.unique(size):
        at = np.flatnonzero(size == length)
        step = max(1, 100_000 // int(length))
        for i in range(0, len(at), step):
            some = at[i : i + step]
            text = "".join(words[k] for k in some).encode("utf-32-le")
            yield wid[some], n[some], np.frombuffer(text, np.uint32).reshape(len(some), length).astype(np.int64)


def _letters(points: np.ndarray) -> np.ndarray:
    """Code points as digits: a-z 1 to 26, the 64 code points from U+00C0 after them."""
    return np.where(points < 0xC0, points - 0x60, points - 0xC0 + 27)


def _paths(letters: np.ndarray) -> np.ndarray:
    """Numbers of the first nodes of each row's path, depth 0 to SHALLOW at most."""
    out = np.zeros((len(letters), SHALLOW + 1), np.int64)
    for d in range(min(letters.shape[1], SHALLOW)):
        out[:, d + 1] = out[:, d] * 90 + letters[:, d]
    return out


def _digests(points: np.ndarray) -> np.ndarray:
    """Digests of the nodes of each row's path, None down to depth SHALLOW."""
    out = np.full((len(points), points.shape[1] + 1), None, object)
    for row, raw in enumerate(points.astype("<u4")):
        h = blake2b(raw[:SHALLOW].tobytes(), digest_size=16)
        for d in range(SHALLOW, len(raw)):
            h.update(raw[d : d + 1].tobytes())
            out[row, d + 1] = h.copy().digest()
    return out


def _pairs(wid: np.ndarray, n: np.ndarray, points: np.ndarray, deep: bool) -> list[pa.Array]:
    """Columns of the pairs of words of one length: those with a node below
    SHALLOW, which carries its digest in place of a number, or the others."""
    length = points.shape[1]
    i = np.concatenate([np.arange(length), np.arange(length + 1)])  # depth of the prefix node, skipping and plain pairs
    j = np.concatenate([length - 1 - np.arange(length), length - np.arange(length + 1)])
    chosen = np.flatnonzero((np.maximum(i, j) > SHALLOW) == deep)
    again = np.zeros(points.shape, bool)
    again[:, 1:] = points[:, 1:] == points[:, :-1]
    kind = np.concatenate([np.where(again, SKIP_AGAIN, SKIP), np.full((len(points), length + 1), PLAIN)], axis=1)[:, chosen]
    cols = [pa.array(np.repeat(wid, len(chosen))), pa.array(np.repeat(n, len(chosen))), pa.array(kind.ravel().astype(np.int8))]
    letters = _letters(points)
    sides = ((letters, points, i[chosen]), (letters[:, ::-1], points[:, ::-1], j[chosen]))
    for path, _, depth in sides:
        number = _paths(path)[:, np.minimum(depth, SHALLOW)].ravel()
        cols.append(pa.array(number, mask=np.tile(depth > SHALLOW, len(points))))
    if deep:
        cols += [pa.array(_digests(at)[:, depth].ravel().tolist(), pa.binary()) for _, at, depth in sides]
    return cols


_NAMES = ["wid", "n", "kind", "p", "s", "pd", "sd"]
_SHALLOW_ROWS = "wid long, n long, kind byte, p long, s long"


def _shallow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for wid, n, points in _by_length(batch):
            if points.shape[1] <= 2 * SHALLOW + 1:
                yield pa.RecordBatch.from_arrays(_pairs(wid, n, points, False), names=_NAMES[:5])


def _deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for wid, n, points in _by_length(batch):
            if points.shape[1] > SHALLOW:
                yield pa.RecordBatch.from_arrays(_pairs(wid, n, points, True), names=_NAMES)


def node_pairs(words: DataFrame) -> DataFrame:
    """wid, n, kind, p, s: the pairs of node numbers of every word."""
    deep = stored(words.mapInArrow(_deep, _SHALLOW_ROWS + ", pd binary, sd binary"), "spelling-deep")
    nodes = deep.select(F.explode(F.array("pd", "sd")).alias("path")).where(F.col("path").isNotNull()).distinct()
    nodes = stored(nodes.withColumn("number", -1 - F.monotonically_increasing_id()), "spelling-nodes")
    for path, number in (("pd", "p"), ("sd", "s")):
        known, open_ = deep.where(F.col(path).isNull()), deep.where(F.col(path).isNotNull())
        named = open_.drop(number).join(nodes.select(F.col("path").alias(path), F.col("number").alias(number)), path)
        deep = known.unionByName(named)
    return words.mapInArrow(_shallow, _SHALLOW_ROWS).unionByName(deep.drop("pd", "sd"))


def neighbours(words: DataFrame) -> DataFrame:
    """wid, n, n_near, best_n, best: of every word that has near words."""
    member = F.struct((-F.col("n")).alias("minus"), "wid", "kind")
    groups = node_pairs(words).groupBy("p", "s").agg(F.collect_list(member).alias("m")).where(F.size("m") > 1)
    groups = groups.select(F.sort_array("m").alias("m"))

    def meets(x, y):
        skips = (x["kind"] != PLAIN) & (y["kind"] != PLAIN)
        return (x["wid"] != y["wid"]) & (skips | ((x["kind"] + y["kind"]) == PLAIN + SKIP))

    met = F.transform("m", lambda x: F.struct(x["wid"].alias("wid"), x["minus"].alias("minus"), F.filter("m", lambda y: meets(x, y)).alias("near")))
    rows = groups.select(F.explode(met).alias("r")).where(F.size("r.near") > 0)
    best = F.get(F.col("r.near"), F.lit(0))
    rows = rows.select("r.wid", (-F.col("r.minus")).alias("n"), F.size("r.near").cast("long").alias("n_near"), F.struct(best["minus"].alias("minus"), best["wid"].alias("wid")).alias("best"))
    near = rows.groupBy("wid").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return near.select("wid", "n", "n_near", (-F.col("best.minus")).alias("best_n"), F.col("best.wid").alias("best"))


def group_variants(docs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    words = vocabulary(docs)
    near = stored(neighbours(words), "spelling-near")
    forms = near.where(F.col("best_n") >= ratio * F.col("n")).select("wid", F.col("best").alias("form"), F.col("best_n").alias("form_n"))
    roots = stored(forms.select("wid", F.col("form").alias("root")), "spelling-roots")
    for _ in range(5):
        on = roots.select(F.col("wid").alias("root"), F.col("root").alias("further"))
        roots = stored(roots.join(on, "root", "left").select("wid", F.coalesce("further", "root").alias("root")), "spelling-roots")
    named = lambda c: words.select(F.col("wid").alias(f"{c}_wid"), F.col("word").alias(f"{c}_word"))
    told = forms.join(roots, "wid").join(named("form"), F.col("form") == F.col("form_wid")).join(named("root"), F.col("root") == F.col("root_wid"))
    told = told.select("wid", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "form_n")
    rows = words.join(near.select("wid", "n_near"), "wid", "left").join(told, "wid", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    return group_variants(table(spark, sf_dir, "documents"))
