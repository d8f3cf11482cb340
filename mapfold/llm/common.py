"""Helpers shared by the training-data operators: shared-folder tables, code
shipping, Arrow byte views, vectorised word hashing, fixed-size membership
filters and connected components.

Word hashes are 64-bit: every byte has a random odd value, a word is the
position-weighted sum of its byte values modulo 2^64, finished by a bit mixer.
All of it is numpy over a whole Arrow batch; no per-word Python objects exist.
Such sums can be made to collide by long words of a pattern (Thue-Morse), so
words of more than ``LONG_WORD`` bytes take a cryptographic hash instead.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.session import shared_dir

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="mapfold-code-"), "mapfold_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("mapfold", os.path.relpath(full, root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a
    lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """``name`` with underscores in front until no column has it (names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


# ---------------------------------------------------------------- byte views

MASK64 = (1 << 64) - 1


def byte_view(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column without copying rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    n = len(col)
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64)[col.offset : col.offset + n + 1] if bufs[1] is not None else np.zeros(n + 1, np.int64)
    if bufs[2] is None or n == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows`` rows, which bounds what a step holds."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def slices(offs: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together stay near ``limit`` bytes (a longer row
    is a range of its own)."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values; sorting beats numpy's hashed ``unique`` by far on 64-bit keys."""
    a = np.sort(a)
    return a[np.append(True, a[1:] != a[:-1])] if len(a) else a


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    t = np.zeros(256, bool)
    for a, b in ranges:
        t[a : b + 1] = True
    return t


#: words between blanks: everything but \x20 and \x09-\x0D
BLANK_WORDS = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: words of letters and digits after lower-casing A-Z: any byte of a non-ASCII character belongs to a word
ALNUM_WORDS = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]  # A-Z hash like a-z
_BASE = 0x9E3779B97F4A7C15
LONG_WORD = 32
_BASE_INV = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            m = max(n, 1 << 20)
            a, b = np.full(m, _BASE, np.uint64), np.full(m, _BASE_INV, np.uint64)
            a[0] = b[0] = 1
            cls.up, cls.down = np.cumprod(a), np.cumprod(b)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(raw: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the documents ``raw[offs[i]:offs[i+1]]``.

    Returns (starts, ends, hashes, first) where ``first[i]:first[i+1]`` are the
    words of document i; starts and ends are byte places in ``raw``.
    """
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, np.uint64), np.zeros(len(offs), np.int64)
    w = is_word[raw]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    starts = np.flatnonzero(w & (edge[:-1] | ~before))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    ends = np.flatnonzero(w & (edge[1:] | ~after)) + 1
    up, down = _Powers.upto(n + 1)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=acc[1:])
    h = mix((acc[ends] - acc[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        h[i] = np.frombuffer(blake2b(raw[starts[i] : ends[i]].tobytes().lower(), digest_size=8).digest(), np.uint64)[0]
    return starts, ends, h, np.searchsorted(starts, offs)


def ngrams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive words (fewer words: one gram of all)."""
    k = min(k, len(h))
    if k == 0:
        return np.zeros(0, np.uint64)
    m = len(h) - k + 1
    a = np.full(m, k, np.uint64)
    for j in range(k):
        a = mix(a * np.uint64(_BASE) + h[j : j + m])
    return a


def lists(values: list[np.ndarray] | np.ndarray, counts: np.ndarray, kind=None) -> pa.ListArray:
    """Arrow list column from per-row arrays (or one flat array) and counts."""
    flat = values if isinstance(values, np.ndarray) else (np.concatenate(values) if values else np.zeros(0, np.int64))
    if flat.dtype == np.uint64:
        flat = flat.view(np.int64)
    offs = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offs[1:])
    return pa.ListArray.from_arrays(pa.array(offs), pa.array(flat, type=kind))


# ------------------------------------------------------- membership filters


class Membership:
    """Set of 64-bit values as a bitmap of fixed size, two bits per value.

    ``build`` aggregates the bitmap on the executors (one bounded row per
    32,768 bits) and the result, ``bits`` / 8 bytes at most whatever the input,
    is what gets broadcast.  It has false positives and no false negatives, so
    it may only be used to leave work out early, never to decide a result.
    """

    def __init__(self, bits: int, raw: np.ndarray):
        self.bits, self.raw = bits, raw

    @staticmethod
    def build(df: DataFrame, col: str, bits: int = 1 << 26) -> Membership:
        c = F.col(col)
        # both places are 31-bit slices of the value mixed by xxhash64
        h = F.xxhash64(c)
        places = F.array(h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)))
        rows = (
            df.select(F.explode(places).alias("p"))
            .groupBy(F.shiftright("p", 15).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("p").bitwiseAND(F.lit((1 << 15) - 1)) + F.lit(1))).alias("bitmap"))
            .collect()  # at most bits / 32,768 rows of 4 KB
        )
        raw = np.zeros(bits // 8, np.uint8)
        for r in rows:
            b = np.frombuffer(r["bitmap"], np.uint8)
            raw[r["bucket"] * 4096 : r["bucket"] * 4096 + len(b)] = b
        return Membership(bits, raw)

    def test(self, values: np.ndarray) -> np.ndarray:
        h = xxhash64_long(values)
        m = np.uint64(self.bits - 1)
        out = np.ones(len(values), bool)
        for p in (h & m, (h >> np.uint64(32)) & m):
            out &= (self.raw[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """``docs`` without the rows whose id is among the (long, distinct) ids of ``gone``.

    The ids are written first, so the planner knows their size: it broadcasts a
    small table and shuffles both sides for a large one.
    """
    name = fresh(docs.columns, "_gone")
    gone = stored(gone.select(F.col(gone.columns[0]).alias(name)), "gone-ids")
    return docs.join(gone, docs[id_col].cast("long") == gone[name], "left_anti")


def xxhash64_long(x: np.ndarray) -> np.ndarray:
    """Spark's ``xxhash64`` of one bigint column (seed 42), vectorised."""
    x = x.view(np.uint64)
    p1, p2, p3, p4, p5 = (np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def rotl(v, r):
        return (v << np.uint64(r)) | (v >> np.uint64(64 - r))

    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (rotl(x * p2, 31) * p1)
        h = rotl(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return h ^ (h >> np.uint64(32))


# ------------------------------------------------------ connected components


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) with comp the smallest node reachable; every node of an edge.

    Randomised contraction: each round draws a fresh order of the nodes, sends
    every node to the first of itself and its neighbours (a map-side combined
    minimum, so a node with a third of all edges costs one row per task) and
    goes on with the edges between the images.  The last node of a round's order
    is nobody's image, so every round has fewer nodes and it always ends; a
    quarter of the nodes goes at least in expectation, whatever the ids, so the
    rounds grow with the logarithm of the nodes.  Rounds are written to the
    shared folder and shrink with the graph; the images are joined up backwards.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b).alias("u"), F.col(a).alias("v")))
    both = stored(both.where("u != v").distinct(), "cc-edges")
    images: list[DataFrame] = []
    while not images or both.limit(1).count():
        drawn = F.lit(len(images))
        # xxhash64 of one value of 64 bits is a bijection: no two nodes tie
        near = both.groupBy("u").agg(F.min_by("v", F.xxhash64("v", drawn)).alias("low"))
        image = F.when(F.xxhash64("low", drawn) < F.xxhash64("u", drawn), F.col("low")).otherwise(F.col("u"))
        images.append(stored(near.select("u", image.alias("to")), "cc-images"))
        left, right = (images[-1].select(F.col("u").alias(c), F.col("to").alias(f"{c}_to")) for c in ("u", "v"))
        moved = both.join(left, "u").join(right, "v").select(F.col("u_to").alias("u"), F.col("v_to").alias("v"))
        both = stored(moved.where("u != v").distinct(), "cc-edges")
    roots = images.pop()
    while images:
        up = roots.select(F.col("u").alias("k"), F.col("to").alias("root"))
        roots = stored(images.pop().join(up, F.col("to") == F.col("k"), "left").select("u", F.coalesce("root", "to").alias("to")), "cc-roots")
    least = roots.groupBy("to").agg(F.min("u").alias("comp"))
    return stored(roots.join(least, "to").select(F.col("u").alias("node"), "comp"), "cc-labels")
