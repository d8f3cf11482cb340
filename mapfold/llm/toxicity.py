"""Toxicity scores by FTRL-proximal logistic regression on hashed word features.

Features of a text: the presence of each word, of each word's first 4, 5 and 7
bytes (so that inflected forms share a weight), of each pair of neighbours and
of each pair one word apart, hashed to 2^20 places.  Training is follow the
regularised leader with a learning rate per coordinate; the L1 term leaves only
the places that carry evidence, and the (place, weight) pairs are the model that
is broadcast: at most 2^20 pairs, in practice a few thousand.

The fit reads a bounded sample: the ``max_rows`` labelled rows with the least
hash of their id (30,000 by default, stated here as the documented bound; fewer
labels are all used).  They stream through one task ``epochs`` times in hash
order, so the fit is the same on every run and takes the same time at any size.
Scoring covers every row and the whole text.

Defined cases: null and empty texts have no features and score the bias alone;
ids that occur twice among the labels take the greater label; without labels of
both kinds the model is empty and every score is the clipped share of toxic
labels; a null id is never a training row; further columns are ignored by
``scores`` and passed through by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import _BASE, ALNUM_WORDS, byte_view, distinct, mix, ship, slices, table, words

DIM = 1 << 20
MAX_ROWS = 30_000
STEMS = (4, 5, 7)


def grams(raw: np.ndarray, offs: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For stretches of texts: their first row, where their words begin, and (owner row in the
    stretch, feature place) arrays, one pair for each kind of feature."""
    for i, j in slices(offs):
        part = raw[offs[i] : offs[j]]
        s, e, h, first = words(part, offs[i : j + 1] - offs[i], ALNUM_WORDS)
        owner = np.repeat(np.arange(j - i), np.diff(first))
        out = [(owner, h)]
        out += [(owner, mix(_prefix_hash(part, s, np.minimum(e, s + n)) + np.uint64(n))) for n in STEMS]
        for gap, salt in ((1, 0), (2, 7)):
            same = np.flatnonzero(owner[:-gap] == owner[gap:])
            out.append((owner[same], mix(h[same] * np.uint64(_BASE + 2 * gap) + h[same + gap] + np.uint64(salt))))
        yield i, first, [(o, (g & np.uint64(DIM - 1)).astype(np.int64)) for o, g in out]


def features(raw: np.ndarray, offs: np.ndarray) -> Iterator[np.ndarray]:
    """Distinct feature places of each text of a byte view."""
    for _, first, kinds in grams(raw, offs):
        at = distinct(np.concatenate([o * DIM + g for o, g in kinds]))
        edge = np.searchsorted(at, np.arange(len(first)) * DIM)
        at %= DIM
        for a, b in zip(edge[:-1], edge[1:]):
            yield at[a:b]


def _prefix_hash(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    from mapfold.llm.common import _BYTE, _Powers

    up, down = _Powers.upto(len(raw) + 1)
    acc = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=acc[1:])
    return (acc[ends] - acc[starts]) * down[starts]


class Ftrl:
    """FTRL-proximal state: z, n per place and for the bias (place DIM)."""

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 5.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(DIM + 1), np.zeros(DIM + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where((np.abs(z) <= self.l1) & (at < DIM), 0.0, w)

    def learn(self, places: np.ndarray, label: int) -> None:
        at = np.append(places, DIM)
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g

    def model(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(np.abs(self.z[:DIM]) > self.l1)
        at = np.append(at, DIM)
        return at, self.weights(at)


class Model:
    """Sparse weights; ``score`` is the probability of the toxic label."""

    def __init__(self, at: np.ndarray, weight: np.ndarray):
        self.at, self.weight = at.astype(np.int32), weight.astype(np.float32)
        self._dense: np.ndarray | None = None

    def __getstate__(self):
        return {"at": self.at, "weight": self.weight, "_dense": None}

    def score(self, raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros(DIM + 1)
            self._dense[self.at] = self.weight
        d = self._dense
        total = np.full(len(offs) - 1, d[DIM])
        for row, first, kinds in grams(raw, offs):
            known = [(o[hit], g[hit]) for o, g in kinds if len(hit := np.flatnonzero(d[g]))]
            if known:
                at = distinct(np.concatenate([o * DIM + g for o, g in known]))
                n = len(first) - 1
                total[row : row + n] += np.bincount(at // DIM, weights=d[at % DIM], minlength=n)
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def held_out(id_col: str = "doc_id"):
    """True for ids outside the training folds."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, epochs: int = 3, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Model learnt from the labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    ship(spark)
    usable = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_y"))
    sample = usable.withColumn("_h", F.xxhash64("_id")).orderBy("_h", "_id").limit(max_rows)  # the documented bound
    keyed = docs.select(F.col(id_col).alias("_k"), F.col(text_col).alias("_t"), F.xxhash64(text_col).alias("_x"))
    # an id may stand on many rows, so the bound holds for rows: narrow first, then their texts
    some = keyed.join(F.broadcast(sample), F.col("_k") == F.col("_id")).select("_h", F.col("_id").alias("_k"), "_x", "_y").distinct()
    some = some.orderBy("_h", "_k", "_x").limit(max_rows)
    rows = (
        keyed.join(F.broadcast(some), ["_k", "_x"])  # bounded by max_rows
        .dropDuplicates(["_k", "_x"])
        .select("_h", "_k", "_y", "_t")
        .withColumn("_e", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    )
    rows = rows.repartition(1).sortWithinPartitions("_e", "_h", "_k", "_t").select("_y", "_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, seen = Ftrl(), [0, 0]
        for b in batches:
            for y, x in zip(b.column(0).to_pylist(), features(*byte_view(b.column(1)))):
                f.learn(x, y)
                seen[y] += 1
        at, w = f.model()
        if min(seen) == 0:
            p = (seen[1] + 1) / (sum(seen) + 2)
            at, w = np.array([DIM]), np.array([np.log(p / (1 - p))])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(w.astype(np.float64))], names=["place", "weight"])

    found = rows.mapInArrow(run, "place long, weight double").toPandas()  # at most 2^20 + 1 rows
    if found.empty:
        return Model(np.array([DIM]), np.array([0.0]))
    return Model(found["place"].to_numpy(), found["weight"].to_numpy())


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score of every row."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(held.value.score(*byte_view(b.column(1))))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents that score under ``limit``, with all their columns."""
    ship(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(held.value.score(*byte_view(b.column(place))) < limit))

    return docs.mapInArrow(run, docs.schema)


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document by a model of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    found = scores(docs, model)
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
