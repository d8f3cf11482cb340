"""Exact deduplication by composable polynomial fingerprints.

A text (runs of blanks made one space) is a number in base 256; its fingerprint
is that number modulo a 61-bit prime.  Chunks hash independently and combine by
length-shifted arithmetic, ``H(ab) = H(a) * 256^len(b) + H(b)``, so a huge text
never needs to be one number.  Equal (fingerprint, length) only proposes a
group; the texts are then compared chunk by chunk: a chunk place holds one
content exactly when its least and greatest bytes are equal, and least and
greatest are map-side combined, so a group with a third of all rows costs one
row per task and place.  A group whose texts differ is regrouped with the
SHA-256 as a further key and compared again.

Defined cases: null counts as empty; all empty texts are one group; the row with
the smallest doc_id stays, and rows that repeat that doc_id with an equal text
are kept with it; a null doc_id stays only if its whole group has none; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import BLANK_WORDS, Membership, byte_view, fresh, ship, slices, stored, table

PRIME = (1 << 61) - 31
CHUNK = 1 << 16


def chunk_print(chunk: bytes, prime: int = PRIME) -> int:
    return int.from_bytes(chunk, "big") % prime


def combine(a: int, b: int, b_len: int, prime: int = PRIME) -> int:
    """Fingerprint of a text from those of its two parts."""
    return (a * pow(256, b_len, prime) + b) % prime


def fingerprint(text: bytes, prime: int = PRIME, chunk: int = CHUNK) -> int:
    h = 0
    for i in range(0, len(text), chunk):
        part = text[i : i + chunk]
        h = combine(h, chunk_print(part, prime), len(part), prime)
    return h


def normalised(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of [\\x20\\x09-\\x0D] as one space, for all texts of a byte view."""
    if len(raw) == 0:
        return raw, offs
    blank = ~BLANK_WORDS[raw]
    again = np.zeros(len(raw), bool)
    again[1:] = blank[1:] & blank[:-1]
    again[offs[:-1][offs[:-1] < len(raw)]] = False
    keep = ~again
    out = np.where(blank, np.uint8(32), raw)[keep]
    places = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(keep, out=places[1:])
    return out, places[offs]


def texts(batch_col) -> Iterator[tuple[int, bytes]]:
    raw, offs = byte_view(batch_col)
    for i, j in slices(offs, 4 << 20):
        part, at = normalised(raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
        body = part.tobytes()
        for k in range(j - i):
            yield i + k, body[at[k] : at[k + 1]]


def prints(docs: DataFrame, prime: int = PRIME) -> DataFrame:
    """(doc_id, fp, n_bytes, text_sha256) of every row."""

    def run(batches):
        for b in batches:
            fp, size, sha = [], [], []
            for _, t in texts(b.column(1)):
                fp.append(fingerprint(t, prime))
                size.append(len(t))
                sha.append(hashlib.sha256(t).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), pa.array(size, pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "fp", "n_bytes", "text_sha256"])

    return docs.mapInArrow(run, "doc_id long, fp long, n_bytes long, text_sha256 string")


def differing(docs: DataFrame, shared: Membership, keys: list[str], prime: int = PRIME) -> DataFrame:
    """Keys of proposed groups whose texts are not all equal, by streaming the
    chunks of the rows that ``shared`` may hold."""
    held = docs.sparkSession.sparkContext.broadcast(shared)

    def run(batches):
        for b in batches:
            rows = {"fp": [], "n_bytes": [], "text_sha256": [], "place": [], "chunk": []}
            pending = 0
            for _, t in texts(b.column(1)):
                fp = fingerprint(t, prime)
                if not held.value.test(np.array([fp], np.int64))[0]:
                    continue
                sha = hashlib.sha256(t).hexdigest()
                for k in range(0, len(t), CHUNK):
                    rows["fp"].append(fp)
                    rows["n_bytes"].append(len(t))
                    rows["text_sha256"].append(sha)
                    rows["place"].append(k)
                    rows["chunk"].append(t[k : k + CHUNK])
                    pending += CHUNK if len(t) > CHUNK else len(t)
                    if pending > 8 << 20:
                        yield pa.RecordBatch.from_pydict(rows, schema=schema)
                        rows, pending = {c: [] for c in rows}, 0
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    schema = pa.schema([("fp", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("place", pa.int64()), ("chunk", pa.binary())])
    chunks = docs.mapInArrow(run, "fp long, n_bytes long, text_sha256 string, place long, chunk binary")
    spread = chunks.groupBy(*keys, "place").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
    return spread.where("lo != hi").select(*keys).distinct()


def exact_groups(docs: DataFrame, prime: int = PRIME, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    marks = stored(prints(docs, prime), "dedup-prints")
    keys = ["fp", "n_bytes"]
    for keys in (["fp", "n_bytes"], ["fp", "n_bytes", "text_sha256"]):
        groups = stored(marks.groupBy(*keys).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"), "dedup-groups")
        shared = Membership.build(groups.select("fp").distinct(), "fp")
        if differing(docs, shared, keys, prime).limit(1).count() == 0:
            break
    else:
        raise RuntimeError("different texts share length, fingerprint and SHA-256")
    found = marks.join(groups, keys, "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select("doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), keep.eqNullSafe(F.col("doc_id")).alias("kept"), "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    gone_id, gone_sha = fresh(docs.columns, "_gone"), fresh(docs.columns, "_sha")
    gone = exact_groups(docs, id_col=id_col, text_col=text_col).where("not kept").select(F.col("doc_id").alias(gone_id), F.col("text_sha256").alias(gone_sha)).distinct()
    gone = stored(gone, "dedup-gone")  # written, so the planner broadcasts it while it is small
    # an id may stand on rows of several texts, or be null: the text decides with it
    sha = F.sha2(F.regexp_replace(F.coalesce(docs[text_col], F.lit("")), r"[\x20\x09-\x0D]+", " ").cast("binary"), 256)
    return docs.join(gone, docs[id_col].cast("long").eqNullSafe(gone[gone_id]) & (sha == gone[gone_sha]), "left_anti")


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Exact copies among all documents after blank normalisation."""
    return exact_groups(table(spark, sf_dir, "documents"))
