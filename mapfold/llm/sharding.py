"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

Every row hashes by its id, size and text checksum into one of ``slots`` virtual
slots (8,192), which never change.  Bytes and rows are summed per slot, and a map says which shard
owns each slot.  Version 1 deals slots evenly; ``rebalance`` edits a version
into the next by moving single slots from the fullest to the emptiest shard
until no move helps, so most slots stay where they are.  Every version is kept
as a row group of one small table in the shared folder: (version, slot, shard).

The map has one row per slot whatever the input, so it may be read by the
driver and broadcast.  A row's place in its shard is the slot's offset (a sum
over the map) plus its place within the slot; only slots, each a few thousandths
of the rows, are ever sorted.

Defined cases: null text has no bytes (size 16); rows with a null or repeated id
are spread by their texts; rows equal in id and text are rows of their own but
share a slot, so a table of very many such rows is as uneven as they are heavy;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mapfold.llm.common import table
from mapfold.session import shared_dir

SLOTS = 1 << 13


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, vslot of every row; the text itself is not shuffled."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return rows.withColumn("vslot", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slots)).cast("int"))


def even_map(slots: int, shards: int) -> list[int]:
    return [s * shards // slots for s in range(slots)]


def rebalance(owner: list[int], load: list[int], shards: int) -> list[int]:
    """The next version of a map: slots move one at a time from the fullest to
    the emptiest shard while that lowers the difference between the two.  Slots
    of shards that are no more go to the emptiest shard first."""
    owner = list(owner)
    total = [0] * shards
    own: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    for slot, s in sorted(enumerate(owner), key=lambda x: (x[1] >= shards, -load[x[0]] if x[1] >= shards else 0)):
        if s >= shards:
            s = owner[slot] = min(range(shards), key=total.__getitem__)
        total[s] += load[slot]
        own[s].append((load[slot], slot))
    full = [(-t, s) for s, t in enumerate(total)]
    heapq.heapify(full)
    while full:
        t, a = heapq.heappop(full)
        if -t != total[a]:
            continue
        b = min(range(shards), key=total.__getitem__)
        gap = total[a] - total[b]
        # the slot nearest to half of the gap; any smaller than the gap helps
        best = min(((abs(2 * w - gap), w, slot) for w, slot in own[a] if 0 < w < gap), default=None)
        if best is None:
            continue  # this shard is as low as single slots allow
        _, w, slot = best
        own[a].remove((w, slot))
        own[b].append((w, slot))
        owner[slot] = b
        total[a] -= w
        total[b] += w
        heapq.heappush(full, (-total[a], a))
        heapq.heappush(full, (-total[b], b))
    return owner


def store_version(spark: SparkSession, path: str, version: int, owner: list[int]) -> None:
    rows = spark.createDataFrame([(version, slot, shard) for slot, shard in enumerate(owner)], "version int, slot int, shard int")
    rows.coalesce(1).write.mode("append").parquet(path)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> list[int]:
    """One version of a stored map (the newest if none is named)."""
    rows = spark.read.schema("version int, slot int, shard int").parquet(path)
    if version is None:
        version = rows.agg(F.max("version")).first()[0]
    return [r["shard"] for r in rows.where(F.col("version") == version).orderBy("slot").collect()]  # one row per slot


def newest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the newest stored version; none if nothing is stored yet."""
    try:
        return spark.read.schema("version int, slot int, shard int").parquet(path).agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def assign(docs: DataFrame, shards: int = 40, slots: int = SLOTS, map_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows with their shard (near-equal bytes) and place in it.  A map stored at
    ``map_path`` is rebalanced by the bytes of each slot into its next version;
    without one, version 1 (even) and version 2 (rebalanced) are written."""
    spark = docs.sparkSession
    rows = slotted(docs, slots, id_col, text_col)
    load, count = [0] * slots, [0] * slots
    for r in rows.groupBy("vslot").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect():  # one row per slot
        load[r["vslot"]], count[r["vslot"]] = r["b"], r["n"]
    path = map_path or shared_dir(spark, "slot-map")
    version = newest_version(spark, path)
    if version is None:
        version = 1
        store_version(spark, path, version, even_map(slots, shards))
    owner = read_version(spark, path, version)
    if len(owner) != slots:
        raise ValueError(f"version {version} of {path} has {len(owner)} slots, not {slots}")
    store_version(spark, path, version + 1, rebalance(owner, load, shards))
    owner = read_version(spark, path, version + 1)
    seen = [0] * shards
    placed = []
    for slot, s in enumerate(owner):
        placed.append((slot, s, seen[s]))
        seen[s] += count[slot]
    places = spark.createDataFrame(placed, "vslot int, shard int, first long")
    inside = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    return (
        rows.withColumn("n", F.row_number().over(inside))
        .join(F.broadcast(places), "vslot")  # one row per slot
        .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("n") - 1).cast("long").alias("slot"), "vslot")
    )


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of near-equal bytes."""
    placed = assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot")
