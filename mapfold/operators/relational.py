"""Relational helpers: bounded top-k per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topk_per_group(df: DataFrame, keys: list[str], order: list, k: int, salt_buckets: int = 32) -> DataFrame:
    """First ``k`` rows per group by ``order`` without sending a whole group to one task.

    Step 1 ranks inside (group, salt) buckets and keeps k rows per bucket;
    step 2 ranks the at most k * salt_buckets survivors of each group.  A group
    holding a third of all rows is thus spread over ``salt_buckets`` tasks.
    ``order`` must be a total order (ties broken by a unique column).
    """
    salt = F.abs(F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in order])) % salt_buckets
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    pre = df.withColumn("_salt", salt).withColumn("_r", F.row_number().over(w1)).where(F.col("_r") <= k)
    w2 = Window.partitionBy(*keys).orderBy(*order)
    out = pre.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
    return out.drop("_salt", "_r")
