"""Streaming and archive queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapfold.fixtures import view
from mapfold.plans import query
from mapfold.session import shared_dir
from mapfold.streaming.ledger_stream import run_ledger_stream


@query("ledger_stream", "select distinct filepath from fx_ledger")
def ledger_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Ledger rows land as files; the stream keeps one row per file path."""
    landing, table, ckpt = (shared_dir(spark, n) for n in ("landing", "ledger_table", "ledger_ckpt"))
    l = view(spark, sf, "fx_ledger").select("event_id", "iso", "level", "filepath", "processed_at")
    l.write.mode("overwrite").parquet(landing)
    run_ledger_stream(spark, landing, table, ckpt, delay="3650 days")
    return spark.read.parquet(table).select("filepath").distinct()
