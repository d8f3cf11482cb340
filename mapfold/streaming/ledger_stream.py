"""Ledger stream: arriving ledger files -> watermark + de-duplication -> ledger table.

A file-source stream over a landing folder; duplicates of one file path within
the watermark delay are dropped; ``foreachBatch`` writes each micro-batch to the
ledger table's folder of its batch id, so a batch that runs again replaces itself.  The
checkpoint lives in the shared checkpoint folder, so a restarted or relocated
driver resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LEDGER_SCHEMA = "event_id long, iso string, level string, filepath string, processed_at timestamp"


def run_ledger_stream(spark: SparkSession, landing: str, table: str, checkpoint: str, delay: str = "1 hour") -> None:
    src = spark.readStream.schema(LEDGER_SCHEMA).parquet(landing)
    dedup = src.withWatermark("processed_at", delay).dropDuplicatesWithinWatermark(["filepath"])

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")

    q = dedup.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
