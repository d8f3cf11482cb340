"""Intermediate tables in the shared folder: lineage is cut, and a lost executor
costs no recomputation of what came before."""

from __future__ import annotations

from pyspark.sql import DataFrame

from mapfold.session import shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
