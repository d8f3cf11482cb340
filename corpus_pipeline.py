"""The corpus pipeline: five stages over ``documents``, each written as Parquet
to the shared folder and read back as the next stage's input.

1. toxicity: documents that the model scores 0.5 or more go;
2. exact dedup: of equal texts the smallest doc_id stays;
3. near duplicates: of each component of linked documents the smallest doc_id stays;
   documents are linked by op8's contract, four-word shingles and a similarity of 0.85
   or more, not by the general rule of five words and 0.8 (see the README);
4. benchmark decontamination: documents with one word in twenty or more inside a
   benchmark window go;
5. packing: what is left is packed into 2048-token windows.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mapfold.llm import decontam, exact_dedup, packing, sigtree, toxicity
from mapfold.llm.common import stored, table


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sigtree.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), action="drop")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(docs, order_by=["doc_id"]))


STAGES = [
    ("toxicity", keep_clean),
    ("exact dedup", drop_copies),
    ("near duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: the model of stage 1 and the token stream of stage 5 are beyond SQL; tests/llm has the brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
