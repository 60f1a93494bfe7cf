"""The corpus pipeline: documents through four operators of the training-data subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import remove, scratch, table
from tidemark.llm.stages import classify, deduplicate, mix, pack

#: Each takes (spark, docs, sf_dir); all but the last return the columns of documents.
STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's documents go as soon as the next stage has read them."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = scratch(spark, name.split()[0])
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            remove(spark, before)
        before = folder
    return docs
