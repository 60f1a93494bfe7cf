"""Stages of the corpus pipeline. Each takes (spark, docs, sf_dir); all but the last return the columns of documents.

Stages decide per row, not per id: rows are told apart by their id and a hash of all their columns, so texts that
share an id, or have none, are different documents, and rows that agree in every column are repeats of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import curriculum, ngram_join, pattern_packing, quality_knn
from .common import Work, cut, small, table

ROW = "__row"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose quality score is at least 0.5."""
    score = quality_knn.scorer(docs, quality_knn.learn(docs, table(spark, sf_dir, "labels")))
    return docs.withColumn("__score", score("text")).where(F.col("__score") >= 0.5).drop("__score")


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with a hash of all their columns."""
    return docs.withColumn(ROW, F.xxhash64(*docs.columns))


def same_row(left: DataFrame, right: DataFrame):
    """Ids may be null."""
    return left["doc_id"].eqNullSafe(right["__id"]) & (left[ROW] == right["__key"])


def once(docs: DataFrame, repeated: DataFrame, n: int) -> DataFrame:
    """Keyed rows without the repeats of those in `repeated` (__id, __key; n of them). No other row is shuffled if they are few."""
    if not n:
        return docs
    more = small(repeated, n)
    first = docs.join(more, same_row(docs, more), "left_semi").dropDuplicates(["doc_id", ROW])
    return docs.join(more, same_row(docs, more), "left_anti").unionByName(first)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the least id (none comes last), then the least row hash; equal rows once.

    Documents without words link with nothing and all stay.
    """
    rows = keyed(docs)
    with Work(spark, "deduplicate") as work:
        found = ngram_join.jaccard_classes(rows, row=ROW).where("n > 0")
        # written, so that Spark can split a root that a third of the documents have when it joins
        first = work.keep(found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("first")))
        marked = work.keep(found.join(first, "root").select(F.col("id").alias("__id"), F.col("row").alias("__key"), (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("row") == F.col("first.row"))).alias("stays")))
        gone, n = work.sized(marked.where("NOT stays").select("__id", "__key").distinct())
        repeated, more = work.sized(marked.where("stays").groupBy("__id", "__key").count().where("count > 1").select("__id", "__key"))
        gone, repeated = cut(gone), cut(repeated)
    less = small(gone, n)
    return once(rows.join(less, same_row(rows, less), "left_anti"), repeated, more).drop(ROW)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents as the mix takes them, sorted by training position.

    Documents are taken whole; rows that agree in every column are taken as often as all of them together.
    """
    rows = keyed(docs)
    with Work(spark, "mix") as work:
        mixed = curriculum.mix_sources(rows, whole=True, keep=(ROW,))
        taken = work.keep(mixed.groupBy(F.col("doc_id").alias("__id"), F.col(ROW).alias("__key")).agg(F.sum("copies").alias("__copies"), F.min("position").alias("__position"), F.count("*").alias("n")))
        repeated, more = work.sized(taken.where("n > 1 AND __copies > 0").select("__id", "__key"))
        taken, repeated = cut(taken.where("__copies > 0").drop("n")), cut(repeated)
    rows = once(rows, repeated, more)
    kept = rows.join(taken, same_row(rows, taken)).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    return kept.orderBy("__position").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sequences of 2048 tokens."""
    return pattern_packing.pack(docs)
