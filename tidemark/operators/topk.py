"""The first or largest rows of each key, with ranks that Spark limits before it shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """At most n rows of each key in a total order; a group limit runs before the exchange."""
    own = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(own)).where(F.col(rank) <= n)


def largest_n(rows: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str], n: int = 20) -> DataFrame:
    """The n largest by value, nulls as 0, ties in their order."""
    return first_n(rows, keys, [F.coalesce(F.col(value), F.lit(0)).desc(), *(F.col(t) for t in tie)], n)


def capped(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, item: Column) -> DataFrame:
    """The first n items of each key as an array, with the number of all."""
    few = first_n(rows.withColumn("__item", item), keys, order, n)
    lists = few.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("rank", "__item"))).alias("__list")).select(*keys, F.transform("__list", lambda x: x["__item"]).alias("items"))
    return rows.groupBy(*keys).agg(F.count("*").alias("total")).join(lists, list(keys))


def best_and_gap(candidates: DataFrame, key: str, score: str, tie: str) -> DataFrame:
    """The best candidate of each key with its lead over the second."""
    own = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie))
    rows = candidates.withColumn("__second", F.lead(score).over(own)).withColumn("__rank", F.row_number().over(own)).where("__rank = 1")
    return rows.withColumn("gap", F.col(score) - F.coalesce("__second", F.lit(0.0))).drop("__second", "__rank")


def prioritised(work: DataFrame, n: int) -> DataFrame:
    from .classify import priority_rank

    return work.withColumn("priority_rank", priority_rank(F.col("priority"))).orderBy("priority_rank", "created_at", "accession").limit(n)
