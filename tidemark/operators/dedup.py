"""Keeping one row per key, and reporting keys that have more."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order. Null keys are a key of their own."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row of each key that is last by one column, by an aggregation with map-side maxima (no sort)."""
    rest = [c for c in df.columns if c not in keys]
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("__last"))
    return last.select(*keys, "__last.*").select(*df.columns)


def split_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Every row with kept: whether it's the first of its key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("kept", rank == 1)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that stand in more than one row, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def record_key(line: Column, strategy: str) -> Column:
    """Key of a raw record: its first tab-separated field, or the line's digest if that is asked for or there is none."""
    digest = F.sha2(line, 256)
    if strategy == "line_sha256":
        return digest
    return F.coalesce(text.blank_to_null(F.get(F.split(line, "\t"), F.lit(0))), digest)


def document_id(line: Column, strategy: str) -> Column:
    """The document that a raw record speaks of, by its feed's rule; null if it names none."""
    fields = F.split(line, "\t")
    is_url = lambda x: F.trim(x).rlike(r"^https?://")
    if strategy == "last_field_url":
        last = F.trim(F.element_at(fields, -1))
        return F.when(is_url(last), last)
    if strategy == "field_6":
        return text.blank_to_null(F.get(fields, F.lit(5)))
    return F.trim(F.get(F.filter(F.slice(fields, 1, 10), is_url), F.lit(0)))


def security_key(composite_figi: Column, share_class_figi: Column, isin: Column, cusip: Column, name: Column) -> Column:
    """The strongest identifier that a security has: composite FIGI, share class FIGI, ISIN, CUSIP with name."""
    tagged = lambda tag, x: F.concat(F.lit(f"{tag}:"), text.blank_to_null(x))
    both = F.concat(F.lit("cusip_name:"), F.coalesce(F.trim(cusip), F.lit("")), F.lit("|"), text.dedup_name(name))
    return F.coalesce(tagged("composite_figi", composite_figi), tagged("share_class_figi", share_class_figi), tagged("isin", isin), both)


def ingest_records(new: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of `new` that are inserted: the first of each (feed, record_key), unless known already.

    new has feed, record_key, interval_ts, file_id and line_no; known has feed and record_key.
    """
    first = keep_first(new, ["feed", "record_key"], [F.col("interval_ts"), F.col("file_id"), F.col("line_no")])
    return first.join(known.select("feed", "record_key"), ["feed", "record_key"], "left_anti")
