"""Aggregations: per-document rollups, per-filing totals, metrics and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed


def rollup_documents(records: DataFrame, key: str = "document_id", seq: Sequence[str] = ("interval_ts", "file_id", "line_no"), feed: str = "feed", url: str = "source_url", ts: str = "interval_ts") -> DataFrame:
    """First and last sight of each document in order of application; the last time is the greatest one.

    One aggregation with map-side combine, so a document that a third of the records name costs one row
    for each task.
    """
    at = F.struct(*seq)
    return records.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.min_by(ts, at).alias("first_seen_interval_ts"),
        F.max(ts).alias("last_seen_interval_ts"),
        F.min_by(feed, at).alias("first_seen_feed"),
        F.max_by(feed, at).alias("last_seen_feed"),
        F.min_by(url, at).alias("first_source_url"),
        F.max_by(url, at).alias("last_source_url"),
        F.count("*").alias("observations"),
    )


def merge_rollups(table: DataFrame, new: DataFrame, key: str = "document_id") -> DataFrame:
    """The rollup table after a batch: `new` was applied after all of `table`."""
    both = table.withColumn("__part", F.lit(0)).unionByName(new.withColumn("__part", F.lit(1)))
    return both.groupBy(key).agg(
        F.min_by("first_seen_interval_ts", "__part").alias("first_seen_interval_ts"),
        F.max("last_seen_interval_ts").alias("last_seen_interval_ts"),
        F.min_by("first_seen_feed", "__part").alias("first_seen_feed"),
        F.max_by("last_seen_feed", "__part").alias("last_seen_feed"),
        F.min_by("first_source_url", "__part").alias("first_source_url"),
        F.max_by("last_source_url", "__part").alias("last_source_url"),
        F.sum("observations").alias("observations"),
    )


def total_and_count(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Sum that skips nulls, and the number of rows, for each key."""
    return rows.groupBy(key).agg(F.sum(value).alias("total_value"), F.count("*").alias("entry_count"))


def histogram(rows: DataFrame, labels: Sequence[str], value: str, bounds: Sequence[float] = fixed.LATENCY_BOUNDS) -> DataFrame:
    """Cumulative buckets: labels, le, bucket_count, and the labels' total_sum and total_count.

    One aggregation with a conditional count per bound; the buckets are unfolded afterwards.
    """
    names = [f"__{i}" for i in range(len(bounds))]
    counts = [F.count_if(F.col(value) <= b).alias(n) for b, n in zip(bounds, names, strict=True)]
    done = rows.groupBy(*labels).agg(*counts, F.sum(value).alias("total_sum"), F.count(value).alias("total_count"))
    pairs = [F.struct(F.lit(str(b)).alias("le"), F.col(n).alias("bucket_count")) for b, n in zip(bounds, names, strict=True)]
    pairs.append(F.struct(F.lit("+Inf").alias("le"), F.col("total_count").alias("bucket_count")))
    return done.select(*labels, "total_sum", "total_count", F.inline(F.array(*pairs)))


def counters(rows: DataFrame, labels: Sequence[str], amount: str) -> DataFrame:
    return rows.groupBy(*labels).agg(F.sum(amount).alias("value"))


def gauges(rows: DataFrame, labels: Sequence[str], value: str, at: str) -> DataFrame:
    """The last value that each label set was given."""
    return rows.groupBy(*labels).agg(F.max_by(value, at).alias("value"))


def exposition(metrics: DataFrame) -> DataFrame:
    """Metric rows (name, kind, help, labels, value) as exposition lines in order: line."""
    from ..functions.digests import labels_key

    rows = metrics.withColumn("key", labels_key(F.col("labels")))
    heads = rows.select("name", "kind", "help").distinct().select("name", F.inline(F.array(
        F.struct(F.lit(0).alias("part"), F.lit("").alias("key"), F.concat_ws(" ", F.lit("# HELP"), "name", "help").alias("line")),
        F.struct(F.lit(1).alias("part"), F.lit("").alias("key"), F.concat_ws(" ", F.lit("# TYPE"), "name", "kind").alias("line")),
    )))
    own = rows.select("name", F.lit(2).alias("part"), "key", F.concat(F.col("name"), F.col("key"), F.lit(" "), F.col("value").cast("string")).alias("line"))
    return heads.unionByName(own).orderBy("name", "part", "key").select("line")


def health(gauge: DataFrame, stale_seconds: float, now: Column) -> DataFrame:
    """status from the last poll: ok, stale, or starting where there was none."""
    last = gauge.agg(F.max("at").alias("last"))
    age = F.unix_timestamp(now) - F.unix_timestamp("last")
    return last.select(F.when(F.col("last").isNull(), "starting").when(age > stale_seconds, "stale").otherwise("ok").alias("status"), age.alias("age_seconds"))


def run_summary(files: DataFrame, inserted: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row about a run: files by status, records inserted and skipped, the range of intervals."""
    a = files.agg(
        F.count("*").alias("files"),
        F.count_if(F.col("download_status") == "applied").alias("applied"),
        F.count_if(F.col("download_status") == "failed").alias("failed"),
        F.min("interval_ts").alias("first_interval"),
        F.max("interval_ts").alias("last_interval"),
    )
    return a.crossJoin(inserted.agg(F.count("*").alias("inserted"))).crossJoin(skipped.agg(F.count("*").alias("skipped")))
