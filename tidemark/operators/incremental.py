"""Watermarks, manifests and calendars of incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def after_watermark(feed: DataFrame, watermark: DataFrame, ts: str = "accepted_at", key: str = "accession") -> DataFrame:
    """Rows past the watermark: without a time, later than it, or at it and not in its boundary set.

    watermark: one row with ts (null: none yet) and boundary (array of keys).
    """
    state = watermark.select(F.col("ts").alias("__ts"), F.col("boundary").alias("__boundary"))
    both = feed.join(F.broadcast(state), how="cross")  # one row
    new = F.col(ts).isNull() | F.col("__ts").isNull() | (F.col(ts) > F.col("__ts"))
    new = new | ((F.col(ts) == F.col("__ts")) & ~F.array_contains(F.coalesce("__boundary", F.array().cast("array<string>")), F.col(key).cast("string")))
    return both.where(new).drop("__ts", "__boundary")


def boundary_found(feed: DataFrame, watermark: DataFrame, ts: str = "accepted_at", key: str = "accession") -> Column | DataFrame:
    """One row, found: whether the feed reaches back to the watermark (else there is a gap)."""
    state = watermark.select(F.col("ts").alias("__ts"), F.col("boundary").alias("__boundary"))
    both = feed.join(F.broadcast(state), how="cross")
    old = (F.col(ts) < F.col("__ts")) | ((F.col(ts) == F.col("__ts")) & F.array_contains("__boundary", F.col(key).cast("string"))) | F.col("__ts").isNull()
    return both.agg(F.coalesce(F.bool_or(old), F.lit(False)).alias("found"))


#: The most keys of one time that a watermark holds: its state is one row.
MOST_KEYS = 1_000_000


def advance_watermark(feed: DataFrame, watermark: DataFrame, ts: str = "accepted_at", key: str = "accession", most: int = MOST_KEYS) -> DataFrame:
    """The next watermark: the latest time and the keys at it; keys of the old boundary stay if the time does.

    The state is one row by its format, so more than `most` keys of one time are an error.
    """
    old = watermark.select(F.col("ts").cast("timestamp").alias("ts"), F.explode_outer("boundary").alias("key"))
    rows = feed.select(F.col(ts).alias("ts"), F.col(key).cast("string").alias("key")).unionByName(old)
    latest = rows.agg(F.max("ts").alias("__max"))
    at = rows.join(F.broadcast(latest), rows["ts"] == latest["__max"])
    # keys come one by one from a distributed distinct, so that the last task sees each once and at most one too many
    keys = at.select(F.col("__max").alias("ts"), "key").distinct().limit(most + 1)
    out = keys.groupBy("ts").agg(F.array_sort(F.collect_set("key")).alias("boundary"), F.count("*").alias("__keys"))
    few = F.when(F.col("__keys") > most, F.raise_error(F.lit(f"more than {most} keys share the latest time"))).otherwise(F.col("boundary"))
    return out.select("ts", few.alias("boundary"))


def parse_watermark(raw: Column) -> Column:
    """ts and boundary from stored text: JSON, a bare time, or nothing."""
    from ..functions.dates import parse_timestamp

    stored = F.from_json(raw, "struct<accepted_at:string,accessions:array<string>>")
    ts = F.coalesce(parse_timestamp(stored["accepted_at"]), parse_timestamp(raw))
    return F.struct(ts.alias("ts"), F.coalesce(stored["accessions"], F.array().cast("array<string>")).alias("boundary"))


def discover_files(listed: DataFrame, feeds: DataFrame) -> DataFrame:
    """Files of each feed in the master lists. listed: list, size, md5, url; feeds (a small table): feed, list, pattern."""
    both = listed.join(F.broadcast(feeds), "list").where("url rlike pattern")
    return both.select("feed", F.col("url").alias("source_url"), F.regexp_extract("url", r"/(\d{14})", 1).alias("interval_ts"), "md5", "size")


def pending_files(manifest: DataFrame, since: str | None, until: str, most: int | None = None) -> DataFrame:
    """Files not yet applied within a range of intervals, earliest first."""
    rows = manifest.where(F.col("applied_at").isNull() & (F.col("interval_ts") <= until))
    if since:
        rows = rows.where(F.col("interval_ts") >= since)
    rows = rows.orderBy("interval_ts", "id")
    return rows.limit(most) if most is not None else rows


def missing_business_days(spark, first: str, last: str, done: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Weekdays of a range that aren't done. done, holidays: day."""
    days = spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(first)), F.to_date(F.lit(last)))).alias("day")).where(F.weekday("day") < 5)
    out = days.join(done.select("day"), "day", "left_anti")
    return out.join(holidays.select("day"), "day", "left_anti") if holidays is not None else out


def bootstrap(recent: DataFrame, older: DataFrame, known: DataFrame, since: str, key: str = "accession", day: str = "filing_date") -> DataFrame:
    """Recent and older filings together, each once, not known yet, on or after a day."""
    both = recent.unionByName(older).dropDuplicates([key])
    return both.join(known.select(key), key, "left_anti").where(F.col(day) >= F.lit(since).cast("date"))


def cron_weekday_hour(expression: Column) -> Column:
    """Weekday, hour and minute of a five-field cron text; Saturday 11:00 where it can't be read."""
    parts = F.split(F.trim(expression), r"\s+")
    at = lambda i: F.when(F.get(parts, F.lit(i)).rlike(r"^\d+$"), F.get(parts, F.lit(i)).try_cast("int"))
    good = (F.size(parts) == 5) & at(0).isNotNull() & at(1).isNotNull() & at(4).isNotNull()
    pick = lambda x, otherwise: F.when(good, x).otherwise(F.lit(otherwise))
    return F.struct(pick(at(4), 6).alias("weekday"), pick(at(1), 11).alias("hour"), pick(at(0), 0).alias("minute"))
