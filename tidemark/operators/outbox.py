"""The event log: deterministic ids, payload digests, revisions, day files, and the events of parsed filings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed
from ..functions.digests import canonical_json, event_id, payload_hash
from .topk import capped, first_n


def envelopes(rows: DataFrame, subject: Column | str, key: Column, payload: dict[str, Column], created_at: Column, accession: str = "accession") -> DataFrame:
    """Events of rows: event_id, subject, accession, payload_json, payload_hash, created_at.

    The same subject and business key give the same id in every run, so publishing twice is harmless.
    """
    subject = F.lit(subject) if isinstance(subject, str) else subject
    body = canonical_json(**payload)
    return rows.select(
        event_id(subject, key).alias("event_id"),
        subject.alias("subject"),
        F.col(accession).alias("accession"),
        body.alias("payload_json"),
        payload_hash(body).alias("payload_hash"),
        created_at.alias("created_at"),
    )


def append_revisions(log: DataFrame, new: DataFrame) -> DataFrame:
    """New events behind the log. An event that the log has with the same payload is left out; one with
    another payload is a revision. commit_seq goes on from the log's last, in order of created_at and id.

    The log needs one sequence: rows are numbered within buckets (a time and the first letters of an id, as
    ids are digests), buckets within days, days one behind the other, so that no task orders a whole day."""
    fresh = new.dropDuplicates(["event_id", "payload_hash"]).join(log.select("event_id", "payload_hash"), ["event_id", "payload_hash"], "left_anti")
    last = log.agg(F.coalesce(F.max("commit_seq"), F.lit(0)).alias("__last"))
    bucket = ["created_at", "__head"]
    fresh = fresh.withColumns({"__day": F.substring("created_at", 1, 10), "__head": F.substring("event_id", 1, 3)})
    sizes = fresh.groupBy("__day", *bucket).agg(F.count("*").alias("__n"))
    days = sizes.groupBy("__day").agg(F.sum("__n").alias("__n"))
    days = days.select("__day", (F.sum("__n").over(Window.orderBy("__day")) - F.col("__n")).alias("__days"))
    within = Window.partitionBy("__day").orderBy(*bucket)
    before = sizes.withColumn("__before", F.sum("__n").over(within) - F.col("__n")).drop("__n").join(F.broadcast(days), "__day").withColumn("__before", F.col("__before") + F.col("__days"))
    own = F.row_number().over(Window.partitionBy(*bucket).orderBy("event_id", "payload_hash"))
    numbered = fresh.withColumn("__own", own).join(before.drop("__day"), bucket).join(F.broadcast(last), how="cross")
    seq = (F.col("__last") + F.col("__before") + F.col("__own")).cast("long")
    return log.unionByName(numbered.withColumn("commit_seq", seq).select(*log.columns))


def authoritative(log: DataFrame) -> DataFrame:
    """The newest revision of each event."""
    rest = [c for c in log.columns if c != "event_id"]
    return log.groupBy("event_id").agg(F.max_by(F.struct(*rest), "commit_seq").alias("r")).select("event_id", "r.*").select(*log.columns)


def event_day(committed_at: Column, created_at: Column) -> Column:
    return F.substring(F.coalesce(committed_at, created_at).cast("string"), 1, 10)


def publish(events: DataFrame, folder: str) -> None:
    """Appends events to JSON day files, in commit order within a file; a long day is several files, one behind the other."""
    rows = events.withColumn("event_date", event_day(F.col("committed_at"), F.col("created_at")))
    rows.repartitionByRange("event_date", "commit_seq").sortWithinPartitions("event_date", "commit_seq").write.partitionBy("event_date").mode("append").json(folder)


def retrieved_events(filings: DataFrame, now: Column) -> DataFrame:
    """Events of filings that were retrieved; without a primary document they are partial."""
    subject = F.when(F.col("primary_doc_path").isNotNull(), fixed.SUBJECTS["retrieved"]).otherwise(fixed.SUBJECTS["retrieved_partial"])
    names = ("accession", "archive_cik", "form_type", "company_name", "issuer_cik", "issuer_name", "filing_date", "raw_txt_path", "primary_doc_path", "txt_sha256", "primary_sha256")
    return envelopes(filings, subject, F.col("accession"), {n: F.col(n) if n in filings.columns else F.lit(None).cast("string") for n in names}, now)


def failed_events(filings: DataFrame, now: Column) -> DataFrame:
    key = F.concat_ws(":", "accession", F.col("attempt").cast("string"))
    payload = {"accession": F.col("accession"), "form_type": F.col("form_type"), "attempt": F.col("attempt"), "error": F.substring("error", 1, 500)}
    return envelopes(filings, fixed.SUBJECTS["failed"], key, payload, now)


def item_events(items: DataFrame, now: Column) -> DataFrame:
    """One event for each item of a current report."""
    payload = {n: F.col(n) for n in ("accession", "item_number", "item_description")}
    return envelopes(items, fixed.SUBJECTS["eight_k_item"], F.concat_ws(":", "accession", "item_number"), payload, now)


def listed_events(rows: DataFrame, subject: str, now: Column, n: int, order: list[Column], item: Column) -> DataFrame:
    """One event per filing with its first n rows: facts (30), transactions (20), holdings by value (20), key facts (50)."""
    few = capped(rows, ["accession"], order, n, item)
    return envelopes(few, fixed.SUBJECTS[subject], F.col("accession"), {"accession": F.col("accession"), "items": F.col("items"), "total": F.col("total")}, now)


def gap_event(gap: DataFrame, now: Column) -> DataFrame:
    """A feed gap: found is false. Its id is random, as two gaps are two events."""
    body = canonical_json(watermark=F.col("watermark"), pages_checked=F.col("pages_checked"))
    return gap.where("NOT found").select(F.substring(F.sha2(F.uuid(), 256), 1, 32).alias("event_id"), F.lit(fixed.SUBJECTS["feed_gap"]).alias("subject"), F.lit("N/A").alias("accession"), body.alias("payload_json"), payload_hash(body).alias("payload_hash"), now.alias("created_at"))


__all__ = ["append_revisions", "authoritative", "envelopes", "event_day", "failed_events", "first_n", "gap_event", "item_events", "listed_events", "publish", "retrieved_events"]
