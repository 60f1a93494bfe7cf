"""Retries, leases and stranded work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions.numbers import backoff


def retry_candidates(filings: DataFrame, now: Column, most: int = 50, attempts: int = fixed.MAX_FILING_ATTEMPTS) -> DataFrame:
    """Failed or partial filings that may be tried again, least recently updated first."""
    ready = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)
    rows = filings.where(F.col("retrieval_status").isin(*fixed.RETRYABLE_RETRIEVAL) & ~F.col("relevance_state").isin(*fixed.TERMINAL_RELEVANCE) & (F.col("attempts") < attempts) & ready)
    return rows.orderBy("updated_at", "accession").limit(most)


def header_candidates(filings: DataFrame, now: Column, most: int = 100, attempts: int = fixed.MAX_FILING_ATTEMPTS) -> DataFrame:
    """Filings whose header failed for the moment."""
    ready = F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now)
    return filings.where((F.col("relevance_state") == "hdr_transient_fail") & (F.col("attempts") < attempts) & ready).orderBy("updated_at", "accession").limit(most)


def pending_headers(filings: DataFrame, most: int = 100) -> DataFrame:
    return filings.where("relevance_state = 'hdr_pending'").orderBy("updated_at", "accession").limit(most)


def stranded(filings: DataFrame, most: int = 200) -> DataFrame:
    """Work that was begun and not ended, with the route that it takes next."""
    from .classify import recovery_route

    skip = ("unknown", "hdr_pending", *fixed.TERMINAL_RELEVANCE)
    rows = filings.where(F.col("retrieval_status").isin(*fixed.STRANDED_RETRIEVAL) & ~F.col("relevance_state").isin(*skip))
    return rows.withColumn("route", recovery_route(F.col("relevance_state"))).orderBy("updated_at", "accession").limit(most)


def unprocessed(filings: DataFrame, most: int = 200) -> DataFrame:
    return filings.where("relevance_state = 'unknown' AND retrieval_status = 'discovered'").orderBy("updated_at", "accession").limit(most)


def work_list(*lists: DataFrame) -> DataFrame:
    """The union of work lists (accession, kind, rank), each filing once, in its most urgent list."""
    out = lists[0]
    for more in lists[1:]:
        out = out.unionByName(more)
    return out.groupBy("accession").agg(F.min_by("kind", F.struct("rank", "kind")).alias("kind"), F.min("rank").alias("rank"))


def after_attempt(filings: DataFrame, results: DataFrame, now: Column, base: float = fixed.BACKOFF_BASE) -> DataFrame:
    """Status, attempts and the time of the next try after results (accession, status) came in."""
    both = filings.join(results.withColumnRenamed("status", "__status"), "accession", "left")
    failed = F.col("__status").isin(*fixed.RETRYABLE_RETRIEVAL)
    wait = backoff(F.col("attempts"), base)
    later = F.timestamp_seconds(F.unix_timestamp(now) + wait)
    return (
        both.withColumn("next_retry_at", F.when(failed, later).when(F.col("__status").isNull(), F.col("next_retry_at")))
        .withColumn("attempts", F.col("attempts") + F.coalesce(failed.cast("int"), F.lit(0)))
        .withColumn("retrieval_status", F.coalesce("__status", "retrieval_status"))
        .select(*filings.columns)
    )


def cooling_down(next_retry_at: Column, now: Column) -> Column:
    return F.coalesce(next_retry_at > now, F.lit(False))


def queue(filings: DataFrame, wanted: DataFrame, now: Column, force: bool = False) -> DataFrame:
    """Wanted filings (accession) become queued, unless they are cooling down (or by force)."""
    both = filings.join(wanted.select("accession").distinct().withColumn("__wanted", F.lit(True)), "accession", "left")
    ready = F.lit(True) if force else ~cooling_down(F.col("next_retry_at"), now)
    return both.withColumn("retrieval_status", F.when(F.col("__wanted") & ready, "queued").otherwise(F.col("retrieval_status"))).select(*filings.columns)


def header_failed(filings: DataFrame, failed: DataFrame, now: Column, base: float = fixed.BACKOFF_BASE) -> DataFrame:
    """Headers that couldn't be fetched for the moment: state, one more attempt, and a backoff."""
    both = filings.join(failed.select("accession").distinct().withColumn("__failed", F.lit(True)), "accession", "left")
    hit = F.coalesce("__failed", F.lit(False))
    later = F.timestamp_seconds(F.unix_timestamp(now) + backoff(F.col("attempts"), base))
    return (
        both.withColumn("next_retry_at", F.when(hit, later).otherwise(F.col("next_retry_at")))
        .withColumn("attempts", F.col("attempts") + hit.cast("int"))
        .withColumn("relevance_state", F.when(hit, "hdr_transient_fail").otherwise(F.col("relevance_state")))
        .select(*filings.columns)
    )


def lease_batch(outbox: DataFrame, now: Column, most: int = 200, lease_seconds: int = 60) -> DataFrame:
    """The next events to publish, in commit order; expired leases count as pending."""
    expired = (F.col("status") == "leased") & (F.col("leased_at") < F.timestamp_seconds(F.unix_timestamp(now) - lease_seconds))
    due = F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= now)
    rows = outbox.where(((F.col("status") == "pending") | expired) & due)
    return rows.orderBy(F.coalesce("commit_seq", F.lit(-1)), "created_at", "event_id").limit(most)


def mark_published(outbox: DataFrame, published: DataFrame) -> DataFrame:
    """Compare and set: only events whose lease token is still the publisher's become published."""
    done = published.select("commit_seq", "lease_token").distinct().withColumn("__done", F.lit(True))
    both = outbox.join(done, ["commit_seq", "lease_token"], "left")
    return both.withColumn("status", F.when(F.col("__done"), "published").otherwise(F.col("status"))).select(*outbox.columns)


def mark_publish_failed(outbox: DataFrame, failed: DataFrame, now: Column, most: int = fixed.MAX_PUBLISH_ATTEMPTS) -> DataFrame:
    """One more attempt, a backoff, and failed for good after `most`; errors keep 1000 characters."""
    both = outbox.join(failed.select("commit_seq", F.substring("error", 1, 1000).alias("__error")), "commit_seq", "left")
    hit = F.col("__error").isNotNull()
    attempts = F.col("publish_attempts") + hit.cast("int")
    later = F.timestamp_seconds(F.unix_timestamp(now) + backoff(F.col("publish_attempts")))
    status = F.when(hit, F.when(attempts >= most, "failed").otherwise("pending")).otherwise(F.col("status"))
    return (
        both.withColumn("next_attempt_at", F.when(hit, later).otherwise(F.col("next_attempt_at")))
        .withColumn("status", status)
        .withColumn("publish_attempts", attempts)
        .withColumn("last_error", F.coalesce("__error", "last_error"))
        .select(*outbox.columns)
    )


def reset_stale_leases(outbox: DataFrame, now: Column, stale_seconds: int = 120) -> DataFrame:
    stale = (F.col("status") == "leased") & (F.col("leased_at") < F.timestamp_seconds(F.unix_timestamp(now) - stale_seconds))
    return outbox.withColumn("status", F.when(stale, "pending").otherwise(F.col("status")))
