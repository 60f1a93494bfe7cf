"""Committing parsed filings: all tables' next versions from one batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import outbox
from .merge import replace_by_key
from .retry import after_attempt


def commit_filings(state: Mapping[str, DataFrame], parsed: Mapping[str, DataFrame], bundles: DataFrame, now: Column) -> dict[str, DataFrame]:
    """The next version of `filings`, `outbox` and each table in `parsed`.

    bundles (accession, raw_txt_path, primary_doc_path, txt_sha256, primary_sha256) are the filings that were
    fetched. Rows of their accessions are replaced in every parsed table, even where a new parse gives
    none. A filing with a primary document is retrieved, another one partial; each gives one event.
    """
    batch = bundles.select("accession")
    out = {name: replace_by_key(state[name], rows, ["accession"], batch) for name, rows in parsed.items()}
    status = F.when(F.col("primary_doc_path").isNotNull(), "retrieved").otherwise("retrieved_partial")
    filings = after_attempt(state["filings"], bundles.select("accession", status.alias("status")), now)
    new = bundles.select("accession", *(F.col(c).alias(f"__{c}") for c in bundles.columns if c != "accession"))
    both = filings.join(new, "accession", "left")
    fetched = [c for c in bundles.columns if c != "accession" and c in filings.columns]
    out["filings"] = both.withColumns({c: F.coalesce(f"__{c}", c) for c in fetched}).select(*filings.columns)
    known = state["filings"].drop(*fetched)
    events = outbox.retrieved_events(bundles.join(known, "accession"), F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"))
    out["outbox"] = outbox.append_revisions(state["outbox"], events)
    return out


def commit_failures(state: Mapping[str, DataFrame], failures: DataFrame, now: Column) -> dict[str, DataFrame]:
    """The next version of `filings` and `outbox` after failures (accession, error): backoff and one event each."""
    filings = after_attempt(state["filings"], failures.select("accession", F.lit("retrieval_failed").alias("status")), now)
    rows = failures.join(filings.select("accession", "form_type", F.col("attempts").alias("attempt")), "accession")
    events = outbox.failed_events(rows, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss"))
    return {"filings": filings, "outbox": outbox.append_revisions(state["outbox"], events)}
