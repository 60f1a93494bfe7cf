"""Lookups in the state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def filing(filings: DataFrame, accessions: DataFrame) -> DataFrame:
    """The filings asked for (accession)."""
    return filings.join(accessions.select("accession").distinct(), "accession", "left_semi")


def filing_documents(documents: DataFrame, accessions: DataFrame) -> DataFrame:
    """The documents of the filings asked for, in their order (accession, sequence, filename)."""
    return documents.join(accessions.select("accession").distinct(), "accession", "left_semi").orderBy("accession", "sequence", "filename")


def existence(accessions: DataFrame, filings: DataFrame) -> DataFrame:
    """accession, known: whether a filing is in the table."""
    there = filings.select("accession").distinct().withColumn("known", F.lit(True))
    return accessions.select("accession").distinct().join(there, "accession", "left").select("accession", F.coalesce("known", F.lit(False)).alias("known"))


def known_accessions(filings: DataFrame, cik: str = "cik") -> DataFrame:
    """cik, accession of all filings, each once."""
    return filings.select(cik, "accession").distinct()


def filing_counts(filings: DataFrame, status: str = "retrieval_status") -> DataFrame:
    """How many filings have each status, and how many there are (status null)."""
    return filings.rollup(status).agg(F.count("*").alias("n"))


def pending_count(outbox: DataFrame) -> DataFrame:
    """One row: events that aren't published yet (pending or leased)."""
    return outbox.agg(F.count_if(F.col("status").isin("pending", "leased")).alias("pending"))
