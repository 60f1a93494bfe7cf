"""Relevance of filings to a watchlist, and routing by form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import text
from .dedup import keep_first


def is_direct(form: Column, forms: Sequence[str] = fixed.DIRECT_FORMS) -> Column:
    return F.coalesce(F.upper(F.trim(form)).isin(*(f.upper() for f in forms)), F.lit(False))


def is_ambiguous(form: Column, forms: Sequence[str] = fixed.AMBIGUOUS_FORMS) -> Column:
    return F.coalesce(F.upper(F.trim(form)).isin(*(f.upper() for f in forms)), F.lit(False))


def filter_by_forms(filings: DataFrame, allowed: Sequence[str], form: str = "form_type") -> DataFrame:
    return filings.where(F.upper(form).isin(*(f.upper() for f in allowed)))


def handler_of(form: Column) -> Column:
    """Name of the first handler that takes the form; null if none does."""
    out = F.lit(None).cast("string")
    for name, pattern in reversed(fixed.HANDLERS):
        out = F.when(F.upper(F.trim(form)).rlike(pattern), F.lit(name)).otherwise(out)
    return out


def priority_rank(priority: Column) -> Column:
    out = F.lit(len(fixed.PRIORITIES))
    for rank, name in enumerate(fixed.PRIORITIES):
        out = F.when(priority == name, rank).otherwise(out)
    return out


def is_live(priority: Column) -> Column:
    return F.coalesce(priority.isin(*fixed.LIVE_PRIORITIES), F.lit(False))


def watched(filings: DataFrame, watchlist: DataFrame, key: str = "cik") -> DataFrame:
    """Filings of companies on the list (a semi join; Spark broadcasts the list if it's small)."""
    return filings.join(watchlist.select(key), key, "left_semi")


def unwatched(filings: DataFrame, watchlist: DataFrame, key: str = "cik") -> DataFrame:
    return filings.join(watchlist.select(key), key, "left_anti")


def split_known(filings: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Filings with known: whether their key is in the known table."""
    keys = known.select(F.col(key)).distinct().withColumn("known", F.lit(True))
    return filings.join(keys, key, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def classify(filings: DataFrame, watchlist: DataFrame, form: str = "form_type", key: str = "cik") -> DataFrame:
    """relevance_state of new filings: direct forms by their filer, ambiguous ones wait for their header."""
    listed = watchlist.select(key).distinct().withColumn("__listed", F.lit(True))
    state = (
        F.when(is_direct(F.col(form)), F.when(F.col("__listed"), "direct_match").otherwise("direct_unmatched"))
        .when(is_ambiguous(F.col(form)), "hdr_pending")
        .otherwise("other")
    )
    return filings.join(listed, key, "left").withColumn("relevance_state", state).drop("__listed")


def canonical_issuer(form: Column, parties: Column) -> Column:
    """The party that a filing is about: the issuer of ownership forms, else the filer; of activist forms the subject only."""
    first = lambda role: F.get(F.filter(parties, lambda p: p["role"] == role), F.lit(0))
    form = F.upper(F.trim(form))
    return (
        F.when(form.rlike(r"^(?:3|4|5)(?:/A)?$"), F.coalesce(first("issuer"), first("filer")))
        .when(form.isin(*fixed.ACTIVIST_FORMS), first("subject-company"))
        .otherwise(first("filer"))
    )


def name_index(watchlist: DataFrame) -> DataFrame:
    """Normalised names and aliases to companies. A canonical name wins over aliases, the last company over
    earlier ones; of aliases the first wins. watchlist: position, cik, name, aliases."""
    names = watchlist.select(F.col("position"), "cik", text.issuer_name(F.col("name")).alias("key"), F.lit(0).alias("kind"), (-F.col("position")).alias("order"))
    others = watchlist.select("position", "cik", F.posexplode("aliases").alias("at", "alias"))
    others = others.select("position", "cik", text.issuer_name(F.col("alias")).alias("key"), F.lit(1).alias("kind"), F.col("position").alias("order"))
    both = names.unionByName(others).where("key IS NOT NULL AND key <> ''")
    return keep_first(both, ["key"], [F.col("kind"), F.col("order"), F.col("cik")]).select("key", "cik")


def resolve_headers(headers: DataFrame, watchlist: DataFrame) -> DataFrame:
    """State and company of filings by their header. headers: accession, form_type, parties (role, cik, name).

    With a CIK only the CIK decides; the name or an alias decides where there is none.
    """
    issuer = headers.select("accession", "form_type", canonical_issuer(F.col("form_type"), F.col("parties")).alias("i"))
    issuer = issuer.select("accession", "form_type", text.normalize_cik(F.col("i.cik")).alias("issuer_cik"), F.col("i.name").alias("issuer_name"), F.col("i").isNull().alias("none"))
    by_cik = watchlist.select(F.col("cik").alias("issuer_cik"), F.col("cik").alias("found_cik")).distinct()
    by_name = name_index(watchlist).select(F.col("key").alias("__key"), F.col("cik").alias("found_name"))
    both = issuer.join(by_cik, "issuer_cik", "left").join(by_name, text.issuer_name(F.col("issuer_name")) == F.col("__key"), "left")
    found = F.when(F.col("issuer_cik").isNotNull(), F.col("found_cik")).otherwise(F.col("found_name"))
    activist = F.upper(F.trim(F.col("form_type"))).isin(*fixed.ACTIVIST_FORMS)
    state = F.when(F.col("none") & activist, "unresolved").when(F.col("none"), "hdr_failed").when(found.isNotNull(), "hdr_match").otherwise("irrelevant")
    return both.select("accession", state.alias("state"), found.alias("company_cik"), "issuer_cik", "issuer_name")


def is_terminal(relevance: Column, retrieval: Column) -> Column:
    return F.coalesce(relevance.isin(*fixed.TERMINAL_RELEVANCE), F.lit(False)) | F.coalesce(retrieval.isin(*fixed.TERMINAL_RETRIEVAL), F.lit(False))


def recovery_route(relevance: Column) -> Column:
    """Where stranded work goes next."""
    return F.when(relevance.isin("direct_match", "hdr_match"), "retrieval").when(relevance.isin("hdr_pending", "hdr_transient_fail"), "header_gate").otherwise("discovery")
