"""Fund constituents: validity, payload summaries, completeness, and the choice among captures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import text
from .dedup import keep_first, security_key


def invalid_constituent(isin: Column, weight: Column) -> Column:
    """Why a constituent row is rejected; null if it's good."""
    return F.when(isin.isNull() | ~isin.rlike(fixed.ISIN), "bad isin").when(weight.isNull() | (weight < 0) | (weight > 1) | F.isnan(weight), "bad weight")


def split_constituents(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows (CUSIP trimmed to null) and rejected ones with their reason."""
    checked = rows.withColumn("reason", invalid_constituent(F.col("isin"), F.col("weight"))).withColumn("cusip", text.blank_to_null(F.col("cusip")))
    return checked.where("reason IS NULL").drop("reason"), checked.where("reason IS NOT NULL")


def to_companies(rows: DataFrame) -> DataFrame:
    """Constituents in the output schema, with empty enrichment columns."""
    empty = ("ticker", "exchange_code", "composite_figi", "share_class_figi", "security_type", "cik", "cik_confidence", "cik_rationale")
    return rows.select(text.constituent_name(F.col("name")).alias("name"), F.col("name").alias("raw_name"), "cusip", "isin", "weight", *(F.lit(None).cast("string").alias(c) for c in empty))


def cik_problem(cik: Column) -> Column:
    """Why a CIK isn't valid (1 to 9 999 999 999); null if it is."""
    x = F.trim(cik.cast("string"))
    n = F.when(x.rlike(r"^\d{1,18}$"), x.try_cast("bigint"))
    return F.when(x.isNull() | (x == "") | (F.lower(x) == "nan"), "missing").when(~x.rlike(r"^\d+$"), "not digits").when(n.isNull() | (n > 9_999_999_999), "too large").when(n < 1, "zero")


def dedup_securities(rows: DataFrame, order: list[Column]) -> DataFrame:
    """The first row of each security by its strongest identifier; a missing CIK drops nothing."""
    key = security_key(F.col("composite_figi"), F.col("share_class_figi"), F.col("isin"), F.col("cusip"), F.col("name"))
    return keep_first(rows.withColumn("dedup_key", key), ["dedup_key"], order)


def summarize_payload(rows: DataFrame, keys: list[str], isin: str, weight: str) -> DataFrame:
    """Count, distinct ISINs, and sum, least and greatest weight of each payload."""
    return rows.groupBy(*keys).agg(
        F.count("*").alias("holdings"),
        F.count_distinct(isin).alias("distinct_isin"),
        F.count(weight).alias("weights"),
        F.round(F.sum(weight), 8).alias("weight_sum"),
        F.min(weight).alias("weight_min"),
        F.max(weight).alias("weight_max"),
    )


def is_authoritative(count: Column, declared: Column, least: int) -> Column:
    return F.coalesce((count >= least) & (declared.isNull() | (declared <= count)), F.lit(False))


def completeness(workbook_rows: Column, payload_rows: Column, declared: Column, least: int = 2500) -> Column:
    """complete (null where neither source is there) and the reasons against it."""
    seen = F.array(
        F.when(workbook_rows < least, "workbook_short"),
        F.when(payload_rows < least, "payload_short"),
        F.when(declared > payload_rows, "declared_more"),
    )
    reasons = F.array_compact(seen)
    return F.struct(F.when(workbook_rows.isNull() & payload_rows.isNull(), F.lit(None)).otherwise(F.size(reasons) == 0).alias("complete"), reasons.alias("reasons"))


def best_capture(captures: DataFrame, keys: list[str], least: int = 2500) -> DataFrame:
    """The best capture: authoritative after the click, any after the click, authoritative before it; the largest first."""
    good = is_authoritative(F.col("count"), F.col("declared"), least)
    tier = F.when(F.col("after_click") & good, 0).when(F.col("after_click"), 1).when(good, 2)
    return keep_first(captures.withColumn("tier", tier).where("tier IS NOT NULL"), keys, [F.col("tier"), F.col("count").desc(), F.col("position")])


def candidate_urls(requests: DataFrame) -> DataFrame:
    """Distinct holdings and workbook urls of network requests, in their first order. requests: position, url."""
    low = F.lower("url")
    rows = requests.where(low.contains("/holdings/") | low.contains(".xlsx"))
    return rows.groupBy("url").agg(F.min("position").alias("position")).orderBy("position")


def url_score(url: Column) -> Column:
    """How good a holdings url is: holdings, full load, JSON, without a preview."""
    low = F.lower(url)
    bit = lambda c: c.cast("int")
    return F.struct(bit(low.contains("/holdings/")).alias("holdings"), bit(~low.contains("loadtype=initial")).alias("full"), bit(low.contains("json")).alias("json"), bit(~low.contains("preview")).alias("whole"))
