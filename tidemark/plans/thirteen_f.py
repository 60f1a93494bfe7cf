"""Institutional holdings: information tables, report periods and notices."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import Row, number, parse_each, text_at, whole, xml_root

SCHEMA = (
    "position int, report_period string, issuer_name string, title_of_class string, cusip string, value_thousands double, shares_or_principal double, "
    "shares_or_principal_type string, put_call string, investment_discretion string, voting_sole long, voting_shared long, voting_none long"
)
TEXTS = {"issuer_name": "nameOfIssuer", "title_of_class": "titleOfClass", "cusip": "cusip", "shares_or_principal_type": "shrsOrPrnAmt/sshPrnamtType", "put_call": "putCall", "investment_discretion": "investmentDiscretion"}
NUMBERS = {"value_thousands": "value", "shares_or_principal": "shrsOrPrnAmt/sshPrnamt"}
VOTES = {"voting_sole": "votingAuthority/Sole", "voting_shared": "votingAuthority/Shared", "voting_none": "votingAuthority/None"}


def iso_period(raw: str | None) -> str | None:
    """ISO date from ISO, YYYYMMDD or MMDDYYYY (its first four digits are 1900 at most); other text as it is."""
    if not raw:
        return None
    digits = re.sub(r"[-/]", "", raw.strip())
    if re.fullmatch(r"\d{4}-\d\d-\d\d", raw.strip()) or not re.fullmatch(r"\d{8}", digits):
        return raw.strip()
    year, month, day = (digits[:4], digits[4:6], digits[6:]) if int(digits[:4]) > 1900 else (digits[4:], digits[:2], digits[2:4])
    return f"{year}-{month}-{day}"


def parse(content: bytes | str) -> Iterator[Row]:
    root = xml_root(content)
    if root is None:
        return
    period = iso_period(text_at(root, "reportCalendarOrQuarter", "periodOfReport"))
    for name in ("infoTable", "informationTable"):
        rows = [x for x in root.iter(name) if x is not root] or ([root] if root.tag == name and root.find("nameOfIssuer") is not None else [])
        if rows:
            break
    for i, node in enumerate(rows):
        yield {
            "position": i,
            "report_period": period,
            **{c: text_at(node, path) for c, path in TEXTS.items()},
            **{c: number(text_at(node, path)) for c, path in NUMBERS.items()},
            **{c: whole(text_at(node, path)) for c, path in VOTES.items()},
        }


def holding_rows(docs: DataFrame) -> DataFrame:
    """docs: accession, content."""
    return parse_each(docs, parse, SCHEMA)


def with_header(holdings: DataFrame, headers: DataFrame) -> DataFrame:
    """Holdings with their filer, and the header's period where the table has none. headers: accession, filer_cik, filer_name, period (yyyyMMdd)."""
    both = holdings.join(headers.select("accession", "filer_cik", "filer_name", F.col("period").alias("__period")), "accession", "left")
    return both.withColumn("report_period", F.coalesce("report_period", compact_to_iso(F.col("__period")))).drop("__period")


def compact_to_iso(period: Column) -> Column:
    return F.when(period.rlike(r"^\d{8}$"), F.concat_ws("-", F.substring(period, 1, 4), F.substring(period, 5, 2), F.substring(period, 7, 2)))


def notices(headers: DataFrame) -> DataFrame:
    """Notice filings, which have a header only. headers: accession, form_type, filer_cik, filer_name, period, filing_date."""
    rows = headers.where(F.upper("form_type").rlike(r"^13F-NT(?:/A)?$"))
    return rows.select("accession", F.col("form_type").alias("filing_type"), "filer_cik", "filer_name", compact_to_iso(F.col("period")).alias("report_period"), "filing_date", F.upper("form_type").endswith("/A").alias("is_amendment"))
