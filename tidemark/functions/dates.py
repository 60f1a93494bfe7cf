"""Dates and times as the feeds write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_date(x: Column) -> Column:
    """ISO or compact date; null for anything else."""
    x = F.trim(x)
    return F.coalesce(
        F.when(x.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(x, "yyyy-M-d")),
        F.when(x.rlike(r"^\d{8}$"), F.try_to_date(x, "yyyyMMdd")),
    )


def parse_timestamp(x: Column) -> Column:
    """ISO time with an offset, Z or none (UTC), with a blank or a T, or 14 digits; fractions are accepted."""
    x = F.trim(x)
    iso = F.regexp_replace(x, " ", "T")
    return F.coalesce(
        F.when(x.rlike(r"^\d{14}$"), F.try_to_timestamp(x, F.lit("yyyyMMddHHmmss"))),
        F.when(iso.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d+)?(?:Z|[+-]\d\d:?\d\d)?$"), F.try_to_timestamp(iso)),
    )


def compact_timestamp(x: Column) -> Column:
    return F.when(x.rlike(r"^\d{14}$"), F.try_to_timestamp(x, F.lit("yyyyMMddHHmmss")))


def is_compact_timestamp(x: Column) -> Column:
    return F.coalesce(compact_timestamp(x).isNotNull(), F.lit(False))


def interval_of_url(url: Column) -> Column:
    """The 14 digits after the first slash that has them; null without any."""
    return F.nullif(F.regexp_extract(url, r"/(\d{14})", 1), F.lit(""))


def german_date(x: Column) -> Column:
    """dd.MM.yyyy from one of the three ways that dates are shown."""
    x = F.trim(x)
    found = F.coalesce(
        F.when(x.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.try_to_date(x, "d.M.yyyy")),
        F.when(x.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(x, "yyyy-M-d")),
        F.when(x.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(x, "d/M/yyyy")),
    )
    return F.date_format(found, "dd.MM.yyyy")


def business_date(ts: Column) -> Column:
    """The calendar day in New York."""
    return F.to_date(F.from_utc_timestamp(ts, "America/New_York"))


def utc_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_compact(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMddHHmmss")


def as_of_date(text: Column, section: str | None = None) -> Column:
    """The date after "Stand:" or "As of:", first behind a section title, else anywhere."""
    pattern = r"(?is)(?:Stand|As\s+of)\s*:?\s*(\d{1,2}[./]\d{1,2}[./]\d{4}|\d{4}-\d{2}-\d{2})"
    anywhere = F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    if not section:
        return anywhere
    inside = F.nullif(F.regexp_extract(text, rf"(?is)\Q{section}\E.*?{pattern[5:]}", 1), F.lit(""))
    return F.coalesce(inside, anywhere)


def leading_date(name: Column) -> Column:
    return F.regexp_extract(F.element_at(F.split(name, "/"), -1), r"^(\d{4}-\d{2}-\d{2})", 1)
