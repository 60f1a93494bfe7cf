"""Filing feeds: Atom pages, company submissions, daily indexes, and the news dumps' master lists and archives."""

from __future__ import annotations

import gzip
import html
import io
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..plans.batches import Row, parse_each, text_at, xml_root

ENTRY = "position int, title string, updated string, summary string, href string, term string"


def atom_entries(content: bytes | str) -> Iterator[Row]:
    root = xml_root(content)
    for i, entry in enumerate(root.iter("entry") if root is not None else ()):
        link, category = entry.find("link"), entry.find("category")
        summary = entry.find("summary")
        yield {
            "position": i,
            "title": text_at(entry, "title") or "",
            "updated": text_at(entry, "updated"),
            "summary": html.unescape("".join(summary.itertext())) if summary is not None else "",
            "href": link.get("href") if link is not None else None,
            "term": category.get("term") if category is not None else None,
        }


def atom_feed(pages: DataFrame) -> DataFrame:
    """Discoveries of Atom pages (page, content), in the feed's order; entries without accession or CIK are left out."""
    rows = parse_each(pages, atom_entries, ENTRY, key="page")
    title, summary, href = F.col("title"), F.col("summary"), F.col("href")
    form = text.first_match(title, r"^([A-Z0-9\-/]+)\s+-\s+.+$")
    rest = F.coalesce(text.first_match(title, r"^[A-Z0-9\-/]+\s+-\s+(.+)$"), title)
    cik = F.coalesce(text.normalize_cik(text.first_match(rest, r"\((\d{1,10})\)")), text.normalize_cik(text.first_match(href, r"/data/(\d{1,10})/")))
    accession = text.extract_accession(F.concat_ws(" ", title, summary, href))
    found = rows.select(
        "page",
        "position",
        accession.alias("accession"),
        cik.alias("cik"),
        F.coalesce(text.first_match(rest, r"^(.*?)\s*\(\d{1,10}\)"), text.blank_to_null(rest), F.lit("UNKNOWN")).alias("company_name"),
        F.coalesce(text.blank_to_null(F.col("term")), form, F.lit("UNKNOWN")).alias("form_type"),
        dates.parse_date(text.first_match(F.regexp_replace(summary, r"<[^>]+>", ""), r"Filed:?\s*(\d{4}-\d{2}-\d{2}|\d{8})")).alias("filing_date"),
        F.coalesce(dates.parse_timestamp(F.col("updated")), dates.parse_timestamp(text.first_match(summary, r"Accepted:?\s*([^<\n]+)"))).alias("accepted_at"),
        "href",
        F.lit("latest_filings_atom").alias("source"),
    )
    good = found.where("accession IS NOT NULL AND cik IS NOT NULL")
    return good.withColumns(text.submission_urls(F.col("cik"), F.col("accession")))


RECENT = "struct<accessionNumber:array<string>,filingDate:array<string>,acceptanceDateTime:array<string>,form:array<string>,primaryDocument:array<string>>"
COMPANY = f"struct<cik:string,name:string,tickers:array<string>,exchanges:array<string>,formerNames:array<struct<name:string>>,filings:struct<recent:{RECENT},files:array<struct<name:string>>>>"


def unfold_recent(rows: DataFrame, recent: Column) -> DataFrame:
    """Filings from parallel arrays; short arrays are padded. rows: cik, company_name."""
    names = {"accessionNumber": "accession", "filingDate": "filed", "acceptanceDateTime": "accepted", "form": "form_type", "primaryDocument": "primary_document"}
    none = F.array().cast("array<string>")  # a missing array is a short one
    zipped = F.arrays_zip(*(F.coalesce(recent[a], none).alias(b) for a, b in names.items()))
    each = rows.select("cik", "company_name", F.posexplode(zipped).alias("position", "z")).select("cik", "company_name", "position", "z.*")
    return each.where(text.is_accession(F.col("accession"))).select(
        "accession", "cik", F.coalesce("company_name", F.lit("UNKNOWN")).alias("company_name"), F.coalesce(text.blank_to_null(F.col("form_type")), F.lit("UNKNOWN")).alias("form_type"),
        dates.parse_date(F.col("filed")).alias("filing_date"), dates.parse_timestamp(F.col("accepted")).alias("accepted_at"), text.blank_to_null(F.col("primary_document")).alias("primary_document"), "position",
    )


def submissions(payloads: DataFrame) -> DataFrame:
    """Recent filings of company payloads. payloads: json."""
    rows = payloads.select(F.from_json("json", COMPANY).alias("c")).select(text.digits_cik(F.col("c.cik")).alias("cik"), F.col("c.name").alias("company_name"), F.col("c.filings.recent").alias("recent"))
    return unfold_recent(rows, F.col("recent"))


def older_submissions(payloads: DataFrame) -> DataFrame:
    """Filings of history payloads, whose company is given. payloads: cik, company_name, json."""
    rows = payloads.select("cik", "company_name", F.from_json("json", RECENT).alias("recent"))
    return unfold_recent(rows, F.col("recent"))


def history_urls(payloads: DataFrame, base: str = "https://data.sec.gov/submissions/") -> DataFrame:
    """Urls of a company's history files, whether they're named by text or by an object."""
    names = F.expr("from_json(get_json_object(json, '$.filings.files'), 'array<string>')")
    each = payloads.select(F.explode(names).alias("f"))
    return each.select(F.concat(F.lit(base), F.coalesce(F.get_json_object("f", "$.name"), F.col("f"))).alias("url")).where("url IS NOT NULL")


def profiles(payloads: DataFrame) -> DataFrame:
    """cik, names (current first, normalised), tickers of company payloads."""
    rows = payloads.select(F.from_json("json", COMPANY).alias("c"))
    names = F.concat(F.array("c.name"), F.coalesce(F.transform("c.formerNames", lambda x: x["name"]), F.array().cast("array<string>")))
    clean = F.filter(F.transform(names, text.company_name), lambda x: x != "")
    return rows.select(text.digits_cik(F.col("c.cik")).alias("cik"), clean.alias("names"), F.transform(F.coalesce("c.tickers", F.array().cast("array<string>")), text.normalize_ticker).alias("tickers"))


def company_index(lines: DataFrame) -> DataFrame:
    """Rows of a daily index: lines (value) of five fields with a number first; what stands before the heading has none."""
    parts = F.split("value", r"\|")
    rows = lines.select(parts.alias("p")).where((F.size("p") == 5) & F.trim(F.get("p", F.lit(0))).rlike(r"^\d{1,10}$"))
    at = lambda i: F.trim(F.get("p", F.lit(i)))
    return rows.select(text.normalize_cik(at(0)).alias("cik"), at(1).alias("company_name"), at(2).alias("form_type"), dates.parse_date(at(3)).alias("filing_date"), at(4).alias("filename"), text.extract_accession(at(4)).alias("accession")).where("accession IS NOT NULL")


def master_list(lines: DataFrame) -> DataFrame:
    """size, md5, url of master list lines (value); other lines are left out, a line with three fields and a url is tolerated."""
    v = F.trim(F.col("value"))
    strict = r"^(\d+)\s+([0-9A-Fa-f]{32})\s+(https?://\S+)$"
    loose = F.split(v, r"\s+")
    is_loose = (F.size(loose) >= 3) & F.get(loose, F.lit(0)).rlike(r"^\d+$") & F.get(loose, F.lit(2)).rlike("^https?://")
    return lines.where(v.rlike(strict) | is_loose).select(F.get(loose, F.lit(0)).cast("bigint").alias("size"), F.lower(F.get(loose, F.lit(1))).alias("md5"), F.get(loose, F.lit(2)).alias("url"))


def archive_lines(files: DataFrame, id_col: str = "path") -> DataFrame:
    """path, line_no, line of every line in ZIP or GZ files read with the binaryFile source; damaged files give no lines."""

    def unpack(content: bytes) -> Iterator[bytes]:
        if content[:2] == b"\x1f\x8b":
            yield gzip.decompress(content)
            return
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            yield from (z.read(n) for n in z.namelist() if not n.endswith("/"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, content in zip(batch[id_col], batch["content"], strict=True):
                try:
                    members = list(unpack(content))
                except (OSError, EOFError, zipfile.BadZipFile):
                    continue
                lines = [x.rstrip("\r") for m in members for x in m.decode("utf-8", "replace").split("\n")]
                lines = [(i, x) for i, x in enumerate(lines) if x]
                yield pd.DataFrame({id_col: key, "line_no": [i for i, _ in lines], "line": [x for _, x in lines]})

    return files.select(id_col, "content").mapInPandas(read, f"{id_col} string, line_no long, line string")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    return archive_lines(spark.read.format("binaryFile").load(path))


def well_formed(content: bytes | str) -> bool:
    try:
        ET.fromstring(content)
    except ET.ParseError:
        return False
    return True
