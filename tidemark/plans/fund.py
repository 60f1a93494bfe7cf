"""Fund portfolio reports: XML, or else the page that shows it."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from itertools import dropwhile, takewhile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import fixed
from .batches import Row, number, parse_each, text_at, xml_root

FILING = "series_id string, series_name string, class_id string, report_date string, total_assets double, net_assets double, holding_count int, parse_source string"
HOLDING = (
    "position int, issuer_name string, title string, cusip string, isin string, lei string, balance double, units string, value_usd double, pct_of_nav double, "
    "asset_category string, issuer_category string, country string, currency string, is_restricted boolean, maturity_date string, coupon_rate double"
)
#: Column: paths below a holding, and the names of its column in a page.
TEXTS = {
    "issuer_name": (("name",), ("name",)),
    "title": (("title",), ("title",)),
    "cusip": (("cusip",), ("cusip",)),
    "isin": (("isin",), ("isin",)),
    "lei": (("lei",), ("lei",)),
    "units": (("units",), ("units",)),
    "asset_category": (("assetCat",), ("assetcat", "asset_category")),
    "issuer_category": (("issuerCat",), ("issuercat", "issuer_category")),
    "country": (("invCountry",), ("invcountry", "country")),
    "currency": (("curCd",), ("curcd", "currency")),
    "maturity_date": (("debtSec/maturityDt", "maturityDt"), ("maturitydt", "maturity_date")),
}
NUMBERS = {
    "balance": (("balance",), ("balance",)),
    "value_usd": (("valUSD",), ("valussd", "valusd", "value")),
    "pct_of_nav": (("pctVal",), ("pctval", "pct_of_nav")),
    "coupon_rate": (("debtSec/couponKind/couponRate", "debtSec/couponRate", "couponRate"), ("couponrate", "coupon_rate")),
}
RESTRICTED = (("isRestrictedSec",), ("isrestrictedsec", "is_restricted"))
GENERAL = {"series_id": "seriesId", "series_name": "seriesName", "class_id": "classId", "report_date": "repPd"}
TABLE_ROW = re.compile(r"<tr[^>]*>(.*?)</tr>", re.I | re.S)
TABLE_CELL = re.compile(r"<t[dh][^>]*>(.*?)</t[dh]>", re.I | re.S)


def from_xml(content: bytes | str) -> tuple[Row, list[Row]] | None:
    root = xml_root(content)
    if root is None:
        return None
    general, fund, nodes = root.find(".//genInfo"), root.find(".//fundInfo"), list(root.iter("invstOrSec"))
    if general is None and fund is None and not nodes:
        return None
    filing = {c: text_at(general, tag) for c, tag in GENERAL.items()} | {"total_assets": number(text_at(fund, "totAssets")), "net_assets": number(text_at(fund, "netAssets")), "holding_count": len(nodes), "parse_source": "xml"}
    rows = []
    for i, node in enumerate(nodes):
        row = {c: text_at(node, *paths) for c, (paths, _) in TEXTS.items()} | {c: number(text_at(node, *paths)) for c, (paths, _) in NUMBERS.items()}
        rows.append(row | {"position": i, "is_restricted": text_at(node, *RESTRICTED[0]) in ("Y", "true", "1")})
    return filing, rows


def plain(cell: str) -> str:
    return html.unescape(re.sub(r"<[^>]+>", "", cell)).strip()


def grid(page: str) -> list[list[str]]:
    """The cells of a page's table rows."""
    return [[plain(c) for c in TABLE_CELL.findall(row)] for row in TABLE_ROW.findall(page)]


def labelled(rows: list[list[str]]) -> Row:
    """What cells say that stand behind a known label, the last of each."""
    pairs = ((fixed.FUND_LABELS.get(a.lower().rstrip(":").strip()), b) for cells in rows for a, b in zip(cells, cells[1:], strict=False))
    return {column: number(value) if column.endswith("assets") else value for column, value in pairs if column and value}


def tables(rows: list[list[str]]) -> Iterator[tuple[dict[str, int], list[list[str]]]]:
    """Heading (column name -> place) and body of each table whose heading has three known names."""
    heads = [i for i, cells in enumerate(rows) if sum(c.lower() in fixed.FUND_HEADINGS for c in cells) >= 3]
    for start, end in zip(heads, [*heads[1:], len(rows)], strict=True):
        yield {c.lower(): i for i, c in enumerate(rows[start])}, [cells for cells in rows[start + 1 : end] if cells]


def listed(heading: dict[str, int], cells: list[str]) -> Row:
    def cell(names: tuple[str, ...]) -> str | None:
        return next((cells[at] for n in names if (at := heading.get(n, len(cells))) < len(cells) and cells[at]), None)

    row = {c: cell(names) for c, (_, names) in TEXTS.items()} | {c: number(cell(names)) for c, (_, names) in NUMBERS.items()}
    return row | {"is_restricted": cell(RESTRICTED[1]) in ("Y", "true", "1")}


def from_page(page: str) -> tuple[Row, list[Row]] | None:
    """Labels with values, and the named rows of its tables up to an empty one; None without an identity or rows."""
    rows = grid(page)
    stream = (listed(heading, cells) if any(cells) else None for heading, body in tables(rows) for cells in body)
    named = (row for row in stream if row is None or row["issuer_name"] or row["cusip"])
    held = [row | {"position": i} for i, row in enumerate(takewhile(bool, dropwhile(lambda row: row is None, named)))]
    filing = {"parse_source": "html_fallback", "holding_count": len(held)} | labelled(rows)
    return (filing, held) if held and any(filing.get(c) for c in ("series_id", "series_name", "report_date")) else None


def read(content: bytes | str) -> tuple[Row, list[Row]] | None:
    found = from_xml(content)
    return found if found else from_page(content.decode("utf-8", "replace") if isinstance(content, bytes) else content)


def fund_filings(docs: DataFrame) -> DataFrame:
    """docs: accession, content."""
    return parse_each(docs, lambda x: [f[0]] if (f := read(x)) else [], FILING)


def fund_holdings(docs: DataFrame) -> DataFrame:
    return parse_each(docs, lambda x: f[1] if (f := read(x)) else [], HOLDING)


def with_header(filings: DataFrame, headers: DataFrame) -> DataFrame:
    """Filer and form from the header, and its filing date where the report has no date."""
    both = filings.join(headers.select("accession", "form_type", "filer_cik", "filer_name", F.col("filing_date").alias("__date")), "accession", "left")
    return both.withColumn("report_date", F.coalesce("report_date", "__date")).drop("__date")
