"""Reference tables and lists: watchlists, entities, workbooks, holdings payloads, and YAML sinks."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..operators.dedup import keep_first
from ..plans.batches import Row, number, parse_each

COMPANY = "position int, cik string, ticker string, name string, aliases array<string>, isin string"


def companies_of(payload) -> list[dict]:
    found = payload.get("companies") if isinstance(payload, dict) else payload
    if not isinstance(found, list):
        raise ValueError("a list of companies is expected")
    return [x for x in found if isinstance(x, dict)]


def yaml_companies(content: bytes | str) -> Iterator[Row]:
    """The companies of a YAML text, as they're written."""
    import yaml

    for i, c in enumerate(companies_of(yaml.safe_load(content))):
        aliases = [str(a) for a in c.get("aliases") or []]
        texts = {n: str(c.get(n) or "").strip() for n in ("cik", "ticker", "name")}
        yield texts | {"position": i, "aliases": aliases, "isin": str(c["isin"]) if c.get("isin") is not None else None}


def listed_companies(files: DataFrame) -> DataFrame:
    """Companies of YAML lists (path, content) with a CIK, ticker and name; the first of each CIK in a list."""
    raw = parse_each(files, yaml_companies, COMPANY, key="path").withColumn("cik", text.normalize_cik(F.col("cik")))
    return keep_first(raw.where("cik IS NOT NULL AND ticker <> '' AND name <> ''"), ["path", "cik"], [F.col("position")])


def watchlist(spark: SparkSession, path: str) -> DataFrame:
    """The companies of one YAML list, read by Spark; an error if there's none."""
    files = spark.read.text(path, wholetext=True).select(F.lit(path).alias("path"), F.col("value").alias("content"))
    good = listed_companies(files).drop("path")
    if good.isEmpty():
        raise ValueError("no valid company")
    return good


def write_companies(rows: DataFrame, path: str, as_of: str = "", most: int = 1_000_000) -> int:
    """Writes a company list as YAML with quoted CIKs. The list is one file by its format, so it's bounded."""
    import yaml

    found = [r.asDict(recursive=True) for r in rows.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"more than {most} companies")
    body = {"schema_version": 2, "as_of_date": as_of, "companies": found}
    draft = Path(f"{path}.part")
    draft.write_text(yaml.safe_dump(body, sort_keys=False, allow_unicode=True), encoding="utf-8")
    draft.replace(path)
    return len(found)


def entity_columns(payloads: DataFrame) -> DataFrame:
    """cik, name, ticker, exchange of column-oriented payloads (json: fields and data)."""
    rows = payloads.select(F.from_json("json", "struct<fields:array<string>,data:array<array<string>>>").alias("p"))
    each = rows.select("p.fields", F.explode("p.data").alias("d"))
    at = lambda name: F.get("d", F.array_position("fields", name).cast("int") - 1)
    return each.select(text.digits_cik(at("cik")).alias("cik"), at("name").alias("name"), text.normalize_ticker(at("ticker")).alias("ticker"), at("exchange").alias("exchange"))


def name_lookup(lines: DataFrame) -> DataFrame:
    """cik, name of lookup lines `name:cik:` (value)."""
    pattern = r"^(.+?):(\d{1,10}):$"
    rows = lines.where(F.col("value").rlike(pattern))
    return rows.select(text.normalize_cik(F.regexp_extract("value", pattern, 2)).alias("cik"), F.regexp_extract("value", pattern, 1).alias("name"))


def browse_results(pages: DataFrame) -> DataFrame:
    """company_id, cik, name of a search page's links. pages: company_id, html."""
    link = r"""(?is)href=["'](?:https?://www\.sec\.gov)?/(?:edgar/browse/\?CIK=|cgi-bin/browse-edgar\?[^"']*CIK=)(\d{1,10})[^"']*["'][^>]*>(.*?)</a>"""
    pairs = F.arrays_zip(F.regexp_extract_all("html", F.lit(link), 1), F.regexp_extract_all("html", F.lit(link), 2))
    each = pages.select("company_id", F.explode(pairs).alias("x"))
    return each.select("company_id", text.normalize_cik(F.col("x.0")).alias("cik"), text.strip_tags(F.col("x.1")).alias("name")).distinct()


def holdings_payload(payloads: DataFrame) -> DataFrame:
    """id, position, name, cusip, isin, weight of JSON holdings payloads (id, json)."""
    kind = "struct<holdings:array<struct<issuerName:string,name:string,cusip:string,isin:string,percentageOfTotalNetAssets:double,weight:double>>>"
    each = payloads.select("id", F.posexplode(F.from_json("json", kind)["holdings"]).alias("position", "h"))
    return each.select("id", "position", F.coalesce("h.issuerName", "h.name").alias("name"), "h.cusip", "h.isin", (F.coalesce("h.percentageOfTotalNetAssets", "h.weight") / 100).alias("weight"))


SPACE = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def is_workbook(content: bytes | None) -> bool:
    if not content or content[:2] != b"PK":
        return False
    try:
        names = set(zipfile.ZipFile(io.BytesIO(content)).namelist())
    except zipfile.BadZipFile:
        return False
    return "[Content_Types].xml" in names and any(n.startswith("xl/") for n in names)


def column_number(reference: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", reference)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_files(book: zipfile.ZipFile) -> dict[str, str]:
    """Sheet name -> its file, in the workbook's order, by its relationships or else by its place."""
    office = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
    targets = {}
    if "xl/_rels/workbook.xml.rels" in book.namelist():
        for link in ET.fromstring(book.read("xl/_rels/workbook.xml.rels")):
            target = link.get("Target") or ""
            targets[link.get("Id")] = target[1:] if target.startswith("/") else f"xl/{target}"
    sheets = ET.fromstring(book.read("xl/workbook.xml")).iter(f"{SPACE}sheet")
    return {s.get("name") or "": targets.get(s.get(office)) or f"xl/worksheets/sheet{i}.xml" for i, s in enumerate(sheets, 1)}


def cell_value(cell: ET.Element, shared: list[str]) -> str | float | bool | None:
    v = cell.find(f"{SPACE}v")
    kind, text = cell.get("t"), v.text if v is not None else None
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{SPACE}t"))
    if kind == "s" and text is not None:
        return shared[int(text)]
    if kind == "b":
        return text == "1"
    if kind in (None, "n") and text is not None:
        return number(text)
    return text


def typed_rows(content: bytes, sheet: str | None = None) -> Iterator[list[str | float | bool | None]]:
    """Cells of a workbook's sheet (default: the first), row by row, blank rows included; numbers as numbers."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in si.iter(f"{SPACE}t")) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{SPACE}si")]
        files = sheet_files(book)
        root = ET.fromstring(book.read(files[sheet] if sheet in files else next(iter(files.values()))))
    last = 0
    for row in root.iter(f"{SPACE}row"):
        here = int(row.get("r") or last + 1)
        for _ in range(here - last - 1):
            yield []
        last = here
        cells: list[str | float | bool | None] = []
        for c in row.iter(f"{SPACE}c"):
            at = column_number(c.get("r")) if c.get("r") else len(cells)
            cells += [None] * (at + 1 - len(cells))
            cells[at] = cell_value(c, shared)
        yield cells


def shown(value: str | float | bool | None) -> str | None:
    """A cell as text; whole numbers without a point."""
    return str(int(value)) if isinstance(value, float) and value == int(value) else None if value is None else str(value)


def sheet_rows(content: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """The cells of a sheet as text."""
    return ([shown(v) for v in cells] for cells in typed_rows(content, sheet))


def workbook_summary(content: bytes, head: int = 4, samples: int = 5) -> Iterator[Row]:
    """What a workbook holds: sheets, holdings behind the heading with their weights in per cent, metadata."""
    if not is_workbook(content):
        return
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = list(sheet_files(book))
    out: Row = {"file_size_bytes": len(content), "sheet_names": names}
    if "Holdings" in names:
        rows = [r for i, r in enumerate(typed_rows(content, "Holdings")) if i >= head and any(v not in (None, "") for v in r[:4])]
        weights = [float(r[3]) for r in rows if len(r) > 3 and isinstance(r[3], (int, float))]
        total = round(sum(100 * w if w <= 1 else w for w in weights), 8) if weights else None
        out |= {"data_row_count": len(rows), "weight_sum_percent": total, "sample_names": [str(shown(r[0])) for r in rows[:samples]]}
    if "Metadata" in names:
        pairs = ([*cells, None, None][:2] for cells in typed_rows(content, "Metadata"))
        out["metadata"] = {str(shown(k)): shown(v) for k, v in pairs if k}
    yield out


def workbook_summaries(files: DataFrame) -> DataFrame:
    """path and summary of workbooks read with the binaryFile source; other files have none."""
    return parse_each(files, workbook_summary, "file_size_bytes long, sheet_names array<string>, data_row_count long, weight_sum_percent double, sample_names array<string>, metadata map<string,string>", key="path")


def constituents_of(content: bytes, skip: int = 4) -> Iterator[Row]:
    """Rows behind a workbook's heading with an ISIN: name, cusip, isin, weight."""
    if not is_workbook(content):
        return
    for i, cells in enumerate(sheet_rows(content, "Holdings")):
        cells = [*cells, None, None, None, None][:4]
        if i >= skip and cells[2]:
            yield {"position": i, "name": cells[0], "cusip": cells[1], "isin": cells[2].strip(), "weight": number(cells[3])}


def constituents(files: DataFrame) -> DataFrame:
    """Constituents of workbooks read with the binaryFile source, with the date in the file's or folder's name."""
    rows = parse_each(files, constituents_of, "position int, name string, cusip string, isin string, weight double", key="path")
    folder = F.regexp_extract("path", r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return rows.withColumn("as_of_date", F.coalesce(F.nullif(dates.leading_date(F.col("path")), F.lit("")), F.nullif(folder, F.lit("")), F.lit("")))


def build_workbook(rows: list[tuple], sheets_head: list[list[str]], metadata: dict | None = None) -> bytes:
    """A workbook with a "Holdings" sheet: head rows, then the rows (text or numbers; None is an empty cell).

    metadata, if given, becomes a second sheet of keys and values.
    """
    from xml.sax.saxutils import escape

    def cell(at: int, line: int, v) -> str:
        name = f"{chr(65 + at)}{line}"
        if v is None:
            return ""
        if isinstance(v, (int, float)):
            return f'<c r="{name}"><v>{v}</v></c>'
        return f'<c r="{name}" t="inlineStr"><is><t>{escape(str(v))}</t></is></c>'

    space, office = f'xmlns="{SPACE[1:-1]}"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    main = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    sheets = {"Holdings": [*sheets_head, *rows]} | ({"Metadata": list(metadata.items())} if metadata else {})
    numbered = list(enumerate(sheets.items(), 1))
    overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{main}.worksheet+xml"/>' for i, _ in numbered)
    named = "".join(f'<sheet name="{name}" sheetId="{i}" r:id="r{i}"/>' for i, (name, _) in numbered)
    links = "".join(f'<Relationship Id="r{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in numbered)
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/>{overrides}</Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook {space} xmlns:r="{office}"><sheets>{named}</sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships">{links}</Relationships>',
    }
    for i, (_, lines) in numbered:
        body = "".join(f'<row r="{n}">{"".join(cell(j, n, v) for j, v in enumerate(line))}</row>' for n, line in enumerate(lines, 1))
        parts[f"xl/worksheets/sheet{i}.xml"] = f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>"
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for name, part in parts.items():
            z.writestr(name, '<?xml version="1.0" encoding="UTF-8"?>' + part)
    return raw.getvalue()


def fresh(cache: DataFrame, now, seconds: int | None) -> DataFrame:
    """Cached answers that aren't older than their time to live. cache: namespace, key, fetched_at, value."""
    return cache if seconds is None else cache.where(F.unix_timestamp(now) - F.unix_timestamp("fetched_at") <= seconds)
