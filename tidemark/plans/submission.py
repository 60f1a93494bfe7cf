"""Submission texts: header fields, parties, documents and items; index pages; the primary document."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .batches import Row, parse_each

ROLES = r"FILER|ISSUER|REPORTING-OWNER|SUBJECT\s+COMPANY|FILED-BY"
HEAD = re.compile(rf"^(?:(?P<colon>{ROLES}):[ \t]*\r?$|[ \t]*<(?P<angle>{ROLES})>)|<(?P<end>DOCUMENT|/SEC-HEADER)>", re.I | re.M)
TEXTUAL = (".htm", ".html", ".txt", ".xml", ".xsd", ".xsl")
PARTY = "position int, role string, cik string, name string"
DOCUMENT = "position int, sequence string, filename string, description string, doc_type string"
PARTS = "primary string, info string, instance string, body string"
INDEX_ROW = "position int, sequence string, description string, href string, filename string, doc_type string, size string"


def decoded(content: bytes | str) -> str:
    return content.decode("utf-8", "replace") if isinstance(content, bytes) else content


def parties(content: bytes | str) -> Iterator[Row]:
    """Parties by sections headed `ROLE:`, else by `<ROLE>`, else the first name and number as the filer."""
    body = decoded(content)
    heads = list(HEAD.finditer(body))
    found: list[Row] = []
    for style in ("colon", "angle"):
        for m in heads:
            if not m[style]:
                continue
            # a section ends at the next head of its own style or at the end of the header
            end = next((h.start() for h in heads if h.start() > m.start() and (h[style] or h["end"])), len(body))
            row = party(body[m.end() : end], re.sub(r"\s+", "-", m[style].strip().lower()))
            if row["cik"] or row["name"]:
                found.append(row)
        if found:
            break
    if not found:
        row = party(body, "filer")
        found = [row] if row["cik"] or row["name"] else []
    for i, row in enumerate(found):
        yield row | {"position": i}


def party(body: str, role: str) -> Row:
    name, cik = re.search(r"COMPANY CONFORMED NAME:\s*(.+)", body), re.search(r"CENTRAL INDEX KEY:\s*(\d{1,10})", body)
    return {"role": role, "name": name[1].strip() if name else None, "cik": cik[1].zfill(10) if cik else None}


def documents(content: bytes | str) -> Iterator[Row]:
    for i, raw in enumerate(re.findall(r"<DOCUMENT>(.*?)</DOCUMENT>", decoded(content), re.I | re.S)):
        fields = {c: re.search(rf"<{tag}>([^\n<]+)", raw, re.I) for c, tag in (("sequence", "SEQUENCE"), ("filename", "FILENAME"), ("description", "DESCRIPTION"), ("doc_type", "TYPE"))}
        yield {"position": i, **{c: m[1].strip() if m else None for c, m in fields.items()}}


def document_body(content: bytes | str, filename: str) -> Iterator[Row]:
    """The text of the document with a file name, without its XML or XBRL wrapper."""
    for raw in re.findall(r"<DOCUMENT>(.*?)</DOCUMENT>", decoded(content), re.I | re.S):
        name, body = re.search(r"<FILENAME>([^\n\r<]+)", raw, re.I), re.search(r"<TEXT>(.*?)</TEXT>", raw, re.I | re.S)
        if name and body and filename and name[1].strip().lower() == filename.lower():
            inner = re.sub(r"^\s*<(?:XBRL|XML)[^>]*>", "", body[1], count=1, flags=re.I)
            yield {"body": re.sub(r"</(?:XBRL|XML)>\s*$", "", inner, count=1, flags=re.I).strip()}
            return


def index_rows(page: str) -> Iterator[Row]:
    """Rows of an index page's tables with five cells or more and a sequence or a type; empty cells are null."""
    place = 0
    for row in re.findall(r"<tr[^>]*>(.*?)</tr>", page, re.I | re.S):
        cells = re.findall(r"<td[^>]*>(.*?)</td>", row, re.I | re.S)
        if len(cells) < 5:
            continue
        href = re.search(r"<a[^>]+href=[\"']([^\"']+)", cells[2], re.I)
        sequence, description, filename, doc_type, size = (re.sub(r"<[^>]+>", "", c).strip() or None for c in cells[:5])
        sequence, doc_type = (x if x and html.unescape(x).strip() else None for x in (sequence, doc_type))
        if sequence or doc_type:
            yield {"position": place, "sequence": sequence, "description": description, "href": href[1] if href else None, "filename": filename, "doc_type": doc_type, "size": size}
            place += 1


def archive_links(page: str, base: str) -> Iterator[Row]:
    """Distinct absolute links to archived documents, in their first order."""
    links = (urljoin(base or "", html.unescape(h)) for h in re.findall(r"href=[\"']([^\"']+)[\"']", page, re.I))
    good = dict.fromkeys(x for x in links if "/Archives/" in x and re.search(r"\.(?:htm|html|txt|xml|xsd|xsl|pdf|jpg|jpeg|png)$", x, re.I))
    yield from ({"position": i, "link": x} for i, x in enumerate(good))


def header_fields(submissions: DataFrame, content: str = "content", keep: tuple[Column | str, ...] = ()) -> DataFrame:
    """accession, form_type, acceptance_datetime, filed_as_of_date, period, items of submission texts, and the columns in `keep`."""
    c = F.col(content).cast("string")
    items = F.transform(F.regexp_extract_all(c, F.lit(r"ITEM INFORMATION:\s*(.+)"), 1), F.trim)
    return submissions.select(
        "accession",
        text.first_match(c, r"CONFORMED SUBMISSION TYPE:\s*([^\n]+)").alias("form_type"),
        text.first_match(c, r"(?i)<ACCEPTANCE-DATETIME>(\d{14})").alias("acceptance_datetime"),
        text.first_match(c, r"FILED AS OF DATE:\s*(\d{8})").alias("filed_as_of_date"),
        text.first_match(c, r"CONFORMED PERIOD OF REPORT:\s*(\d{8})").alias("period"),
        items.alias("items"),
        *keep,
    )


def party_rows(submissions: DataFrame) -> DataFrame:
    return parse_each(submissions, parties, PARTY)


def document_rows(submissions: DataFrame) -> DataFrame:
    return parse_each(submissions, documents, DOCUMENT)


def document_bodies(submissions: DataFrame) -> DataFrame:
    """accession, body of the chosen document. submissions: accession, content, filename."""
    return parse_each(submissions, document_body, "body string", extra=("filename",))


def index_document_rows(pages: DataFrame) -> DataFrame:
    return parse_each(pages, index_rows, INDEX_ROW)


def link_rows(pages: DataFrame) -> DataFrame:
    return parse_each(pages, archive_links, "position int, link string", extra=("base",))


def primary_from_header(docs: DataFrame, headers: DataFrame) -> DataFrame:
    """The primary document of each submission: the preferred file, the form's type, sequence 1, any text, the first.

    docs: document_rows; headers: accession, form_type, preferred (may be null).
    """
    both = docs.where("filename IS NOT NULL").join(headers.select("accession", "form_type", "preferred"), "accession")
    textual = text.is_textual(F.col("filename"))
    first = F.regexp_replace(F.trim(F.coalesce("sequence", F.lit(""))), "^0+", "").isin("", "1")
    same = F.upper(F.trim(F.col("doc_type"))) == F.upper(F.trim(F.col("form_type")))
    rank = F.when(F.lower("filename") == F.lower("preferred"), 0).when(same & textual, 1).when(first & textual, 2).when(textual, 3).otherwise(4)
    return both.groupBy("accession").agg(F.min_by("filename", F.struct(rank.alias("rank"), "position")).alias("filename"))


def primary_from_index(links: DataFrame, rows: DataFrame, headers: DataFrame) -> DataFrame:
    """The primary document's url by an index page. links: link_rows; rows: index_document_rows with url; headers: accession, form_type."""
    both = links.join(rows.select("accession", F.col("url").alias("link"), "doc_type").dropDuplicates(["accession", "link"]), ["accession", "link"], "left").join(headers.select("accession", "form_type"), "accession")
    low, kind, form = F.lower("link"), F.upper(F.trim(F.coalesce("doc_type", F.lit("")))), F.upper(F.trim(F.coalesce("form_type", F.lit(""))))
    same = (kind == form) & (form != "")
    out = kind.startswith("EX-") | (kind == "GRAPHIC") | low.endswith("-index.html")
    rank = (
        F.when(same & ~low.contains("/xsl"), 0).when(same, 1).when(out, 9)
        .when(form.rlike(r"^[345](?:/A)?$") & low.endswith(".xml"), 2)
        .when(low.rlike(r"\.html?$"), 3).when(low.endswith(".xml"), 4).when(low.endswith(".txt"), 5).otherwise(6)
    )
    return both.groupBy("accession").agg(F.min_by("link", F.struct(rank.alias("rank"), "position")).alias("primary_url"))


def xbrl_marker(content: Column) -> Column:
    """Whether a document's first 51 200 characters speak of tagged facts."""
    head = F.lower(F.substring(content.cast("string"), 1, 51200))
    return head.contains("xbrl") | head.contains("<ix:")


def info_table(docs: DataFrame, primary: DataFrame) -> DataFrame:
    """The information table among the documents of a holdings report. docs: document_rows; primary: accession, filename."""
    low = F.lower(F.concat_ws(" ", "doc_type", "description", "filename"))
    rest = docs.join(primary.select("accession", F.col("filename").alias("__primary")), "accession", "left").where(~F.col("filename").eqNullSafe(F.col("__primary")))
    hits = rest.where(low.contains("information table") | low.contains("infotable") | low.contains("info table"))
    return hits.groupBy("accession").agg(F.min_by("filename", "position").alias("filename"))


def instance(content: bytes | str, primary: str | None, rows: list[Row] | None = None) -> Iterator[Row]:
    """The first document besides the primary one that is said to be an instance, else the first XML file that is no
    schema, linkbase or stylesheet; either must begin with tagged facts. rows: `documents`, if they're there already."""
    stated, others = [], []
    for row in documents(content) if rows is None else rows:
        name, kind, told = row["filename"], (row["doc_type"] or "").upper(), (row["description"] or "").lower()
        low = (name or "").lower()
        if not low or low == (primary or "").lower() or not low.endswith(TEXTUAL):
            continue
        xml = low.endswith(".xml")
        if "XBRL INSTANCE" in kind or "EX-101.INS" in kind or "xbrl instance" in told or (xml and ("xbrl" in told or "instance" in told)):
            stated.append(name)
        if xml and not re.search("SCHEMA|LINKBASE|XSD|XSLT", kind) and not re.search(r"_(?:lab|def|pre|cal|ref)\.", low):
            others.append(name)
    for name in dict.fromkeys([*stated, *others]):
        for found in document_body(content, name):
            if re.search(r"<xbrli:xbrl|<xbrl|<ix:header", found["body"][:10240], re.I):
                yield {"filename": name}
                return


def primary_name(rows: list[Row], form_type: str | None, preferred: str | None) -> str | None:
    """What `primary_from_header` chooses among one submission's documents."""
    plain = lambda x: x.strip(" ").upper() if x is not None else None

    def rank(row: Row) -> int:
        textual = re.search(r"\.(?:htm|html|txt|xml|xsd|xsl)\Z", row["filename"].lower())
        if preferred is not None and row["filename"].lower() == preferred.lower():
            return 0
        if textual and None is not plain(row["doc_type"]) == plain(form_type):
            return 1
        first = (row["sequence"] or "").strip(" ").lstrip("0") in ("", "1")
        return (2 if first else 3) if textual else 4

    return min((r for r in rows if r["filename"] is not None), key=lambda r: (rank(r), r["position"]), default={"filename": None})["filename"]


def info_name(rows: list[Row], primary: str | None) -> str | None:
    """What `info_table` finds among one submission's documents."""
    said = lambda r: " ".join(r[c] for c in ("doc_type", "description", "filename") if r[c] is not None).lower()
    return next((r["filename"] for r in rows if r["filename"] != primary and re.search("information table|infotable|info table", said(r))), None)


def parts(submissions: DataFrame, *keep: str) -> DataFrame:
    """The columns in `keep` and primary, info, instance, body: what `primary_from_header`, `info_table`, `xbrl_instance`
    and `document_bodies` give for each submission, in one pass over the texts and without a join.

    submissions: content, form_type, preferred (may be null). Each row stays; a part that can't be parsed is null.
    """

    def each(content: bytes | str | None, form_type: str | None, preferred: str | None) -> tuple[str | None, ...]:
        if content is None:
            return None, None, None, None
        try:
            rows = list(documents(content))
            primary = primary_name(rows, form_type, preferred)
            found = next(instance(content, primary, rows), {"filename": None})["filename"]
            body = next(document_body(content, primary), {"body": None})["body"] if primary else None
            return primary, info_name(rows, primary), found, body
        except Exception:  # noqa: BLE001  documents hold anything; only this one is lost
            return None, None, None, None

    @F.pandas_udf(PARTS)
    def read(content: pd.Series, form_type: pd.Series, preferred: pd.Series) -> pd.DataFrame:
        rows = [each(*values) for values in zip(content, form_type, preferred, strict=True)]
        return pd.DataFrame(rows, columns=["primary", "info", "instance", "body"], dtype=object)

    return submissions.select(*keep, read("content", "form_type", "preferred").alias("__parts")).select(*keep, "__parts.*")


def xbrl_instance(submissions: DataFrame, primary: DataFrame) -> DataFrame:
    """accession, filename of the instance by type or description, else by content. submissions: accession, content; primary: accession, filename."""
    both = submissions.select("accession", "content").join(primary.select("accession", F.col("filename").alias("primary")), "accession", "left")
    return parse_each(both, instance, "filename string", extra=("primary",))
