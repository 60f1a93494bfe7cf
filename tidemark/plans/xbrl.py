"""Tagged facts: instance documents and inline facts, joined to their contexts."""

from __future__ import annotations

import math
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import Row, number, parse_each

FACT = "position int, concept string, value string, numeric_value double, unit string, decimals string, context_id string"
CONTEXT = "context_id string, period_start string, period_end string, period_instant string, segment string"
PREFIXES = ("us-gaap", "ifrs-full", "dei")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
EMBEDDED = re.compile(r"<(?:\w+:)?context\s[^>]*?\bid=[\"'][^\"']+[\"'][^>]*>.*?</(?:\w+:)?context>", re.I | re.S)


def value_of(raw: str | None) -> float | None:
    """A fact's number: commas and dollars off, brackets as a minus; dashes are none."""
    return number((raw or "").replace("(", "-"), ",$)")


def local(tag: str) -> str:
    return tag.rpartition("}")[2].rpartition(":")[2]


def xml_contexts(root: ET.Element) -> Iterator[Row]:
    for node in root.iter():
        if not isinstance(node.tag, str) or local(node.tag).lower() != "context" or not node.get("id"):
            continue
        row: Row = {"context_id": node.get("id")}
        for part in node.iter():
            name, text = local(part.tag).lower() if isinstance(part.tag, str) else "", (part.text or "").strip()
            if name in ("startdate", "enddate", "instant") and text:
                row[{"startdate": "period_start", "enddate": "period_end", "instant": "period_instant"}[name]] = text
            elif name == "segment":
                members = [(m.get("dimension", ""), (m.text or "").strip()) for m in part]
                row["segment"] = "; ".join(f"{d}={v}" if d else v for d, v in members if v) or None
        yield row


def instance_facts(root: ET.Element) -> Iterator[Row]:
    for node in root.iter():
        space, _, name = node.tag.lstrip("{").rpartition("}") if isinstance(node.tag, str) else ("", "", "")
        prefix = next((p for p in PREFIXES if p in space), None)
        text = (node.text or "").strip()
        if prefix and text:
            yield {"concept": f"{prefix}:{name}", "value": text, "numeric_value": value_of(text), "unit": node.get("unitRef"), "decimals": node.get("decimals"), "context_id": node.get("contextRef")}


class InlineFacts(HTMLParser):
    """Facts and continuations of a page. Open facts form a stack, so that a fact within a fact is both's text;
    void elements don't count as open."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, dict, list[str]]] = []
        self.facts: list[tuple[dict, list[str]]] = []
        self.more: dict[str, tuple[list[str], str | None]] = {}

    def handle_starttag(self, tag: str, attrs) -> None:
        prefix, _, name = tag.partition(":")
        if prefix in ("ix", "ixt") and name in ("nonfraction", "nonnumeric", "continuation") and tag not in VOID:
            own, text = dict(attrs) | {"kind": name}, []
            self.open.append((tag, own, text))
            if name == "continuation":
                self.more[own.get("id") or ""] = (text, own.get("continuedat"))
            else:
                self.facts.append((own, text))

    def handle_startendtag(self, tag: str, attrs) -> None:
        pass

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i]
                return

    def handle_data(self, data: str) -> None:
        for _, _, text in self.open:
            text.append(data)

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Marked sections of any name are skipped; the base class knows a few and fails on others."""
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def text_of(self, own: dict, text: list[str]) -> str:
        """A fact's text with its continuations, each followed once."""
        parts, following, seen = ["".join(text)], own.get("continuedat"), set()
        while following in self.more and following not in seen:
            seen.add(following)
            more, following_next = self.more[following]
            parts.append("".join(more))
            following = following_next
        return " ".join(p for p in parts if p).strip()


def scaled(value: str, scale: str | None, sign: str | None) -> str:
    n = value_of(value)
    if n is None or not scale and not sign:
        return value
    if scale and re.fullmatch(r"[+-]?[0-9]{1,3}", scale):
        n *= 10.0 ** max(-300, min(300, int(scale)))
    if not math.isfinite(n):
        return value
    n = -abs(n) if sign == "-" else n
    return str(int(n)) if n == int(n) else str(n)


def inline_facts(page: str) -> Iterator[Row]:
    reader = InlineFacts()
    reader.feed(page)
    for own, text in reader.facts:
        concept, value = own.get("name") or "", reader.text_of(own, text)
        if not concept.startswith(tuple(f"{p}:" for p in PREFIXES)) or not value:
            continue
        if own["kind"] == "nonfraction":
            value = scaled(value, own.get("scale"), own.get("sign"))
        yield {"concept": concept, "value": value, "numeric_value": value_of(value), "unit": own.get("unitref"), "decimals": own.get("decimals"), "context_id": own.get("contextref")}


def decoded(content: bytes | str) -> str:
    return content.decode("utf-8", "replace") if isinstance(content, bytes) else content


def root_of(content: bytes | str) -> ET.Element | None:
    try:
        return ET.fromstring(content)
    except (ET.ParseError, ValueError):
        return None


def facts(content: bytes | str) -> Iterator[Row]:
    root = root_of(content)
    found = list(instance_facts(root)) if root is not None else []
    for i, row in enumerate(found or inline_facts(decoded(content))):
        yield row | {"position": i}


def contexts(content: bytes | str) -> Iterator[Row]:
    root = root_of(content)
    found = list(xml_contexts(root)) if root is not None else []
    if not found:
        for block in EMBEDDED.findall(decoded(content)):
            bare = re.sub(r"(</?)\w+:", r"\1", block)
            inner = root_of(f"<root>{bare}</root>")
            found += list(xml_contexts(inner)) if inner is not None else []
    yield from {row["context_id"]: row for row in found}.values()


def fact_rows(docs: DataFrame) -> DataFrame:
    """Facts of each filing with the period and segment of their context. docs: accession, content."""
    own = parse_each(docs, facts, FACT)
    return own.join(parse_each(docs, contexts, CONTEXT), ["accession", "context_id"], "left")


def report_periods(rows: DataFrame, filings: DataFrame) -> DataFrame:
    """accession, period_of_report: the first stated period end with ten characters or more, else the filing date."""
    stated = rows.where(F.col("concept").isin("dei:DocumentPeriodEndDate", "dei:CurrentFiscalYearEndDate") & (F.length("value") >= 10))
    first = stated.groupBy("accession").agg(F.min_by(F.substring("value", 1, 10), "position").alias("__stated"))
    return filings.join(first, "accession", "left").select("accession", F.coalesce("__stated", F.col("filing_date").cast("string")).alias("period_of_report"))


def key_facts(rows: DataFrame, prefixes: tuple[str, ...], n: int = 50) -> DataFrame:
    """The first n facts of each filing whose concept begins with a key prefix."""
    wanted = rows.where(F.col("concept").rlike("^(?:" + "|".join(re.escape(p) for p in prefixes) + ")"))
    place = F.row_number().over(Window.partitionBy("accession").orderBy("position"))
    return wanted.withColumn("place", place).where(F.col("place") <= n).drop("place")
