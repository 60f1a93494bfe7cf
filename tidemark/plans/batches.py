"""Parsing documents in batches."""

from __future__ import annotations

import math
import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

Row = dict
#: Parsed rows that are held before they're passed on.
HELD = 5000


def parse_each(docs: DataFrame, parse: Callable[..., Iterable[Row]], schema: str, content: str = "content", key: str = "accession", extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows that `parse(content, *extra)` gives for each document, behind the document's key.

    schema: the rows' columns. A document that can't be parsed, for whatever reason, gives no rows and stops nothing.
    """
    names = [x.split()[0].split(":")[0] for x in split_schema(schema)]
    kinds = dict(docs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for values in batch.itertuples(index=False, name=None):
                if values[1] is None:
                    continue
                try:
                    rows = list(parse(values[1], *values[2:]))
                except Exception:  # noqa: BLE001  documents hold anything; only this one is lost
                    continue
                out += [(values[0], *(row.get(n) for n in names)) for row in rows]
                if len(out) >= HELD:
                    yield pd.DataFrame(out, columns=[key, *names], dtype=object)
                    out = []
            yield pd.DataFrame(out, columns=[key, *names], dtype=object)

    return docs.select(key, content, *extra).mapInPandas(run, f"{key} {kinds[key]}, {schema}")


def split_schema(schema: str) -> list[str]:
    """The columns of a schema text; commas within brackets don't part them."""
    parts, depth, last = [], 0, 0
    for i, c in enumerate(schema):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            parts.append(schema[last:i].strip())
            last = i + 1
    return [*parts, schema[last:].strip()]


def xml_root(content: bytes | str) -> ET.Element | None:
    """The document's root with all namespaces taken off; None if it isn't well-formed."""
    try:
        root = ET.fromstring(content)
    except (ET.ParseError, ValueError):
        return None
    for node in root.iter():
        if isinstance(node.tag, str):
            node.tag = node.tag.rpartition("}")[2]
    return root


def text_at(node: ET.Element | None, *paths: str) -> str | None:
    """The first text that isn't empty along the paths, trimmed."""
    for path in paths if node is not None else ():
        found = node.find(path)
        if found is not None and found.text and found.text.strip():
            return found.text.strip()
    return None


def number(raw: str | None, drop: str = ",") -> float | None:
    """A finite number without the characters in `drop`; None if it isn't one."""
    if raw is None:
        return None
    raw = raw.strip().translate(str.maketrans("", "", drop))
    if "_" in raw:
        return None
    try:
        n = float(raw)
    except ValueError:
        return None
    return n if math.isfinite(n) else None


def whole(raw: str | None) -> int | None:
    """A whole number of at most 18 digits; None if it isn't one."""
    raw = (raw or "").strip().replace(",", "")
    return int(raw) if re.fullmatch(r"[+-]?[0-9]{1,18}", raw) else None
