"""License scans: exact phrases, and fuzzy search for short notices.

The text is lower-cased (A-Z only) and cut into words of ASCII letters, digits and all characters beyond
ASCII. Base labels come from places where a phrase's words stand consecutively. The method then searches
short notices with up to `edits` character edits: by the pigeonhole principle one of `edits + 1` pieces
of a notice stands unchanged in any match, so exact searches for the pieces locate every candidate, and
bounded-error matching of the regex library verifies the window around it and reports the span.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows are scanned
each; texts of any length are scanned whole, in time linear in their length plus the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: Short notices, as normalised words, with their labels.
NOTICES = {
    "licensed under the gnu general public license version": "gpl",
    "licensed under the gnu lesser general public license": "lgpl",
    "licensed under the apache license version": "apache",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by nc": "cc-by",
    "licensed under the mozilla public license": "mpl",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person": "mit",
}
EDITS = 3
#: Letters lower-cased, everything in ASCII that no word has becomes a space.
WORD_BYTES = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
SCHEMA = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,start:long,end:long,edits:int>>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def places(line: bytes, what: bytes) -> Iterator[int]:
    """Offsets where `what` stands, overlapping ones too."""
    at = line.find(what)
    while at >= 0:
        yield at
        at = line.find(what, at + 1)


def word_numbers(line: bytes, offsets: list[int]) -> dict[int, int]:
    """Spaces before each offset, counted in one sweep."""
    out, last, n = {}, 0, 0
    for at in sorted(set(offsets)):
        n += line.count(b" ", last, at)
        out[at] = n
        last = at
    return out


def pieces(notice: str, edits: int) -> list[tuple[int, bytes]]:
    """The notice in edits + 1 pieces with their offsets; any text within `edits` edits holds one unchanged."""
    raw, n = notice.encode(), edits + 1
    cuts = [len(raw) * i // n for i in range(n + 1)]
    return [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def matchers(notices: Mapping[str, str], edits: int) -> list:
    import regex

    out = []
    for notice, label in notices.items():
        pattern = regex.compile(b"(?b)(?:" + regex.escape(notice).encode() + b"){e<=%d}" % edits)
        out.append((notice.encode(), label, pieces(notice, edits), pattern))
    return out


def fuzzy_spans(line: bytes, found: list, edits: int) -> list[tuple[str, int, int, int, int]]:
    """Verified matches in a line of words: label, start, end, edits, length of the notice."""
    spans = set()
    for notice, label, parts, pattern in found:
        windows = sorted({at - offset for offset, piece in parts for at in places(line, piece)})
        done = -1
        for start in windows:
            if start <= done:  # within the reach of the window that was searched last
                continue
            low, high = max(0, start - edits), min(len(line), start + len(notice) + 2 * edits)
            m = pattern.search(line, low, high)
            if m:
                spans.add((label, m.start(), m.end(), sum(m.fuzzy_counts), len(notice)))
                done = start + edits
    return sorted(spans)


def scan_text(text: str | None, phrases: Mapping[str, str], found: list, edits: int) -> tuple:
    words = words_of(text)
    line = b" " + b" ".join(words) + b" "
    starts, base = [], set()
    for phrase, label in phrases.items():
        if at := list(places(line, b" " + phrase.encode() + b" ")):
            base.add(label)
            starts += at
    spans = fuzzy_spans(line, found, edits)
    labels = base | {s[0] for s in spans}
    score = 1.0 if base else max((1.0 - s[3] / s[4] for s in spans), default=0.0)
    number = word_numbers(line, [*starts, *(max(1, s[1]) for s in spans), *(s[2] for s in spans)])
    out = [{"label": s[0], "start": number[max(1, s[1])] - 1, "end": max(number[s[2]] - 1, 0), "edits": s[3]} for s in spans]
    places_at = [number[at] for at in starts]
    return len(words), len(starts), min(places_at, default=None), max(places_at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, out


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: Mapping[str, str] = PHRASES, notices: Mapping[str, str] = NOTICES, edits: int = EDITS) -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans (in words, end inclusive)."""
    phrases, notices = dict(phrases), dict(notices)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = kept(f"notices {sorted(notices.items())} {edits}", lambda: matchers(notices, edits))
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows = [scan_text(x, phrases, found, edits) for x in batch["text"]]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, "id", batch["id"].to_numpy())
            out[["first_word", "last_word"]] = out[["first_word", "last_word"]].astype("Int64")
            yield out

    # ids travel as text: whole numbers with nulls would become floating point
    rows = docs.selectExpr(f"CAST(`{id_col}` AS string) AS id", f"`{text_col}` AS text").mapInPandas(scan, f"id string, {SCHEMA}")
    return rows.withColumn("id", F.col("id").cast(dict(docs.dtypes)[id_col])).withColumnRenamed("id", id_col)
