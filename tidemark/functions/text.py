"""Names, identifiers, urls and markup."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def first_match(x: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group, trimmed; null without a match or with an empty one."""
    return blank_to_null(F.regexp_extract(x, pattern, group))


def squeeze(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def pad_left(x: Column, width: int) -> Column:
    """Zeros on the left; longer strings stay whole (lpad would cut them)."""
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, "0"))


def normalize_cik(x: Column) -> Column:
    """Ten digits from a number or a string of digits; null for anything else."""
    digits = F.trim(x.cast("string"))
    return F.when(digits.rlike(r"^\d+$"), pad_left(digits, 10))


def digits_cik(x: Column) -> Column:
    """Ten digits from whatever digits there are; empty without any."""
    digits = F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"\D+", "")
    return F.when(digits == "", digits).otherwise(pad_left(digits, 10))


def is_accession(x: Column) -> Column:
    return F.coalesce(x.rlike(f"^{fixed.ACCESSION}$"), F.lit(False))


def extract_accession(x: Column) -> Column:
    return first_match(x, f"({fixed.ACCESSION})")


def normalize_identifier(x: Column) -> Column:
    return F.upper(F.regexp_replace(F.coalesce(x.cast("string"), F.lit("")), r"[^A-Za-z0-9]+", ""))


def normalize_ticker(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.coalesce(x.cast("string"), F.lit(""))), r"[^A-Z0-9]+", "")


def issuer_name(x: Column) -> Column:
    """Upper case without punctuation, for lookups by name."""
    return squeeze(F.regexp_replace(F.upper(x), r"""[.,;:!?'"\-]""", ""))


#: HTML 4's named references, `amp;` and the like, and the few that need no semicolon.
REFERENCES = json.dumps({f"{name};": chr(n) for name, n in name2codepoint.items()} | {"AMP;": "&", "apos;": "'", "amp": "&", "AMP": "&", "lt": "<", "gt": ">", "quot": '"', "nbsp": "\xa0"})
REFERENCE = r"^(#[0-9]{1,9};?|#[xX][0-9a-fA-F]{1,8};?|[A-Za-z][A-Za-z0-9]{1,9};|amp|AMP|lt|gt|quot|nbsp)"


def decode_entities(x: Column) -> Column:
    """Character references as HTML reads them, each once: all numbers, and HTML 4's names."""
    known = F.from_json(F.lit(REFERENCES), "map<string,string>")
    parts = F.split(x, "&")
    # what stands behind each ampersand, with the reference in it
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.struct(p.alias("p"), F.regexp_extract(p, REFERENCE, 1).alias("r")))

    def decoded(s: Column) -> Column:
        digits = F.regexp_extract(s["r"], "([0-9a-fA-F]+)", 1)
        digits = F.when(s["r"].rlike("^#[xX]"), digits).otherwise(F.conv(digits, 10, 16))
        point = F.lpad(digits, 8, "0")
        letter = F.when(point.rlike("(?i)^00(?:0[0-9a-f]|10)(?!(?<=^0000)d[89a-f])[0-9a-f]{4}$"), F.decode(F.unhex(point), "UTF-32")).otherwise("\ufffd")
        char = F.when(s["r"].startswith("#"), letter).otherwise(F.try_element_at(known, s["r"]))
        return F.coalesce(F.concat(char, F.substring(s["p"], F.length(s["r"]) + 1, F.length(s["p"]))), F.concat(F.lit("&"), s["p"]))

    return F.when(x.contains("&"), F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(rest, decoded), ""))).otherwise(x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalised(raw: Column) -> Column:
    """A decoded name in upper case, without share class, legal form, generic words or numbers."""
    raw = F.regexp_replace(F.upper(raw), r"\s*-\s*[A-Z]{1,2}\s*$", "")
    raw = F.regexp_replace(F.replace(raw, F.lit("&"), F.lit(" AND ")), r"[^A-Z0-9]+", " ")
    words = F.filter(F.split(raw, " "), lambda w: (w != "") & ~w.isin(*fixed.GENERIC_WORDS) & ~w.rlike(r"^\d+$"))
    return F.array_join(words, " ")


def company_name(x: Column) -> Column:
    """Name for matching: upper case, no share class, legal form, generic words or numbers."""
    return normalised(decode_entities(F.coalesce(x.cast("string"), F.lit(""))))


def constituent_name(x: Column) -> Column:
    """Constituent name without par value, depositary and preferred endings."""
    for pattern in (fixed.PAR_VALUE, fixed.DEPOSITARY, fixed.PREFERRED):
        x = F.regexp_replace(x, pattern, "")
    return F.trim(x)


def recall_variants(x: Column) -> Column:
    """Other normalised forms of a name that widen a candidate search, as a sorted array."""
    table = F.create_map(*(F.lit(w) for pair in fixed.ABBREVIATIONS.items() for w in pair))

    def transliterated(y: Column) -> Column:
        for a, b in fixed.TRANSLITERATIONS:
            y = F.replace(y, F.lit(a), F.lit(b))
        return y

    def names(raw: Column) -> Column:
        plain = F.regexp_replace(F.upper(raw), rf"\b(?:{'|'.join(fixed.RECALL_WORDS)})\b", " ")
        return F.array(normalised(raw), normalised(F.regexp_replace(plain, r"\bCLASS\s+[A-Z0-9]\b", " ")))

    def expanded(y: Column) -> Column:
        return F.array_join(F.transform(F.split(y, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " ")

    def widened(two: Column) -> Column:
        forms = let(F.concat(two, F.transform(two, transliterated)), lambda f: F.array_distinct(F.concat(f, F.transform(f, expanded))))
        return F.array_sort(F.filter(forms, lambda v: (v != "") & (v != F.get(two, F.lit(0)))))

    return let(let(decode_entities(F.coalesce(x, F.lit(""))), names), widened)


def dedup_name(x: Column) -> Column:
    return F.regexp_replace(F.upper(F.trim(F.coalesce(x, F.lit("")))), r"\s+", " ")


def strip_tags(x: Column, by: str = " ") -> Column:
    return squeeze(F.regexp_replace(x, r"<[^>]+>", by))


def item_title(x: Column) -> Column:
    """A report item's title for lookups: upper case, no leading ITEM without a number, words only."""
    return squeeze(F.regexp_replace(F.regexp_replace(F.upper(x), r"^\s*ITEM\s+(?!\d)", ""), r"[^A-Z0-9]+", " "))


def safe_filename(x: Column) -> Column:
    return F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_")


UMLAUTS = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("Ä", "Ae"), ("Ö", "Oe"), ("Ü", "Ue"), ("ß", "ss"))


def plain_filename(x: Column) -> Column:
    """File name in ASCII: umlauts spelt out, everything else unsafe as one underscore."""
    for a, b in UMLAUTS:
        x = F.replace(x, F.lit(a), F.lit(b))
    return F.btrim(F.regexp_replace(x, r"[^A-Za-z0-9._-]+", "_"), F.lit("_"))


def filename_of_url(x: Column) -> Column:
    return blank_to_null(F.element_at(F.split(x, "/"), -1))


def disposition_filename(x: Column) -> Column:
    """File name of a Content-Disposition header; the encoded form first."""
    encoded = first_match(x, r"(?i)filename\*\s*=\s*(?:UTF-8'')?([^;]+)")
    plain = first_match(x, r"""(?i)filename\s*=\s*"?([^";]+)"?""")
    return F.coalesce(F.try_url_decode(encoded), plain)


def http_urls(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(r"(https?://[^\s\"'<>]+)"), 1)


def full_holdings_url(x: Column) -> Column:
    """The url that loads all holdings, from the one that loads the first ones."""
    return F.when(F.lower(x).contains("loadtype=initial"), F.regexp_replace(x, r"(?i)(loadtype=)initial", "$1full"))


def archive_base(cik: Column, accession: Column) -> Column:
    return F.concat(F.lit("https://www.sec.gov/Archives/edgar/data/"), cik.cast("bigint").cast("string"), F.lit("/"), no_dashes(accession))


def no_dashes(accession: Column) -> Column:
    return F.replace(accession, F.lit("-"), F.lit(""))


def submission_urls(cik: Column, accession: Column) -> dict[str, Column]:
    base = archive_base(cik, accession)
    return {
        "complete_txt_url": F.concat(base, F.lit("/"), accession, F.lit(".txt")),
        "index_url": F.concat(base, F.lit("/"), accession, F.lit("-index.html")),
        "hdr_sgml_url": F.concat(base, F.lit("/"), accession, F.lit(".hdr.sgml")),
    }


def content_type(name: Column) -> Column:
    """MIME type by a file name's ending."""
    low = F.lower(name)
    kinds = ((r"\.html?$", "text/html"), (r"\.txt$", "text/plain"), (r"\.xsd$|\.xml$|\.xsl$", "application/xml"), (r"\.pdf$", "application/pdf"), (r"\.jpe?g$", "image/jpeg"), (r"\.png$", "image/png"), (r"\.json$", "application/json"), (r"\.zip$", "application/zip"))
    out = F.lit(None).cast("string")
    for pattern, kind in reversed(kinds):
        out = F.when(low.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def is_textual(name: Column) -> Column:
    return F.coalesce(F.lower(name).rlike(r"\.(?:htm|html|txt|xml|xsd|xsl)$"), F.lit(False))


def looks_like_json(x: Column) -> Column:
    return F.coalesce(F.substring(F.ltrim(x), 1, 1).isin("[", "{"), F.lit(False))


def preview(x: Column, limit: int = 160) -> Column:
    return F.trim(F.replace(F.substring(x, 1, limit), F.lit("\n"), F.lit(" ")))


def names_workbook(url: Column, kind: Column, disposition: Column) -> Column:
    """Whether a response's url, MIME type or file name speaks of a workbook (its bytes are tested by the reader)."""
    file = F.lower(F.coalesce(disposition_filename(disposition), F.lit("")))
    mime = F.lower(F.coalesce(kind, F.lit("")))
    return file.endswith(".xlsx") | mime.contains("spreadsheetml") | F.coalesce(F.lower(url).rlike(r"\.xlsx(?:[?#]|$)"), F.lit(False))
