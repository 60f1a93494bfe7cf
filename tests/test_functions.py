"""Column functions on golden values."""

import html

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, digests, numbers, text


def value(spark, column, x, kind="string"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("f", "x", "y"),
    [
        (text.company_name, "MAHINDRA &amp; MAHINDRA", "MAHINDRA MAHINDRA"),
        (text.company_name, "MUENCHENER RUECKVER AG-REG", "MUENCHENER RUECKVER REG"),
        (text.company_name, "Alphabet Inc - A", "ALPHABET"),
        (text.company_name, None, ""),
        (text.constituent_name, "NESTLE SA CHF0.10 REG", "NESTLE SA"),
        (text.constituent_name, "TAIWAN SEMI-SPON ADR", "TAIWAN SEMI"),
        (text.normalize_cik, "320193", "0000320193"),
        (text.normalize_cik, "12345678901", "12345678901"),
        (text.normalize_cik, "12a", None),
        (text.digits_cik, "CIK 77", "0000000077"),
        (text.digits_cik, "", ""),
        (text.extract_accession, "x 0001234567-24-000001.txt", "0001234567-24-000001"),
        (text.filename_of_url, "https://a/b/c.txt", "c.txt"),
        (text.filename_of_url, "https://a/b/", None),
        (text.disposition_filename, 'attachment; filename="a b.xlsx"', "a b.xlsx"),
        (text.disposition_filename, "attachment; filename*=UTF-8''a%20b.xlsx", "a b.xlsx"),
        (text.plain_filename, "Ümlaut: straße?.xlsx", "Uemlaut_strasse_.xlsx"),
        (text.content_type, "a/B.HTM", "text/html"),
        (text.content_type, None, None),
        (text.item_title, "Item  Results of Ops, etc.", "RESULTS OF OPS ETC"),
        (text.full_holdings_url, "https://x/holdings/a?loadType=initial&b=1", "https://x/holdings/a?loadType=full&b=1"),
        (text.looks_like_json, "  {", True),
        (text.looks_like_json, None, False),
        (dates.german_date, "2026-03-31", "31.03.2026"),
        (dates.german_date, "31/3/2026", "31.03.2026"),
        (dates.german_date, "soon", None),
        (dates.interval_of_url, "http://d/20240101000000.export.CSV.zip", "20240101000000"),
        (dates.as_of_date, "Foo\nStand: 30.03.2026", "30.03.2026"),
        (dates.leading_date, "/a/2026-03-30__x.xlsx", "2026-03-30"),
        (numbers.money_number, "(1,234.50)", -1234.5),
        (numbers.money_number, "—", None),
        (numbers.money_number, "$5", 5.0),
        (numbers.plain_number, "1_000", None),
        (numbers.plain_number, "1d", None),
        (numbers.whole_number, "1,234", 1234),
        (numbers.flag, "yes", True),
        (numbers.flag, None, False),
        (numbers.name_threshold, "A B", 0.92),
    ],
)
def test_values(spark, f, x, y):
    assert value(spark, f, x) == y


def test_variants_of_a_german_name(spark):
    got = value(spark, text.recall_variants, "MUENCHENER RUECKVER AG-REG")
    assert any("MUNCHENER" in v for v in got) and any("RUCKVERSICHERUNGS" in v for v in got) and "MUENCHENER RUECKVER REG" not in got


def test_dates(spark):
    day = lambda x: value(spark, lambda c: dates.parse_date(c).cast("string"), x)
    assert [day(x) for x in ("2026-01-02", "20260102", "2026-1-2", "2026-01", "2026-13-01", None)] == ["2026-01-02", "2026-01-02", "2026-01-02", None, None, None]
    at = lambda x: value(spark, lambda c: dates.utc_iso(dates.parse_timestamp(c)), x)
    assert at("20260102030405") == at("2026-01-02T03:04:05.000Z") == at("2026-01-02 03:04:05") == at("2026-01-01T22:04:05-05:00") == "2026-01-02T03:04:05Z"
    assert at("soon") is None
    assert value(spark, lambda c: dates.business_date(c.cast("timestamp")).cast("string"), "2026-01-02 03:00:00") == "2026-01-01"


@pytest.mark.parametrize(("x", "scale", "sign", "y"), [("12.5", "", "", "12.5"), ("0.001", "3", "", "1"), ("(5)", "6", None, "-5000000"), ("5", None, "-", "-5"), ("n/a", "3", "-", "n/a")])
def test_scaling(spark, x, scale, sign, y):
    row = spark.createDataFrame([(x, scale, sign)], "x string, s string, g string").select(numbers.scaled_fact(F.col("x"), F.col("s"), F.col("g")).alias("y")).first()
    assert row["y"] == y


def test_canonical_json(spark):
    row = spark.range(1).select(digests.canonical_json(b=F.lit(None).cast("string"), a=F.lit(1)).alias("j"), digests.event_id(F.lit("s"), F.lit("k")).alias("e")).first()
    assert row["j"] == '{"a":1,"b":null}' and len(row["e"]) == 32


def test_names_of_workbooks(spark):
    rows = [("https://a/x.xlsx?b", None, None, True), ("https://a", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", None, True), ("https://a", "text/html", 'attachment; filename="H.XLSX"', True), ("https://a/x.xlsx.html", "text/html", None, False), (None, None, None, False)]
    df = spark.createDataFrame(rows, "u string, k string, d string, y boolean")
    assert all(r["x"] == r["y"] for r in df.withColumn("x", text.names_workbook(F.col("u"), F.col("k"), F.col("d"))).collect())


@pytest.mark.parametrize("x", ["a &amp; b", "AT&ampT", "&#65;B&#x42;&#x1F600;", "&#xD800;&#999999999;", "x&no; & &;", "&szlig;&eacute;&AElig;", "&amp;lt;", "&#38;amp;", "R&D", "", "&lt&gt&nbsp;z"])
def test_character_references(spark, x):
    assert value(spark, text.decode_entities, x) == html.unescape(x)
