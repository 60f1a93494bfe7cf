"""Current reports (items and facts) and beneficial ownership reports, by column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed
from ..functions import numbers, text

TITLES = sorted({t.upper(): item for item, t in [*fixed.EIGHT_K_ITEMS.items(), *((i, t) for i, ts in fixed.EIGHT_K_TITLES.items() for t in ts)]}.items())


def known_titles(spark) -> DataFrame:
    """item, title (normalised): a small fixed table."""
    rows = spark.createDataFrame([(item, title) for title, item in TITLES], "item string, title string")
    return rows.select("item", text.item_title(F.col("title")).alias("title")).dropDuplicates(["title"])


def item_numbers(items: DataFrame) -> DataFrame:
    """Number of each header line: stated, by title, by the longest title that holds it or that it holds, or unknown.

    items: accession, position, line. The titles are a fixed table, so the containment join is a broadcast.
    """
    rows = items.withColumn("__title", text.item_title(F.col("line"))).withColumn("__stated", text.first_match(F.col("line"), r"(?i)Item\s+(\d+\.\d+)"))
    titles = F.broadcast(known_titles(items.sparkSession))
    near = (F.col("__title") == F.col("title")) | F.col("__title").contains(F.col("title")) | F.col("title").contains(F.col("__title"))
    both = rows.join(titles, F.col("__stated").isNull() & near, "left")
    best = F.max_by("item", F.struct((F.col("__title") == F.col("title")).alias("same"), F.length("title").alias("n"), "item"))
    found = both.groupBy("accession", "position", "line").agg(F.first("__stated").alias("__stated"), best.alias("__near"))
    return found.select("accession", "position", "line", F.coalesce("__stated", "__near", F.lit("unknown")).alias("item_number"))


def body_items(body: Column) -> Column:
    """Known items that the text names, in order, each once."""
    found = F.regexp_extract_all(text.strip_tags(body), F.lit(r"(?i)(?:^|\s)Item\s+(\d+\.\d+)\b"), 1)
    return F.array_distinct(F.filter(found, lambda x: x.isin(*fixed.EIGHT_K_ITEMS)))


def report_items(headers: DataFrame, bodies: DataFrame) -> DataFrame:
    """accession, item_number, item_description: header items, then the body's, each number once.

    headers: accession, position, line; bodies: accession, body.
    """
    stated = item_numbers(headers).select("accession", "item_number", F.lit(0).alias("part"), "position")
    named = bodies.select("accession", F.posexplode(body_items(F.col("body"))).alias("position", "item_number"))
    both = stated.unionByName(named.select("accession", "item_number", F.lit(1).alias("part"), "position"))
    each = both.groupBy("accession", "item_number").agg(F.min(F.struct("part", "position")).alias("at"))
    table = F.create_map(*(F.lit(x) for pair in fixed.EIGHT_K_ITEMS.items() for x in pair))
    return each.select("accession", "item_number", F.coalesce(F.try_element_at(table, F.col("item_number")), F.lit("Unknown")).alias("item_description"), F.col("at.part").alias("part"), F.col("at.position").alias("position"))


def report_facts(bodies: DataFrame) -> DataFrame:
    """Facts of current reports: the first match of each kind, where its item is present.

    bodies: accession, body, items (array of item numbers).
    """
    plain = F.regexp_replace(F.regexp_replace("body", r"<[^>]+>", " "), r"\s+", " ")
    rows = bodies.select("accession", "items", plain.alias("plain"))
    facts = []
    for item, kind, key, pattern in fixed.EIGHT_K_FACTS:
        there = F.lit(True) if item is None else F.array_contains("items", item)
        whole = text.first_match(F.col("plain"), pattern, 0)
        if kind == "management_change":
            value, number, currency = F.when(whole.isNotNull(), "true"), F.lit(None).cast("double"), F.lit(None).cast("string")
        elif kind in ("earnings_eps", "dividend"):
            value = text.first_match(F.col("plain"), pattern, 1)
            number, currency = numbers.to_double(value), F.lit("USD")
        else:
            number = numbers.amount(F.regexp_extract("plain", pattern, 1), F.regexp_extract("plain", pattern, 2))
            value, currency = F.substring(whole, 1, 200), F.lit("USD")
        own = F.lit(item) if item else F.coalesce(F.get("items", F.lit(0)), F.lit("unknown"))
        fact = F.struct(own.alias("item_number"), F.lit(kind).alias("fact_type"), F.lit(key).alias("fact_key"), value.alias("fact_value"), number.alias("fact_numeric"), currency.alias("currency"))
        facts.append(F.when(there & whole.isNotNull() & (number.isNotNull() | (F.lit(kind) == "management_change")), fact))
    return rows.select("accession", F.inline(F.array_compact(F.array(*facts))))


def beneficial_owners(docs: DataFrame) -> DataFrame:
    """Beneficial ownership reports. docs: accession, form_type, body, parties (role, cik, name)."""
    party = lambda keep: F.get(F.filter("parties", keep), F.lit(0))
    subject = party(lambda p: p["role"] == "subject-company")
    filer = F.coalesce(party(lambda p: p["role"] == "filer"), party(lambda p: p["role"] == "filed-by"), party(lambda p: p["role"] != "subject-company"))
    body, form = F.col("body"), F.upper(F.trim(F.col("form_type")))
    percent = F.coalesce(text.first_match(body, fixed.DG_PERCENT), text.first_match(body, fixed.DG_PERCENT_SIMPLE))
    amended = form.contains("/A")
    return docs.select(
        "accession",
        form.alias("form_type"),
        filer["cik"].alias("filer_cik"),
        filer["name"].alias("filer_name"),
        subject["cik"].alias("subject_cik"),
        subject["name"].alias("subject_name"),
        text.first_match(body, fixed.DG_CUSIP).alias("subject_cusip"),
        text.first_match(body, fixed.DG_EVENT_DATE).alias("date_of_event"),
        numbers.plain_number(percent).alias("ownership_percent"),
        numbers.plain_number(text.first_match(body, fixed.DG_SHARES)).alias("shares_beneficially_owned"),
        amended.alias("is_amendment"),
        F.when(amended, numbers.whole_number(text.first_match(body, fixed.DG_AMENDMENT))).alias("amendment_number"),
    )
