"""Queries of sources and extraction plans, over documents written from the columns of the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import dates
from .operators import classify, holdings, incremental, outbox, resolve, retry, rollup, topk
from .plans import fund, ownership, reports, submission, thirteen_f, xbrl
from .registry import query, table
from .sources import feeds, tables

ACCESSION = "lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0')"


def accession():
    return F.concat_ws("-", F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.date_format("o_orderdate", "yy"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))


def pick(key, *values):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))


@query("""
    SELECT o_orderkey AS accession, unnest(CASE o_orderkey % 4 WHEN 0 THEN ['2.02', '9.01'] WHEN 1 THEN ['5.02', '2.02', '9.01'] WHEN 2 THEN ['7.01'] ELSE ['unknown', '8.01'] END) AS item_number FROM orders""")
def extract_8k_items(spark, sf_dir):
    """Items by stated numbers, titles and body mentions, each once."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("accession"))
    k = F.col("accession")
    line = pick(k, "Results of Operations and Financial Condition", "Item 5.02 Departure of Directors", "Reg FD", "Nothing that is listed")
    body = pick(k, "<p>Item 2.02 x</p><p>Item 9.01 y</p>", "<b>Item 2.02</b> and Item 2.02, Item 9.01", "Item 44.44", "<p>see</p> Item 8.01")
    headers = rows.select("accession", F.lit(0).alias("position"), line.alias("line"))
    return reports.report_items(headers, rows.select("accession", body.alias("body"))).select("accession", "item_number")


@query("""
    WITH f AS (SELECT o_orderkey AS accession, o_totalprice AS p, o_orderkey % 3 AS m FROM orders)
    SELECT accession, 'revenue' AS fact_type, round(p * CASE m WHEN 0 THEN 1e6 WHEN 1 THEN 1e3 ELSE 1 END, 0) AS fact_numeric FROM f
    UNION ALL SELECT accession, 'earnings_eps', (accession % 90 + 10) / 100.0 FROM f
    UNION ALL SELECT accession, 'dividend', 0.25 FROM f WHERE m = 0""")
def extract_8k_facts(spark, sf_dir):
    k = F.col("o_orderkey")
    amount = F.concat(F.lit("$"), F.format_number("o_totalprice", 2), pick(k, " million", " thousand", " in all"))
    eps = F.concat(F.lit("EPS of $0."), ((k % 90) + 10).cast("string"))
    end = F.when(k % 3 == 0, "; a dividend of $ 0.25 per share").otherwise(".")
    body = F.concat(F.lit("<p>Total  <b>revenue</b> was "), amount, F.lit(" and "), eps, end, F.lit("</p>"))
    bodies = table(spark, sf_dir, "orders").select(k.alias("accession"), body.alias("body"), F.array(F.lit("2.02")).alias("items"))
    return reports.report_facts(bodies).select("accession", "fact_type", F.when(F.col("fact_type") == "revenue", F.round("fact_numeric", 0)).otherwise(F.col("fact_numeric")).alias("fact_numeric"))


@query("""
    SELECT o_orderkey AS accession, lpad(CAST(o_orderkey % 100000000 AS VARCHAR), 9, '0') AS subject_cusip, (o_orderkey % 100) / 10.0 AS ownership_percent,
      CAST(o_custkey AS DOUBLE) AS shares_beneficially_owned, o_orderkey % 2 = 0 AS is_amendment, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 7 ELSE -1 END AS amendment_number, 'F' || o_custkey AS filer_name FROM orders""")
def extract_13dg(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    percent = F.format_string("%d.%d", (k % 100 / 10).cast("int"), (k % 10).cast("int"))
    share = F.when(k % 3 == 0, F.concat(F.lit("Percent of class represented: "), percent, F.lit(" %"))).otherwise(F.concat(percent, F.lit("% of the outstanding stock")))
    body = F.concat(F.lit("CUSIP No. "), F.lpad((k % 100000000).cast("string"), 9, "0"), F.lit(" AMENDMENT NO. "), (k % 7).cast("string"), F.lit(". Aggregate number "), c, F.lit(" . "), share)
    parties = F.array(F.struct(F.lit("subject-company").alias("role"), F.lit("1").alias("cik"), F.lit("S").alias("name")), F.struct(F.lit("filed-by").alias("role"), c.alias("cik"), F.concat(F.lit("F"), c).alias("name")))
    docs = table(spark, sf_dir, "orders").select(k.alias("accession"), F.when(k % 2 == 0, "SC 13D/A").otherwise("SC 13G").alias("form_type"), body.alias("body"), parties.alias("parties"))
    return reports.beneficial_owners(docs).select("accession", "subject_cusip", "ownership_percent", "shares_beneficially_owned", "is_amendment", F.coalesce("amendment_number", F.lit(-1)).alias("amendment_number"), "filer_name")


def order_xml(spark, sf_dir, line, head, tail):
    """One XML document per order, with an element for each of its lines."""
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("x")).alias("r"))
    lists = lines.groupBy("accession").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    return lists.select("accession", F.concat(head, F.array_join(F.transform("rs", lambda r: r["x"]), ""), tail).alias("content"))


@query("""
    SELECT l_orderkey AS accession, 'P' || l_partkey AS security_title, l_quantity AS shares, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_extendedprice END AS price_per_share, l_returnflag AS transaction_code, o.owner
    FROM lineitem, (SELECT unnest(['A', 'B']) AS owner) o""")
def parse_form4(spark, sf_dir):
    """Ownership documents: a row for each transaction and owner."""
    number = lambda c: F.col(c).cast("string")
    line = F.concat(
        F.lit("<nonDerivativeTransaction><securityTitle><value>P"), number("l_partkey"), F.lit("</value></securityTitle><transactionCoding><transactionCode>"), F.col("l_returnflag"),
        F.lit("</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>"), number("l_quantity"), F.lit("</value></transactionShares><transactionPricePerShare>"),
        F.when(F.col("l_linenumber") % 2 == 0, "<footnoteId/>").otherwise(F.concat(F.lit("<value>"), number("l_extendedprice"), F.lit("</value>"))),
        F.lit("</transactionPricePerShare></transactionAmounts></nonDerivativeTransaction>"),
    )
    owner = "<reportingOwner><reportingOwnerId><rptOwnerName>{}</rptOwnerName></reportingOwnerId></reportingOwner>"
    head = f'<ownershipDocument xmlns="urn:o"><issuer/>{owner.format("A")}{owner.format("B")}<nonDerivativeTable>'
    docs = order_xml(spark, sf_dir, line, F.lit(head), F.lit("</nonDerivativeTable></ownershipDocument>"))
    return ownership.ownership_rows(docs).select("accession", "security_title", "shares", "price_per_share", "transaction_code", F.col("reporting_owner_name").alias("owner"))


@query("""
    SELECT l_orderkey AS accession, '1998-03-31' AS report_period, round(sum(l_extendedprice), 2) AS total_value, count(*) AS entry_count, CAST(sum(l_quantity) AS BIGINT) AS votes FROM lineitem GROUP BY l_orderkey""")
def parse_13f(spark, sf_dir):
    line = F.concat(F.lit("<infoTable><nameOfIssuer>P</nameOfIssuer><value>"), F.format_number("l_extendedprice", 2), F.lit("</value><votingAuthority><Sole>"), F.col("l_quantity").cast("long").cast("string"), F.lit("</Sole></votingAuthority></infoTable>"))
    docs = order_xml(spark, sf_dir, line, F.lit("<informationTable xmlns='urn:t'><periodOfReport>03-31-1998</periodOfReport>"), F.lit("</informationTable>"))
    rows = thirteen_f.holding_rows(docs)
    totals = rollup.total_and_count(rows, "accession", "value_thousands").withColumn("total_value", F.round("total_value", 2))
    return totals.join(rows.groupBy("accession").agg(F.first("report_period").alias("report_period"), F.sum("voting_sole").alias("votes")), "accession")


@query("""
    SELECT l_orderkey AS accession, 'P' || l_partkey AS issuer_name, l_extendedprice AS value_usd, l_discount AS coupon_rate, l_linestatus = 'F' AS is_restricted FROM lineitem""")
def parse_nport(spark, sf_dir):
    line = F.concat(
        F.lit("<invstOrSec><name>P"), F.col("l_partkey").cast("string"), F.lit("</name><valUSD>"), F.col("l_extendedprice").cast("string"), F.lit("</valUSD><isRestrictedSec>"),
        F.when(F.col("l_linestatus") == "F", "Y").otherwise("N"), F.lit("</isRestrictedSec><debtSec><couponRate>"), F.col("l_discount").cast("string"), F.lit("</couponRate></debtSec></invstOrSec>"),
    )
    docs = order_xml(spark, sf_dir, line, F.lit("<e xmlns='urn:n'><genInfo><seriesId>S</seriesId></genInfo>"), F.lit("</e>"))
    return fund.fund_holdings(docs).select("accession", "issuer_name", "value_usd", "coupon_rate", "is_restricted")


@query("""
    SELECT o_orderkey AS accession, 'us-gaap:Revenue' AS concept, CASE WHEN o_orderkey % 2 = 0 THEN -round(o_totalprice * 1000, 0) ELSE round(o_totalprice * 1000, 0) END AS numeric_value, strftime(o_orderdate, '%Y-%m-%d') AS period_instant
    FROM orders""")
def parse_inline_xbrl(spark, sf_dir):
    k = F.col("o_orderkey")
    sign = F.when(k % 2 == 0, ' sign="-"').otherwise("")
    content = F.concat(
        F.lit('<html><xbrli:context id="c"><xbrli:period><xbrli:instant>'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("</xbrli:instant></xbrli:period></xbrli:context><p>about <ix:nonFraction name='us-gaap:Revenue' contextRef='c' scale='3'"),
        sign, F.lit(">"), F.format_number("o_totalprice", 2), F.lit("<br></ix:nonFraction> and <ix:nonFraction name='own:Skip' contextRef='c'>1</ix:nonFraction></p></html>"),
    )
    docs = table(spark, sf_dir, "orders").select(k.alias("accession"), content.alias("content"))
    return xbrl.fact_rows(docs).select("accession", "concept", F.round("numeric_value", 0).alias("numeric_value"), "period_instant")


@query("""
    SELECT o_orderkey AS accession, 'filer' AS role, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, 'NAME ' || o_custkey AS name FROM orders
    UNION ALL SELECT o_orderkey, 'subject-company', NULL, o_orderpriority FROM orders WHERE o_orderkey % 2 = 0""")
def parse_sgml_parties(spark, sf_dir):
    k = F.col("o_orderkey")
    subject = F.when(k % 2 == 0, F.concat(F.lit("SUBJECT COMPANY:\n\tCOMPANY CONFORMED NAME:\t"), "o_orderpriority", F.lit("\n"))).otherwise("")
    content = F.concat(F.lit("<SEC-HEADER>\nFILER:\n\tCOMPANY CONFORMED NAME:\tNAME "), "o_custkey", F.lit("\n\tCENTRAL INDEX KEY:\t"), "o_custkey", F.lit("\n"), subject, F.lit("</SEC-HEADER>\n"))
    return submission.party_rows(table(spark, sf_dir, "orders").select(k.alias("accession"), content.alias("content"))).select("accession", "role", "cik", "name")


@query("""
    SELECT o_orderkey AS accession, CASE WHEN o_orderkey % 3 = 0 THEN 'main.htm' WHEN o_orderkey % 3 = 1 THEN 'one.txt' ELSE 'pref.htm' END AS filename FROM orders""")
def choose_primary_document(spark, sf_dir):
    k = F.col("accession")
    doc = lambda kind, seq, name: f"<DOCUMENT><TYPE>{kind}\n<SEQUENCE>{seq}\n<FILENAME>{name}\n<TEXT>x</TEXT></DOCUMENT>"
    content = pick(k, doc("EX-1", 2, "a.htm") + doc("8-K", 3, "main.htm"), doc("GRAPHIC", 2, "p.jpg") + doc("EX-2", 1, "one.txt"), doc("8-K", 1, "main.htm") + doc("EX-9", 4, "pref.htm"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"))
    headers = rows.select("accession", F.lit("8-K").alias("form_type"), F.when(k % 3 == 2, "PREF.htm").alias("preferred"))
    return submission.primary_from_header(submission.document_rows(rows.select("accession", content.alias("content"))), headers)


@query(f"""
    SELECT o_orderkey AS page, {ACCESSION} AS accession, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN o_orderkey % 2 = 0 THEN '8-K/A' ELSE '8-K' END AS form_type, strftime(o_orderdate, '%Y-%m-%d') AS filing_date
    FROM orders WHERE o_orderkey % 4 <> 3""")
def parse_atom_feed(spark, sf_dir):
    k = F.col("o_orderkey")
    acc = F.when(k % 4 != 3, F.concat(F.lit("AccNo: "), accession())).otherwise("none")
    content = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>8-K - CO '), "o_custkey", F.lit(" ("), "o_custkey", F.lit(") (Filer)</title><summary>Filed: "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" "), acc,
        F.lit("</summary>"), F.when(k % 2 == 0, '<category term="8-K/A"/>').otherwise(""), F.lit("</entry></feed>"),
    )
    rows = feeds.atom_feed(table(spark, sf_dir, "orders").select(k.alias("page"), content.alias("content")))
    return rows.select("page", "accession", "cik", "form_type", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"))


@query(f"SELECT {ACCESSION} AS accession, lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, o_orderstatus AS form_type, strftime(o_orderdate, '%Y-%m-%d') AS filing_date FROM orders WHERE o_orderkey % 5 <> 0")
def parse_company_index(spark, sf_dir):
    k = F.col("o_orderkey")
    parts = [F.col("o_custkey").cast("string"), F.lit("CO"), F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.concat(F.lit("edgar/data/"), accession(), F.lit(".txt"))]
    lines = table(spark, sf_dir, "orders").select(F.when(k % 5 == 0, F.concat_ws("|", *parts[:3])).otherwise(F.concat_ws("|", *parts)).alias("value"))
    rows = feeds.company_index(lines)
    return rows.select("accession", "cik", "form_type", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"))


@query("""
    SELECT CASE WHEN event_id % 3 = 0 THEN 'events_en' WHEN event_id % 3 = 1 THEN 'mentions_en' ELSE 'gkg_en' END AS feed, strftime(ts, '%Y%m%d%H%M%S') AS interval_ts, md5(props) AS md5, event_id AS size
    FROM events WHERE event_id % 7 <> 0""")
def discover_manifest(spark, sf_dir):
    """Master list lines to files of feeds; lines that aren't files are left out."""
    from . import fixed

    e = F.col("event_id")
    name = pick(e, ".export.CSV.zip", ".mentions.CSV.zip", ".gkg.csv.zip")
    line = F.concat_ws(" ", e.cast("string"), F.md5("props"), F.concat(F.lit("http://d.example/v2/"), F.date_format("ts", "yyyyMMddHHmmss"), name))
    lines = table(spark, sf_dir, "events").select(F.when(e % 7 == 0, "not a file").otherwise(line).alias("value"))
    known = spark.createDataFrame([(f[0], f[1], f[2]) for f in fixed.FEEDS], "feed string, list string, pattern string")
    found = incremental.discover_files(feeds.master_list(lines).withColumn("list", F.lit("master")), known)
    return found.select("feed", "interval_ts", "md5", "size")


@query("""
    WITH r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem)
    SELECT lpad(CAST(l_suppkey AS VARCHAR), 10, '0') AS cik, lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '-98-' || lpad(CAST(l_partkey AS VARCHAR), 6, '0') AS accession, strftime(l_shipdate, '%Y-%m-%d') AS filing_date, 'UNKNOWN' AS form_type FROM r""")
def unfold_submissions(spark, sf_dir):
    """Company payloads of parallel arrays, one of them short."""
    rows = table(spark, sf_dir, "lineitem")
    acc = F.concat_ws("-", F.lpad(F.col("l_orderkey").cast("string"), 10, "0"), F.lit("98"), F.lpad(F.col("l_partkey").cast("string"), 6, "0"))
    lists = rows.groupBy("l_suppkey").agg(F.collect_list(F.struct(acc.alias("a"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("d"))).alias("rs"))
    recent = F.struct(F.transform("rs", lambda r: r["a"]).alias("accessionNumber"), F.transform("rs", lambda r: r["d"]).alias("filingDate"), F.array().cast("array<string>").alias("form"))
    payload = F.to_json(F.struct(F.col("l_suppkey").cast("string").alias("cik"), F.lit("S").alias("name"), F.struct(recent.alias("recent")).alias("filings")))
    got = feeds.submissions(lists.select(payload.alias("json")))
    return got.select("cik", "accession", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"), "form_type")


@query("""
    SELECT o_orderkey AS accession, CASE WHEN o_orderkey % 5 = 4 THEN 'unresolved' WHEN o_orderkey % 5 = 3 THEN 'hdr_failed'
      WHEN c_mktsegment = 'BUILDING' THEN 'hdr_match' ELSE 'irrelevant' END AS state
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def header_resolution(spark, sf_dir):
    """Headers against a watchlist, by CIK or, without one, by name."""
    customers = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'")
    watchlist = customers.select(F.col("c_custkey").cast("int").alias("position"), F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("cik"), F.col("c_name").alias("name"), F.array().cast("array<string>").alias("aliases"))
    k, c = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    name = F.concat(F.lit("CUSTOMER#"), F.lpad(c, 9, "0"))
    issuer = F.struct(F.lit("issuer").alias("role"), F.when(k % 5 != 1, c).alias("cik"), name.alias("name"))
    none = F.array().cast("array<struct<role:string,cik:string,name:string>>")
    headers = table(spark, sf_dir, "orders").select(k.alias("accession"), F.when(k % 5 == 4, "SC 13D").otherwise("4").alias("form_type"), F.when(k % 5 >= 3, none).otherwise(F.array(issuer)).alias("parties"))
    return classify.resolve_headers(headers, watchlist).select("accession", "state")


@query("""
    SELECT p_partkey AS company_id, p_partkey AS cik, TRUE AS accepted FROM part""")
def entity_resolution(spark, sf_dir):
    """All parts as companies, resolved among all parts by their ticker and name."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand", F.concat(F.lit("X"), F.hex("p_partkey"))).alias("name"), F.concat(F.lit("T"), "p_partkey").alias("ticker"))
    rows = resolve.cut(resolve.normalised(rows))
    companies = rows.select(F.col("p_partkey").alias("company_id"), "norm", "ticker")
    entities = rows.select(F.col("p_partkey").alias("cik"), "norm", "ticker", F.lit(True).alias("current"))
    hints = companies.select("company_id", "ticker", "norm", F.lit(0.9).alias("score"))
    profiles = entities.select("cik", F.array("norm").alias("names"), F.array("ticker").alias("tickers"))
    candidates = resolve.gather_candidates(companies, entities, hints)
    return resolve.accept(resolve.validate(candidates, companies, profiles, hints)).select("company_id", "cik", "accepted")


@query("""
    WITH m AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
    SELECT 'events_total{type="' || event_type || '"} ' || CAST(CAST(n AS DOUBLE) AS VARCHAR) AS line FROM m
    UNION ALL SELECT '# HELP events_total Events.' UNION ALL SELECT '# TYPE events_total counter'""")
def metrics_exposition(spark, sf_dir):
    counts = rollup.counters(table(spark, sf_dir, "events").withColumn("one", F.lit(1.0)), ["event_type"], "one")
    rows = counts.select(F.lit("events_total").alias("name"), F.lit("counter").alias("kind"), F.lit("Events.").alias("help"), F.create_map(F.lit("type"), "event_type").alias("labels"), "value")
    return rollup.exposition(rows)


@query("""
    WITH e AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 'leased' ELSE 'pending' END AS status, event_id % 12 AS attempts FROM events)
    SELECT event_id AS commit_seq, CASE WHEN event_id % 6 = 0 THEN 'published' WHEN event_id % 6 = 3 THEN CASE WHEN attempts + 1 >= 10 THEN 'failed' ELSE 'pending' END ELSE status END AS status,
      attempts + CASE WHEN event_id % 6 = 3 THEN 1 ELSE 0 END AS publish_attempts FROM e""")
def outbox_publish_cycle(spark, sf_dir):
    """Leases that are published, and others that fail and go back or give up."""
    e = F.col("event_id")
    box = table(spark, sf_dir, "events").select(
        e.alias("commit_seq"), F.when(e % 3 == 0, "leased").otherwise("pending").alias("status"), F.when(e % 3 == 0, "mine").alias("lease_token"), (e % 12).alias("publish_attempts"),
        F.lit(None).cast("timestamp").alias("next_attempt_at"), F.lit(None).cast("string").alias("last_error"),
    )
    c = F.col("commit_seq")
    done = box.where(c % 6 == 0).select("commit_seq", "lease_token").unionByName(box.where(c % 6 == 1).select("commit_seq", F.lit("stolen").alias("lease_token")))
    failed = box.where(c % 6 == 3).select("commit_seq", F.lit("lost").alias("error"))
    after = retry.mark_publish_failed(retry.mark_published(box, done), failed, F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return after.select("commit_seq", "status", "publish_attempts")


@query("""
    WITH f AS (SELECT l_orderkey, count(*) AS total, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey)[1:2] AS items FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey AS accession, substr(sha256('edgar.form4.parsed:' || l_orderkey), 1, 32) AS event_id,
      '{"accession":' || l_orderkey || ',"items":[' || array_to_string(items, ',') || '],"total":' || total || '}' AS payload_json FROM f""")
def build_events(spark, sf_dir):
    """One event per filing with its first rows."""
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "accession")
    few = topk.capped(rows, ["accession"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")], 2, F.col("l_partkey"))
    events = outbox.envelopes(few, "edgar.form4.parsed", F.col("accession").cast("string"), {"accession": F.col("accession"), "items": F.col("items"), "total": F.col("total")}, F.lit(None).cast("string"))
    return events.select("accession", "event_id", "payload_json")


@query("""
    SELECT l_suppkey AS id, l_orderkey AS position, CAST(l_partkey AS VARCHAR) AS isin, l_discount AS weight FROM lineitem""")
def parse_holdings_payload(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    held = F.struct(F.col("l_partkey").cast("string").alias("isin"), F.col("l_orderkey").cast("string").alias("name"), F.round(F.col("l_discount") * 100, 2).alias("weight"))
    payloads = rows.groupBy("l_suppkey").agg(F.to_json(F.struct(F.collect_list(held).alias("holdings"))).alias("json")).withColumnRenamed("l_suppkey", "id")
    got = tables.holdings_payload(payloads)
    return got.select("id", F.col("name").cast("long").alias("position"), "isin", F.round("weight", 4).alias("weight"))


@query("""
    SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'bad isin' WHEN p_partkey % 4 = 1 THEN 'bad weight' END AS reason FROM part""")
def constituent_validity(spark, sf_dir):
    k = F.col("p_partkey")
    isin = F.when(k % 4 == 0, "us0378331005").otherwise(F.concat(F.lit("US"), F.lpad(k.cast("string"), 10, "0")))
    weight = F.when(k % 4 == 1, 1.5).otherwise(0.5)
    return table(spark, sf_dir, "part").select("p_partkey", holdings.invalid_constituent(isin, weight).alias("reason"))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, sha256(props) AS digest FROM events WHERE strftime(ts, '%Y-%m-%dT%H:%M:%S') >= '2024-01-05T00:00:00'")
def parse_timestamps(spark, sf_dir):
    """Times written in two ways, read back and compared."""
    e = F.col("event_id")
    written = F.when(e % 2 == 0, F.date_format("ts", "yyyyMMddHHmmss")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    rows = table(spark, sf_dir, "events").select("event_id", dates.parse_timestamp(written).alias("at"), F.sha2("props", 256).alias("digest"))
    return rows.where(dates.utc_compact(F.col("at")) >= "20240105000000").select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), "digest")


