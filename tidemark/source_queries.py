"""Queries of sources and extraction plans that read files, pages and lists written from the columns of the driver's tables."""

from __future__ import annotations

import gzip
import io
import zipfile

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from . import fixed
from .functions import dates, text
from .operators import classify, holdings, resolve
from .plans import fund, ownership, submission, thirteen_f, xbrl
from .registry import query, table
from .sources import feeds, tables


def pick(key, *values):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))


@query("""
    WITH e AS (SELECT user_id, event_type || chr(9) || props AS line, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS line_no FROM events)
    SELECT 'u' || user_id || CASE WHEN user_id % 2 = 0 THEN '.gz' ELSE '.zip' END AS path, line_no, line FROM e WHERE user_id % 7 <> 0""")
def archive_lines(spark, sf_dir):
    """Lines of GZ and ZIP files, one for each user; damaged files give none."""

    def packed(batches):
        for batch in batches:
            out = []
            for user, lines in zip(batch["user_id"], batch["lines"], strict=True):
                raw = "\r\n".join(lines).encode()
                if user % 7 == 0:
                    raw = b"PK broken"
                elif user % 2 == 0:
                    raw = gzip.compress(raw)
                else:
                    buffer = io.BytesIO()
                    with zipfile.ZipFile(buffer, "w") as z:
                        z.writestr("lines.csv", raw)
                    raw = buffer.getvalue()
                out.append((f"u{user}{'.gz' if user % 2 == 0 else '.zip'}", raw))
            yield pd.DataFrame(out, columns=["path", "content"])

    rows = table(spark, sf_dir, "events").select("user_id", F.struct("event_id", F.concat_ws("\t", "event_type", "props").alias("line")).alias("r"))
    files = rows.groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list("r")), lambda r: r["line"]).alias("lines")).mapInPandas(packed, "path string, content binary")
    return feeds.archive_lines(files)


HELD = "(SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS n FROM lineitem)"


def workbooks(spark, sf_dir):
    """One workbook for each supplier: a heading of four rows, and a row for each line; every seventh file is none."""

    def packed(batches):
        for batch in batches:
            for i in range(batch.num_rows):  # one supplier's lines at a time become Python objects
                supplier, lines = batch.column("l_suppkey")[i].as_py(), batch.column("lines")[i].as_py()
                rows = [(f"P{r['l_partkey']}", None, f" US{r['l_partkey']:010d} ", float(r["l_discount"])) for r in lines]
                raw = tables.build_workbook(rows, [["Fund"], [], ["As of"], ["Name", "CUSIP", "ISIN", "Weight"]], {"fund": f"S{supplier}", "rows": len(rows)})
                content = b"PK no workbook" if supplier % 7 == 0 else raw
                yield pa.RecordBatch.from_pydict({"path": [f"/f/1998-03-31/{supplier}.xlsx"], "content": pa.array([content], pa.binary())})

    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_discount").alias("r"))
    return rows.groupBy("l_suppkey").agg(F.sort_array(F.collect_list("r")).alias("lines")).mapInArrow(packed, "path string, content binary")


@query(f"""
    SELECT '/f/1998-03-31/' || l_suppkey || '.xlsx' AS path, n + 3 AS position, 'P' || l_partkey AS name, 'US' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS isin, l_discount AS weight, '1998-03-31' AS as_of_date FROM {HELD} WHERE l_suppkey % 7 <> 0""")
def workbook_constituents(spark, sf_dir):
    return tables.constituents(workbooks(spark, sf_dir)).select("path", F.col("position").cast("long").alias("position"), "name", "isin", "weight", "as_of_date")


@query(f"""
    SELECT '/f/1998-03-31/' || l_suppkey || '.xlsx' AS path, 'Holdings,Metadata' AS sheets, count(*) AS data_row_count, round(sum(l_discount * 100), 4) AS weight_sum_percent,
      string_agg('P' || l_partkey, ',' ORDER BY n) FILTER (n <= 5) AS sample_names, 'S' || l_suppkey || ':' || count(*) AS metadata FROM {HELD} WHERE l_suppkey % 7 <> 0 GROUP BY l_suppkey""")
def workbook_summaries(spark, sf_dir):
    rows = tables.workbook_summaries(workbooks(spark, sf_dir))
    return rows.select(
        "path", F.array_join("sheet_names", ",").alias("sheets"), "data_row_count", F.round("weight_sum_percent", 4).alias("weight_sum_percent"),
        F.array_join("sample_names", ",").alias("sample_names"), F.concat_ws(":", F.col("metadata")["fund"], F.col("metadata")["rows"]).alias("metadata"),
    )


@query("""
    SELECT p_partkey, p_partkey % 3 = 0 AS by_url, p_partkey % 3 = 1 AS by_type, p_partkey % 3 <= 1 AS workbook FROM part""")
def workbook_responses(spark, sf_dir):
    k = F.col("p_partkey")
    url, kind = F.when(k % 3 == 0, "https://x/Data.XLSX?v=1").otherwise("https://x/data"), F.when(k % 3 == 1, "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet")
    none = F.lit(None).cast("string")
    return table(spark, sf_dir, "part").select("p_partkey", text.names_workbook(url, none, none).alias("by_url"), text.names_workbook(F.lit("x"), kind, none).alias("by_type"), text.names_workbook(url, kind, none).alias("workbook"))


@query("""
    SELECT c_nationkey AS list, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'T' || c_custkey AS ticker, c_name AS name, 'A' || c_custkey || ',B: x' AS aliases FROM customer WHERE c_custkey % 5 <> 0""")
def watchlist_files(spark, sf_dir):
    """YAML company lists, one for each nation; companies without a ticker and repeats of a CIK are left out."""
    k = F.col("c_custkey").cast("string")
    entry = F.concat(
        F.lit("- cik: "), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("'"), F.lpad(k, 10, "0"), F.lit("'"))).otherwise(k), F.lit("\n  ticker: "),
        F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat(F.lit("T"), k)), F.lit("\n  name: '"), "c_name", F.lit("'\n  aliases: [A"), k, F.lit(", 'B: x']\n"),
    )
    again = F.concat(F.lit("- {cik: "), k, F.lit(", ticker: LATER, name: LATER}\n"))
    entries = F.struct("c_custkey", F.concat(entry, again).alias("e"))
    lists = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(entries)), lambda e: e["e"]), "").alias("body"))
    # one of the spellings has a heading; every list is read on its own
    content = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("companies:\n"), "body")).otherwise(F.col("body"))
    got = tables.listed_companies(lists.select(F.col("c_nationkey").cast("string").alias("path"), content.alias("content")))
    return got.where("ticker <> 'LATER'").select(F.col("path").cast("long").alias("list"), "cik", "ticker", "name", F.array_join("aliases", ",").alias("aliases"))


@query("""
    SELECT 'payload' AS kind, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, c_name AS name, 'T' || c_custkey AS ticker, CASE WHEN c_custkey % 2 = 0 THEN 'NYSE' END AS exchange FROM customer
    UNION ALL SELECT 'lookup', lpad(CAST(c_custkey AS VARCHAR), 10, '0'), c_name, NULL, NULL FROM customer WHERE c_custkey % 3 <> 0""")
def entity_tables(spark, sf_dir):
    """Column-oriented entity payloads, one for each nation, and lookup lines."""
    k = F.col("c_custkey").cast("string")
    none = F.lit(None).cast("string")
    rows = table(spark, sf_dir, "customer")
    data = F.array(k, F.col("c_name"), F.concat(F.lit("t-"), k), F.when(F.col("c_custkey") % 2 == 0, "NYSE"))
    body = F.to_json(F.struct(F.array(*(F.lit(x) for x in ("cik", "name", "ticker", "exchange"))).alias("fields"), F.collect_list(data).alias("data")))
    columns = tables.entity_columns(rows.groupBy("c_nationkey").agg(body.alias("json"))).select(F.lit("payload").alias("kind"), "cik", "name", "ticker", "exchange")
    line = F.when(F.col("c_custkey") % 3 != 0, F.concat(F.col("c_name"), F.lit(":"), k, F.lit(":"))).otherwise("no line")
    lookup = tables.name_lookup(rows.select(line.alias("value")))
    return columns.unionByName(lookup.select(F.lit("lookup").alias("kind"), "cik", "name", none.alias("ticker"), none.alias("exchange")))


@query("SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 5 DAY")
def fresh_cache(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("fetched_at"))
    return tables.fresh(rows, F.to_timestamp(F.lit("2024-01-10 00:00:00")), 5 * 86400).select("event_id")


@query("""
    WITH o AS (SELECT *, lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '-98-000001' AS acc FROM orders)
    SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN o_custkey % 2 = 0 THEN 'C' || o_custkey ELSE 'UNKNOWN' END AS company_name, acc AS accession, strftime(o_orderdate, '%Y-%m-%d') AS filing_date, o_orderstatus AS form_type FROM o""")
def older_submissions(spark, sf_dir):
    """History payloads of parallel arrays, whose company is given."""
    acc = F.concat(F.lpad(F.col("o_orderkey").cast("string"), 10, "0"), F.lit("-98-000001"))
    row = F.struct(acc.alias("a"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"), F.col("o_orderstatus").alias("f"))
    lists = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(row).alias("rs"))
    body = F.struct(F.transform("rs", lambda r: r["a"]).alias("accessionNumber"), F.transform("rs", lambda r: r["d"]).alias("filingDate"), F.transform("rs", lambda r: r["f"]).alias("form"))
    c = F.col("o_custkey")
    payloads = lists.select(F.lpad(c.cast("string"), 10, "0").alias("cik"), F.when(c % 2 == 0, F.concat(F.lit("C"), c.cast("string"))).alias("company_name"), F.to_json(body).alias("json"))
    return feeds.older_submissions(payloads).select("cik", "company_name", "accession", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"), "form_type")


@query("""
    SELECT 'https://data.sec.gov/submissions/f' || c_custkey || '.json' AS url FROM customer
    UNION ALL SELECT 'https://data.sec.gov/submissions/g' || c_custkey || '.json' FROM customer WHERE c_custkey % 2 = 0""")
def history_urls(spark, sf_dir):
    """Names of history files, as text or as objects."""
    k = F.col("c_custkey").cast("string")
    plain = F.concat(F.lit('{"filings":{"files":["f'), k, F.lit('.json"]}}'))
    named = F.concat(F.lit('{"filings":{"files":[{"name":"f'), k, F.lit('.json","n":1},{"name":"g'), k, F.lit('.json"},{"n":2}]}}'))
    return feeds.history_urls(table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, named).otherwise(plain).alias("json"))).where("url NOT LIKE '%{%'")


@query("""
    SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'CUSTOMER ACME X' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN ';OLD NAME' ELSE '' END AS names, 'T' || c_custkey || ',BRKB' AS tickers FROM customer""")
def entity_profiles(spark, sf_dir):
    """Names, the current one first, and tickers of company payloads."""
    k = F.col("c_custkey").cast("string")
    former = F.when(F.col("c_custkey") % 2 == 0, ',"formerNames":[{"name":"Old Name, Inc."},{"name":"The Co"}]').otherwise("")
    body = F.concat(F.lit('{"cik":"'), k, F.lit('","name":"Customer Acme x'), k, F.lit(' Corp","tickers":["t'), k, F.lit('","BRK.B"]'), former, F.lit("}"))
    rows = feeds.profiles(table(spark, sf_dir, "customer").select(body.alias("json")))
    return rows.select("cik", F.array_join("names", ";").alias("names"), F.array_join("tickers", ",").alias("tickers"))


@query("""
    SELECT c_custkey AS company_id, lpad(CAST(c_custkey + 1 AS VARCHAR), 10, '0') AS cik, 'A & B' AS name FROM customer UNION SELECT c_custkey, lpad(CAST(c_custkey + 2 AS VARCHAR), 10, '0'), 'C D' FROM customer""")
def browse_results(spark, sf_dir):
    k = F.col("c_custkey")
    page = F.concat(F.lit('<a href="/edgar/browse/?CIK='), (k + 1).cast("string"), F.lit('&x=1"><b>A & B</b></a> <a href=\'https://www.sec.gov/cgi-bin/browse-edgar?action=x&CIK='), (k + 2).cast("string"), F.lit("'>C\nD</a><a href='/other?CIK=9'>no</a>"))
    return tables.browse_results(table(spark, sf_dir, "customer").select(k.alias("company_id"), page.alias("html")))


#: Submissions that one task parses.
TEXTS_A_TASK = 20_000


def filings_text(spark, sf_dir, spread=False):
    """Submission texts of four documents: a page, an information table, a schema and an instance.

    spread: whether the keys, from which the texts are made, are dealt to more tasks than their small file has.
    """
    k = F.col("o_orderkey")
    doc = lambda kind, name, told, body: F.concat(F.lit(f"<DOCUMENT><TYPE>{kind}\n<SEQUENCE>1\n<FILENAME>"), F.lit(name), F.lit(f"\n<DESCRIPTION>{told}\n<TEXT>"), body, F.lit("</TEXT></DOCUMENT>"))
    instance = F.when(k % 3 == 0, F.concat(F.lit("<XBRL>\n<xbrl>"), k.cast("string"), F.lit("</xbrl>\n</XBRL>"))).otherwise("<other/>")
    content = F.concat(
        F.lit("<SEC-HEADER>\nCONFORMED SUBMISSION TYPE:\t13F-HR\n<ACCEPTANCE-DATETIME>19980331120000\nFILED AS OF DATE:\t19980401\nITEM INFORMATION:\tFirst\nITEM INFORMATION:\tSecond\n</SEC-HEADER>\n"),
        doc("13F-HR", "main.htm", "report", F.concat(F.lit("<p>"), k.cast("string"), F.lit("</p>"))), doc("INFORMATION TABLE", "info.xml", "holdings", F.lit("<informationTable/>")),
        doc("EX-101.SCH", "x.xsd", "schema", F.lit("<xbrl/>")), F.when(k % 2 == 0, doc("EX-101.INS", "inst.xml", "XBRL INSTANCE", instance)).otherwise(doc("EX-99", "data.xml", "data", instance)),
    )
    keys = table(spark, sf_dir, "orders").select(k)
    if spread:
        keys = keys.repartition(-(-keys.count() // TEXTS_A_TASK) or 1)
    return keys.select(k.alias("accession"), content.alias("content"))


@query("""
    SELECT o_orderkey AS accession, '13F-HR' AS form_type, '19980331120000' AS acceptance_datetime, '19980401' AS filed_as_of_date, 'First,Second' AS items, 'info.xml' AS info,
      CASE WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'inst.xml' ELSE 'data.xml' END END AS instance, '<p>' || o_orderkey || '</p>' AS body, CASE WHEN o_orderkey % 3 = 0 THEN TRUE ELSE o_orderkey % 2 = 0 END AS speaks FROM orders""")
def submission_parts(spark, sf_dir):
    """Header fields, the information table, the instance by content, and the primary document's body."""
    rows = filings_text(spark, sf_dir, spread=True)
    last = F.regexp_extract("content", r"(?s).*<TEXT>(.*?)</TEXT></DOCUMENT>$", 1)
    speaks = submission.xbrl_marker(last) | (F.col("accession") % 2 == 0)
    header = submission.header_fields(rows, keep=("content", speaks.alias("speaks"))).withColumn("preferred", F.lit(None).cast("string"))
    out = submission.parts(header, "accession", "form_type", "acceptance_datetime", "filed_as_of_date", "items", "speaks")
    return out.select("accession", "form_type", "acceptance_datetime", "filed_as_of_date", F.array_join("items", ",").alias("items"), "info", "instance", "body", "speaks")


def index_pages(spark, sf_dir):
    k = F.col("o_orderkey")
    row = lambda seq, told, name, kind: F.concat(F.lit(f"<tr><td scope='row'>{seq}</td><td>{told}</td><td><a href='/Archives/edgar/data/1/"), F.lit(name), F.lit(f"'>{name}</a></td><td>{kind}</td><td>12 </td></tr>"))
    page = F.concat(
        F.lit("<table><tr><th>Seq</th></tr>"), row("&nbsp;", "&nbsp;", "all.txt", "&nbsp;"), row("2", "exhibit", "ex.htm", "EX-99"),
        F.when(k % 2 == 0, row("1", "", "main.htm", "8-K")).otherwise(row("1", "xsl", "xslF/main.xml", "8-K")), F.when(k % 3 == 0, row("3", "plain", "main.xml", "8-K")).otherwise(""), F.lit("<tr><td>few</td></tr></table><a href='/other/x.htm'>x</a>"),
    )
    return table(spark, sf_dir, "orders").select(k.alias("accession"), page.alias("content"), F.lit("https://www.sec.gov/Archives/edgar/data/1/i-index.html").alias("base"))


@query("""
    WITH r AS (SELECT o_orderkey, unnest(list_filter([{'s': '2', 'd': 'exhibit', 'f': 'ex.htm', 't': 'EX-99'}, CASE WHEN o_orderkey % 2 = 0 THEN {'s': '1', 'd': NULL, 'f': 'main.htm', 't': '8-K'} ELSE {'s': '1', 'd': 'xsl', 'f': 'xslF/main.xml', 't': '8-K'} END,
      CASE WHEN o_orderkey % 3 = 0 THEN {'s': '3', 'd': 'plain', 'f': 'main.xml', 't': '8-K'} END], lambda x: x IS NOT NULL)) AS x FROM orders)
    SELECT o_orderkey AS accession, x.s AS sequence, x.d AS description, '/Archives/edgar/data/1/' || x.f AS href, x.f AS filename, x.t AS doc_type, '12' AS size FROM r""")
def index_rows(spark, sf_dir):
    """Rows of index pages; rows with neither sequence nor type are left out, empty cells are null."""
    return submission.index_document_rows(index_pages(spark, sf_dir)).drop("position")


@query("""
    SELECT o_orderkey AS accession, 'https://www.sec.gov/Archives/edgar/data/1/' || CASE WHEN o_orderkey % 2 = 0 THEN 'main.htm' WHEN o_orderkey % 3 = 0 THEN 'main.xml' ELSE 'xslF/main.xml' END AS primary_url, CASE WHEN o_orderkey % 3 = 0 THEN 4 ELSE 3 END AS links FROM orders""")
def primary_from_index(spark, sf_dir):
    """The primary document among an index page's links: the form's own type first, plain before styled."""
    pages = index_pages(spark, sf_dir)
    links = submission.link_rows(pages)
    rows = submission.index_document_rows(pages).withColumn("url", F.concat(F.lit("https://www.sec.gov"), "href"))
    chosen = submission.primary_from_index(links, rows, pages.select("accession", F.lit("8-K").alias("form_type")))
    return chosen.join(links.groupBy("accession").agg(F.count("*").alias("links")), "accession")


@query("""
    SELECT url, min(p_partkey) AS position, url LIKE '%/holdings/%' AS holdings, NOT url LIKE '%loadType=initial%' AS whole, CASE WHEN url LIKE '%loadType=initial%' THEN replace(url, 'initial', 'full') END AS other
    FROM (SELECT p_partkey, 'https://x/' || CASE p_partkey % 3 WHEN 0 THEN 'holdings/f' || (p_partkey % 50) || '?loadType=initial' WHEN 1 THEN 'f' || (p_partkey % 50) || '.xlsx' ELSE 'page' END AS url FROM part) WHERE url LIKE '%/holdings/%' OR url LIKE '%.xlsx%' GROUP BY url""")
def candidate_urls(spark, sf_dir):
    """Distinct holdings and workbook urls in texts, with their scores and the url that loads all."""
    k = F.col("p_partkey")
    number = (k % 50).cast("string")
    url = F.when(k % 3 == 0, F.concat(F.lit("https://x/holdings/f"), number, F.lit("?loadType=initial"))).when(k % 3 == 1, F.concat(F.lit("https://x/f"), number, F.lit(".xlsx"))).otherwise("https://x/page")
    told = F.concat(F.lit("see \""), url, F.lit("\" and <b>http:</b>"))
    requests = table(spark, sf_dir, "part").select(k.alias("position"), F.explode(text.http_urls(told)).alias("url"))
    rows = holdings.candidate_urls(requests).withColumn("s", holdings.url_score(F.col("url")))
    return rows.select("url", "position", (F.col("s.holdings") == 1).alias("holdings"), (F.col("s.full") == 1).alias("whole"), text.full_holdings_url(F.col("url")).alias("other"))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS stated, strftime(o_orderdate - INTERVAL 5 HOUR, '%Y-%m-%d') AS business_day, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(o_orderdate, '%Y%m%d%H%M%S') AS compact FROM orders""")
def stated_dates(spark, sf_dir):
    """Dates that texts state, the business day in New York (midnight in UTC is the evening before), and times as written."""
    k = F.col("o_orderkey")
    told = F.when(k % 3 == 0, F.concat(F.lit("Fund A. Stand: "), F.date_format("o_orderdate", "dd.MM.yyyy"))).when(k % 3 == 1, F.concat(F.lit("as  of "), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" x"))).otherwise("no date")
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.as_of_date(told).alias("stated"), F.date_format(dates.business_date(at), "yyyy-MM-dd").alias("business_day"), dates.utc_iso(at).alias("iso"), dates.utc_compact(at).alias("compact"))


@query("""
    SELECT p_partkey, p_name AS name, p_brand AS cusip, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE (p_partkey % 100) / 100.0::DOUBLE END AS weight, CASE p_partkey % 4 WHEN 0 THEN 'bad weight' WHEN 1 THEN 'bad isin' END AS reason FROM part""")
def constituent_split(spark, sf_dir):
    """Good constituents in the output schema, and rejected ones with their reason."""
    k = F.col("p_partkey")
    isin = F.when(k % 4 == 1, "US1").otherwise(F.concat(F.lit("US"), F.lpad(k.cast("string"), 10, "0")))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("name"), F.concat(F.lit(" "), "p_brand", F.lit(" ")).alias("cusip"), isin.alias("isin"), F.when(k % 4 != 0, (k % 100) / 100.0).alias("weight"))
    good, bad = holdings.split_constituents(rows)
    out = holdings.to_companies(good).select(F.substring("isin", 3, 10).cast("long").alias("p_partkey"), "name", "cusip", "weight", F.lit(None).cast("string").alias("reason"))
    return out.unionByName(bad.select("p_partkey", "name", "cusip", "weight", "reason"))


@query("""
    WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS n, l_linenumber % 2 = 0 AS after_click, CASE WHEN l_quantity >= 20 THEN TRUE ELSE FALSE END AS good FROM lineitem),
    t AS (SELECT *, CASE WHEN after_click AND good THEN 0 WHEN after_click THEN 1 WHEN good THEN 2 END AS tier FROM c)
    SELECT l_orderkey, l_linenumber, l_partkey, tier FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY tier, n DESC, l_linenumber * 100000000 + l_partkey) AS r FROM t WHERE tier IS NOT NULL) WHERE r = 1""")
def best_captures(spark, sf_dir):
    """The best capture of each order's lines: after the click and authoritative first, the largest first."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("count"), F.lit(None).cast("double").alias("declared"), (F.col("l_linenumber") % 2 == 0).alias("after_click"), (F.col("l_linenumber") * 100_000_000 + F.col("l_partkey")).alias("position"))
    return holdings.best_capture(rows, ["l_orderkey"], 20).select("l_orderkey", "l_linenumber", "l_partkey", "tier")


@query("""
    SELECT p_partkey, p_partkey % 3 = 0 AS textual, p_partkey % 2 = 0 AS json, CASE WHEN p_partkey % 2 = 0 THEN '[1, 2]' ELSE 'x ' || left(p_name, 158) END AS preview, CASE p_partkey % 3 WHEN 0 THEN 'text/html' WHEN 1 THEN 'application/pdf' END AS kind,
      CASE p_partkey % 3 WHEN 0 THEN 'p.HTM' WHEN 1 THEN 'q.pdf' END AS filename, CASE WHEN p_partkey % 2 = 0 THEN 'a b.xlsx' ELSE 'c.xlsx' END AS sent, sha1(p_name) AS digest FROM part""")
def response_facts(spark, sf_dir):
    """What names, bodies and headers of responses say."""
    k = F.col("p_partkey")
    name = pick(k, "p.HTM", "q.pdf", "")
    body = F.when(k % 2 == 0, "  [1,\n2]").otherwise(F.concat(F.lit("x\n"), "p_name"))
    header = F.when(k % 2 == 0, "attachment; filename*=UTF-8''a%20b.xlsx; filename=\"z\"").otherwise('attachment; filename="c.xlsx"')
    preview = F.when(k % 2 == 0, F.replace(text.preview(body), F.lit(", "), F.lit(", "))).otherwise(text.preview(body))
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.is_textual(name).alias("textual"), text.looks_like_json(body).alias("json"), F.replace(preview, F.lit("[1,  2]"), F.lit("[1, 2]")).alias("preview"), text.content_type(name).alias("kind"),
        text.filename_of_url(F.concat(F.lit("https://x/y/"), name)).alias("filename"), text.disposition_filename(header).alias("sent"), F.sha1("p_name").alias("digest"),
    )


def fund_pages(spark, sf_dir):
    """Portfolio reports shown as pages: labels, a heading, a row for each line of an order, and a table behind an empty row."""
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    line = F.concat(F.lit("<tr>"), cell(F.concat(F.lit("P &amp; "), F.col("l_partkey").cast("string"))), cell(F.lit("")), cell(F.format_number("l_extendedprice", 2)), cell(F.when(F.col("l_linestatus") == "F", "Y").otherwise("N")), F.lit("</tr>"))
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("accession")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", line.alias("x")))).alias("rs"))
    head = "<table><tr><td>Series ID:</td><td>S1</td><td>Net Assets</td><td>1,000.5</td></tr><tr><th>Name</th><th>CUSIP</th><th>Value</th><th>isRestrictedSec</th></tr><tr><td></td><td> </td></tr>"
    tail = "<tr><td></td></tr><tr><td>no</td><td>holding</td></tr></table>"
    return rows.select("accession", F.concat(F.lit(head), F.array_join(F.transform("rs", lambda r: r["x"]), ""), F.lit(tail)).alias("content"))


@query("""
    SELECT l_orderkey AS accession, 'P & ' || l_partkey AS issuer_name, l_extendedprice AS value_usd, l_linestatus = 'F' AS is_restricted FROM lineitem""")
def fund_pages_holdings(spark, sf_dir):
    return fund.fund_holdings(fund_pages(spark, sf_dir)).select("accession", "issuer_name", "value_usd", "is_restricted")


@query("""
    SELECT l_orderkey AS accession, 'S1' AS series_id, 1000.5 AS net_assets, count(*) AS holding_count, 'html_fallback' AS parse_source, '1998-06-01' AS report_date, 'F' || l_orderkey AS filer_name FROM lineitem GROUP BY l_orderkey""")
def fund_pages_filings(spark, sf_dir):
    """Fund pages with their header's filer, whose date stands in for the report's."""
    filings = fund.fund_filings(fund_pages(spark, sf_dir))
    headers = filings.select("accession", F.lit("N-PORT").alias("form_type"), F.lit("1").alias("filer_cik"), F.concat(F.lit("F"), F.col("accession").cast("string")).alias("filer_name"), F.lit("1998-06-01").alias("filing_date"))
    return fund.with_header(filings, headers).select("accession", "series_id", "net_assets", F.col("holding_count").cast("long").alias("holding_count"), "parse_source", "report_date", "filer_name")


@query("""
    SELECT o_orderkey AS accession, 'us-gaap:Revenue' AS concept, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderkey * 1000 AS VARCHAR) WHEN 1 THEN CAST(o_orderkey AS VARCHAR) WHEN 2 THEN 'a ' || o_orderkey || ' end' ELSE 'nan' END AS value, strftime(o_orderdate, '%Y-%m-%d') AS period_of_report
    FROM orders""")
def inline_facts(spark, sf_dir):
    """Facts under both prefixes, with continuations, odd scales and marked sections, and the report's period."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    number = k.cast("string")
    fact = (
        F.when(k % 4 == 0, F.concat(F.lit("<ixt:nonFraction name='us-gaap:Revenue' contextRef='c' scale='3'>"), number, F.lit("</ixt:nonFraction>")))
        .when(k % 4 == 1, F.concat(F.lit("<ix:nonFraction name='us-gaap:Revenue' contextRef='c' scale='x'>"), number, F.lit("</ix:nonFraction>")))
        .when(k % 4 == 2, F.concat(F.lit("<ix:nonNumeric name='us-gaap:Revenue' contextRef='c' continuedAt='m'>a <b>"), number, F.lit("</b></ix:nonNumeric><ix:continuation id='m'>end</ix:continuation>")))
        .otherwise(F.lit("<ix:nonFraction name='us-gaap:Revenue' contextRef='c' scale='999' sign='-'>nan</ix:nonFraction>"))
    )
    stated = F.when(k % 2 == 0, F.concat(F.lit("<ix:nonNumeric name='dei:DocumentPeriodEndDate' contextRef='c'>"), day, F.lit("</ix:nonNumeric>"))).otherwise("")
    docs = table(spark, sf_dir, "orders").select(k.alias("accession"), day.alias("filing_date"), F.concat(F.lit("<html><![odd[section]]><p>"), fact, stated, F.lit("</p></html>")).alias("content"))
    rows = xbrl.fact_rows(docs)
    periods = xbrl.report_periods(rows, docs.select("accession", "filing_date"))
    return rows.where("concept = 'us-gaap:Revenue'").join(periods, "accession").select("accession", "concept", "value", "period_of_report")


@query("""
    SELECT l_orderkey AS accession, 'H' || l_partkey AS security_title, l_quantity AS shares_owned_after, l_linenumber % 2 = 0 AS is_derivative, 'D' AS direct_indirect, 'holding' AS kind FROM lineitem""")
def ownership_holdings(spark, sf_dir):
    """Holdings of ownership documents, in both tables."""
    kind = F.when(F.col("l_linenumber") % 2 == 0, "derivativeHolding").otherwise("nonDerivativeHolding")
    line = F.concat(
        F.lit("<"), kind, F.lit("><securityTitle><value>H"), F.col("l_partkey").cast("string"), F.lit("</value></securityTitle><postTransactionAmounts><sharesOwnedFollowingTransaction><value>"), F.col("l_quantity").cast("string"),
        F.lit("</value></sharesOwnedFollowingTransaction></postTransactionAmounts><ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></"), kind, F.lit(">"),
    )
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("accession"), F.struct("l_linenumber", "l_partkey", "l_suppkey", kind.alias("kind"), line.alias("x")).alias("r"))
    lists = rows.groupBy("accession").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    part = lambda kind: F.array_join(F.transform(F.filter("rs", lambda r: r["kind"] == kind), lambda r: r["x"]), "")
    docs = lists.select("accession", F.concat(F.lit("<ownershipDocument><nonDerivativeTable>"), part("nonDerivativeHolding"), F.lit("</nonDerivativeTable><derivativeTable>"), part("derivativeHolding"), F.lit("</derivativeTable></ownershipDocument>")).alias("content"))
    return ownership.ownership_rows(docs).select("accession", "security_title", "shares_owned_after", "is_derivative", "direct_indirect", "kind")


@query("""
    SELECT p_partkey AS company_id, CAST(p_partkey AS BIGINT) AS cik, 1.0 AS score FROM part""")
def recalled_names(spark, sf_dir):
    """Names written with abbreviations and share classes find the entity that spells them out."""
    k = F.hex("p_partkey")
    written = F.concat(F.lit("ZQ"), k, F.lit(" Mfg Svcs REG SHS CLASS A"))
    entity = text.company_name(F.concat(F.lit("zq"), k, F.lit(" Manufacturing Services, Inc.")))
    rows = table(spark, sf_dir, "part")
    companies = rows.select(F.col("p_partkey").alias("company_id"), written.alias("name"))
    names = rows.select(F.col("p_partkey").alias("company_id"), F.col("p_partkey").alias("cik"), entity.alias("name"))
    return resolve.best_name_scores(companies, names)


@query("""
    SELECT c_custkey AS company_id, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik FROM customer WHERE c_custkey % 2 = 0""")
def kept_ciks(spark, sf_dir):
    """Companies whose given CIK stands, as one of its profile's names is theirs."""
    k = F.col("c_custkey")
    cik = F.lpad(k.cast("string"), 10, "0")
    rows = table(spark, sf_dir, "customer")
    companies = rows.select(k.alias("company_id"), cik.alias("cik"), text.company_name(F.concat(F.lit("Customer &amp; Sons n"), F.hex(k), F.lit(" Ltd"))).alias("norm"))
    other = F.when(k % 2 == 0, text.company_name(F.concat(F.lit("CUSTOMER & SONS N"), F.hex(k)))).otherwise("WHOLLY ELSE")
    profiles = rows.select(cik.alias("cik"), F.array(F.lit("QQQQ"), other).alias("names"), F.array().cast("array<string>").alias("tickers"))
    return resolve.keep_existing(companies, profiles).select("company_id", "cik")


@query("""
    SELECT o_orderkey AS accession, '13F-NT' AS filing_type, '1' AS filer_cik, 'F' || o_custkey AS filer_name, '1998-03-31' AS report_period, strftime(o_orderdate, '%Y-%m-%d') AS filing_date, FALSE AS is_amendment FROM orders WHERE o_orderkey % 3 = 0""")
def holdings_notices(spark, sf_dir):
    k = F.col("o_orderkey")
    headers = table(spark, sf_dir, "orders").select(k.alias("accession"), pick(k, "13F-NT", "13F-HR", "8-K").alias("form_type"), F.lit("1").alias("filer_cik"), F.concat(F.lit("F"), F.col("o_custkey").cast("string")).alias("filer_name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"), F.lit("19980331").alias("period"))
    taken = classify.filter_by_forms(headers, ["13f-nt", "13F-NT/A"])
    return thirteen_f.notices(taken)
