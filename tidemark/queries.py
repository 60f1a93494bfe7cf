"""Registry of the engine's queries over the driver's tables, with their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import extraction_queries, fixed, source_queries, state_queries
from .functions import dates, digests, numbers, text
from .operators import archive, classify, dedup, holdings, incremental, merge, outbox, resolve, retry, rollup, topk
from .registry import ORACLE_SQL, QUERIES, query, table

__all__ = ["ORACLE_SQL", "QUERIES", "extraction_queries", "source_queries", "state_queries"]

COMPACT = "strftime(ts, '%Y%m%d%H%M%S')"


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as raw records of feeds: the event type is the feed, the user the document."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("feed"),
        F.col("event_id").cast("string").alias("record_key"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("interval_ts"),
        F.col("event_id").alias("file_id"),
        F.lit(0).alias("line_no"),
        F.col("user_id").alias("document_id"),
        F.col("props").alias("source_url"),
    )


@query(f"""
    WITH r AS (SELECT user_id, {COMPACT} AS its, event_type, props, event_id FROM events)
    SELECT DISTINCT user_id AS document_id,
      first_value(its) OVER w AS first_seen_interval_ts, max(its) OVER (PARTITION BY user_id) AS last_seen_interval_ts,
      first_value(event_type) OVER w AS first_seen_feed, last_value(event_type) OVER w AS last_seen_feed,
      first_value(props) OVER w AS first_source_url, last_value(props) OVER w AS last_source_url,
      count(*) OVER (PARTITION BY user_id) AS observations
    FROM r WINDOW w AS (PARTITION BY user_id ORDER BY its, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""")
def document_rollup(spark, sf_dir):
    return rollup.rollup_documents(event_records(spark, sf_dir))


@query(f"""
    WITH r AS (SELECT user_id, {COMPACT} AS its, event_type, event_id FROM events),
    a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY its, event_id) AS f, row_number() OVER (PARTITION BY user_id ORDER BY its DESC, event_id DESC) AS l FROM r)
    SELECT user_id AS document_id, max(CASE WHEN f = 1 THEN event_type END) AS first_seen_feed, max(CASE WHEN l = 1 THEN event_type END) AS last_seen_feed,
      min(its) AS first_seen_interval_ts, max(its) AS last_seen_interval_ts, count(*) AS observations FROM a GROUP BY user_id""")
def rollup_merged(spark, sf_dir):
    """The rollup in two batches, merged: rows as if all were applied at once."""
    records = event_records(spark, sf_dir)
    early = records.where("interval_ts < '20240115000000'")
    late = records.where("interval_ts >= '20240115000000'")
    merged = rollup.merge_rollups(rollup.rollup_documents(early), rollup.rollup_documents(late))
    return merged.select("document_id", "first_seen_feed", "last_seen_feed", "first_seen_interval_ts", "last_seen_interval_ts", "observations")


@query("""
    SELECT user_id, event_type, event_id, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n = 1""")
def record_dedup_first(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return dedup.keep_first(rows, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("""
    SELECT event_type AS feed, CAST(event_id AS VARCHAR) AS record_key, strftime(ts, '%Y%m%d%H%M%S') AS interval_ts FROM events
    WHERE NOT (event_id % 3 = 0)""")
def ingest_new_records(spark, sf_dir):
    """Insert-or-ignore: a file that repeats known records inserts only the others."""
    records = event_records(spark, sf_dir)
    known = records.where("file_id % 3 = 0")
    return dedup.ingest_records(records.unionByName(records.withColumn("line_no", F.lit(1))), known).select("feed", "record_key", "interval_ts")


@query("SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS interval_ts FROM events WHERE strftime(ts, '%Y%m%d%H%M%S') >= '20240103000000' AND strftime(ts, '%Y%m%d%H%M%S') <= '20240120000000' AND event_type <> 'error' ORDER BY interval_ts, event_id LIMIT 100")
def pending_window_limit(spark, sf_dir):
    manifest = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.date_format("ts", "yyyyMMddHHmmss").alias("interval_ts"), F.when(F.col("event_type") == "error", F.lit("done")).alias("applied_at"))
    return incremental.pending_files(manifest, "20240103000000", "20240120000000", 100).select(F.col("id").alias("event_id"), "interval_ts")


def feed_and_watermark(spark, sf_dir):
    """Orders as a feed by day, with a watermark in its middle whose boundary holds every second order of that day."""
    feed = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.col("o_orderdate").cast("timestamp").alias("accepted_at"))
    at = F.to_timestamp(F.lit("1998-06-01 00:00:00"))
    mark = feed.where(F.col("accepted_at") == at).agg(F.collect_list(F.when(F.col("accession").cast("long") % 2 == 0, F.col("accession"))).alias("boundary"))
    return feed, mark.select(at.alias("ts"), "boundary")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS accession, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-01' OR (o_orderdate = TIMESTAMP '1998-06-01' AND o_orderkey % 2 = 1)")
def watermark_filter(spark, sf_dir):
    feed, mark = feed_and_watermark(spark, sf_dir)
    return incremental.after_watermark(feed, mark).select("accession", F.date_format("accepted_at", "yyyy-MM-dd").alias("day"))


@query("""
    SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS day, (SELECT string_agg(k, ',' ORDER BY k) FROM (SELECT CAST(o_orderkey AS VARCHAR) AS k FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders))) AS boundary FROM orders""")
def watermark_advance(spark, sf_dir):
    feed, mark = feed_and_watermark(spark, sf_dir)
    return incremental.advance_watermark(feed, mark).select(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.array_join("boundary", ",").alias("boundary"))


@query("SELECT count(*) = 0 AS gap FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01' AND (o_orderdate < TIMESTAMP '1998-06-01' OR (o_orderdate = TIMESTAMP '1998-06-01' AND o_orderkey % 2 = 0))")
def feed_gap(spark, sf_dir):
    feed, mark = feed_and_watermark(spark, sf_dir)
    page = feed.where(F.col("accepted_at") > F.to_timestamp(F.lit("1999-01-01 00:00:00")))
    return incremental.boundary_found(page, mark).select((~F.col("found")).alias("gap"))


@query("SELECT doc_id, rank FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rank FROM documents) WHERE rank = 1")
def within_batch_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("digest"))
    return dedup.keep_first(rows, ["digest"], [F.col("doc_id")]).select("doc_id", F.lit(1).cast("long").alias("rank"))


def order_filings(spark, sf_dir):
    """Orders as filings: the customer is the filer, form and states follow from the order."""
    forms = F.element_at(F.array(*(F.lit(f) for f in ("8-K", "10-Q", "4", "SC 13D", "13F-HR", "S-1"))), (F.col("o_orderkey") % 6 + 1).cast("int"))
    status = F.element_at(F.array(*(F.lit(f) for f in ("discovered", "queued", "in_progress", "retrieved", "retrieved_partial", "retrieval_failed"))), (F.col("o_custkey") % 6 + 1).cast("int"))
    relevance = F.element_at(F.array(*(F.lit(f) for f in ("unknown", "direct_match", "hdr_pending", "hdr_match", "irrelevant", "hdr_transient_fail"))), ((F.col("o_orderkey") / 7).cast("long") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("accession"),
        F.col("o_custkey").alias("cik"),
        forms.alias("form_type"),
        status.alias("retrieval_status"),
        relevance.alias("relevance_state"),
        (F.col("o_orderkey") % 8).alias("attempts"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.col("o_orderpriority").alias("o_orderpriority"),
        F.col("o_totalprice").alias("o_totalprice"),
    )


FILINGS_SQL = """filings AS (
      SELECT o_orderkey AS accession, o_custkey AS cik, (['8-K', '10-Q', '4', 'SC 13D', '13F-HR', 'S-1'])[o_orderkey % 6 + 1] AS form_type,
        (['discovered', 'queued', 'in_progress', 'retrieved', 'retrieved_partial', 'retrieval_failed'])[o_custkey % 6 + 1] AS retrieval_status,
        (['unknown', 'direct_match', 'hdr_pending', 'hdr_match', 'irrelevant', 'hdr_transient_fail'])[(o_orderkey // 7) % 6 + 1] AS relevance_state,
        o_orderkey % 8 AS attempts, o_orderdate AS updated_at, o_totalprice FROM orders)"""
WATCHLIST = "c_mktsegment = 'BUILDING' AND c_acctbal > 0"


def watchlist(spark, sf_dir):
    return table(spark, sf_dir, "customer").where(WATCHLIST).select(F.col("c_custkey").alias("cik"))


@query(f"WITH {FILINGS_SQL} SELECT accession, cik, form_type FROM filings WHERE cik IN (SELECT c_custkey FROM customer WHERE {WATCHLIST})")
def watchlist_direct_match(spark, sf_dir):
    return classify.watched(order_filings(spark, sf_dir), watchlist(spark, sf_dir)).select("accession", "cik", "form_type")


@query(f"WITH {FILINGS_SQL} SELECT accession, cik, form_type FROM filings WHERE cik NOT IN (SELECT c_custkey FROM customer WHERE {WATCHLIST})")
def watchlist_unmatched(spark, sf_dir):
    return classify.unwatched(order_filings(spark, sf_dir), watchlist(spark, sf_dir)).select("accession", "cik", "form_type")


@query(f"""
    WITH {FILINGS_SQL} SELECT accession, form_type,
      CASE WHEN form_type IN ('8-K', '10-Q', '13F-HR') THEN CASE WHEN c.c_custkey IS NOT NULL THEN 'direct_match' ELSE 'direct_unmatched' END
           WHEN form_type IN ('4', 'SC 13D') THEN 'hdr_pending' ELSE 'other' END AS relevance_state
    FROM filings f LEFT JOIN (SELECT c_custkey FROM customer WHERE {WATCHLIST}) c ON f.cik = c.c_custkey""")
def relevance_classify(spark, sf_dir):
    return classify.classify(order_filings(spark, sf_dir), watchlist(spark, sf_dir)).select("accession", "form_type", "relevance_state")


@query(f"""
    WITH {FILINGS_SQL} SELECT accession, CASE form_type WHEN '8-K' THEN 'eight_k' WHEN '10-Q' THEN 'xbrl' WHEN '4' THEN 'ownership' WHEN 'SC 13D' THEN 'thirteen_dg' WHEN '13F-HR' THEN 'thirteen_f' END AS handler,
      form_type IN ('8-K', '10-Q', '13F-HR') AS direct, form_type IN ('4', 'SC 13D') AS ambiguous FROM filings""")
def form_routing(spark, sf_dir):
    form = F.col("form_type")
    return order_filings(spark, sf_dir).select("accession", classify.handler_of(form).alias("handler"), classify.is_direct(form).alias("direct"), classify.is_ambiguous(form).alias("ambiguous"))


@query("SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01') AS known FROM orders")
def known_batch_split(spark, sf_dir):
    known = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return classify.split_known(orders, known.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_partkey, strftime(o_orderdate, '%Y-%m-%d') AS period, coalesce(o_orderpriority, 'none') AS segment FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey")
def context_period_join(spark, sf_dir):
    """Facts with the period of their context; facts without one stay."""
    facts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    contexts = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("period"), "o_orderpriority")
    return facts.join(contexts, "l_orderkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "period", F.coalesce("o_orderpriority", F.lit("none")).alias("segment"))


@query("""
    SELECT o.o_orderkey, l.l_linenumber, l.l_partkey, coalesce(c.n, -1) AS owner FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
    CROSS JOIN LATERAL (SELECT unnest(CASE WHEN o.o_custkey % 3 = 0 THEN [NULL] WHEN o.o_custkey % 3 = 1 THEN [o.o_custkey] ELSE [o.o_custkey, o.o_custkey + 1] END) AS n) c""")
def owner_fanout(spark, sf_dir):
    """A row for each transaction and owner of a filing; one row without an owner where there is none."""
    c = F.col("o_custkey")
    none = F.array().cast("array<bigint>")
    owners = F.when(c % 3 == 0, none).when(c % 3 == 1, F.array(c)).otherwise(F.array(c, c + 1))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey")
    filings = table(spark, sf_dir, "orders").select("o_orderkey", owners.alias("owners"))
    return filings.join(lines, "o_orderkey").select("o_orderkey", "l_linenumber", "l_partkey", F.explode_outer("owners").alias("owner")).withColumn("owner", F.coalesce("owner", F.lit(-1)))


def discoveries(spark, sf_dir):
    """Known filings (even orders), and new discoveries (orders that 3 divides)."""
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("accession"), F.col("o_custkey").cast("string").alias("cik"), F.col("o_orderpriority").alias("company_name"),
        F.col("o_orderstatus").alias("form_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("filing_date"), F.lit(None).cast("string").alias("accepted_at"),
        F.lit(None).cast("string").alias("href"), "o_orderkey",
    )
    k = F.col("o_orderkey")
    old = rows.where(k % 2 == 0).withColumns({"discovered_at": F.lit("day 1"), "source": F.when(k % 5 == 0, "latest_filings_atom").otherwise("index"), "retrieval_status": F.when(k % 4 == 0, "retrieved").otherwise("queued"), "sources": F.array(F.lit("index"))})
    new = rows.where(k % 3 == 0).withColumns({"company_name": F.concat(F.lit("NEW "), "company_name"), "discovered_at": F.lit("day 2"), "source": F.lit("submissions"), "retrieval_status": F.lit(None).cast("string"), "sources": F.array(F.lit("submissions"))})
    return old.drop("o_orderkey"), new.drop("o_orderkey")


@query("""
    WITH o AS (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'retrieved' ELSE 'queued' END AS st FROM orders WHERE o_orderkey % 2 = 0), n AS (SELECT * FROM orders WHERE o_orderkey % 3 = 0)
    SELECT CAST(coalesce(o.o_orderkey, n.o_orderkey) AS VARCHAR) AS accession,
      CASE WHEN o.st = 'retrieved' THEN o.o_orderpriority WHEN n.o_orderkey IS NOT NULL THEN 'NEW ' || n.o_orderpriority ELSE o.o_orderpriority END AS company_name,
      CASE WHEN o.o_orderkey IS NOT NULL THEN 'day 1' ELSE 'day 2' END AS discovered_at,
      CASE WHEN o.o_orderkey % 5 = 0 THEN 'latest_filings_atom' WHEN o.st = 'retrieved' THEN 'index' WHEN n.o_orderkey IS NOT NULL THEN 'submissions' ELSE 'index' END AS source,
      coalesce(o.st, 'discovered') AS retrieval_status,
      CASE WHEN o.o_orderkey IS NULL THEN 'submissions' WHEN n.o_orderkey IS NULL THEN 'index' ELSE 'index,submissions' END AS sources,
      o.o_orderkey IS NULL AS is_new
    FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey""")
def merge_discovery_coalesce(spark, sf_dir):
    old, new = discoveries(spark, sf_dir)
    merged = merge.merge_discoveries(old, new)
    return merged.select("accession", "company_name", "discovered_at", "source", "retrieval_status", F.array_join("sources", ",").alias("sources"), "is_new")


@query("""
    SELECT CAST(o_orderkey AS VARCHAR) AS accession, o_orderkey % 2 = 1 AS replaced, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice * 2 ELSE o_totalprice END AS value FROM orders""")
def replace_by_key(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.lit(False).alias("replaced"), F.col("o_totalprice").alias("value"))
    new = rows.where("cast(accession AS long) % 2 = 1").select("accession", F.lit(True).alias("replaced"), (F.col("value") * 2).alias("value"))
    return merge.replace_by_key(rows, new, ["accession"])


@query("""
    SELECT 'https://x/' || p_partkey AS source_url, 'parts' AS feed, CASE WHEN p_partkey % 2 = 0 THEN 'old' ELSE 'new' END AS first_found, CASE WHEN p_partkey % 3 = 0 THEN 'day 2' ELSE 'day 1' END AS discovered_at
    FROM part WHERE p_partkey % 2 = 0 OR p_partkey % 3 = 0""")
def register_manifest(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("https://x/"), "p_partkey").alias("source_url"), F.lit("parts").alias("feed"), F.lit(None).cast("string").alias("md5"), F.col("p_size").alias("size"), "p_partkey")
    old = rows.where("p_partkey % 2 = 0").withColumns({"interval_ts": F.lit("old"), "discovered_at": F.lit("day 1"), "download_status": F.lit("applied"), "download_attempts": F.lit(1).cast("long"), "applied_at": F.lit("x")}).drop("p_partkey")
    new = rows.where("p_partkey % 3 = 0").withColumns({"interval_ts": F.lit("new"), "discovered_at": F.lit("day 2")}).drop("p_partkey")
    return merge.register_files(old, new).select("source_url", "feed", F.col("interval_ts").alias("first_found"), "discovered_at")


@query(f"""
    WITH {FILINGS_SQL} SELECT accession, retrieval_status, attempts FROM filings
    WHERE retrieval_status IN ('retrieval_failed', 'retrieved_partial') AND relevance_state NOT IN ('irrelevant', 'direct_unmatched', 'hdr_failed', 'unresolved')
      AND attempts < 5 AND (attempts = 0 OR updated_at + to_seconds(CAST(least(3600, 2 * pow(2, attempts)) AS INTEGER)) <= TIMESTAMP '1999-01-01')
    ORDER BY updated_at, accession LIMIT 50""")
def retry_candidates(spark, sf_dir):
    rows = order_filings(spark, sf_dir)
    wait = F.timestamp_seconds(F.unix_timestamp("updated_at") + numbers.backoff(F.col("attempts") - 1))
    rows = rows.withColumn("next_retry_at", F.when(F.col("attempts") > 0, wait))
    return retry.retry_candidates(rows, F.to_timestamp(F.lit("1999-01-01 00:00:00"))).select("accession", "retrieval_status", "attempts")


@query(f"""
    WITH {FILINGS_SQL} SELECT accession, CASE WHEN relevance_state IN ('direct_match', 'hdr_match') THEN 'retrieval' ELSE 'header_gate' END AS route FROM filings
    WHERE retrieval_status IN ('queued', 'in_progress') AND relevance_state IN ('direct_match', 'hdr_match', 'hdr_transient_fail') ORDER BY updated_at, accession LIMIT 200""")
def stranded_work(spark, sf_dir):
    return retry.stranded(order_filings(spark, sf_dir)).select("accession", "route")


@query(f"WITH {FILINGS_SQL} SELECT accession, CAST(least(3600, 2.0 * pow(2.0, attempts + 1)) AS DOUBLE) AS wait_seconds, relevance_state = 'irrelevant' OR retrieval_status = 'retrieved' AS terminal FROM filings")
def retry_backoff(spark, sf_dir):
    return order_filings(spark, sf_dir).select("accession", numbers.backoff(F.col("attempts")).alias("wait_seconds"), classify.is_terminal(F.col("relevance_state"), F.col("retrieval_status")).alias("terminal"))


@query(f"""
    WITH {FILINGS_SQL}, lists AS (
      SELECT accession, 'retry' AS kind, 1 AS rank FROM filings WHERE retrieval_status IN ('retrieval_failed', 'retrieved_partial')
      UNION ALL SELECT accession, 'header', 2 FROM filings WHERE relevance_state = 'hdr_pending'
      UNION ALL SELECT accession, 'unprocessed', 3 FROM filings WHERE relevance_state = 'unknown')
    SELECT accession, arg_min(kind, rank) AS kind, min(rank) AS rank FROM lists GROUP BY accession""")
def recovery_union(spark, sf_dir):
    rows = order_filings(spark, sf_dir)
    part = lambda where, kind, rank: rows.where(where).select("accession", F.lit(kind).alias("kind"), F.lit(rank).alias("rank"))
    return retry.work_list(part("retrieval_status IN ('retrieval_failed', 'retrieved_partial')", "retry", 1), part("relevance_state = 'hdr_pending'", "header", 2), part("relevance_state = 'unknown'", "unprocessed", 3))


@query("""
    SELECT event_id, substr(sha256('events.' || event_type || ':' || CAST(event_id AS VARCHAR)), 1, 32) AS id,
      substr(sha256('{"k":"' || json_extract_string(props, '$.k') || '","user":"' || CAST(user_id AS VARCHAR) || '"}'), 1, 16) AS payload_hash FROM events""")
def outbox_event_id(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    body = digests.canonical_json(user=F.col("user_id").cast("string"), k=F.get_json_object("props", "$.k"))
    return rows.select("event_id", digests.event_id(F.concat(F.lit("events."), "event_type"), F.col("event_id").cast("string")).alias("id"), digests.payload_hash(body).alias("payload_hash"))


@query("SELECT CAST(user_id AS VARCHAR) AS event_id, max(event_id) AS commit_seq, arg_max(props, event_id) AS payload_json FROM events GROUP BY user_id")
def outbox_latest_revision(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("event_id"), F.col("event_id").alias("commit_seq"), F.col("props").alias("payload_json"))
    return outbox.authoritative(log)


@query("""
    WITH e AS (SELECT *, CASE WHEN event_id % 4 = 0 THEN 'published' WHEN event_id % 4 = 1 THEN 'leased' ELSE 'pending' END AS status FROM events)
    SELECT event_id FROM e WHERE status = 'pending' OR (status = 'leased' AND ts < TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 60 SECOND) ORDER BY event_id LIMIT 200""")
def outbox_lease_batch(spark, sf_dir):
    e = F.col("event_id")
    log = table(spark, sf_dir, "events").select("event_id", e.alias("commit_seq"), F.col("ts").cast("timestamp").alias("created_at"), F.when(e % 4 == 0, "published").when(e % 4 == 1, "leased").otherwise("pending").alias("status"))
    log = log.withColumn("leased_at", F.when(F.col("status") == "leased", F.col("created_at"))).withColumn("next_attempt_at", F.lit(None).cast("timestamp"))
    return retry.lease_batch(log, F.to_timestamp(F.lit("2024-01-10 00:00:00"))).select("event_id")


@query("""
    WITH d AS (SELECT event_type || ':' || CAST(user_id AS VARCHAR) AS event_id, md5(props) AS payload_hash, min(strftime(ts, '%Y-%m-%d %H:%M:%S')) AS created_at FROM events GROUP BY ALL)
    SELECT event_id, payload_hash, created_at, row_number() OVER (ORDER BY created_at, event_id, payload_hash) AS commit_seq FROM d""")
def outbox_append_revisions(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    new = rows.select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("event_id"), F.md5("props").alias("payload_hash"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("created_at"))
    new = new.groupBy("event_id", "payload_hash").agg(F.min("created_at").alias("created_at"))
    log = spark.createDataFrame([], "event_id string, payload_hash string, created_at string, commit_seq long")
    return outbox.append_revisions(log, new)


@query("""
    SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY coalesce(l_extendedprice, 0) DESC, l_orderkey, l_linenumber, l_partkey) AS rank FROM lineitem) WHERE rank <= 20""")
def topk_holdings_per_filer(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    best = topk.largest_n(rows, ["l_suppkey"], "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey"], 20)
    return best.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", F.col("rank").cast("long").alias("rank"))


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total_value, count(*) AS entry_count FROM lineitem GROUP BY l_suppkey")
def filing_total_value(spark, sf_dir):
    return rollup.total_and_count(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice").withColumn("total_value", F.round("total_value", 2))


@query("""
    SELECT l_orderkey, count(*) AS total, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY n) FILTER (n <= 3) AS items
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM lineitem) GROUP BY l_orderkey""")
def capped_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    few = topk.capped(rows, ["l_orderkey"], [F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")], 3, F.col("l_partkey").cast("string"))
    return few.select("l_orderkey", "total", F.array_join("items", ",").alias("items"))


@query("SELECT md5(text) AS digest, lang, count(*) AS n FROM documents GROUP BY ALL HAVING count(*) > 1")
def dup_pairs_having(spark, sf_dir):
    return dedup.repeated_keys(table(spark, sf_dir, "documents").select(F.md5("text").alias("digest"), "lang"), ["digest", "lang"])


@query("""
    WITH p AS (SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 'F' || (p_partkey % 40) END AS cf, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 'S' || (p_partkey % 30) END AS sf, p_name, p_brand FROM part),
    k AS (SELECT *, coalesce('composite_figi:' || cf, 'share_class_figi:' || sf, 'cusip_name:' || p_brand || '|' || upper(p_name)) AS dedup_key FROM p)
    SELECT p_partkey, dedup_key FROM (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY p_partkey) AS n FROM k) WHERE n = 1""")
def dedup_by_identifier_priority(spark, sf_dir):
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(k % 5 != 0, F.concat(F.lit("F"), k % 40)).alias("composite_figi"), F.when(k % 10 != 0, F.concat(F.lit("S"), k % 30)).alias("share_class_figi"),
        F.lit("  ").alias("isin"), F.col("p_brand").alias("cusip"), F.col("p_name").alias("name"),
    )
    return holdings.dedup_securities(rows, [k]).select("p_partkey", "dedup_key")


NORM_SQL = "array_to_string(list_filter(string_split(regexp_replace(replace(regexp_replace(upper({x}), '\\s*-\\s*[A-Z]{{1,2}}\\s*$', ''), '&', ' AND '), '[^A-Z0-9]+', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN ({words}) AND NOT regexp_full_match(w, '[0-9]+')), ' ')"
WORDS_SQL = ", ".join(f"'{w}'" for w in fixed.GENERIC_WORDS)


@query(f"""
    SELECT p_partkey, {NORM_SQL.format(x="p_name || ' & ' || p_brand || ' Holdings Inc - A'", words=WORDS_SQL)} AS norm FROM part""")
def normalize_name(spark, sf_dir):
    name = F.concat("p_name", F.lit(" & "), "p_brand", F.lit(" Holdings Inc - A"))
    return table(spark, sf_dir, "part").select("p_partkey", text.company_name(name).alias("norm"))


@query(r"""
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN p_name WHEN 2 THEN p_name ELSE p_name || ' CO' END AS name FROM part""")
def clean_name(spark, sf_dir):
    ending = F.element_at(F.array(F.lit(" USD1.00"), F.lit(" - SPON ADR REP 2"), F.lit(" NON-CUM PRF SHS"), F.lit(" CO - REG S")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", text.constituent_name(F.concat("p_name", ending)).alias("name"))


SHORT_SQL = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in fixed.ABBREVIATIONS.items()) + "}"
TRANSLIT_SQL = "list_reduce([{x}, '" + "', '".join(f"{a}>{b}" for a, b in fixed.TRANSLITERATIONS) + "'], lambda y, r: replace(y, string_split(r, '>')[1], string_split(r, '>')[2]))"


@query(rf"""
    WITH n AS (SELECT p_partkey, upper(p_name) || ' Mfg Hldgs CLASS A' AS name FROM part),
    w AS (SELECT *, regexp_replace(regexp_replace(upper(name), '\b(?:{"|".join(fixed.RECALL_WORDS)})\b', ' ', 'g'), '\bCLASS\s+[A-Z0-9]\b', ' ', 'g') AS plain FROM n),
    o AS (SELECT p_partkey, {NORM_SQL.format(x="name", words=WORDS_SQL)} AS own, {NORM_SQL.format(x="plain", words=WORDS_SQL)} AS base FROM w),
    f AS (SELECT p_partkey, own, [own, base, {TRANSLIT_SQL.format(x="own")}, {TRANSLIT_SQL.format(x="base")}] AS forms FROM o),
    e AS (SELECT p_partkey, own, unnest(list_concat(forms, list_transform(forms, lambda y: array_to_string(list_transform(string_split(y, ' '), lambda t: coalesce({SHORT_SQL}[t], t)), ' ')))) AS v FROM f),
    d AS (SELECT DISTINCT p_partkey, v FROM e WHERE v <> '' AND v <> own)
    SELECT p_partkey, coalesce((SELECT string_agg(v, ';' ORDER BY v) FROM d WHERE d.p_partkey = n.p_partkey), '') AS variants FROM n""")
def recall_variants(spark, sf_dir):
    name = F.concat(F.upper("p_name"), F.lit(" Mfg Hldgs CLASS A"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.recall_variants(name), ";").alias("variants"))


@query("SELECT c_custkey, CASE WHEN length(CAST(c_custkey * 99991 AS VARCHAR)) >= 10 THEN CAST(c_custkey * 99991 AS VARCHAR) ELSE lpad(CAST(c_custkey * 99991 AS VARCHAR), 10, '0') END AS cik, lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 10, '0') AS from_name, upper(regexp_replace(c_name, '[^A-Za-z0-9]+', '', 'g')) AS identifier FROM customer")
def cik_zfill(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", text.normalize_cik(F.col("c_custkey") * 99991).alias("cik"), text.digits_cik(F.col("c_name")).alias("from_name"), text.normalize_identifier(F.col("c_name")).alias("identifier"))


@query(r"""
    WITH a AS (SELECT o_orderkey, o_custkey, lpad(CAST(o_custkey AS VARCHAR), 10, '0') || '-' || strftime(o_orderdate, '%y') || '-' || lpad(CAST(o_orderkey % 1000000 AS VARCHAR), 6, '0') AS acc FROM orders)
    SELECT o_orderkey, acc AS accession, regexp_full_match(acc, '\d{10}-\d{2}-\d{6}') AS valid,
      'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || replace(acc, '-', '') || '/' || acc || '.txt' AS complete_txt_url FROM a""")
def accession_format(spark, sf_dir):
    acc = F.concat_ws("-", F.lpad(F.col("o_custkey").cast("string"), 10, "0"), F.date_format("o_orderdate", "yy"), F.lpad((F.col("o_orderkey") % 1000000).cast("string"), 6, "0"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", acc.alias("acc"))
    urls = text.submission_urls(F.col("o_custkey"), text.extract_accession(F.concat(F.lit("see "), "acc", F.lit(" there"))))
    return rows.select("o_orderkey", text.extract_accession(F.concat(F.lit("<b>"), "acc")).alias("accession"), text.is_accession(F.col("acc")).alias("valid"), urls["complete_txt_url"].alias("complete_txt_url"))


@query("""
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day, strftime(o_orderdate, '%d.%m.%Y') AS german,
      strftime(o_orderdate, '%Y-%m-%d') || 'T12:30:05Z' AS at FROM orders""")
def parse_dates_multi(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    written = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "yyyyMMdd")).when(k == 2, F.date_format("o_orderdate", " yyyy-M-d ")).otherwise(F.date_format("o_orderdate", "yyyy/MM/dd"))
    stamped = F.when(k < 2, F.date_format("o_orderdate", "yyyy-MM-dd'T'12:30:05'Z'")).otherwise(F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("123005")))
    shown = F.when(k < 2, F.date_format("o_orderdate", "d/M/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(dates.parse_date(written), "yyyy-MM-dd").alias("day"), dates.german_date(shown).alias("german"), dates.utc_iso(dates.parse_timestamp(stamped)).alias("at"))


@query("""
    SELECT strftime(d, '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(DATE '1998-01-01', DATE '1998-12-31', INTERVAL 1 DAY)) AS d)
    WHERE isodow(d) <= 5 AND d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey % 7 = 0)""")
def business_days(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' AND o_orderkey % 7 = 0").select(F.to_date("o_orderdate").alias("day"))
    return incremental.missing_business_days(spark, "1998-01-01", "1998-12-31", done).select(F.date_format("day", "yyyy-MM-dd").alias("day"))


@query("""
    SELECT o_orderkey, round(o_totalprice * CASE o_orderkey % 4 WHEN 0 THEN 1e6 WHEN 1 THEN 1e9 WHEN 2 THEN 1e3 ELSE 1 END, 0) AS amount,
      CASE o_orderkey % 3 WHEN 0 THEN o_totalprice WHEN 1 THEN -o_totalprice END AS money, o_orderkey % 2 = 0 AS flag FROM orders""")
def money_normalize(spark, sf_dir):
    k = F.col("o_orderkey")
    number = F.format_number("o_totalprice", 2)
    unit = F.element_at(F.array(F.lit("million"), F.lit("B"), F.lit("Thousand"), F.lit(None)), (k % 4 + 1).cast("int"))
    shown = F.when(k % 3 == 0, F.concat(F.lit("$ "), number)).when(k % 3 == 1, F.concat(F.lit("("), number, F.lit(")"))).otherwise("—")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(numbers.amount(number, unit), 0).alias("amount"), numbers.money_number(F.replace(shown, F.lit(" "), F.lit(""))).alias("money"), numbers.flag(F.when(k % 2 == 0, "yes").otherwise("no")).alias("flag"))


@query("""
    SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '-25000' WHEN 2 THEN '12.5' ELSE 'n/a' END AS value FROM part""")
def ixbrl_scaling(spark, sf_dir):
    pick = lambda *xs: F.element_at(F.array(*(F.lit(x) for x in xs)), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", numbers.scaled_fact(pick("0.001", "25", "12.5", "n/a"), pick("3", "3", "", "2"), pick("", "-", "", "-")).alias("value"))


@query("""
    SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(json_extract_string(props, '$.k') AS INTEGER) > 50 AS large FROM events""")
def json_field_extract(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), (k.try_cast("int") > 50).alias("large"))


@query(r"""
    SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""")
def html_strip(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query("""
    SELECT page_id, pos, link FROM (SELECT page_id, unnest(links) AS link, generate_subscripts(links, 1) - 1 AS pos FROM (
      SELECT page_id, regexp_extract_all(html, 'href="([^"]+)"', 1) AS links FROM pages))""")
def html_links(spark, sf_dir):
    links = F.regexp_extract_all("html", F.lit('href="([^"]+)"'), 1)
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("pos", "link")).select("page_id", F.col("pos").cast("long").alias("pos"), "link")


@query("""
    WITH w AS (SELECT DISTINCT p_partkey, unnest(string_split(upper(p_name || ' ' || p_brand || ' ' || p_type), ' ')) AS token FROM part),
    h AS (SELECT q.p_partkey AS company_id, w.p_partkey AS cik, count(*) AS hits FROM w q JOIN w USING (token) GROUP BY ALL)
    SELECT company_id, cik, hits FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY hits DESC, cik) AS n FROM h) WHERE n <= 300""")
def token_candidates(spark, sf_dir):
    """Entities that share words with a company, the first 300 of each: all parts against all parts."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.upper(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("norm"))
    return resolve.token_candidates(rows.withColumnRenamed("p_partkey", "company_id"), rows.withColumnRenamed("p_partkey", "cik"))


@query()
def name_similarity(spark, sf_dir):
    """The most similar part names for every part: a top-k report."""
    rows = resolve.cut(table(spark, sf_dir, "part").select("p_partkey", text.company_name(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("norm")))
    return resolve.fuzzy_candidates(rows.withColumnRenamed("p_partkey", "company_id"), rows.withColumnRenamed("p_partkey", "cik"))


@query("""
    WITH c AS (SELECT l_orderkey, l_suppkey, round(sum(l_quantity), 2) AS score FROM lineitem GROUP BY ALL),
    r AS (SELECT *, lead(score) OVER w AS second, row_number() OVER w AS n FROM c WINDOW w AS (PARTITION BY l_orderkey ORDER BY score DESC, l_suppkey))
    SELECT l_orderkey, l_suppkey, score, score - coalesce(second, 0.0) AS gap FROM r WHERE n = 1""")
def best_second_gap(spark, sf_dir):
    scores = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("score"))
    return topk.best_and_gap(scores, "l_orderkey", "score", "l_suppkey")


@query("SELECT l_suppkey, count(*) AS holdings, count(DISTINCT l_partkey) AS distinct_isin, count(l_discount) AS weights, round(sum(l_discount), 6) AS weight_sum, min(l_discount) AS weight_min, max(l_discount) AS weight_max FROM lineitem GROUP BY l_suppkey")
def payload_summary(spark, sf_dir):
    done = holdings.summarize_payload(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_partkey", "l_discount")
    return done.withColumn("weight_sum", F.round("weight_sum", 6))


@query("""
    WITH n AS (SELECT l_suppkey, count(*) AS c FROM lineitem GROUP BY l_suppkey)
    SELECT l_suppkey, CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE c >= 600 AND 610 <= c END AS complete,
      CASE WHEN l_suppkey % 5 = 0 THEN '' ELSE concat_ws(',', CASE WHEN c < 600 THEN 'payload_short' END, CASE WHEN 610 > c THEN 'declared_more' END) END AS reasons FROM n""")
def completeness_check(spark, sf_dir):
    n = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("c"))
    payload = F.when(F.col("l_suppkey") % 5 != 0, F.col("c"))
    done = n.select("l_suppkey", holdings.completeness(F.lit(None).cast("long"), payload, F.lit(610), 600).alias("x"))
    return done.select("l_suppkey", "x.complete", F.array_join("x.reasons", ",").alias("reasons"))


@query("SELECT event_type, le, count(*) FILTER (le = '+Inf' OR value <= TRY_CAST(le AS DOUBLE)) AS bucket_count, count(*) AS total_count FROM events, (SELECT unnest(['10.0', '20.0', '40.0', '80.0', '+Inf']) AS le) GROUP BY ALL")
def latency_histogram(spark, sf_dir):
    done = rollup.histogram(table(spark, sf_dir, "events"), ["event_type"], "value", (10.0, 20.0, 40.0, 80.0))
    return done.select("event_type", "le", "bucket_count", "total_count")


@query("SELECT event_type, arg_max(value, event_id) AS value FROM events GROUP BY event_type")
def gauge_last_value(spark, sf_dir):
    return rollup.gauges(table(spark, sf_dir, "events"), ["event_type"], "value", "event_id")


@query("SELECT strftime(ts, '%Y-%m-%d') AS event_date, count(*) AS events, count(DISTINCT event_type) AS subjects FROM events GROUP BY ALL")
def events_by_day(spark, sf_dir):
    day = outbox.event_day(F.lit(None).cast("string"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return table(spark, sf_dir, "events").groupBy(day.alias("event_date")).agg(F.count("*").alias("events"), F.count_distinct("event_type").alias("subjects"))


@query(f"""
    WITH {FILINGS_SQL} SELECT accession, strftime(updated_at, '%Y-%m-%d') AS retrieved_on FROM filings
    WHERE retrieval_status = 'retrieved' AND CAST(updated_at AS DATE) < DATE '1998-12-02' AND accession % 5 <> 0 ORDER BY updated_at, accession LIMIT 200""")
def archive_eligible(spark, sf_dir):
    k = F.col("accession")
    path = lambda name: F.when(k % 5 == 0, F.concat(F.lit("/archive/"), k, F.lit(name))).otherwise(F.concat(F.lit("/raw/"), k, F.lit(name)))
    rows = order_filings(spark, sf_dir).withColumns({"retrieved_on": F.to_date("updated_at"), "raw_txt_path": path(".txt"), "primary_doc_path": path(".htm")})
    done = archive.eligible(rows, F.lit("1999-01-01").cast("date"), 30, 200, "/archive")
    return done.select("accession", F.date_format("retrieved_on", "yyyy-MM-dd").alias("retrieved_on"))


@query("SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5, strlen(text) AS size_bytes FROM documents")
def payload_checksum(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.md5("text").alias("md5"), F.octet_length("text").cast("long").alias("size_bytes"))


@query(r"""
    SELECT page_id, regexp_extract(url, '/([^/?#]*)(?:[?#].*)?$', 1) AS part, contains(lower(url), '/en/') AS english, 'root/pages/2024/01/02/' || page_id || '.html' AS path FROM pages""")
def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"/([^/?#]*)(?:[?#].*)?$", 1).alias("part"), F.lower("url").contains("/en/").alias("english"),
        archive.feed_path("root", F.lit("pages"), F.lit("20240102000000"), F.concat(F.lit("https://x/"), "page_id", F.lit(".html"))).alias("path"),
    )


@query("""
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'https://a/' || event_id WHEN 1 THEN 'id' || event_id ELSE NULL END AS document_id,
      CASE event_id % 3 WHEN 1 THEN sha256(concat_ws(chr(9), 'k' || event_id, 'b', 'c', 'd', 'e', 'id' || event_id, 'x')) WHEN 2 THEN sha256(chr(9) || 'only') ELSE 'k' || event_id END AS record_key
    FROM events""")
def raw_record_keys(spark, sf_dir):
    """Record keys and document ids of tab-separated lines, by the rules of three feeds."""
    e = F.col("event_id")
    key = F.concat(F.lit("k"), e)
    a = F.concat_ws("\t", key, F.lit("b"), F.concat(F.lit("https://a/"), e))
    b = F.concat_ws("\t", key, F.lit("b"), F.lit("c"), F.lit("d"), F.lit("e"), F.concat(F.lit("id"), e), F.lit("x"))
    c = F.lit("\tonly")
    pick = lambda x, y, z: F.when(e % 3 == 0, x).when(e % 3 == 1, y).otherwise(z)
    return table(spark, sf_dir, "events").select(
        "event_id",
        pick(dedup.document_id(a, "last_field_url"), dedup.document_id(b, "field_6"), dedup.document_id(c, "first_url_in_10")).alias("document_id"),
        pick(dedup.record_key(a, "first_field"), dedup.record_key(b, "line_sha256"), dedup.record_key(c, "first_field")).alias("record_key"),
    )


@query("""
    SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'missing' WHEN c_custkey % 7 = 1 THEN 'not digits' WHEN c_custkey % 7 = 2 THEN 'too large' WHEN c_custkey % 7 = 3 THEN 'zero' END AS problem FROM customer""")
def invalid_ciks(spark, sf_dir):
    k = F.col("c_custkey") % 7
    cik = F.when(k == 0, F.lit(None).cast("string")).when(k == 1, "12a").when(k == 2, "99999999999").when(k == 3, "0").otherwise(F.col("c_custkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", holdings.cik_problem(cik).alias("problem"))


@query("""
    WITH s AS (SELECT n_nationkey AS source, 'c' || n_nationkey AS cursor, 1 AS updated_at FROM nation UNION ALL SELECT n_nationkey, 'd' || n_nationkey, 2 FROM nation WHERE n_regionkey = 1)
    SELECT source, arg_max(cursor, updated_at) AS cursor, max(updated_at) AS updated_at FROM s GROUP BY source""")
def checkpoint_state(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    state = nation.select(F.col("n_nationkey").alias("source"), F.concat(F.lit("c"), "n_nationkey").alias("cursor"), F.lit(1).alias("updated_at"))
    new = nation.where("n_regionkey = 1").select(F.col("n_nationkey").alias("source"), F.concat(F.lit("d"), "n_nationkey").alias("cursor"), F.lit(2).alias("updated_at"))
    return merge.set_state(state, new)
