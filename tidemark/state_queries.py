"""Queries of state tables: transitions, watermarks, archives, commits and the events of parsed filings."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import fixed
from .operators import archive, classify, commit, incremental, merge, outbox, quality, retry, rollup, state, topk
from .plans import xbrl
from .registry import query, table

NOW = "TIMESTAMP '1998-06-01 00:00:00'"


def now():
    return F.to_timestamp(F.lit("1998-06-01 00:00:00"))


def pick(key, *values):
    return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))


def work(spark, sf_dir):
    """Orders as filings in all states of work."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        k.cast("string").alias("accession"),
        F.col("o_custkey").alias("cik"),
        pick(k, "8-K", "10-Q", "4").alias("form_type"),
        pick(F.col("o_custkey"), "discovered", "queued", "in_progress", "retrieved", "retrieval_failed").alias("retrieval_status"),
        pick((k / 7).cast("long"), "unknown", "direct_match", "hdr_pending", "hdr_transient_fail").alias("relevance_state"),
        (k % 7).cast("int").alias("attempts"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        F.when(k % 3 == 0, F.col("o_orderdate").cast("timestamp")).alias("next_retry_at"),
        F.lit(None).cast("string").alias("issuer_cik"),
        F.lit(None).cast("string").alias("issuer_name"),
    )


WORK = """w AS (
      SELECT CAST(o_orderkey AS VARCHAR) AS accession, o_orderkey AS k, o_custkey AS cik, (['8-K', '10-Q', '4'])[o_orderkey % 3 + 1] AS form_type,
        (['discovered', 'queued', 'in_progress', 'retrieved', 'retrieval_failed'])[o_custkey % 5 + 1] AS retrieval_status,
        (['unknown', 'direct_match', 'hdr_pending', 'hdr_transient_fail'])[(o_orderkey // 7) % 4 + 1] AS relevance_state,
        CAST(o_orderkey % 7 AS INTEGER) AS attempts, o_orderdate AS updated_at, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS next_retry_at FROM orders)"""


@query(f"""
    WITH {WORK}, d AS (SELECT *, CASE k % 4 WHEN 0 THEN 'hdr_match' WHEN 1 THEN 'irrelevant' WHEN 2 THEN 'direct_match' END AS state FROM w)
    SELECT accession, coalesce(state, relevance_state) AS relevance_state, CASE WHEN k % 4 < 3 AND k % 2 = 0 THEN CAST(cik AS VARCHAR) END AS issuer_cik,
      CASE WHEN state IN ('hdr_match', 'irrelevant') THEN 'discovered' ELSE retrieval_status END AS retrieval_status FROM d""")
def relevance_updates(spark, sf_dir):
    rows = work(spark, sf_dir)
    k = F.col("accession").cast("long")
    decided = rows.where(k % 4 < 3).select("accession", pick(k, "hdr_match", "irrelevant", "direct_match", "-").alias("state"), F.when(k % 2 == 0, F.col("cik").cast("string")).alias("issuer_cik"), F.lit(None).cast("string").alias("issuer_name"))
    return merge.update_relevance(rows, decided).select("accession", "relevance_state", "issuer_cik", "retrieval_status")


@query(f"""
    WITH {WORK} SELECT accession, CASE k % 3 WHEN 0 THEN 'retrieved' WHEN 1 THEN 'retrieval_failed' ELSE retrieval_status END AS retrieval_status,
      attempts + CASE WHEN k % 3 = 1 THEN 1 ELSE 0 END AS attempts,
      CASE k % 3 WHEN 1 THEN {NOW} + to_seconds(CAST(least(3600, 2 * pow(2, attempts + 1)) AS INTEGER)) WHEN 2 THEN next_retry_at END IS NULL AS no_retry FROM w""")
def attempt_results(spark, sf_dir):
    rows = work(spark, sf_dir)
    k = F.col("accession").cast("long")
    results = rows.where(k % 3 < 2).select("accession", pick(k, "retrieved", "retrieval_failed", "-").alias("status"))
    after = retry.after_attempt(rows, results, now())
    return after.select("accession", "retrieval_status", "attempts", F.col("next_retry_at").isNull().alias("no_retry"))


@query(f"""
    WITH {WORK} SELECT accession, CASE WHEN k % 2 = 0 AND NOT coalesce(next_retry_at > {NOW}, FALSE) THEN 'queued' ELSE retrieval_status END AS retrieval_status,
      CASE WHEN k % 2 = 0 THEN 'queued' ELSE retrieval_status END AS forced FROM w""")
def queue_filings(spark, sf_dir):
    rows = work(spark, sf_dir)
    wanted = rows.where(F.col("accession").cast("long") % 2 == 0)
    forced = retry.queue(rows, wanted, now(), force=True).select("accession", F.col("retrieval_status").alias("forced"))
    return retry.queue(rows, wanted, now()).select("accession", "retrieval_status").join(forced, "accession")


@query(f"""
    WITH {WORK} SELECT accession, CASE WHEN k % 5 = 0 THEN 'hdr_transient_fail' ELSE relevance_state END AS relevance_state, attempts + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS attempts,
      strftime(CASE WHEN k % 5 = 0 THEN {NOW} + to_seconds(CAST(least(3600, 2 * pow(2, attempts + 1)) AS INTEGER)) ELSE next_retry_at END, '%Y-%m-%d %H:%M:%S') AS next_retry_at FROM w""")
def header_failures(spark, sf_dir):
    rows = work(spark, sf_dir)
    after = retry.header_failed(rows, rows.where(F.col("accession").cast("long") % 5 == 0), now())
    return after.select("accession", "relevance_state", "attempts", F.date_format("next_retry_at", "yyyy-MM-dd HH:mm:ss").alias("next_retry_at"))


@query(f"""
    WITH {WORK}, one AS (SELECT 'header' AS list, accession FROM w WHERE relevance_state = 'hdr_transient_fail' AND attempts < 5 AND (next_retry_at IS NULL OR next_retry_at <= {NOW}) ORDER BY updated_at, accession LIMIT 100),
    two AS (SELECT 'pending', accession FROM w WHERE relevance_state = 'hdr_pending' ORDER BY updated_at, accession LIMIT 100),
    three AS (SELECT 'unprocessed', accession FROM w WHERE relevance_state = 'unknown' AND retrieval_status = 'discovered' ORDER BY updated_at, accession LIMIT 200)
    SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three""")
def header_work_lists(spark, sf_dir):
    rows = work(spark, sf_dir)
    lists = {"header": retry.header_candidates(rows, now()), "pending": retry.pending_headers(rows), "unprocessed": retry.unprocessed(rows)}
    named = [df.select(F.lit(name).alias("list"), "accession") for name, df in lists.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query(f"WITH {WORK} SELECT accession, coalesce(next_retry_at > {NOW}, FALSE) AS cooling, CASE WHEN relevance_state = 'direct_match' THEN 'retrieval' WHEN relevance_state IN ('hdr_pending', 'hdr_transient_fail') THEN 'header_gate' ELSE 'discovery' END AS route, k % 4 < 2 AS live FROM w")
def cooling_and_routes(spark, sf_dir):
    rows = work(spark, sf_dir)
    priority = pick(F.col("accession").cast("long"), "live", "retrieval", "backfill", "repair")
    return rows.select("accession", retry.cooling_down(F.col("next_retry_at"), now()).alias("cooling"), classify.recovery_route(F.col("relevance_state")).alias("route"), classify.is_live(priority).alias("live"))


@query(f"""
    WITH {WORK}, p AS (SELECT *, ['live', 'retry', 'header_gate', 'retrieval', 'audit', 'backfill', 'repair'][k % 7 + 1] AS priority FROM w)
    SELECT accession, priority FROM p ORDER BY k % 7, updated_at, accession LIMIT 150""")
def prioritised_work(spark, sf_dir):
    rows = work(spark, sf_dir).withColumn("priority", pick(F.col("accession").cast("long"), *fixed.PRIORITIES)).withColumnRenamed("updated_at", "created_at")
    return topk.prioritised(rows, 150).select("accession", "priority")


@query(f"""
    WITH {WORK} SELECT 'status' AS kind, retrieval_status AS name, count(*) AS n FROM w GROUP BY retrieval_status UNION ALL SELECT 'status', NULL, count(*) FROM w
    UNION ALL SELECT 'pending', NULL, count(*) FROM w WHERE retrieval_status IN ('queued', 'in_progress')
    UNION ALL SELECT 'known', CAST(k % 10 = 0 AS VARCHAR), count(*) FROM w GROUP BY 2
    UNION ALL SELECT 'filing', form_type, count(*) FROM w WHERE k % 10 = 0 GROUP BY form_type
    UNION ALL SELECT 'accessions', NULL, count(*) FROM w""")
def state_lookups(spark, sf_dir):
    """Counts by status, pending events, existence, filings and their documents."""
    rows = work(spark, sf_dir)
    tenth = rows.where(F.col("accession").cast("long") % 10 == 0)
    none = F.lit(None).cast("string")
    box = rows.withColumn("status", F.when(F.col("retrieval_status") == "queued", "pending").when(F.col("retrieval_status") == "in_progress", "leased").otherwise("published"))
    parts = [
        state.filing_counts(rows).select(F.lit("status").alias("kind"), F.col("retrieval_status").alias("name"), "n"),
        state.pending_count(box).select(F.lit("pending").alias("kind"), none.alias("name"), F.col("pending").alias("n")),
        state.existence(rows, tenth).groupBy(F.col("known").cast("string").alias("name")).agg(F.count("*").alias("n")).select(F.lit("known").alias("kind"), "name", "n"),
        state.filing(rows, tenth).groupBy("form_type").agg(F.count("*").alias("n")).select(F.lit("filing").alias("kind"), F.col("form_type").alias("name"), "n"),
        state.known_accessions(rows).agg(F.count("*").alias("n")).select(F.lit("accessions").alias("kind"), none.alias("name"), "n"),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


@query("SELECT CAST(l_orderkey AS VARCHAR) AS accession, l_linenumber AS sequence, 'f' || l_partkey || '.htm' AS filename FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def filing_documents(spark, sf_dir):
    documents = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("accession"), F.col("l_linenumber").alias("sequence"), F.concat(F.lit("f"), "l_partkey", F.lit(".htm")).alias("filename"))
    asked = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("string").alias("accession"))
    return state.filing_documents(documents, asked)


@query("""
    WITH m AS (SELECT p_partkey, 'https://x/' || p_partkey AS source_url, p_size % 4 AS tries FROM part)
    SELECT source_url, CASE WHEN p_partkey % 3 = 0 THEN 'failed' ELSE 'pending' END AS download_status, tries + CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS download_attempts, CASE WHEN p_partkey % 3 = 0 THEN 'HTTP ' || p_partkey END AS error FROM m""")
def manifest_failures(spark, sf_dir):
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(F.concat(F.lit("https://x/"), "p_partkey").alias("source_url"), F.lit("pending").alias("download_status"), (F.col("p_size") % 4).alias("download_attempts"), F.lit(None).cast("string").alias("error"))
    failed = table(spark, sf_dir, "part").where(k % 3 == 0).select(F.concat(F.lit("https://x/"), "p_partkey").alias("source_url"), F.concat(F.lit("HTTP "), "p_partkey").alias("error"))
    return merge.mark_failed(rows, failed)


@query("""
    SELECT CAST(p_partkey AS VARCHAR) AS accession, CASE WHEN p_partkey % 2 = 0 THEN '/archive/' ELSE '/raw/' END || p_partkey AS path, p_size AS size, CAST(NULL AS VARCHAR) AS note FROM part
    UNION ALL SELECT 'new' || n_nationkey, '/raw/n', 0, NULL FROM nation""")
def relocated_documents(spark, sf_dir):
    """Artifacts that moved, a newer schema's column, and new rows besides the known ones."""
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("accession"), F.concat(F.lit("/raw/"), "p_partkey").alias("path"), F.col("p_size").cast("long").alias("size"))
    moved = rows.where(F.col("accession").cast("long") % 2 == 0).select("accession", F.col("path").alias("old_path"), F.concat(F.lit("/archive/"), "accession").alias("new_path"))
    wide = merge.add_missing_columns(merge.rewrite_locations(rows, moved), {"size": "long", "note": "string"})
    fresh = table(spark, sf_dir, "nation").select(F.concat(F.lit("new"), "n_nationkey").alias("accession"), F.lit("/raw/n").alias("path"), F.lit(0).cast("long").alias("size"), F.lit(None).cast("string").alias("note"))
    return merge.insert_new(wide, fresh.unionByName(wide.select("accession", F.lit("/raw/other").alias("path"), "size", "note")), ["accession"])


@query("""
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS ts, CASE WHEN event_id % 4 = 0 THEN 'a' || event_id || ',b' ELSE '' END AS boundary FROM events""")
def stored_watermarks(spark, sf_dir):
    """Watermarks as stored: JSON, a bare time, nothing, and what can't be read."""
    e, at = F.col("event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    kept = F.concat(F.lit('{"accepted_at":"'), at, F.lit('","accessions":["a'), "event_id", F.lit('","b"]}'))
    raw = F.when(e % 4 == 0, kept).when(e % 4 == 1, at).when(e % 4 == 2, "").otherwise("{broken")
    rows = table(spark, sf_dir, "events").select("event_id", incremental.parse_watermark(raw).alias("w"))
    return rows.select("event_id", F.date_format("w.ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.array_join("w.boundary", ",").alias("boundary"))


@query("""
    SELECT c_custkey, 'edgar.feed.gap_detected' AS subject, 'N/A' AS accession, '{"pages_checked":' || (c_custkey % 10) || ',"watermark":"' || c_name || '"}' AS payload_json,
      substr(sha256('{"pages_checked":' || (c_custkey % 10) || ',"watermark":"' || c_name || '"}'), 1, 16) AS payload_hash FROM customer WHERE c_custkey % 3 <> 0""")
def gap_events(spark, sf_dir):
    k = F.col("c_custkey")
    gaps = table(spark, sf_dir, "customer").select((k % 3 == 0).alias("found"), F.col("c_name").alias("watermark"), (k % 10).alias("pages_checked"))
    events = outbox.gap_event(gaps, F.lit("1998-06-01T00:00:00"))
    number = F.regexp_extract("payload_json", r"#0*(\d+)", 1).cast("long")
    return events.select(number.alias("c_custkey"), "subject", "accession", "payload_json", "payload_hash")


@query("""
    SELECT CASE c_custkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 6 ELSE 6 END AS weekday, CASE c_custkey % 3 WHEN 0 THEN c_custkey % 24 ELSE 11 END AS hour, CASE c_custkey % 3 WHEN 0 THEN c_custkey % 60 ELSE 0 END AS minute, c_custkey FROM customer""")
def cron_fields(spark, sf_dir):
    k = F.col("c_custkey")
    text = F.when(k % 3 == 0, F.concat_ws(" ", (k % 60).cast("string"), (k % 24).cast("string"), F.lit("* * 3"))).when(k % 3 == 1, "*/5 * * * 1").otherwise("0 1 *")
    return table(spark, sf_dir, "customer").select("c_custkey", incremental.cron_weekday_hour(text).alias("c")).select("c_custkey", "c.weekday", "c.hour", "c.minute")


@query("""
    SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS accession, strftime(o_orderdate, '%Y-%m-%d') AS filing_date FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderkey % 4 <> 0""")
def bootstrap_filings(spark, sf_dir):
    """Recent and older filings overlap; known ones and those before a day are left out."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("accession"), F.to_date("o_orderdate").alias("filing_date"))
    recent, older = rows.where("filing_date >= '1997-01-01'"), rows.where("filing_date < '1998-01-01'")
    known = rows.where(F.col("accession").cast("long") % 4 == 0)
    return incremental.bootstrap(recent, older, known, "1996-01-01").select("accession", F.date_format("filing_date", "yyyy-MM-dd").alias("filing_date"))


@query("""
    SELECT 'ok' AS status, CAST(60 AS BIGINT) AS age_seconds, 'polled' AS case UNION ALL SELECT 'stale', 7200, 'late' UNION ALL SELECT 'starting', NULL, 'none'""")
def health_status(spark, sf_dir):
    polls = table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp")).alias("at"))
    last = polls.first()["at"]
    later = lambda seconds: F.timestamp_seconds(F.unix_timestamp(F.lit(last)) + seconds)
    cases = {"polled": (polls, 60), "late": (polls, 7200), "none": (polls.limit(0), 0)}
    out = None
    for name, (gauge, seconds) in cases.items():
        one = rollup.health(gauge, 3600, later(seconds)).withColumn("case", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


@query("""
    SELECT (SELECT count(*) FROM part) AS files, (SELECT count(*) FROM part WHERE p_partkey % 3 = 0) AS applied, (SELECT count(*) FROM part WHERE p_partkey % 3 = 1) AS failed,
      (SELECT min(p_brand) FROM part) AS first_interval, (SELECT max(p_brand) FROM part) AS last_interval, (SELECT count(*) FROM events) AS inserted, (SELECT count(*) FROM events WHERE event_type = 'error') AS skipped""")
def run_summary(spark, sf_dir):
    files = table(spark, sf_dir, "part").select(pick(F.col("p_partkey"), "applied", "failed", "pending").alias("download_status"), F.col("p_brand").alias("interval_ts"))
    events = table(spark, sf_dir, "events")
    return rollup.run_summary(files, events, events.where("event_type = 'error'"))


@query("""
    WITH c AS (SELECT c_custkey % 900 AS k, CASE WHEN c_custkey % 10 = 0 THEN ' ' ELSE c_name END AS name, CASE c_custkey % 4 WHEN 0 THEN lpad(CAST(c_custkey AS VARCHAR), 10, '0') WHEN 1 THEN 'x' END AS cik FROM customer),
    r AS (SELECT 'name is missing' AS rule, count(*) FILTER (trim(name) = '') AS n FROM c UNION ALL SELECT 'cik isn''t ten digits', count(*) FILTER (cik = 'x') FROM c
      UNION ALL SELECT '1 rows are expected', CASE WHEN count(*) = 1 THEN 0 ELSE count(*) END FROM c UNION ALL SELECT 'k repeats', count(*) FROM (SELECT k FROM c GROUP BY k HAVING count(*) > 1))
    SELECT rule, n FROM r WHERE n > 0""")
def output_violations(spark, sf_dir):
    k = F.col("c_custkey")
    cik = F.when(k % 4 == 0, F.lpad(k.cast("string"), 10, "0")).when(k % 4 == 1, "x")
    rows = table(spark, sf_dir, "customer").select((k % 900).alias("k"), F.when(k % 10 == 0, " ").otherwise(F.col("c_name")).alias("name"), cik.alias("cik"))
    return quality.violations(rows, required=["name"], unique=["k"], expected=1, cik="cik")


@query("""
    SELECT p_partkey, '/arch/' || CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey AS VARCHAR), 10, '0') || '/a/f.txt' ELSE 'x/y/' || p_partkey || '.txt' END AS archived_path,
      CASE p_partkey % 4 WHEN 0 THEN 'good' WHEN 1 THEN 'damaged' WHEN 2 THEN 'missing' ELSE 'good' END AS state, p_partkey % 4 IN (0, 3) AS removable FROM part""")
def archive_copies(spark, sf_dir):
    """Where files go, whether their copies are good, and which originals may be removed."""
    k = F.col("p_partkey")
    path = F.when(k % 2 == 0, F.concat(F.lit("/raw/q/"), F.lpad(k.cast("string"), 10, "0"), F.lit("/a/f.txt"))).otherwise(F.concat(F.lit("/raw/q/x/y/"), k.cast("string"), F.lit(".txt")))
    rows = table(spark, sf_dir, "part").select("p_partkey", path.alias("path"), F.sha2("p_name", 256).alias("digest"))
    rows = rows.withColumn("archived_path", archive.archive_path("/arch", F.col("path")))
    expected = rows.select("p_partkey", "path", "archived_path", F.when(k % 4 != 3, F.col("digest")).alias("sha256"))
    copies = rows.where(k % 4 != 2).select(F.col("archived_path").alias("path"), F.when(k % 4 == 0, F.col("digest")).otherwise("other").alias("sha256"))
    pending = expected.where(k % 3 == 0).withColumnRenamed("path", "original_path")
    gone = archive.orphans(pending, expected.withColumnRenamed("path", "original_path"), copies).select("archived_path", F.lit(True).alias("removable"))
    return archive.verify_copies(expected, copies).join(gone, "archived_path", "left").select("p_partkey", "archived_path", "state", F.coalesce("removable", F.lit(False)).alias("removable"))


@query("SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS event_date FROM events WHERE strftime(ts, '%Y-%m-%d') <> '2024-01-05'")
def closed_event_days(spark, sf_dir):
    days = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("event_date")).distinct()
    return archive.closed_days(days, F.to_timestamp(F.lit("2024-01-05 12:00:00")))


def commit_state(spark, sf_dir):
    rows = work(spark, sf_dir).withColumns({"raw_txt_path": F.lit(None).cast("string"), "primary_doc_path": F.lit(None).cast("string")})
    box = spark.createDataFrame([], "event_id string, subject string, accession string, payload_json string, payload_hash string, created_at string, commit_seq long")
    return {"filings": rows, "outbox": box}


@query(f"""
    WITH {WORK}, b AS (SELECT *, k % 4 = 0 AS fetched, k % 8 = 0 AS main FROM w)
    SELECT accession, CASE WHEN main THEN 'retrieved' WHEN fetched THEN 'retrieved_partial' ELSE retrieval_status END AS retrieval_status, CASE WHEN fetched THEN '/t/' || accession END AS raw_txt_path,
      attempts + CASE WHEN fetched AND NOT main THEN 1 ELSE 0 END AS attempts, CASE WHEN main THEN 'edgar.filing.retrieved' WHEN fetched THEN 'edgar.filing.retrieved_partial' END AS subject,
      CASE WHEN fetched THEN 0 ELSE CAST(k % 5 AS BIGINT) END + CASE WHEN fetched AND main THEN 2 ELSE 0 END AS rows FROM b""")
def commit_cycle(spark, sf_dir):
    """Fetched filings with their parsed rows: statuses, paths, replaced rows and events of one commit."""
    now_state = commit_state(spark, sf_dir)
    k = F.col("accession").cast("long")
    rows = now_state["filings"]
    parsed = rows.select("accession", F.explode_outer(F.when(k % 5 > 0, F.sequence(F.lit(1), (k % 5).cast("int")))).alias("line")).where("line IS NOT NULL")
    new = rows.where(k % 8 == 0).select("accession", F.explode(F.array(F.lit(1), F.lit(2))).alias("line"))
    path = lambda folder, when: F.when(when, F.concat(F.lit(folder), "accession"))
    bundles = rows.where(k % 4 == 0).select("accession", path("/t/", F.lit(True)).alias("raw_txt_path"), path("/p/", k % 8 == 0).alias("primary_doc_path"), F.lit("x").alias("txt_sha256"), F.lit("y").alias("primary_sha256"))
    after = commit.commit_filings(now_state | {"lines": parsed}, {"lines": new}, bundles, now())
    counts = after["lines"].groupBy("accession").agg(F.count("*").alias("rows"))
    both = after["filings"].join(after["outbox"].select("accession", "subject"), "accession", "left").join(counts, "accession", "left")
    return both.select("accession", "retrieval_status", "raw_txt_path", "attempts", "subject", F.coalesce("rows", F.lit(0)).alias("rows"))


@query(f"""
    WITH {WORK} SELECT accession, 'retrieval_failed' AS retrieval_status, attempts + 1 AS attempts, substr(sha256('edgar.filing.failed:' || accession || ':' || (attempts + 1)), 1, 32) AS event_id, row_number() OVER (ORDER BY substr(sha256('edgar.filing.failed:' || accession || ':' || (attempts + 1)), 1, 32)) AS commit_seq
    FROM w WHERE k % 4 = 1""")
def commit_failures(spark, sf_dir):
    now_state = commit_state(spark, sf_dir)
    failures = now_state["filings"].where(F.col("accession").cast("long") % 4 == 1).select("accession", F.lit("timeout").alias("error"))
    after = commit.commit_failures(now_state, failures, now())
    return after["filings"].join(after["outbox"].select("accession", "event_id", "commit_seq"), "accession").select("accession", "retrieval_status", "attempts", "event_id", "commit_seq")


EVENT_ROWS = "(SELECT l_orderkey AS accession, l_linenumber, l_partkey, l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey, l_suppkey, l_linenumber) AS m FROM lineitem)"


@query(f"""
    WITH e AS (SELECT * FROM {EVENT_ROWS}),
    f AS (SELECT 'edgar.8k.facts_extracted' AS subject, accession, count(*) AS total, array_to_string(list(l_partkey ORDER BY n) FILTER (n <= 30), ',') AS items FROM e GROUP BY accession
      UNION ALL SELECT 'edgar.13f.parsed', accession, count(*), array_to_string(list(l_partkey ORDER BY m) FILTER (m <= 20), ',') FROM e GROUP BY accession
      UNION ALL SELECT 'edgar.xbrl.parsed', accession, count(*), array_to_string(list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey)[1:2], ',') FROM e WHERE l_linenumber % 2 = 1 GROUP BY accession)
    SELECT subject, accession, substr(sha256(subject || ':' || accession), 1, 32) AS event_id, '{{"accession":' || accession || ',"items":[' || items || '],"total":' || total || '}}' AS payload_json FROM f""")
def listed_events(spark, sf_dir):
    """Events of filings with their first rows: facts, holdings by value, and key facts."""
    rows = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "accession")
    at, part = F.lit("1998-06-01T00:00:00"), F.col("l_partkey")
    place = [F.col("l_linenumber"), part, F.col("l_suppkey")]
    concept = F.when(F.col("l_linenumber") % 2 == 1, "us-gaap:Revenue").otherwise("us-gaap:Other")
    key = xbrl.key_facts(rows.select("accession", "l_linenumber", "l_partkey", "l_suppkey", concept.alias("concept"), (F.col("l_linenumber").cast("long") * 1_000_000_000 + part * 1000 + F.col("l_suppkey") % 1000).alias("position")), ("us-gaap:Rev",))
    found = [
        outbox.listed_events(rows, "eight_k_facts", at, 30, place, part),
        outbox.listed_events(rows, "thirteen_f", at, 20, [F.col("l_extendedprice").desc(), part, F.col("l_suppkey"), F.col("l_linenumber")], part),
        outbox.listed_events(key, "xbrl", at, 2, place, part),
    ]
    events = found[0].unionByName(found[1]).unionByName(found[2])
    return events.select("subject", "accession", "event_id", "payload_json")


@query("""
    WITH i AS (SELECT o_orderkey AS accession, unnest(['2.02', '9.01']) AS item_number FROM orders)
    SELECT accession, substr(sha256('edgar.8k.item_detected:' || accession || ':' || item_number), 1, 32) AS event_id, '{"accession":' || accession || ',"item_description":"D' || item_number || '","item_number":"' || item_number || '"}' AS payload_json FROM i""")
def item_events(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("accession"), F.explode(F.array(F.lit("2.02"), F.lit("9.01"))).alias("item_number"))
    return outbox.item_events(rows.withColumn("item_description", F.concat(F.lit("D"), "item_number")), F.lit("x")).select("accession", "event_id", "payload_json")


@query("""
    SELECT event_id, CASE WHEN event_id % 2 = 0 AND ts < TIMESTAMP '2024-01-10 00:00:00' - INTERVAL 120 SECOND THEN 'pending' WHEN event_id % 2 = 0 THEN 'leased' ELSE 'published' END AS status FROM events""")
def stale_leases(spark, sf_dir):
    e = F.col("event_id")
    box = table(spark, sf_dir, "events").select("event_id", F.when(e % 2 == 0, "leased").otherwise("published").alias("status"), F.col("ts").cast("timestamp").alias("leased_at"))
    return retry.reset_stale_leases(box, F.to_timestamp(F.lit("2024-01-10 00:00:00"))).select("event_id", "status")
