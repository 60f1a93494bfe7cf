"""Operators on small inputs, with properties that must hold for any."""

import datetime
import hashlib
import random
import zipfile

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import archive, classify, commit, dedup, holdings, incremental, merge, outbox, quality, resolve, retry, rollup, topk
from tidemark.sources import feeds, tables
from tidemark.streaming import jobs


def now():
    return F.to_timestamp(F.lit("2026-01-02 00:00:00"))


def test_header_resolution(spark):
    watchlist = spark.createDataFrame([(0, "0000000001", "One Corp.", ["Uno"]), (1, "0000000002", "Two, Inc", [])], "position int, cik string, name string, aliases array<string>")
    kind = "accession string, form_type string, parties array<struct<role:string,cik:string,name:string>>"
    headers = spark.createDataFrame(
        [
            ("cik", "4", [("issuer", "1", "Other")]),
            ("stranger", "4", [("issuer", "9", "One Corp")]),
            ("name", "4", [("issuer", None, "TWO INC")]),
            ("alias", "4", [("issuer", None, "uno")]),
            ("subject", "SC 13D", [("filer", "1", "x")]),
            ("nobody", "4", []),
        ],
        kind,
    )
    got = {r["accession"]: (r["state"], r["company_cik"]) for r in classify.resolve_headers(headers, watchlist).collect()}
    assert got == {"cik": ("hdr_match", "0000000001"), "stranger": ("irrelevant", None), "name": ("hdr_match", "0000000002"), "alias": ("hdr_match", "0000000001"), "subject": ("unresolved", None), "nobody": ("hdr_failed", None)}


def test_candidates_by_variants_hints_and_fallback(spark):
    companies = resolve.normalised(spark.createDataFrame([(1, "ZORB MFG", ""), (2, "QUUX", ""), (3, "NVIDEA", "")], "company_id int, name string, ticker string"))
    entities = resolve.normalised(spark.createDataFrame([("a", "MANUFACTURING", "", True), ("b", "BLARG WIDGETS INTL PLASTICS", "", True), ("c", "NVIDIA", "", True), ("d", "NVIDEAS", "", False)], "cik string, name string, ticker string, current boolean"))
    hints = spark.createDataFrame([(2, "", "BLARG WIDGETS INTL PLASTIC", 0.5)], "company_id int, ticker string, norm string, score double")
    rows = {(r["company_id"], r["cik"]): r for r in resolve.gather_candidates(companies, entities, hints).collect()}
    assert (1, "a") in rows
    assert "figi_fuzzy" in rows[2, "b"]["evidence"] and rows[2, "b"]["id_backed"]
    assert rows[3, "c"]["evidence"] == ["fuzzy"] and (3, "d") not in rows
    assert not [r for r in resolve.token_candidates(companies, entities).collect() if r["company_id"] == 3]


COMPANIES = [("NVIDIA CORP", "0001045810"), ("APPLE INC", "0000320193"), ("MICROSOFT CORP", "0000789019"), ("AMAZON.COM INC", "0001018724"), ("MAHINDRA &amp; MAHINDRA", "0001076930"), ("MUENCHENER RUECKVER AG-REG", "0001781933")]
ENTITIES = [("0001045810", "NVIDIA CORP", "NVDA"), ("0000320193", "Apple Inc.", "AAPL"), ("0000789019", "MICROSOFT CORP", "MSFT"), ("0001018724", "AMAZON COM INC", "AMZN"), ("0001781933", "MUENCHENER RUCKVERSICHERUNGS-GESELLSCHAFT AG IN MUENCHEN", "MURGY"), ("0001076930", "MAHINDRA & MAHINDRA LTD", "MAHMF")]
HINTS = [(0, "NVDA", "NVIDIA CORP", "US"), (1, "AAPL", "APPLE INC", "US"), (2, "MSFT", "MICROSOFT CORP", "US"), (3, "AMZN", "AMAZON COM INC", "US"), (4, "MM", "MAHINDRA & MAHINDRA LTD", "IB"), (4, "MAHMF", "MAHINDRA & MAHINDRA", "US"), (5, "MUV2", "MUENCHENER RUECKVER AG-REG", "GY"), (5, "MURGY", "MUENCHENER RUCK MUNICH RE REG", "US")]


def test_entity_resolution(spark):
    companies = resolve.normalised(spark.createDataFrame([(i, n, "") for i, (n, _) in enumerate(COMPANIES)], "company_id int, name string, ticker string"))
    entities = resolve.normalised(spark.createDataFrame([(*e, True) for e in ENTITIES], "cik string, name string, ticker string, current boolean"))
    hints = resolve.normalised(spark.createDataFrame([(*h, "Equity", "Common Stock", "ISIN") for h in HINTS], "company_id int, ticker string, name string, exchange string, market_sector string, security_type string, id_type string"))
    hints = resolve.hint_scores(hints.join(companies.select("company_id", F.col("norm").alias("company_norm")), "company_id"))
    profiles = entities.select("cik", F.array("norm").alias("names"), F.array("ticker").alias("tickers"))
    candidates = resolve.gather_candidates(companies, entities, hints)
    got = {r["company_id"]: r for r in resolve.accept(resolve.validate(candidates, companies, profiles, hints)).collect()}
    for i, (_, cik) in enumerate(COMPANIES):
        assert got[i]["cik"] == cik and got[i]["accepted"], COMPANIES[i]
    assert all(got[i]["confidence"] > 0.75 for i in range(4))


def test_tables_written_once_are_not_broadcast_by_their_files_size(spark, tmp_path):
    names = spark.range(100_000).select("id", F.lit("THE SAME NAME EVERYWHERE").alias("norm"))
    names.coalesce(1).write.parquet(f"{tmp_path}/names")
    read = spark.read.parquet(f"{tmp_path}/names")
    plan = lambda df: df.join(df.withColumnRenamed("norm", "other"), "id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan(read) and "BroadcastHashJoin" not in plan(resolve.cut(read))
    assert resolve.cut(read).groupBy("norm").count().first()["count"] == 100_000


def test_only_candidates_that_cannot_be_nearest_are_left_out():
    rng = random.Random(3)
    lefts = [f"BIG RING BRAND X{rng.randrange(16**5):X}" for _ in range(20)] + ["", "RING", "Ä" * 250]
    rights = [f"BIG RING BRAND X{rng.randrange(16**4):X}" for _ in range(60)] + ["RING BIG", "RING", "", "Ä" * 240, "X BRAND RING"]
    one, two = (x.ravel() for x in np.mgrid[: len(lefts), : len(rights)])
    whole = resolve.similarities(lefts, rights, one, two, 0.0)
    got = resolve.best_similarities(lefts, rights, one, two, np.arange(len(one)), one, 5, 0.0)
    assert ((got == whole) | (got == 0)).all() and (got[whole > 0] == 0).any()
    for i in range(len(lefts)):
        least = np.sort(whole[one == i])[-5]
        assert (got[one == i][whole[one == i] >= least] == whole[one == i][whole[one == i] >= least]).all()


def test_entities_are_joined_without_broadcasts_by_their_files_size(spark, tmp_path):
    read = []
    for name in ("cik", "company_id"):
        rows = spark.range(2000).select(F.concat(F.lit("c"), "id").alias(name), F.concat(F.lit("ZORB X"), F.hex("id")).alias("norm"), F.concat(F.lit("T"), "id").alias("ticker"), F.lit(True).alias("current"))
        rows.write.parquet(f"{tmp_path}/{name}")
        read.append(spark.read.parquet(f"{tmp_path}/{name}"))
    entities, companies = read[0], read[1].drop("current")
    hints = companies.withColumn("score", F.lit(0.9))
    profiles = entities.select("cik", F.array("norm").alias("names"), F.array("ticker").alias("tickers"))
    done = resolve.validate(resolve.gather_candidates(companies, entities, hints), companies, profiles, hints)
    assert "BroadcastHashJoin" not in done._jdf.queryExecution().sparkPlan().toString()


def test_similarity(spark):
    rows = spark.createDataFrame([("APPLE", "APPLE"), ("", "APPLE"), ("APPLE", "APPLE HOSPITALITY"), ("ALPHA BETA", "BETA ALPHA")], "a string, b string")
    got = [r[0] for r in rows.select(resolve.similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 1.0 and got[1] == 0.0 and 0.7 < got[2] < 1 and 0.6 < got[3] < 1


def test_watermark_is_monotonic_and_idempotent(spark):
    kind = "accession string, accepted_at timestamp"
    feed = spark.createDataFrame([("a", None), ("b", None)], "accession string, t string").selectExpr("accession", "timestamp'2026-01-01 00:00:00' AS accepted_at")
    later = feed.selectExpr("concat(accession, '2') AS accession", "accepted_at")
    empty = spark.createDataFrame([(None, [])], "ts timestamp, boundary array<string>")
    one = incremental.advance_watermark(feed, empty)
    assert one.first()["boundary"] == ["a", "b"]
    assert incremental.after_watermark(feed, one).count() == 0
    two = incremental.advance_watermark(later, one)
    assert two.first()["boundary"] == ["a", "a2", "b", "b2"] and incremental.after_watermark(later, one).count() == 2
    old = feed.selectExpr("accession", "accepted_at - INTERVAL 1 DAY AS accepted_at")
    assert incremental.after_watermark(old, one).count() == 0 and incremental.boundary_found(old, one).first()["found"]
    assert incremental.advance_watermark(old, one).first()["ts"] == one.first()["ts"]
    nothing = spark.createDataFrame([], kind)
    assert incremental.advance_watermark(nothing, one).collect() == one.collect()
    raw = spark.createDataFrame([('{"accepted_at":"2026-01-01T00:00:00Z","accessions":["a"]}',), ("2026-01-01T00:00:00Z",), ("junk",), (None,)], "raw string")
    parsed = [r[0] for r in raw.select(incremental.parse_watermark(F.col("raw"))).collect()]
    assert parsed[0]["boundary"] == ["a"] and parsed[1]["ts"] == parsed[0]["ts"] and parsed[2]["ts"] is None and parsed[3]["ts"] is None


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.sampled_from("xyz")), min_size=1, max_size=25))
def test_rollup_of_parts_is_rollup_of_all(spark, rows):
    kind = "document_id int, interval_ts string, feed string, source_url string, file_id int, line_no int"
    make = lambda part: spark.createDataFrame([(d, str(t), f, f"u{i}", 0, i) for i, (d, t, f) in part], kind)
    ordered = sorted(enumerate(rows), key=lambda x: (str(x[1][1]), 0, x[0]))
    cut = len(ordered) // 2
    whole = rollup.rollup_documents(make(ordered))
    merged = rollup.merge_rollups(rollup.rollup_documents(make(ordered[:cut])), rollup.rollup_documents(make(ordered[cut:])))
    assert sorted(map(tuple, merged.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))


def test_records_are_ingested_once(spark):
    kind = "feed string, record_key string, interval_ts string, file_id int, line_no int"
    rows = spark.createDataFrame([("e", "1", "b", 2, 0), ("e", "1", "a", 1, 0), ("e", "2", "a", 1, 1), ("m", "1", "a", 3, 0)], kind)
    none = spark.createDataFrame([], "feed string, record_key string")
    first = dedup.ingest_records(rows, none)
    assert sorted((r["feed"], r["record_key"], r["interval_ts"]) for r in first.collect()) == [("e", "1", "a"), ("e", "2", "a"), ("m", "1", "a")]
    assert dedup.ingest_records(rows, first).count() == 0


def test_replace_by_key_matches_nulls(spark):
    kind = "accession string, cik string, v int"
    table = spark.createDataFrame([("a", None, 1), ("a", "1", 2), ("b", None, 3)], kind)
    new = spark.createDataFrame([("a", None, 9)], kind)
    assert sorted(r["v"] for r in merge.replace_by_key(table, new, ["accession", "cik"]).collect()) == [2, 3, 9]
    batch = spark.createDataFrame([("b",)], "accession string")
    assert sorted(r["v"] for r in merge.replace_by_key(table, new.limit(0), ["accession"], batch).collect()) == [1, 2]


def test_state_changes(spark):
    filings = spark.createDataFrame([("a", "queued", "hdr_pending", 1, None, None, None), ("b", "queued", "unknown", 0, None, "7", None)], "accession string, retrieval_status string, relevance_state string, attempts int, next_retry_at timestamp, issuer_cik string, issuer_name string")
    decided = spark.createDataFrame([("a", "hdr_match", "1", "X")], "accession string, state string, issuer_cik string, issuer_name string")
    got = {r["accession"]: r for r in merge.update_relevance(filings, decided).collect()}
    assert (got["a"]["relevance_state"], got["a"]["retrieval_status"], got["a"]["issuer_cik"]) == ("hdr_match", "discovered", "1") and got["b"]["issuer_cik"] == "7"
    results = spark.createDataFrame([("a", "retrieval_failed"), ("b", "retrieved")], "accession string, status string")
    after = {r["accession"]: r for r in retry.after_attempt(filings, results, now()).collect()}
    assert (after["a"]["attempts"], after["a"]["next_retry_at"].second, after["b"]["attempts"], after["b"]["next_retry_at"]) == (2, 8, 0, None)
    manifest = spark.createDataFrame([("u", "pending", 0)], "source_url string, download_status string, download_attempts long")
    bad = merge.mark_failed(manifest, spark.createDataFrame([("u", "e" * 5000)], "source_url string, error string")).first()
    assert (bad["download_status"], bad["download_attempts"], len(bad["error"])) == ("failed", 1, 4000)
    moved = merge.rewrite_locations(spark.createDataFrame([("a", "/x"), ("a", "/y")], "accession string, path string"), spark.createDataFrame([("a", "/x", "/z")], "accession string, old_path string, new_path string"))
    assert sorted(r["path"] for r in moved.collect()) == ["/y", "/z"]
    assert merge.add_missing_columns(manifest, {"applied_at": "string"}).first()["applied_at"] is None
    assert merge.insert_new(manifest, manifest, ["source_url"]).count() == 1


def test_publishing(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", None)], "accession string, v int")
    events = outbox.envelopes(rows, "s", F.col("accession"), {"v": F.col("v")}, F.lit("2026-01-01T00:00:00"))
    empty = spark.createDataFrame([], "event_id string, subject string, accession string, payload_json string, payload_hash string, created_at string, commit_seq long")
    log = outbox.append_revisions(empty, events)
    assert outbox.append_revisions(log, events).count() == 2
    changed = outbox.envelopes(rows.where("accession = 'a'"), "s", F.col("accession"), {"v": F.lit(5)}, F.lit("2026-01-02T00:00:00"))
    log = outbox.append_revisions(log, changed)
    assert [r["commit_seq"] for r in log.orderBy("commit_seq").collect()] == [1, 2, 3]
    assert outbox.authoritative(log).where("accession = 'a'").first()["payload_json"] == '{"v":5}'
    assert events.where("accession = 'b'").first()["payload_json"] == '{"v":null}'
    ready = log.withColumn("committed_at", F.lit(None).cast("string"))
    outbox.publish(ready, str(tmp_path / "days"))
    assert {p.name for p in (tmp_path / "days").glob("event_date=*")} == {"event_date=2026-01-01", "event_date=2026-01-02"}
    box = log.withColumns({"status": F.lit("leased"), "lease_token": F.lit("t"), "publish_attempts": F.lit(9), "last_error": F.lit(None).cast("string"), "next_attempt_at": F.lit(None).cast("timestamp"), "leased_at": F.to_timestamp(F.lit("2026-01-01 00:00:00"))})
    done = spark.createDataFrame([(1, "t"), (2, "stolen")], "commit_seq long, lease_token string")
    assert {r["commit_seq"]: r["status"] for r in retry.mark_published(box, done).collect()} == {1: "published", 2: "leased", 3: "leased"}
    failed = retry.mark_publish_failed(box, spark.createDataFrame([(3, "x" * 2000)], "commit_seq long, error string"), now()).where("commit_seq = 3").first()
    assert (failed["status"], failed["publish_attempts"], len(failed["last_error"])) == ("failed", 10, 1000)
    assert retry.reset_stale_leases(box, now()).where("status = 'pending'").count() == 3
    assert outbox.item_events(spark.createDataFrame([("a", "2.02", "x")], "accession string, item_number string, item_description string"), F.lit("t")).first()["subject"] == "edgar.8k.item_detected"
    facts = spark.createDataFrame([("a", i) for i in range(40)], "accession string, position int")
    assert outbox.listed_events(facts, "eight_k_facts", F.lit("t"), 30, [F.col("position")], F.col("position")).first()["payload_json"].count(",") == 31
    gap = spark.createDataFrame([(False, "w", 10)], "found boolean, watermark string, pages_checked int")
    assert outbox.gap_event(gap, F.lit("t")).count() == 1


def test_holdings(spark):
    rows = spark.createDataFrame([("A", " ", "US0378331005", 0.5), ("B", "c", "bad", 0.5), ("C", None, "US0378331005", 1.5)], "name string, cusip string, isin string, weight double")
    good, bad = holdings.split_constituents(rows)
    assert good.first()["cusip"] is None and sorted(r["reason"] for r in bad.collect()) == ["bad isin", "bad weight"]
    assert holdings.to_companies(good).first()["raw_name"] == "A"
    assert dedup.repeated_keys(rows, ["isin"]).first()["n"] == 2
    kind = "id int, position int, count int, declared int, after_click boolean"
    captures = spark.createDataFrame([(1, 0, 3000, 3000, False), (1, 1, 50, None, True), (2, 0, 10, None, False), (3, 0, 2600, 9999, True), (3, 1, 2700, None, True)], kind)
    assert {r["id"]: r["position"] for r in holdings.best_capture(captures, ["id"]).collect()} == {1: 1, 3: 1}
    done = spark.createDataFrame([(None, 2, 2601)], "w int, p int, d int").select(holdings.completeness(F.col("w"), F.col("p"), F.col("d"), 2).alias("c")).first()["c"]
    assert done["complete"] is False and done["reasons"] == ["declared_more"]


def test_archive(spark, tmp_path):
    paths = spark.createDataFrame([("/raw/0000000001/acc/x.txt",), ("/a/b/c/d.txt",)], "p string").select(archive.archive_path("/arc", F.col("p")).alias("q"))
    assert [r["q"] for r in paths.collect()] == ["/arc/0000000001/acc/x.txt", "/arc/b/c/d.txt"]
    (tmp_path / "x").write_bytes(b"abc")
    files = archive.checksums(spark.read.format("binaryFile").load(str(tmp_path)))
    found = files.first()
    assert found["sha256"] == hashlib.sha256(b"abc").hexdigest()
    expected = spark.createDataFrame([("o1", found["path"], found["sha256"]), ("o2", found["path"], "0"), ("o3", "gone", None)], "path string, archived_path string, sha256 string")
    assert {r["path"]: r["state"] for r in archive.verify_copies(expected, files).collect()} == {"o1": "good", "o2": "damaged", "o3": "missing"}
    gone = archive.orphans(expected.withColumnRenamed("path", "original_path"), expected.withColumnRenamed("path", "original_path").limit(0), files)
    assert [r["original_path"] for r in gone.collect()] == ["o1"]


def test_metrics(spark):
    rows = spark.createDataFrame([("m", "counter", "help", {"b": "2", "a": "1"}, 3.0), ("m", "counter", "help", {}, 1.0)], "name string, kind string, help string, labels map<string,string>, value double")
    assert [r["line"] for r in rollup.exposition(rows).collect()] == ["# HELP m help", "# TYPE m counter", "m 1.0", 'm{a="1",b="2"} 3.0']
    health = rollup.health(spark.createDataFrame([("2026-01-01 23:59:50",)], "t string").select(F.to_timestamp("t").alias("at")), 60, now()).first()
    assert health["status"] == "ok"


def test_sources(spark, tmp_path):
    atom = """<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>8-K - X CO (0000000077) (Filer)</title><link href="https://www.sec.gov/Archives/edgar/data/77/000000007726000001/0000000077-26-000001-index.htm"/>
    <summary type="html">&lt;b&gt;Filed:&lt;/b&gt; 2026-01-02 &lt;b&gt;AccNo:&lt;/b&gt; 0000000077-26-000001</summary><updated>2026-01-02T03:04:05-05:00</updated><category term="8-K/A"/></entry>
    <entry><title>4 - Nobody</title><summary>x</summary></entry></feed>"""
    got = feeds.atom_feed(spark.createDataFrame([("p", atom)], "page string, content string")).collect()
    assert [(r["accession"], r["cik"], r["form_type"], str(r["filing_date"]), r["company_name"]) for r in got] == [("0000000077-26-000001", "0000000077", "8-K/A", "2026-01-02", "X CO")]
    company = '{"cik":"77","name":"X","tickers":["x-1"],"formerNames":[{"name":"Y Inc"}],"filings":{"recent":{"accessionNumber":["0000000077-26-000001","0000000077-26-000002"],"filingDate":["2026-01-02"],"acceptanceDateTime":["2026-01-02T03:04:05.000Z"],"form":["8-K"],"primaryDocument":["a.htm"]},"files":[{"name":"f.json"},"g.json"]}}'
    payload = spark.createDataFrame([(company,)], "json string")
    rows = feeds.submissions(payload).orderBy("position").collect()
    assert [(r["form_type"], r["accepted_at"] is None) for r in rows] == [("8-K", False), ("UNKNOWN", True)]
    assert sorted(r["url"] for r in feeds.history_urls(payload).collect()) == ["https://data.sec.gov/submissions/f.json", "https://data.sec.gov/submissions/g.json"]
    assert feeds.profiles(payload).first()["names"] == ["X", "Y"]
    index = spark.createDataFrame([("CIK|Company Name|Form Type|Date Filed|Filename",), ("77|X|8-K|2026-01-02|edgar/data/77/0000000077-26-000001.txt",), ("77|X|8-K",)], "value string")
    assert feeds.company_index(index).count() == 1
    master = spark.createDataFrame([(f" 12 {'a' * 32} http://d/20240101000000.export.CSV.zip ",), ("junk",), ("",), ("5 nomd5 http://d/x",)], "value string")
    files = feeds.master_list(master)
    assert files.count() == 2
    found = incremental.discover_files(files.withColumn("list", F.lit("m")), spark.createDataFrame([("e", "m", r"/\d{14}\.export\.CSV\.zip$")], "feed string, list string, pattern string"))
    assert found.first()["interval_ts"] == "20240101000000"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x.csv", b"1\ta\r\n\n2\tb\xff\n")
    (tmp_path / "b.zip").write_bytes(b"PK broken")
    lines = feeds.read_archives(spark, str(tmp_path)).orderBy("line_no").collect()
    assert [(r["line_no"], r["line"]) for r in lines] == [(0, "1\ta"), (2, "2\tb�")]
    folder = tmp_path / "2026-03-30"
    folder.mkdir()
    (folder / "h.xlsx").write_bytes(tables.build_workbook([("A", "c", "US0378331005", 0.25), ("B & C", None, None, 1)], [["t"], [], [], ["Name", "CUSIP", "ISIN", "Weight"]]))
    held = tables.constituents(spark.read.format("binaryFile").load(str(folder))).collect()
    assert [(r["name"], r["isin"], r["weight"], r["as_of_date"]) for r in held] == [("A", "US0378331005", 0.25, "2026-03-30")]
    (tmp_path / "w.yaml").write_text("companies:\n- {cik: 1, ticker: A, name: One, aliases: [x]}\n- {cik: 1, ticker: B, name: Again}\n- {cik: bad, ticker: C, name: Three}\n- {ticker: D}\n")
    listed = tables.watchlist(spark, str(tmp_path / "w.yaml")).collect()
    assert [(r["cik"], r["name"]) for r in listed] == [("0000000001", "One")]
    (tmp_path / "e.yaml").write_text("companies: []\n")
    with pytest.raises(ValueError):
        tables.watchlist(spark, str(tmp_path / "e.yaml"))
    assert tables.write_companies(spark.createDataFrame([("A", "0000000001")], "name string, cik string"), str(tmp_path / "o.yaml")) == 1
    assert "cik: '0000000001'" in (tmp_path / "o.yaml").read_text()
    columns = spark.createDataFrame([('{"fields":["cik","name","ticker","exchange"],"data":[[77,"X","x","N"]]}',)], "json string")
    assert tables.entity_columns(columns).first()["cik"] == "0000000077"
    assert tables.name_lookup(spark.createDataFrame([("A: B CO:77:",), ("bad",)], "value string")).collect()[0]["name"] == "A: B CO"
    page = spark.createDataFrame([(1, '<a href="/cgi-bin/browse-edgar?action=x&CIK=77&o">X <b>Co</b></a>')], "company_id int, html string")
    assert tables.browse_results(page).first()["name"] == "X Co"
    json_rows = tables.holdings_payload(spark.createDataFrame([(1, '{"holdings":[{"name":"A","isin":"I","weight":25}]}')], "id int, json string"))
    assert json_rows.first()["weight"] == 0.25


def test_streams(spark, tmp_path):
    kind = "accession string, accepted_at timestamp"
    source = tmp_path / "in"
    put = lambda rows, n: spark.createDataFrame(rows, "accession string, t string").selectExpr("accession", "to_timestamp(t) AS accepted_at").coalesce(1).write.mode("append").parquet(str(source))
    put([("a", "2026-01-01 00:00:00"), ("b", "2026-01-02 00:00:00")], 0)
    state = jobs.Versions(spark, str(tmp_path / "state"), spark.createDataFrame([], "ts timestamp, boundary array<string>"))

    def poll():
        stream = spark.readStream.schema(kind).parquet(str(source))
        jobs.poll_feed(stream, state, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)

    poll()
    put([("b", "2026-01-02 00:00:00"), ("c", "2026-01-02 00:00:00"), ("old", "2025-01-01 00:00:00")], 1)
    poll()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("accession").collect()
    assert [(r["accession"], r["batch"]) for r in got] == [("a", 0), ("b", 0), ("c", 1)]
    assert state.read().first()["boundary"] == ["b", "c"]
    records = "feed string, record_key string, interval_ts string, file_id int, line_no int, document_id string, source_url string"
    spark.createDataFrame([("e", "1", "a", 1, 0, "d", "u"), ("e", "1", "a", 1, 1, "d", "v"), ("e", "2", "b", 1, 2, "d", "w")], records).write.parquet(str(tmp_path / "records"))
    known = jobs.Versions(spark, str(tmp_path / "known"), spark.createDataFrame([], "feed string, record_key string"))
    documents = jobs.Versions(spark, str(tmp_path / "documents"), spark.createDataFrame([], "document_id string, first_seen_interval_ts string, last_seen_interval_ts string, first_seen_feed string, last_seen_feed string, first_source_url string, last_source_url string, observations long"))
    jobs.ingest(spark.readStream.schema(records).parquet(str(tmp_path / "records")), known, documents, str(tmp_path / "check2")).awaitTermination(120)
    assert documents.read().first()["observations"] == 2 and documents.read().first()["last_source_url"] == "w"
    events = "event_id string, payload_hash string, committed_at string, created_at string, commit_seq long"
    spark.createDataFrame([("x", "h", None, "2026-01-01T00:00:00", 1), ("x", "h", None, "2026-01-01T00:00:00", 1)], events).write.parquet(str(tmp_path / "events"))
    jobs.publish_events(spark.readStream.schema(events).parquet(str(tmp_path / "events")), str(tmp_path / "log"), str(tmp_path / "check3")).awaitTermination(120)
    assert spark.read.json(str(tmp_path / "log")).count() == 1


def test_topk_and_lists(spark):
    rows = spark.createDataFrame([("a", i, None if i == 3 else float(i % 3)) for i in range(6)], "k string, i int, v double")
    assert [r["i"] for r in topk.largest_n(rows, ["k"], "v", ["i"], 3).orderBy("rank").collect()] == [2, 5, 1]
    work = spark.createDataFrame([("a", "backfill", 1), ("b", "live", 2), ("c", "live", 1)], "accession string, priority string, created_at int")
    assert [r["accession"] for r in topk.prioritised(work, 2).collect()] == ["c", "b"]
    cron = spark.createDataFrame([("30 4 * * 1",), ("bad",)], "c string").select(incremental.cron_weekday_hour(F.col("c")).alias("x")).collect()
    assert tuple(cron[0]["x"]) == (1, 4, 30) and tuple(cron[1]["x"]) == (6, 11, 0)


def test_commit(spark):
    filings = spark.createDataFrame([(a, "8-K", "queued", 1, None, None) for a in "abc"], "accession string, form_type string, retrieval_status string, attempts int, next_retry_at timestamp, primary_doc_path string")
    items = spark.createDataFrame([("a", "1.01"), ("b", "2.02"), ("c", "5.02")], "accession string, item string")
    empty = spark.createDataFrame([], "event_id string, subject string, accession string, payload_json string, payload_hash string, created_at string, commit_seq long")
    state = {"filings": filings, "items": items, "outbox": empty}
    bundles = spark.createDataFrame([("a", "/a.txt", "/a.htm", "t", "p"), ("b", "/b.txt", None, "t", None)], "accession string, raw_txt_path string, primary_doc_path string, txt_sha256 string, primary_sha256 string")
    done = commit.commit_filings(state, {"items": spark.createDataFrame([("a", "9.01")], "accession string, item string")}, bundles, now())
    assert sorted(map(tuple, done["items"].collect())) == [("a", "9.01"), ("c", "5.02")]
    assert {r["accession"]: (r["retrieval_status"], r["primary_doc_path"]) for r in done["filings"].collect()} == {"a": ("retrieved", "/a.htm"), "b": ("retrieved_partial", None), "c": ("queued", None)}
    assert sorted(r["subject"] for r in done["outbox"].collect()) == ["edgar.filing.retrieved", "edgar.filing.retrieved_partial"]
    again = commit.commit_filings({**done, "items": done["items"]}, {"items": spark.createDataFrame([("a", "9.01")], "accession string, item string")}, bundles, now())
    assert again["outbox"].count() == 2
    failed = commit.commit_failures(done, spark.createDataFrame([("c", "lost")], "accession string, error string"), now())
    assert failed["outbox"].where("subject = 'edgar.filing.failed'").first()["payload_json"].startswith('{"accession":"c","attempt":2')
    queued = retry.queue(failed["filings"], failed["filings"], now())
    assert {r["accession"]: r["retrieval_status"] for r in queued.collect()} == {"a": "queued", "b": "retrieved_partial", "c": "retrieval_failed"}
    assert retry.queue(failed["filings"], failed["filings"], now(), force=True).where("retrieval_status = 'queued'").count() == 3
    gate = filings.withColumn("relevance_state", F.lit("hdr_pending"))
    assert retry.header_failed(gate, filings.where("accession = 'a'"), now()).where("relevance_state = 'hdr_transient_fail' AND attempts = 2 AND next_retry_at > timestamp'2026-01-02'").count() == 1


def test_violations(spark):
    rows = spark.createDataFrame([("1", "0000000001"), ("1", "12"), (" ", None)], "id string, cik string")
    got = {r["rule"]: r["n"] for r in quality.violations(rows, ["id", "cik"], ["id"], 3, "cik").collect()}
    assert got == {"id is missing": 1, "cik is missing": 1, "cik isn't ten digits": 1, "id repeats": 1}
    assert quality.violations(rows.limit(1), ["id"], ["id"], 1).count() == 0


def test_copies(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"abc" * 200_000)
    good = hashlib.sha256(b"abc" * 200_000).hexdigest()
    plan = spark.createDataFrame([(str(tmp_path / "x"), str(tmp_path / "arc/a/x"), good), (str(tmp_path / "x"), str(tmp_path / "arc/y"), "0"), (str(tmp_path / "gone"), str(tmp_path / "arc/z"), None)], "path string, archived_path string, sha256 string")
    assert [r["state"] for r in archive.copy_files(plan.coalesce(1)).collect()] == ["copied", "damaged", "missing"]
    assert (tmp_path / "arc/a/x").read_bytes() == b"abc" * 200_000 and not (tmp_path / "arc/y").exists()
    first = plan.limit(1)
    assert archive.copy_files(first, remove=True).first()["state"] == "present" and not (tmp_path / "x").exists()
    assert archive.copy_files(first, remove=True).first()["state"] == "present"


def test_name_scores_use_variants(spark):
    companies = spark.createDataFrame([(1, "MUENCHENER RUECKVER AG-REG")], "company_id int, name string")
    names = spark.createDataFrame([(1, "x", "MUNCHENER RUCKVERSICHERUNGS"), (1, "y", "OTHER")], "company_id int, cik string, name string")
    got = {r["cik"]: r["score"] for r in resolve.best_name_scores(companies, names).collect()}
    assert got["x"] > 0.9 > got["y"]


def test_a_watermark_holds_few_keys(spark):
    at = datetime.datetime(2026, 1, 1)
    feed = spark.createDataFrame([(at, f"k{i}") for i in range(20)], "accepted_at timestamp, accession string")
    mark = spark.createDataFrame([(None, [])], "ts timestamp, boundary array<string>")
    assert len(incremental.advance_watermark(feed, mark, most=20).first()["boundary"]) == 20
    with pytest.raises(Exception, match="more than 19 keys"):
        incremental.advance_watermark(feed, mark, most=19).collect()


def test_pruned_similarity_keeps_what_reaches_the_least(spark):
    names = ["ALPHA BETA GAMMA", "ALPHA BETA GAMA", "BETA ALPHA", "ALPHA", "GAMMA BETA ALPHA", "DELTA", "", "ALPHA BETA GAMMA DELTA", "ALPHABETAGAMMA"]
    rows = spark.createDataFrame([(a, b) for a in names for b in names], "a string, b string")
    for least in (0.5, 0.78, 0.95):
        for r in rows.select(resolve.similarity(F.col("a"), F.col("b")).alias("x"), resolve.similarity(F.col("a"), F.col("b"), least).alias("y")).collect():
            assert r["x"] == r["y"] or r["y"] <= r["x"] < least


def test_pools_of_common_words_lose_no_candidate(spark, monkeypatch):
    """Names of few and of many frequent words, and of rare ones, against counting every pair."""
    import random

    monkeypatch.setattr(resolve, "RARE", 3)
    monkeypatch.setattr(resolve, "FEW", 3)
    dice = random.Random(4)
    names = {i: " ".join([*dice.choices("ABCDEFGH", k=dice.randint(1, 6)), *([f"R{i % 40}"] if i % 3 else [])]) for i in range(120)}
    rows = spark.createDataFrame(list(names.items()), "id int, norm string")
    got = {(r["company_id"], r["cik"], r["hits"]) for r in resolve.token_candidates(rows.withColumnRenamed("id", "company_id"), rows.withColumnRenamed("id", "cik"), pool=7).collect()}
    want = set()
    for i, a in names.items():
        hits = sorted((-len(set(a.split()) & set(b.split())), j) for j, b in names.items())
        want |= {(i, j, -n) for n, j in hits[:7] if n}
    assert got == want


def test_ratios_of_many_pairs_are_those_of_difflib():
    import difflib
    import random

    import numpy as np

    dice = random.Random(5)
    for letters, most in (("AB", 12), ("ABC D", 30), ("éß\U0001f600B ", 25), ("AB ", 230)):
        lefts, rights = (["".join(dice.choices(letters, k=dice.randint(0, most))) for _ in range(30)] for _ in range(2))
        one, two = (x.ravel() for x in np.meshgrid(np.arange(30), np.arange(30)))
        assert resolve.ratios(lefts, rights, one, two).tolist() == [difflib.SequenceMatcher(None, lefts[i], rights[j]).ratio() for i, j in zip(one, two, strict=True)]


def test_parsed_rows_are_passed_on_in_parts():
    """A batch of many documents never stands in memory with all its rows."""
    import pandas as pd

    from tidemark.plans.batches import parse_each

    class Docs:
        dtypes = [("path", "string"), ("content", "string")]
        select = lambda self, *_: self
        mapInPandas = lambda self, run, _: run  # noqa: E731, N815

    run = parse_each(Docs(), lambda _: ({"n": i} for i in range(4000)), "n int", key="path")
    sizes = [len(x) for x in run(iter([pd.DataFrame({"path": list("abcdef"), "content": "x"})]))]
    assert sum(sizes) == 24000 and max(sizes) <= 8000
