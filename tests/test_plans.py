"""Extraction plans on handmade filings."""

import io
import zipfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.plans import fund, ownership, reports, submission, thirteen_f, xbrl
from tidemark.plans.batches import number, parse_each, whole
from tidemark.sources import tables

OWNERS = "".join(f"<reportingOwner><reportingOwnerId><rptOwnerCik>{i}</rptOwnerCik><rptOwnerName>Owner {i}</rptOwnerName></reportingOwnerId><reportingOwnerRelationship><isDirector>{i % 2}</isDirector></reportingOwnerRelationship></reportingOwner>" for i in (1, 2))
FORM4 = """<ownershipDocument{ns}><issuer><issuerCik>0000000009</issuerCik><issuerName>X Co</issuerName><issuerTradingSymbol>X</issuerTradingSymbol></issuer>{owners}
<nonDerivativeTable><nonDerivativeTransaction><securityTitle><value>Common</value></securityTitle><transactionDate><value>2026-01-02</value></transactionDate>
<transactionCoding><transactionCode>P</transactionCode></transactionCoding><transactionAmounts><transactionShares><value>100</value></transactionShares>
<transactionPricePerShare><footnoteId id="F1"/></transactionPricePerShare><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode></transactionAmounts>
<postTransactionAmounts><sharesOwnedFollowingTransaction><value>500</value></sharesOwnedFollowingTransaction></postTransactionAmounts>
<ownershipNature><directOrIndirectOwnership><value>D</value></directOrIndirectOwnership></ownershipNature></nonDerivativeTransaction>
<nonDerivativeHolding><securityTitle><value>Common</value></securityTitle><ownershipNature><natureOfOwnership><value>By trust</value></natureOfOwnership></ownershipNature></nonDerivativeHolding></nonDerivativeTable>
<footnotes><footnote id="F1"> note </footnote></footnotes></ownershipDocument>"""


def docs(spark, *contents):
    return spark.createDataFrame([(f"a{i}", c) for i, c in enumerate(contents)], "accession string, content string")


def test_ownership(spark):
    rows = ownership.ownership_rows(docs(spark, FORM4.format(ns="", owners=OWNERS), FORM4.format(ns=' xmlns="urn:x"', owners=""), "<broken", None)).collect()
    first = [r for r in rows if r["accession"] == "a0"]
    assert len(first) == 4 and {r["reporting_owner_name"] for r in first} == {"Owner 1", "Owner 2"} and [r["is_director"] for r in first if r["kind"] == "holding"] == [True, False]
    t = first[0]
    assert (t["shares"], t["price_per_share"], t["shares_owned_after"], t["acquired_disposed"], t["transaction_date"], t["is_derivative"]) == (100.0, None, 500.0, "A", "2026-01-02", False)
    second = [r for r in rows if r["accession"] == "a1"]
    assert len(second) == 2 and second[0]["reporting_owner_cik"] is None and second[1]["nature_of_ownership"] == "By trust"
    assert ownership.footnote_rows(docs(spark, FORM4.format(ns="", owners=""))).first()["text"] == "note"


def test_institutional_holdings(spark):
    entry = "<infoTable><nameOfIssuer>A</nameOfIssuer><cusip>1</cusip><value>1,200</value><shrsOrPrnAmt><sshPrnamt>10</sshPrnamt><sshPrnamtType>SH</sshPrnamtType></shrsOrPrnAmt><votingAuthority><Sole>1,0</Sole><Shared>x</Shared><None>0</None></votingAuthority></infoTable>"
    rows = thirteen_f.holding_rows(docs(spark, f"<informationTable xmlns='urn:t'><periodOfReport>03-31-2026</periodOfReport>{entry}{entry.replace('1,200', '')}</informationTable>", entry, "<x/>")).orderBy("accession", "position").collect()
    assert [(r["accession"], r["value_thousands"], r["report_period"]) for r in rows] == [("a0", 1200.0, "2026-03-31"), ("a0", None, "2026-03-31"), ("a1", 1200.0, None)]
    assert (rows[0]["voting_sole"], rows[0]["voting_shared"], rows[0]["voting_none"]) == (10, None, 0)
    assert [thirteen_f.iso_period(x) for x in ("2026-03-31", "20260331", "03312026", "Q1", None)] == ["2026-03-31", "2026-03-31", "2026-03-31", "Q1", None]
    headers = spark.createDataFrame([("a0", "13F-NT/A", "1", "F", "20260331", "2026-05-01"), ("a1", "13F-HR", "1", "F", "20260331", "2026-05-01")], "accession string, form_type string, filer_cik string, filer_name string, period string, filing_date string")
    notice = thirteen_f.notices(headers).collect()
    assert len(notice) == 1 and notice[0]["is_amendment"] and notice[0]["report_period"] == "2026-03-31"


def test_funds(spark):
    xml = "<e xmlns='urn:n'><genInfo><seriesId>S1</seriesId><repPd>2026-03-31</repPd></genInfo><fundInfo><totAssets>1,5</totAssets></fundInfo><invstOrSecs><invstOrSec><name>A</name><valUSD>10</valUSD><isRestrictedSec>Y</isRestrictedSec><debtSec><maturityDt>2030-01-01</maturityDt><couponKind><couponRate>2.5</couponRate></couponKind></debtSec></invstOrSec></invstOrSecs></e>"
    page = "<table><tr><td>Series Name:</td><td>Big <b>Fund</b></td></tr><tr><td>Net Assets</td><td>1,000</td></tr></table><table><tr><th>Name</th><th>CUSIP</th><th>Value</th></tr><tr><td>B</td><td>2</td><td>3,0</td></tr><tr><td></td><td></td><td></td></tr><tr><td>C</td><td>3</td><td>1</td></tr></table>"
    source = docs(spark, xml, page, "<other/>", page.replace("Series Name", "Nothing"))
    filings = {r["accession"]: r for r in fund.fund_filings(source).collect()}
    assert set(filings) == {"a0", "a1"} and filings["a0"]["total_assets"] == 15.0 and filings["a1"]["series_name"] == "Big Fund" and filings["a1"]["holding_count"] == 1
    held = {r["accession"]: r for r in fund.fund_holdings(source).collect()}
    assert (held["a0"]["coupon_rate"], held["a0"]["maturity_date"], held["a0"]["is_restricted"]) == (2.5, "2030-01-01", True) and held["a1"]["value_usd"] == 30.0


INSTANCE = """<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:g="http://fasb.org/us-gaap/2025" xmlns:dei="http://xbrl.sec.gov/dei/2025" xmlns:o="http://own">
<context id="c1"><entity><segment><explicitMember dimension="d">m</explicitMember></segment></entity><period><startDate>2026-01-01</startDate><endDate>2026-03-31</endDate></period></context>
<g:Assets contextRef="c1" unitRef="USD" decimals="-3">(1,000)</g:Assets><g:Empty contextRef="c1"/><dei:CurrentFiscalYearEndDate contextRef="c9">--12-31</dei:CurrentFiscalYearEndDate>
<dei:DocumentPeriodEndDate contextRef="c1">2026-03-31</dei:DocumentPeriodEndDate><o:X contextRef="c1">1</o:X></xbrl>"""
INLINE = """<html><body><xbrli:context id="c1"><xbrli:period><xbrli:instant>2026-03-31</xbrli:instant></xbrli:period></xbrli:context>
<p><ix:nonFraction name="us-gaap:Revenue" contextRef="c1" scale="6" sign="-">1<b>2.5</b><br></ix:nonFraction> after</p>
<ix:nonNumeric name="dei:Note" contextRef="c1" continuedAt="k1">One</ix:nonNumeric><ix:continuation id="k1" continuedAt="k2">two</ix:continuation><ix:continuation id="k2">three</ix:continuation>
<ix:nonNumeric name="own:Skip" contextRef="c1">x</ix:nonNumeric></body></html>"""


def test_facts(spark):
    source = docs(spark, INSTANCE, INLINE, "nothing")
    rows = xbrl.fact_rows(source)
    got = {(r["accession"], r["concept"]): r for r in rows.collect()}
    assert set(got) == {("a0", "us-gaap:Assets"), ("a0", "dei:CurrentFiscalYearEndDate"), ("a0", "dei:DocumentPeriodEndDate"), ("a1", "us-gaap:Revenue"), ("a1", "dei:Note")}
    a = got["a0", "us-gaap:Assets"]
    assert (a["numeric_value"], a["period_end"], a["segment"], a["unit"]) == (-1000.0, "2026-03-31", "d=m", "USD")
    assert got["a0", "dei:CurrentFiscalYearEndDate"]["period_end"] is None
    assert got["a1", "us-gaap:Revenue"]["value"] == "-12500000" and got["a1", "us-gaap:Revenue"]["period_instant"] == "2026-03-31"
    assert got["a1", "dei:Note"]["value"] == "One two three"
    filings = spark.createDataFrame([("a0", "2026-05-01"), ("a1", "2026-05-02")], "accession string, filing_date string")
    assert dict(map(tuple, xbrl.report_periods(rows, filings).collect())) == {"a0": "2026-03-31", "a1": "2026-05-02"}
    assert xbrl.key_facts(rows, ("us-gaap:Rev", "dei:"), 1).count() == 2


def test_current_reports(spark):
    body = "<p>Item 2.02 Results</p><p>Item 2.02 again, Item 99.99, Item&nbsp;x</p><div>Item 9.01</div><p>EPS of $1.25. Total revenue rose to $2.5 billion. Net loss was $3 K. Outlook: we expect $10 million.</p> A dividend of $ 0.50 per share"
    headers = spark.createDataFrame([("a0", 0, "Item 5.02 Departure"), ("a0", 1, "Results of Operations and Financial Condition"), ("a0", 2, "Reg FD"), ("a0", 3, "Nothing known"), ("a0", 4, "Item 5.02")], "accession string, position int, line string")
    bodies = spark.createDataFrame([("a0", body)], "accession string, body string")
    items = [r["item_number"] for r in reports.report_items(headers, bodies).orderBy("part", "position").collect()]
    assert items == ["5.02", "2.02", "7.01", "unknown", "9.01"]
    facts = {r["fact_type"]: r for r in reports.report_facts(bodies.withColumn("items", F.array(F.lit("2.02"), F.lit("9.01")))).collect()}
    assert {k: r["fact_numeric"] for k, r in facts.items()} == {"earnings_eps": 1.25, "revenue": 2.5e9, "net_income": 3e3, "guidance": 10e6, "dividend": 0.5}
    assert facts["dividend"]["item_number"] == "2.02" and facts["earnings_eps"]["fact_value"] == "1.25"
    changed = spark.createDataFrame([("a1", "Ms X was appointed as Chief Executive Officer. Purchase price of $ 7 M", ["5.02", "2.01"])], "accession string, body string, items array<string>")
    assert {(r["fact_type"], r["fact_value"]) for r in reports.report_facts(changed).collect()} >= {("management_change", "true")}


def test_beneficial_owners(spark):
    rows = [
        ("a0", "SC 13D/A", "CUSIP No. 123456789 DATE OF EVENT which requires: March 3, 2026 AMENDMENT NO. 4 Percent of class represented: 5.25 % aggregate number 1,000", [("subject-company", "1", "S"), ("filed-by", "2", "F")]),
        ("a1", "SC 13G", "owns 7.5% of the outstanding stock", [("filer", "3", "G")]),
    ]
    got = {r["accession"]: r for r in reports.beneficial_owners(spark.createDataFrame(rows, "accession string, form_type string, body string, parties array<struct<role:string,cik:string,name:string>>")).collect()}
    a, b = got["a0"], got["a1"]
    assert (a["filer_name"], a["subject_name"], a["subject_cusip"], a["date_of_event"], a["ownership_percent"], a["shares_beneficially_owned"], a["amendment_number"]) == ("F", "S", "123456789", "March 3, 2026", 5.25, 1000.0, 4)
    assert (b["filer_cik"], b["subject_cik"], b["ownership_percent"], b["is_amendment"], b["amendment_number"]) == ("3", None, 7.5, False, None)


SUBMISSION = """<SEC-HEADER><ACCEPTANCE-DATETIME>20260102030405
CONFORMED SUBMISSION TYPE:\t8-K
CONFORMED PERIOD OF REPORT:\t20251231
FILED AS OF DATE:\t20260102
ITEM INFORMATION:\t\tOther Events
FILER:

\tCOMPANY CONFORMED NAME:\t\tX CO
\tCENTRAL INDEX KEY:\t\t77
SUBJECT COMPANY:
\tCOMPANY CONFORMED NAME:\t\tY CO
</SEC-HEADER>
<DOCUMENT><TYPE>EX-99
<SEQUENCE>2
<FILENAME>ex.htm
<TEXT>ex</TEXT></DOCUMENT>
<DOCUMENT><TYPE>8-K
<SEQUENCE>1
<FILENAME>Main.htm
<TEXT><XBRL>
<p>body</p></XBRL>
</TEXT></DOCUMENT>"""


def test_submissions(spark):
    source = docs(spark, SUBMISSION, "<FILER>\nCOMPANY CONFORMED NAME: Z\n<ISSUER>\nCENTRAL INDEX KEY: 5\n", "COMPANY CONFORMED NAME: Only\n")
    head = submission.header_fields(source).orderBy("accession").first()
    assert (head["form_type"], head["acceptance_datetime"], head["filed_as_of_date"], head["period"], head["items"]) == ("8-K", "20260102030405", "20260102", "20251231", ["Other Events"])
    parties = [tuple(r) for r in submission.party_rows(source).orderBy("accession", "position").select("accession", "role", "cik", "name").collect()]
    assert parties == [("a0", "filer", "0000000077", "X CO"), ("a0", "subject-company", None, "Y CO"), ("a1", "filer", None, "Z"), ("a1", "issuer", "0000000005", None), ("a2", "filer", None, "Only")]
    documents = submission.document_rows(source)
    headers = spark.createDataFrame([("a0", "8-K", None)], "accession string, form_type string, preferred string")
    chosen = submission.primary_from_header(documents, headers)
    assert chosen.first()["filename"] == "Main.htm"
    assert submission.document_bodies(source.join(chosen, "accession")).first()["body"] == "<p>body</p>"


def test_instances(spark):
    document = lambda kind, name, told, body: f"<DOCUMENT><TYPE>{kind}\n<FILENAME>{name}\n<DESCRIPTION>{told}\n<TEXT>\n{body}\n</TEXT></DOCUMENT>"
    facts = "<?xml version='1.0'?><xbrli:xbrl>1</xbrli:xbrl>"
    primary = document("10-K", "main.xml", "10-K", facts)
    source = docs(
        spark,
        primary + document("EX-99", "first.xml", "x", "<other/>") + document("EX-99", "facts.xml", "x", facts),  # by content
        primary + document("EX-99", "early.xml", "x", facts) + document("OTHER", "told.txt", "XBRL Instance Document", facts),  # by description
        primary + document("EX-101.INS", "no.xml", "x", "<empty/>") + document("EX-101.INS", "yes.xml", "x", facts),  # stated, but verified
        primary + document("EX-101.SCHEMA", "a.xml", "x", facts) + document("XML", "a_ref.xml", "x", facts) + document("XSLT", "b.xml", "x", facts),  # none
    )
    first = spark.createDataFrame([(f"a{i}", "MAIN.xml") for i in range(4)], "accession string, filename string")
    assert dict(submission.xbrl_instance(source, first).collect()) == {"a0": "facts.xml", "a1": "told.txt", "a2": "yes.xml"}
    assert dict(submission.xbrl_instance(source, first.limit(0)).collect()) == {"a0": "main.xml", "a1": "told.txt", "a2": "yes.xml", "a3": "main.xml"}


def test_parts_are_those_of_the_single_operators(spark):
    document = lambda kind, name, told, body, seq="": f"<DOCUMENT><TYPE>{kind}\n{seq}<FILENAME>{name}\n<DESCRIPTION>{told}\n<TEXT>\n{body}\n</TEXT></DOCUMENT>"
    head, table, facts = "CONFORMED SUBMISSION TYPE: 13F-HR\n", document("INFORMATION TABLE", "info.xml", "x", "<t/>"), document("EX-101.INS", "i.xml", "x", "<xbrl>1</xbrl>")
    source = docs(
        spark,
        head + document("EX-99", "a.htm", "x", "a") + document("13F-HR", "Main.HTM", "x", "<XML>m</XML>") + table + facts,
        document("EX-99", "a.pdf", "x", "a", "<SEQUENCE>1\n") + document("EX-98", "b.txt", "x", "b", "<SEQUENCE>002\n") + document("EX-97", "c.txt", "x", "c", "<SEQUENCE>001\n"),
        head + table + table + document("13F-HR", "info.xml", "infotable", "again"),
        head + document("13F-HR", "p.pdf", "x", "p") + document("X", "pick.bin", "x", "picked") + "<DOCUMENT><TYPE>INFO TABLE\n<TEXT>no name</TEXT></DOCUMENT>" + table,
        "<DOCUMENT><TEXT>neither name nor type</TEXT></DOCUMENT>", "no documents", "", None,
    )
    headers = submission.header_fields(source).withColumn("preferred", F.when(F.col("accession") == "a3", "PICK.bin"))
    rows = submission.document_rows(source)
    primary = submission.primary_from_header(rows, headers)
    want = headers.select("accession").join(primary.withColumnRenamed("filename", "primary"), "accession", "left")
    for name, found in (("info", submission.info_table(rows, primary)), ("instance", submission.xbrl_instance(source, primary)), ("body", submission.document_bodies(source.join(primary, "accession")))):
        want = want.join(found.toDF("accession", name), "accession", "left")
    got = submission.parts(headers.join(source, "accession"), "accession")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.columns == want.columns


def test_submission_parts_reads_each_text_once(spark, sf):
    from tidemark.source_queries import submission_parts

    plan = submission_parts(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_index_pages(spark):
    row = "<tr><td>{0}</td><td>d</td><td><a href='/Archives/edgar/data/1/{1}'>{1}</a></td><td>{2}</td><td>9</td></tr>"
    page = "<table><tr><th>Seq</th></tr>" + row.format(1, "xslF345/a.xml", "4") + row.format(2, "a.xml", "4") + row.format(3, "x.jpg", "GRAPHIC") + "</table><a href='/Archives/edgar/data/1/a.xml'>again</a>"
    base = "https://www.sec.gov/Archives/edgar/data/1/x-index.html"
    pages = spark.createDataFrame([("a0", page, base)], "accession string, content string, base string")
    links = submission.link_rows(pages)
    assert links.count() == 3
    rows = submission.index_document_rows(pages).withColumn("url", F.concat(F.lit("https://www.sec.gov"), "href"))
    headers = spark.createDataFrame([("a0", "4")], "accession string, form_type string")
    assert submission.primary_from_index(links, rows, headers).first()["primary_url"].endswith("/1/a.xml")


@pytest.mark.parametrize("content", ["", "<a", "plain", "<html><body>"])
def test_malformed_documents_give_no_rows(spark, content):
    source = docs(spark, content)
    for plan in (ownership.ownership_rows, thirteen_f.holding_rows, fund.fund_filings, xbrl.fact_rows, submission.document_rows):
        assert plan(source).count() == 0


def test_odd_values_lose_only_their_document(spark):
    """Scales, numbers, sections and workbooks that can't be read give no value or no row, and the other documents stay."""
    fact = "<html><ix:nonFraction name='us-gaap:A' contextRef='c' scale='{}' sign='-'>{}</ix:nonFraction></html>"
    odd = [fact.format("999", "5"), fact.format("-999", "5"), fact.format("3", "nan"), fact.format("x", "inf"), "<![foo[bar]]>" + fact.format("0", "7"), "<![", "<!", "\x00", fact.format("3", "2")]
    got = {r["accession"]: r["numeric_value"] for r in parse_each(docs(spark, *odd), xbrl.facts, xbrl.FACT).collect()}
    assert got["a4"] == -7 and got["a8"] == -2000 and got["a2"] is None and got["a3"] is None
    assert [whole(x) for x in ("²", "+-5", "٣", "1,000", "+7", "9" * 19, "")] == [None, None, None, 1000, 7, None, None]
    assert [number(x) for x in ("nan", "inf", "1e999", "1_0", "-2.5")] == [None, None, None, None, -2.5]

    def fails(content):
        yield {"x": "first"}
        raise RuntimeError(content)

    assert parse_each(docs(spark, "a"), fails, "x string").count() == 0
    good = tables.build_workbook([("A", None, "US1", 0.25), (None, "c", None, 30)], [["h"]] * 4, {"k": 1, "d": None})
    parts = zipfile.ZipFile(io.BytesIO(good))

    def without(name, raw=None):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for n in parts.namelist():
                if n != name or raw is not None:
                    z.writestr(n, raw if n == name else parts.read(n))
        return out.getvalue()

    files = [good, b"PK", without("xl/workbook.xml"), without("xl/workbook.xml", "<broken"), without("xl/worksheets/sheet1.xml", "<broken"), without("xl/_rels/workbook.xml.rels"), None]
    books = spark.createDataFrame([(f"/1998-03-31/{i}.xlsx", f) for i, f in enumerate(files)], "path string, content binary")
    assert Counter(r["path"][12] for r in tables.constituents(books).collect()) == {"0": 1, "5": 1}
    rows = {r["path"][12]: r for r in tables.workbook_summaries(books).collect()}
    assert set(rows) == {"0", "5"} and rows["0"]["sheet_names"] == ["Holdings", "Metadata"] and rows["0"]["metadata"] == {"k": "1", "d": None}
    assert (rows["0"]["data_row_count"], rows["0"]["weight_sum_percent"], rows["0"]["sample_names"], rows["0"]["file_size_bytes"]) == (2, 55.0, ["A", "None"], len(good))


def test_index_rows_without_sequence_and_type(spark):
    cells = "<tr><td>{}</td><td>{}</td><td><a href='/x'>{}</a></td><td>{}</td><td></td></tr>"
    page = cells.format("&nbsp;", "all", "a.txt", "&nbsp;") + cells.format(" ", "", "", "") + cells.format("", "d", "b.htm", "8-K") + cells.format("2", "", "", "&#160;")
    rows = submission.index_document_rows(docs(spark, page)).orderBy("position").collect()
    assert [(r["position"], r["sequence"], r["description"], r["filename"], r["doc_type"], r["size"]) for r in rows] == [(0, None, "d", "b.htm", "8-K", None), (1, "2", None, None, None, None)]
