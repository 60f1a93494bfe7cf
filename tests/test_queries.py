"""Every query against its DuckDB oracle on the smallest tables."""

import difflib
import glob
import os
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.operators import resolve
from tidemark.queries import ORACLE_SQL, QUERIES


def plain(row):
    return tuple(round(x, 6) if isinstance(x, float) else x for x in row)


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    got = QUERIES[name](spark, sf)
    rows = got.collect()
    if name not in ORACLE_SQL:
        assert rows
        return
    result = db.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert Counter(plain(r[c] for c in columns) for r in rows) == Counter(plain(r) for r in result.fetchall())


def test_entry_imports():
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_name_similarity_searches_every_part(spark, sf):
    from tidemark.functions import text

    parts = spark.read.parquet(f"{sf}/part.parquet")
    norm = dict(parts.select("p_partkey", text.company_name(F.concat_ws(" ", "p_name", "p_brand", "p_type"))).collect())
    assert len(norm) <= resolve.POOL

    def score(a, b):
        one, two = set(a.split(" ")), set(b.split(" "))
        seq = difflib.SequenceMatcher(None, a, b).ratio()
        near = max(seq, 0.6 * seq + 0.4 * len(one & two) / max(1, min(len(one), len(two))))
        return 1.0 if a == b else min(1.0, near + (0.08 if a.startswith(b) or b.startswith(a) else 0.0))

    want = set()
    for i, a in norm.items():
        near = sorted((-score(a, b), j) for j, b in norm.items() if set(a.split(" ")) & set(b.split(" ")))[: resolve.NEAREST]
        want |= {(i, j, round(-s, 9)) for s, j in near}
    got = [(r["company_id"], r["cik"], round(r["similarity"], 9)) for r in QUERIES["name_similarity"](spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == want
