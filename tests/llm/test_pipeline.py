"""The pipeline against the same stages by brute force, and the registry."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tidemark.llm import curriculum, quality_knn, queries, stages
from tidemark.llm.common import table

from test_set_operators import brute_components
from test_text_operators import check_packing


def test_stages_by_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    scored = {r["doc_id"]: r["predicted"] for r in quality_knn.classify_quality(docs, table(spark, sf, "labels")).collect()}
    kept = stages.classify(spark, docs, sf)
    assert kept.columns == docs.columns
    assert Counter(kept.collect()) == Counter(r for r in docs.collect() if scored[r["doc_id"]])
    first = stages.deduplicate(spark, kept, sf)
    assert first.columns == docs.columns
    groups = brute_components([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert sorted(r["doc_id"] for r in first.collect()) == sorted(i for i, n, c in groups if i == c or n == 0)
    mixed = stages.mix(spark, first, sf)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["copies"] for r in curriculum.mix_sources(first, whole=True).collect()}
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in copies.items() if n})
    mixed = mixed.cache()
    check_packing(stages.pack(spark, mixed, sf).collect(), mixed.collect(), 2048)


def test_run_equals_its_stages(spark, sf):
    docs = table(spark, sf, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
    want = Counter((r["doc_id"], r["piece"], r["length"]) for r in corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect())
    assert Counter((r["doc_id"], r["piece"], r["length"]) for r in corpus_pipeline.run(spark, sf).collect()) == want


def test_stages_with_odd_documents(spark, odd_documents, no_documents, sf):
    docs = odd_documents.select("doc_id", "text", "lang", "source", "n_chars", "score")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf).count() >= 0
        assert stage(spark, no_documents, sf).count() == 0
    ids = Counter(r["doc_id"] for r in stages.deduplicate(spark, docs, sf).collect())
    assert ids == Counter([0, 1, 2, 3, 4, 7, 9, 10, None, 12, 13, 14, 15])


def test_rows_that_share_an_id_are_decided_one_by_one(spark, sf):
    """A row goes for its own text: (5, U) isn't lost with (5, T), and rows without an id are told apart too."""
    t, u, v = ("the same words stand in this text %s" % x for x in ("one", "two", "three"))
    kind = "doc_id long, text string, lang string, source string, n_chars long, id long, row long"
    rows = [(i, x, "en", s, len(x or ""), 1, 2) for i, x, s in ((3, t, "a"), (5, t, "a"), (5, u, "b"), (5, u, "b"), (None, u, "b"), (None, v, "a"), (None, v, "a"), (7, None, "a"), (7, None, "a"))]
    docs = spark.createDataFrame(rows, kind).repartition(3)
    kept = stages.deduplicate(spark, docs, sf)
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter([(3, t), (5, u), (None, v), (7, None), (7, None)])
    mixed = Counter((r["doc_id"], r["text"]) for r in stages.mix(spark, kept, sf).collect())
    want = Counter()
    for r in curriculum.mix_sources(kept.withColumn("k", F.xxhash64("text")), whole=True, keep=("k",)).join(kept.select(F.xxhash64("text").alias("k"), "text"), "k").collect():
        want[r["doc_id"], r["text"]] += r["copies"]
    assert mixed == +want and set(mixed) <= {(3, t), (5, u), (None, v)} and mixed[5, u] > 0
    again = stages.mix(spark, docs.where("text IS NOT NULL"), sf)
    assert again.columns == docs.columns and again.count() > 0


def test_registry():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 11)}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, sf, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    result = db.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    want = Counter(result.fetchall())
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want
