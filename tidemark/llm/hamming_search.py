"""Exact top-k search for binary codes, by incremental multi-index hashing.

Vectors become codes by the signs of their dimensions, cut into segments of 16 bits (32 where there are
more than `MANY` distinct codes). Distinct codes stand in a table under each of their segments' values.
Round r sends each open query to the values at Hamming distance r from its own segments: a join with that
table by segment and value, where a code found is verified by its whole distance. A pair counts in the
round of its nearest segment and in the first segment that is so near, so each is verified once and no
round looks at pairs again. After round r with m segments every code within m (r + 1) - 1 is found (else
each segment would differ in more than r bits), so a query closes when its kth verified distance is no
greater; the others go on, and what is farther than their kth so far is left out. Equal codes are searched
once and hold their k least ids; the first k codes by distance and least id hold the k nearest rows.

A round's rows are the open queries' probes and the codes under them; nothing is sent from every code to
every query. The index is broadcast if its counted rows are few, else it's joined by a shuffle whose large
values Spark splits.

Defined results: null vectors have no code: they are neither found nor searched; null, NaN and missing
dimensions are 0 bits; ties in distance go by id; repeated ids count as often as they stand there; fewer
than k vectors give all of them; an empty table gives an empty result. A query finds itself too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Work, cut

WORD = 64
#: Distinct codes beyond which segments have 32 bits.
MANY = 1 << 24
#: The most rows of the index (some 100 bytes each) that are broadcast.
INDEX_ROWS = 400_000


def sign_words(vectors: DataFrame, words: int) -> DataFrame:
    """id, asked, words (the code's bits as 64-bit numbers) of vectors that aren't null. vectors: id, asked, vector."""
    kind = dict(vectors.dtypes)["id"]

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bits = np.zeros((len(batch), WORD * words), bool)
            for i, v in enumerate(batch["vector"]):
                x = np.asarray(v, float)  # null is NaN, which isn't above 0
                bits[i, : len(x)] = x > 0
            codes = np.packbits(bits, axis=1).view(">i8").astype(np.int64)
            yield pd.DataFrame({"id": batch["id"], "asked": batch["asked"], "words": list(codes)})

    return vectors.mapInPandas(encode, f"id {kind}, asked boolean, words array<long>")


def segments_of(words: Column, bits: int, count: int) -> list[Column]:
    """The values of a code's segments."""
    out = []
    for at in range(0, bits * count, bits):
        word = F.get(words, F.lit(at // WORD))
        out.append(F.shiftrightunsigned(word, WORD - bits - at % WORD).bitwiseAND((1 << bits) - 1))
    return out


def probes(asked: DataFrame, bits: int, count: int, radius: int) -> DataFrame:
    """q, words, kth, segment, value: the values at distance `radius` of each segment of each query."""
    out = asked.select("q", "words", "kth", F.posexplode(F.array(*segments_of(F.col("words"), bits, count))).alias("segment", "value"))
    out = out.withColumn("top", F.lit(-1))
    for left in range(radius, 0, -1):  # flip one more bit above the last
        out = out.withColumn("top", F.explode(F.sequence(F.col("top") + 1, F.lit(bits - left))))
        out = out.withColumn("value", F.col("value").bitwiseXOR(F.expr("shiftleft(1L, top)")))
    return out.drop("top")


def verified(hits: DataFrame, bits: int, count: int, radius: int) -> DataFrame:
    """q, c, first, size, distance of probed codes whose nearest segment is this one. hits: probes with code and its columns."""
    parts = [F.bit_count(a.bitwiseXOR(b)) for a, b in zip(segments_of(F.col("words"), bits, count), segments_of(F.col("code"), bits, count), strict=True)]
    hits = hits.select("q", "c", "first", "size", "kth", "segment", *(p.alias(f"d{i}") for i, p in enumerate(parts)))
    near = lambda i: F.when(F.col("segment") > i, F.col(f"d{i}") > radius).otherwise(F.col(f"d{i}") >= radius)
    hits = hits.where(reduce(Column.__and__, [near(i) for i in range(count)]))
    distance = reduce(Column.__add__, [F.col(f"d{i}") for i in range(count)])
    hits = hits.select("q", "c", "first", "size", "kth", distance.cast("int").alias("distance"))
    return hits.where("kth IS NULL OR distance <= kth").drop("kth")


def nearest_codes(asked: DataFrame, codes: DataFrame, n_codes: int, k: int, bits: int, count: int, work: Work) -> DataFrame:
    """q, c, distance: the first k codes of each query by distance and least id. asked: q, words; codes: c, code, first, size."""
    index = work.keep(codes.select("c", "first", "size", "code", F.posexplode(F.array(*segments_of(F.col("code"), bits, count))).alias("segment", "value")))
    # probes are never broadcast: Spark takes the few queries that they are made from for their number
    index = F.broadcast(index) if n_codes * count <= INDEX_ROWS else index.hint("merge")
    best, waiting = None, asked.withColumn("kth", F.lit(None).cast("int"))
    order = Window.partitionBy("q").orderBy("distance", "first", "c")
    for radius in range(bits + 1):
        found = verified(probes(waiting, bits, count, radius).join(index, ["segment", "value"]), bits, count, radius)
        both = found if best is None else best.unionByName(found)
        before = best
        best, _ = work.sized(both.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place"))
        if before is not None:
            work.drop(before)
        so_far = best.withColumn("rows", F.sum("size").over(order)).groupBy("q").agg(F.min(F.when(F.col("rows") >= k, F.col("distance"))).alias("kth"), F.count("*").alias("codes"))
        covered = count * (radius + 1) - 1
        rest = waiting.select("q", "words").join(so_far, "q", "left").where(f"(kth IS NULL OR kth > {covered}) AND coalesce(codes, 0) < {n_codes}")
        waiting, left = work.sized(rest.select("q", "words", "kth"))
        if not left:
            break
    return best


def top_k(vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", bits: int | None = None) -> DataFrame:
    """query_id, rank (from 1), the id and the distance of the k nearest codes of each query. bits: of a segment (8, 16 or 32)."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asked")).where("vector IS NOT NULL AND id IS NOT NULL")
    widest = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    with Work(vectors.sparkSession, "hamming") as work:
        rows = work.keep(sign_words(rows, -(-widest // WORD)))
        nth = F.row_number().over(Window.partitionBy("words").orderBy("id"))
        few = rows.select("words", "id").withColumn("nth", nth).where(F.col("nth") <= k)
        ids = few.groupBy(F.col("words").alias("code")).agg(F.sort_array(F.collect_list("id")).alias("ids"))
        codes, n = work.sized(ids.select(F.monotonically_increasing_id().alias("c"), "code", "ids", F.get("ids", F.lit(0)).alias("first"), F.size("ids").alias("size")))
        asked, _ = work.sized(rows.where("asked").select("words").distinct().select(F.monotonically_increasing_id().alias("q"), "words"))
        bits = bits or (16 if n <= MANY else 32)
        best = nearest_codes(asked, codes.drop("ids"), n, k, bits, -(-widest // bits), work)
        near = best.join(codes.select("c", "ids"), "c").select("q", "distance", F.explode("ids").alias("id"))
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", "id"))).where(F.col("rank") <= k)
        each = rows.where("asked").select(F.col("id").alias("query_id"), "words").join(asked, "words").select("query_id", "q")
        return cut(each.join(near, "q").select("query_id", "rank", F.col("id").alias(id_col), "distance"))
