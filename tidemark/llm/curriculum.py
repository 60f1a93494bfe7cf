"""Mixing sources to target weights along a curriculum.

Targets: sources in code point order weigh 5, 2, 1, repeating, and share 150 % of all words; no source
gives more than twice its words, what is above is shared among the others by weight. Each source has a
weight schedule over training time 0..1, piecewise linear, normalised to the source's target; its
integral is the source's cumulative demand. Documents stand in a pseudo-random order within their source;
the demand, inverted at the words before a document, gives the document's training position, and the
documents are range-sorted by position. Words before a document come from two levels of sums, buckets
of the order and rows of a bucket, so that a source with a third of all rows is spread over many tasks.

Defined results: null and empty texts have size 0 and are never taken; a null source is a source of its
own, the last; rows without an id are ordered by a hash of their text; repeated rows are mixed each; equal order keys
go by id; an empty table gives an empty result; reruns agree. More than `MAX_SOURCES` sources are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, parallelism

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
#: Weight schedules as knots (time, weight), repeating over the sources: steady, rising, falling.
SCHEDULES = (((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.5), (1.0, 0.5)))
MAX_SOURCES = 100_000


def share_targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: int = MOST) -> list[float]:
    """Shares of the total by weight, none above `most` times its size; what is above goes to the others by weight."""
    order = sorted(range(len(sizes)), key=lambda i: most * sizes[i] / weights[i])
    left, weight = total, float(sum(weights))
    level = 0.0
    for i in order:  # the least roomy sources fill up first
        level = left / weight
        if most * sizes[i] >= level * weights[i]:
            break
        left -= most * sizes[i]
        weight -= weights[i]
    return [min(float(most * sizes[i]), level * weights[i]) for i in range(len(sizes))]


class Demand:
    """Cumulative demand of a schedule, as a share of the whole, and its inverse."""

    def __init__(self, knots: Sequence[tuple[float, float]]) -> None:
        self.t, self.w = (np.array(x, float) for x in zip(*knots, strict=True))
        parts = np.diff(self.t) * (self.w[1:] + self.w[:-1]) / 2
        self.whole = parts.sum()
        self.before = np.concatenate([[0.0], np.cumsum(parts)])

    def time(self, share: np.ndarray) -> np.ndarray:
        """The time at which a share of the demand has passed."""
        y = np.clip(share, 0, 1) * self.whole
        k = np.clip(np.searchsorted(self.before, y, side="right") - 1, 0, len(self.t) - 2)
        a, slope = self.w[k], (self.w[k + 1] - self.w[k]) / (self.t[k + 1] - self.t[k])
        rest = y - self.before[k]
        root = a + np.sqrt(np.maximum(a * a + 2 * slope * rest, 0))
        return self.t[k] + np.divide(2 * rest, root, out=np.zeros_like(rest), where=root > 0)


def measure(docs: DataFrame, id_col: str, text_col: str, source_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """id, source, size and the columns to keep of each row."""
    kinds = dict(docs.dtypes)
    extra = "".join(f", `{c}` {kinds[c]}" for c in keep)

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # bytes.split() separates at 0x20 and 0x09-0x0D, as the contract's words do
            batch["size"] = np.array([0 if t is None else len(t.encode("utf-8", "surrogatepass").split()) for t in batch["text"]], "int64")
            yield batch.drop(columns="text")

    # ids travel as text: whole numbers with nulls would become floating point
    other = f"CASE WHEN `{id_col}` IS NULL THEN md5(coalesce(`{text_col}`, '')) END AS other"  # rows without an id go by their text
    rows = docs.selectExpr(f"CAST(`{id_col}` AS string) AS id", other, f"`{source_col}` AS source", *(f"`{c}`" for c in keep), f"`{text_col}` AS text")
    return rows.mapInPandas(words, f"id string, other string, source string{extra}, size long").withColumn("id", F.col("id").cast(kinds[id_col]))


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    whole: bool = False,
    seed: str = "mix",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row, sorted by position: id, size, source_size, target, taken, copies, position, and the columns named in `keep` (long, not null).

    taken: words that the mix takes; with `whole`, documents are taken whole, else the last one of a
    source may be taken in part. copies: how often the document is taken whole. position: training time
    0..1 of the first copy, null if none is taken.
    """
    spark = docs.sparkSession
    rows = cut(measure(docs, id_col, text_col, source_col, keep))
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows")).limit(MAX_SOURCES + 1).collect()
    if len(per_source) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    per_source.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    n = len(per_source)
    sizes = [r["source_size"] for r in per_source]
    targets = share_targets(sizes, [weights[i % len(weights)] for i in range(n)], share * sum(sizes)) if sum(sizes) else [0.0] * n
    group = min(100_000, max(256, sum(r["rows"] for r in per_source) // (8 * parallelism(spark))))
    known = spark.createDataFrame(
        [(i, r["source"], sizes[i], targets[i], int(np.floor(targets[i] + 0.5)), -(-r["rows"] // group)) for i, r in enumerate(per_source)],
        "s int, source string, source_size long, target double, demand long, buckets long",
    )
    known = known.withColumnRenamed("source", "known")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.col("other"))))
    keyed = rows.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("known"))).drop("source", "known").withColumn("key", key).drop("other")
    # buckets are ranges of the order, as the key's first eight digits are a number
    bucket = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("buckets") / F.lit(2.0**32))
    keyed = keyed.withColumn("bucket", bucket)
    sums = keyed.groupBy("s", "bucket").agg(F.sum("size").alias("sum"))
    before = sums.withColumn("base", F.sum("sum").over(Window.partitionBy("s").orderBy("bucket")) - F.col("sum")).drop("sum")
    within = Window.partitionBy("s", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed.withColumn("own", F.sum("size").over(within) - F.col("size")).join(before, ["s", "bucket"]).withColumn("before", F.col("base") + F.col("own"))
    full = F.when(F.col("source_size") > 0, F.expr("demand div source_size")).otherwise(0)
    rest = F.col("demand") - F.col("full") * F.col("source_size") - F.col("before")
    extra = F.when(F.col("size") <= 2 * rest, F.col("size")).otherwise(0) if whole else F.greatest(F.lit(0), F.least("size", rest))
    placed = placed.withColumn("full", full).withColumn("extra", extra).withColumn("taken", F.col("full") * F.col("size") + F.col("extra"))
    copies = F.when(F.col("size") > 0, F.expr("taken div size")).otherwise(0).cast("int")
    first = F.when(F.col("full") > 0, F.col("size")).otherwise(F.col("extra"))
    passed = F.when(F.col("taken") > 0, (F.col("before") + first / 2.0) / F.col("demand"))
    placed = placed.withColumn("copies", copies).withColumn("passed", passed)
    kind, extra = dict(docs.dtypes)[id_col], "".join(f", `{c}` long" for c in keep)
    # ids travel as text: whole numbers with nulls would become floating point
    timed = placed.select(F.col("id").cast("string").alias("id"), "s", "size", "source_size", "target", "taken", "copies", "passed", *keep).mapInPandas(
        timing(schedules), f"id string, size long, source_size long, target double, taken long, copies int{extra}, position double"
    )
    timed = timed.withColumn("id", F.col("id").cast(kind))
    # NaN would sort last and stay NaN: untaken rows get null
    timed = timed.withColumn("position", F.when(F.col("taken") > 0, F.round("position", 6)))
    # the hash parts the rows that have no position
    return timed.withColumnRenamed("id", id_col).orderBy(F.col("position").asc_nulls_last(), F.xxhash64(id_col, "size"))


def timing(schedules: Sequence[Sequence[tuple[float, float]]]) -> Callable:
    demands = [Demand(x) for x in schedules]

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            passed = batch["passed"].to_numpy(dtype=float, na_value=0.0)
            which = batch["s"].to_numpy() % len(demands)
            position = np.zeros(len(batch))
            for i, demand in enumerate(demands):
                own = which == i
                position[own] = demand.time(passed[own])
            batch["position"] = position
            yield batch.drop(columns=["s", "passed"])

    return assign
