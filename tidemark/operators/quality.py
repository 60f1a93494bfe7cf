"""Checks of outputs, as tables of violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def violations(rows: DataFrame, required: Sequence[str] = (), unique: Sequence[str] = (), expected: int | None = None, cik: str | None = None) -> DataFrame:
    """rule, n: how many rows break each rule; no rows if all hold. One pass, and one for uniqueness."""
    rules = {f"{c} is missing": F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "") for c in required}
    if cik:
        rules[f"{cik} isn't ten digits"] = F.col(cik).isNotNull() & ~F.col(cik).cast("string").rlike(r"^\d{10}$")
    counts = [F.count_if(c).alias(f"r{i}") for i, c in enumerate(rules.values())]
    done = rows.agg(F.count("*").alias("all"), *counts)
    found = [F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n")) for i, name in enumerate(rules)]
    if expected is not None:
        found.append(F.struct(F.lit(f"{expected} rows are expected").alias("rule"), F.when(F.col("all") == expected, 0).otherwise(F.col("all")).cast("long").alias("n")))
    none = F.struct(F.lit("").alias("rule"), F.lit(0).cast("long").alias("n"))
    out = done.select(F.inline(F.array(none, *found)))
    if unique:
        again = rows.groupBy(*unique).count().where("count > 1").agg(F.count("*").alias("n"))
        out = out.unionByName(again.select(F.lit(f"{', '.join(unique)} repeats").alias("rule"), "n"))
    return out.where("n > 0")
