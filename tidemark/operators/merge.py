"""Merges into state tables: each returns the table's next version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import keep_last


def replace_by_key(table: DataFrame, new: DataFrame, keys: Sequence[str], batch: DataFrame | None = None) -> DataFrame:
    """Rows of the keys in `batch` (default: in `new`) give way to the new rows. Null keys match nulls."""
    gone = (batch if batch is not None else new).select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    return table.join(gone, condition, "left_anti").unionByName(new)


def upsert(table: DataFrame, new: DataFrame, keys: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Inserts new keys and merges known ones, column by column.

    rules: for each column that isn't a key, "old" (old value first, new where it's null), "new" (new
    value first) or "replace" (the new value, null or not). Keys are unique on both sides.
    """
    one, two = table.withColumn("__old", F.lit(True)).alias("o"), new.withColumn("__new", F.lit(True)).alias("n")
    condition = None
    for k in keys:
        same = F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
        condition = same if condition is None else condition & same
    both = one.join(two, condition, "full_outer")
    out: list[Column] = [F.coalesce(f"n.{k}", f"o.{k}").alias(k) for k in keys]
    for c, rule in rules.items():
        o, n = F.col(f"o.{c}"), F.col(f"n.{c}")
        value = F.coalesce(o, n) if rule == "old" else F.coalesce(n, o) if rule == "new" else F.when(F.col("__new"), n).otherwise(o)
        out.append(value.alias(c))
    return both.select(*out)


def merge_discoveries(table: DataFrame, new: DataFrame, live_source: str = "latest_filings_atom") -> DataFrame:
    """Discoveries into the filings table, by accession.

    A retrieved filing keeps its old values first and its identity; another takes the new identity, new
    dates and urls first, and keeps the time of its first discovery. The live feed sticks as the source.
    `sources` is the ordered union of the sources that found the filing.
    """
    one, two = table.alias("o"), new.alias("n")
    both = one.join(two, F.col("o.accession") == F.col("n.accession"), "full_outer")
    done = F.coalesce(F.col("o.retrieval_status") == "retrieved", F.lit(False))
    old_first = lambda c: F.coalesce(f"o.{c}", f"n.{c}")
    new_first = lambda c: F.coalesce(f"n.{c}", f"o.{c}")
    by_state = lambda c: F.when(done, old_first(c)).otherwise(new_first(c)).alias(c)
    source = F.when((F.col("o.source") == live_source) | (F.col("n.source") == live_source), live_source).otherwise(F.when(done, old_first("source")).otherwise(new_first("source")))
    own = lambda side: F.coalesce(F.col(f"{side}.sources"), F.when(F.col(f"{side}.source").isNotNull(), F.array(f"{side}.source")), F.array().cast("array<string>"))
    return both.select(
        old_first("accession").alias("accession"),
        *(by_state(c) for c in ("cik", "company_name", "form_type", "filing_date", "accepted_at", "href")),
        old_first("discovered_at").alias("discovered_at"),
        source.alias("source"),
        F.coalesce("o.retrieval_status", "n.retrieval_status", F.lit("discovered")).alias("retrieval_status"),
        F.array_union(own("o"), own("n")).alias("sources"),
        F.col("o.accession").isNull().alias("is_new"),
    )


def update_relevance(filings: DataFrame, decided: DataFrame) -> DataFrame:
    """States and issuers from header decisions; final header outcomes put the filing back to discovered."""
    final = F.col("d.state").isin("hdr_match", "irrelevant", "unresolved", "hdr_failed")
    both = filings.alias("f").join(decided.alias("d"), "accession", "left")
    changed = {
        "relevance_state": F.coalesce("d.state", "f.relevance_state"),
        "issuer_cik": F.coalesce("d.issuer_cik", "f.issuer_cik"),
        "issuer_name": F.coalesce("d.issuer_name", "f.issuer_name"),
        "retrieval_status": F.when(final, "discovered").otherwise(F.col("f.retrieval_status")),
    }
    return both.select(*(changed[c].alias(c) if c in changed else F.col("accession") if c == "accession" else F.col(f"f.{c}") for c in filings.columns))


def register_files(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Files of a master list into the manifest, by url: old values first, the time of discovery renewed."""
    return upsert(
        manifest,
        found.withColumns({"download_status": F.lit("pending"), "download_attempts": F.lit(0).cast("long"), "applied_at": F.lit(None).cast("string")}),
        ["source_url"],
        {"feed": "old", "interval_ts": "old", "md5": "old", "size": "old", "discovered_at": "new", "download_status": "old", "download_attempts": "old", "applied_at": "old"},
    )


def mark_failed(manifest: DataFrame, failed: DataFrame, most: int = 4000) -> DataFrame:
    """Manifest with the files that failed: status, one more attempt, the error's first characters."""
    both = manifest.alias("m").join(failed.select("source_url", F.substring("error", 1, most).alias("__error")), "source_url", "left")
    hit = F.col("__error").isNotNull()
    return both.select(
        "source_url",
        *(F.col(f"m.{c}") for c in manifest.columns if c not in ("source_url", "download_status", "download_attempts", "error")),
        F.when(hit, "failed").otherwise(F.col("download_status")).alias("download_status"),
        (F.col("download_attempts") + hit.cast("int")).alias("download_attempts"),
        F.col("__error").alias("error"),
    )


def set_state(table: DataFrame, new: DataFrame) -> DataFrame:
    """Key-value state (source, cursor, updated_at): the new value of a source replaces the old one."""
    return keep_last(table.unionByName(new), ["source"], "updated_at")


def rewrite_locations(documents: DataFrame, moved: DataFrame) -> DataFrame:
    """Paths of artifacts after a move: documents (accession, path, ...), moved (accession, old_path, new_path)."""
    both = documents.join(moved.withColumnRenamed("old_path", "path"), ["accession", "path"], "left")
    return both.withColumn("path", F.coalesce("new_path", "path")).select(*documents.columns)


def add_missing_columns(table: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """The table with the columns that a newer schema has, as nulls."""
    return table.withColumns({c: F.lit(None).cast(kind) for c, kind in schema.items() if c not in table.columns})


def insert_new(table: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New keys only; rows of known keys stay as they are."""
    return table.unionByName(new.dropDuplicates(list(keys)).join(table.select(*keys), list(keys), "left_anti"))
