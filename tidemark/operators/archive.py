"""Archiving: what may move, where to, and whether copies are good."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def archived(path: Column, archive_dir: str) -> Column:
    root = archive_dir.rstrip("/") + "/"
    return F.coalesce(path.startswith(root), F.lit(False))


def eligible(filings: DataFrame, today: Column, days: int = 30, most: int = 200, archive_dir: str | None = None) -> DataFrame:
    """Retrieved filings older than the retention, with a path, not archived with both paths; oldest first.

    Archived filings are left out before the limit, so that they take no place in it.
    """
    rows = filings.where((F.col("retrieval_status") == "retrieved") & (F.col("retrieved_on") < F.date_sub(today, days)) & (F.col("raw_txt_path").isNotNull() | F.col("primary_doc_path").isNotNull()))
    if archive_dir:
        rows = rows.where(~(archived(F.col("raw_txt_path"), archive_dir) & archived(F.col("primary_doc_path"), archive_dir)))
    return rows.orderBy("retrieved_on", "accession").limit(most)


def archive_path(archive_dir: str, path: Column) -> Column:
    """The path under the archive from the ten-digit folder on, else its last three parts."""
    from_cik = F.nullif(F.regexp_extract(path, r"/(\d{10}/.*)$", 1), F.lit(""))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    last = F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 2), F.lit(3)), "/")
    return F.concat(F.lit(archive_dir.rstrip("/") + "/"), F.coalesce(from_cik, last))


def feed_path(root: str, feed: Column, interval: Column, url: Column) -> Column:
    """root/feed/YYYY/MM/DD/file"""
    return F.concat_ws("/", F.lit(root), feed, F.substring(interval, 1, 4), F.substring(interval, 5, 2), F.substring(interval, 7, 2), F.element_at(F.split(url, "/"), -1))


def checksums(files: DataFrame) -> DataFrame:
    """path, length, sha256 of files read with the binaryFile source."""
    return files.select("path", "length", F.sha2("content", 256).alias("sha256"))


def verify_copies(expected: DataFrame, copies: DataFrame) -> DataFrame:
    """Whether each copy is there with the expected digest (null: any). expected: path, archived_path, sha256."""
    both = expected.join(copies.select(F.col("path").alias("archived_path"), F.col("sha256").alias("found")), "archived_path", "left")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("sha256").isNull() | (F.col("sha256") == F.col("found")), "good").otherwise("damaged")
    return both.withColumn("state", state)


def closed_days(days: DataFrame, now: Column) -> DataFrame:
    """Day files that may be archived: all but today's (UTC)."""
    return days.where(F.col("event_date") != F.date_format(now, "yyyy-MM-dd"))


def orphans(pending: DataFrame, originals: DataFrame, copies: DataFrame) -> DataFrame:
    """Originals that can go: their deletion is pending, or their archive path is there; the copy is good."""
    both = pending.select("original_path", "archived_path", "sha256").unionByName(originals.select("original_path", "archived_path", "sha256")).dropDuplicates(["original_path"])
    return verify_copies(both.withColumnRenamed("original_path", "path"), copies).where("state = 'good'").select(F.col("path").alias("original_path"), "archived_path")


def file_system(path: str):
    """The file system of a uri or local path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def digest_of(store, path: str, out=None) -> str:
    """sha256 of a file, read in blocks; with `out`, the blocks are written there too."""
    found = hashlib.sha256()
    with store.open_input_stream(path) as stream:
        while block := stream.read(1 << 18):
            found.update(block)
            if out is not None:
                out.write(block)
    return found.hexdigest()


def copy_files(plan: DataFrame, remove: bool = False) -> DataFrame:
    """Copies files on the executors: path, archived_path, sha256 (null: any) in; the same with state out.

    A copy is written beside its place, read back, and moved there if its digest is the original's and
    the expected one; then the original goes, if `remove` asks for it. Repeated tasks find the copy done.
    states: copied, present, damaged, missing.
    """

    def one(path: str, target: str, expected: str | None) -> str:
        (source, a), (store, b) = file_system(path), file_system(target)
        there = store.get_file_info([b])[0].is_file
        if not source.get_file_info([a])[0].is_file:
            return "present" if there and (expected is None or digest_of(store, b) == expected) else "missing"
        original = digest_of(source, a)
        if expected is not None and original != expected:
            return "damaged"
        state = "present"
        if not there or digest_of(store, b) != original:
            store.create_dir(b.rpartition("/")[0], recursive=True)
            draft = f"{b}.part-{hashlib.sha256(path.encode()).hexdigest()[:8]}"
            with store.open_output_stream(draft) as out:
                digest_of(source, a, out)
            if digest_of(store, draft) != original:
                store.delete_file(draft)
                return "damaged"
            store.move(draft, b)
            state = "copied"
        if remove:
            source.delete_file(a)
        return state

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            expected = [x if isinstance(x, str) else None for x in batch["sha256"]]
            yield batch.assign(state=[one(p, t, e) for p, t, e in zip(batch["path"], batch["archived_path"], expected, strict=True)])

    return plan.select("path", "archived_path", "sha256").mapInPandas(run, "path string, archived_path string, sha256 string, state string")
