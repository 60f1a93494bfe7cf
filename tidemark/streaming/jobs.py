"""Streams: feed polling with a watermark, record ingestion with rollups, and event publishing.

Each is a file stream whose micro-batches go through the batch operators. A batch writes its results
under its number, so a repeated batch replaces its own output; state tables get a new version per batch,
written before the pointer to it moves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import dedup, incremental, outbox, rollup


class Versions:
    """A state table as numbered versions in a folder; a version that wasn't completed isn't seen."""

    def __init__(self, spark: SparkSession, folder: str, empty: DataFrame) -> None:
        self.spark, self.folder, self.empty = spark, folder.rstrip("/"), empty
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        if not self.fs.exists(self.path(self.folder)):
            return []
        found = [f.getPath().getName() for f in self.fs.listStatus(self.path(self.folder))]
        return sorted(int(n) for n in found if n.isdigit() and self.fs.exists(self.path(f"{self.folder}/{n}/_SUCCESS")))

    def read(self, before: int | None = None) -> DataFrame:
        """The newest version; with `before`, the newest one below it, as a repeated batch must see it."""
        found = [n for n in self.numbers() if before is None or n < before]
        return self.spark.read.schema(self.empty.schema).parquet(f"{self.folder}/{found[-1]}") if found else self.empty

    def write(self, table: DataFrame, number: int) -> None:
        table.write.mode("overwrite").parquet(f"{self.folder}/{number}")


def start(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()


def poll_feed(stream: DataFrame, state: Versions, out: str, checkpoint: str, ts: str = "accepted_at", key: str = "accession") -> StreamingQuery:
    """New filings of a feed stream, each once, past the watermark; the watermark moves after they're written."""

    def each(batch: DataFrame, number: int) -> None:
        mark = state.read(before=number)
        mark = mark if not mark.isEmpty() else batch.sparkSession.createDataFrame([(None, [])], mark.schema)
        rows = batch.dropDuplicates([key])
        incremental.after_watermark(rows, mark, ts, key).write.mode("overwrite").parquet(f"{out}/batch={number}")
        state.write(incremental.advance_watermark(rows, mark, ts, key), number)

    return start(stream, each, checkpoint)


def ingest(stream: DataFrame, known: Versions, documents: Versions, checkpoint: str) -> StreamingQuery:
    """Raw records into the keys seen and the per-document rollup; repeated records count once."""

    def each(batch: DataFrame, number: int) -> None:
        seen, table = known.read(before=number), documents.read(before=number)
        fresh = dedup.ingest_records(batch, seen).persist()
        documents.write(rollup.merge_rollups(table, rollup.rollup_documents(fresh)).select(*documents.empty.columns), number)
        known.write(seen.unionByName(fresh.select("feed", "record_key")), number)
        fresh.unpersist()

    return start(stream, each, checkpoint)


def publish_events(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Events into JSON day files, each (event, payload) once per batch; ids let readers drop repeats."""

    def each(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates(["event_id", "payload_hash"]).withColumn("event_date", outbox.event_day(F.col("committed_at"), F.col("created_at")))
        rows.repartitionByRange("event_date", "commit_seq").sortWithinPartitions("event_date", "commit_seq").write.mode("overwrite").partitionBy("event_date").json(f"{folder}/batch={number}")

    return start(stream, each, checkpoint)


def publish_latencies(stream: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Extension: latency counts per window and subject, with late events up to a bound."""
    rows = stream.withWatermark("committed_at", late)
    return rows.groupBy(F.window("committed_at", width), "subject").agg(F.count("*").alias("events"), F.max("latency").alias("worst"))
