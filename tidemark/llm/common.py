"""Shared helpers of the training-data operators."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors need not have this package installed: its functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: Rows of a counted table that one task takes.
ROWS_A_TASK = 200_000
#: The most rows of ids or hashes that are broadcast, always after a count.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; where the setting is absent, a local one in local mode only (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return sc._jsc.sc().getCheckpointDir().get().rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder, so that a lost executor costs a re-read and no recomputation."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder name in the shared folder."""
    return f"{shared_dir(spark)}/tidemark-{what}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder by Spark's file systems."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Work:
    """Tables that a computation writes to the shared folder, so that a lost executor costs a re-read and no
    recomputation. They go when the computation ends, or before by `drop`. What it returns must be `cut`."""

    def __init__(self, spark: SparkSession, what: str) -> None:
        self.spark, self.folder, self.made = spark, scratch(spark, what), 0
        self.places: dict[int, tuple[DataFrame, str]] = {}

    def __enter__(self) -> Work:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.folder)

    def keep(self, df: DataFrame) -> DataFrame:
        self.made += 1
        place = f"{self.folder}/{self.made}"
        df.write.parquet(place)
        out = self.spark.read.schema(df.schema).parquet(place)
        self.places[id(out)] = out, place
        return out

    def sized(self, df: DataFrame) -> tuple[DataFrame, int]:
        """The kept table in no more partitions than its rows need, and the number of its rows. One partition needs no shuffles."""
        whole = self.keep(df)
        rows = whole.count()
        out = whole.coalesce(-(-rows // ROWS_A_TASK) or 1)
        self.places[id(out)] = out, self.places[id(whole)][1]
        return out, rows

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            remove(self.spark, self.places.pop(id(df))[1])


def small(df: DataFrame, rows: int) -> DataFrame:
    """A counted table, to be broadcast if it's small enough."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def kept(key: str, build):
    """What a Python worker builds once (models, automata), kept across its tasks."""
    store = sys.modules.setdefault("_tidemark_kept", types.ModuleType("_tidemark_kept")).__dict__
    if key not in store:
        store[key] = build()
    return store[key]


def forget() -> None:
    """Gives back what other operators have kept on this Python worker, which Spark uses again, and what its allocators hold unused."""
    import ctypes

    import pyarrow

    if store := sys.modules.get("_tidemark_kept"):
        store.__dict__.clear()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU library
        pass
