"""Best-fit packing by patterns: non-negative least squares on the length histogram.

Documents become pieces of at most `capacity` tokens. The histogram of piece lengths, `capacity` numbers
whatever the corpus, is all that the driver sees. It enumerates patterns of one to four lengths that fill
a sequence, fits non-negative repeat counts to the histogram (least squares, greedy coordinate descent,
so that few patterns are used), rounds them to what the histogram holds, and packs the residue by
best fit, largest lengths first, a whole run of equal sequences at a time. Pieces then take the slots of
their length by rank; the ranks come from salted groups, so that a length that a third of all pieces
share is spread over many tasks.

Defined results: null and empty texts are one piece of one token (the end id); repeated rows are packed
each; ties between equal pieces go by id and piece; an empty table gives an empty result. Only documents
longer than a sequence are cut: full pieces from the end, the first piece may be shorter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, parallelism
from .tokens import id_bytes

CAPACITY = 2048
PIECES = "piece int, start long, length long, ids_crc32 long"


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and end of each piece of a document of n tokens."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *((a, a + capacity) for a in range(first, n, capacity))]


def cut_documents(docs: DataFrame, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of each document, ids as text: whole numbers with nulls would become floating point."""

    def tokenize(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.uint32(end_id).astype("<u4").tobytes()
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"], strict=True):
                ids = id_bytes(text or "") + end
                rows += [(key, i, a, b - a, zlib.crc32(ids[4 * a : 4 * b])) for i, (a, b) in enumerate(pieces_of(len(ids) // 4, capacity))]
            yield pd.DataFrame(rows, columns=["id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr(f"CAST(`{id_col}` AS string) AS id", f"`{text_col}` AS text").mapInPandas(tokenize, f"id string, {PIECES}")


@dataclass
class Plan:
    """Runs of slots. Run k serves `count` pieces of one length, ranks from `rank`: `mult` of them in each
    of a row of sequences from `sequence` on, the first at `offset`."""

    length: list[int] = field(default_factory=list)
    rank: list[int] = field(default_factory=list)
    mult: list[int] = field(default_factory=list)
    sequence: list[int] = field(default_factory=list)
    offset: list[int] = field(default_factory=list)
    sequences: int = 0


def patterns(histogram: np.ndarray, grid: int = 48) -> np.ndarray:
    """Patterns as rows of four lengths (0: none): the last of them is the largest length that still fits."""
    capacity = len(histogram) - 1
    there = np.flatnonzero(histogram[1:]) + 1
    if not len(there):
        return np.zeros((0, 4), int)
    best = np.zeros(capacity + 1, int)  # the largest length there that fits into a room
    best[there] = there
    best = np.maximum.accumulate(best)
    share = np.cumsum(histogram[there]) / histogram.sum()
    some = np.unique(np.concatenate([there[np.searchsorted(share, (np.arange(grid) + 0.5) / grid).clip(max=len(there) - 1)], there[:: max(1, len(there) // grid)]]))
    one = there[:, None]
    fit = lambda rows: np.column_stack([rows, best[np.maximum(capacity - rows.sum(1), 0)]])
    mesh = lambda *axes: np.stack(np.meshgrid(*axes, indexing="ij"), -1).reshape(-1, len(axes))
    few = some[:: max(1, len(some) // 24)]
    found = []
    for rows in (one, mesh(there, some), mesh(some, few, few)):
        rows = rows[rows.sum(1) <= capacity]
        rows = fit(rows)
        found.append(np.pad(rows, ((0, 0), (0, 4 - rows.shape[1]))))
    rows = np.unique(-np.sort(-np.concatenate(found), axis=1), axis=0)
    filled = rows.sum(1)
    return rows[(filled <= capacity) & (filled >= 0.995 * capacity)]


def fit_repeats(rows: np.ndarray, histogram: np.ndarray, steps: int = 6000, tolerance: float = 1e-3) -> np.ndarray:
    """Non-negative least squares of histogram = rows' lengths x repeats, by the best coordinate each time.

    Errors on short lengths weigh less: what is left of them fills gaps later.
    """
    capacity = len(histogram) - 1
    square = (np.arange(capacity + 1) / capacity) ** 2
    norm = np.zeros(len(rows))
    for i in range(4):
        same = (rows == rows[:, i : i + 1]).sum(1)
        norm += square[rows[:, i]] * same
    repeats, rest = np.zeros(len(rows)), histogram.astype(float).copy()
    rest[0] = 0
    gain_floor = tolerance * max(1.0, float((square * rest**2).sum())) / max(1, steps)
    by_length: dict[int, np.ndarray] = {}
    push = (square * rest)[rows].sum(1)
    for _ in range(steps):
        move = np.maximum(-repeats, push / norm)
        gain = move * push - 0.5 * move**2 * norm
        k = int(np.argmax(gain))
        if gain[k] <= gain_floor:
            break
        repeats[k] += move[k]
        for length, times in zip(*np.unique(rows[k], return_counts=True), strict=True):
            if length:
                rest[length] -= move[k] * times
                if length not in by_length:
                    by_length[length] = np.argwhere(rows == length)[:, 0]
                np.add.at(push, by_length[length], -square[length] * move[k] * times)
    return repeats


def make_plan(histogram: np.ndarray) -> Plan:
    """histogram[n]: pieces of length n, n up to the capacity. Deterministic."""
    capacity, left = len(histogram) - 1, histogram.astype(np.int64).copy()
    taken, plan = np.zeros(capacity + 1, np.int64), Plan()

    def emit(content: list[tuple[int, int]], times: int) -> None:
        offset = 0
        for length, mult in content:
            plan.length.append(length)
            plan.rank.append(int(taken[length]))
            plan.mult.append(mult)
            plan.sequence.append(plan.sequences)
            plan.offset.append(offset)
            taken[length] += times * mult
            left[length] -= times * mult
            offset += length * mult
        plan.sequences += times

    if left[capacity]:  # a full piece is a sequence
        emit([(capacity, 1)], int(left[capacity]))
    rows = patterns(left)
    repeats = fit_repeats(rows, left) if len(rows) else np.zeros(0)
    for k in np.argsort(-rows.sum(1) * (repeats >= 0.5), kind="stable"):
        if repeats[k] < 0.5:
            break
        content = [(int(a), int(b)) for a, b in zip(*np.unique(rows[k][rows[k] > 0], return_counts=True), strict=True)]
        times = min(int(np.floor(repeats[k] + 0.5)), *(int(left[a] // b) for a, b in content))
        if times > 0:
            emit(content[::-1], times)
    lengths = np.flatnonzero(left)
    while len(lengths):  # the residue: best fit, largest first
        room, content, at = capacity, [], len(lengths) - 1
        while at >= 0 and room:
            at = min(at, int(np.searchsorted(lengths, room, side="right")) - 1)
            if at < 0:
                break
            length = int(lengths[at])
            mult = min(room // length, int(left[length])) if content else 1
            mult = max(1, mult)
            if not content and 2 * length <= room:
                mult = min(room // length, int(left[length]))
            content.append((length, mult))
            room -= length * mult
            at -= 1
        emit(content, min(int(left[a] // b) for a, b in content))
        lengths = np.flatnonzero(left)
    return plan


def place(plan: Plan):
    """The plan as a function from lengths and ranks to sequences and offsets."""
    columns = [np.array(x, np.int64) for x in (plan.length, plan.rank, plan.mult, plan.sequence, plan.offset)]
    order = np.lexsort((columns[1], columns[0]))
    length, rank, mult, sequence, offset = (x[order] for x in columns)
    first = np.searchsorted(length, np.arange(length[-1] + 2 if len(length) else 1))

    def at(lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.empty(len(lengths), np.int64)
        for n in np.unique(lengths):
            own = lengths == n
            a, b = first[n], first[n + 1]
            run[own] = a + np.searchsorted(rank[a:b], ranks[own], side="right") - 1
        step = ranks - rank[run]
        return sequence[run] + step // mult[run], offset[run] + step % mult[run] * lengths

    return at


def rank_in_length(pieces: DataFrame, histogram: np.ndarray) -> DataFrame:
    """Adds rank: 0, 1, ... within each length, by groups of bounded size however common the length."""
    spark = pieces.sparkSession
    group = min(100_000, max(256, int(histogram.sum()) // (8 * parallelism(spark))))
    salts = spark.createDataFrame([(n, int(-(-int(c) // group))) for n, c in enumerate(histogram) if c], "length long, salts long")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("salt", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.col("salts"))).drop("salts")
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("size"))
    before = sizes.withColumn("before", F.sum("size").over(Window.partitionBy("length").orderBy("salt")) - F.col("size"))
    number = F.row_number().over(Window.partitionBy("length", "salt").orderBy("id", "piece", "ids_crc32"))
    ranked = salted.withColumn("number", number)
    return ranked.join(before.drop("size"), ["length", "salt"]).withColumn("rank", F.col("before") + F.col("number") - 1).drop("before", "number", "salt")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    kind = dict(docs.dtypes)[id_col]
    pieces = cut(cut_documents(docs, id_col, text_col, capacity, end_id))
    histogram = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        histogram[row["length"]] = row["count"]
    at = place(make_plan(histogram))

    def lay(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["sequence_id"], batch["offset"] = at(batch["length"].to_numpy(), batch["rank"].to_numpy())
            yield batch.drop(columns="rank")

    ranked = rank_in_length(pieces, histogram).select("id", "piece", "start", "length", "ids_crc32", "rank")
    laid = ranked.mapInPandas(lay, f"id string, {PIECES}, sequence_id long, offset long")
    return laid.withColumn("id", F.col("id").cast(kind)).withColumnRenamed("id", id_col)
