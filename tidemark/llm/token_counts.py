"""Token counts without token ids.

A byte-level BPE merges within pre-tokens only, so a text has as many tokens as its pre-tokens have
together. Each distinct pre-token is counted once, in a table of pre-tokens and counts made from all
texts. Documents are then reduced to pre-token frequencies, joined to that table and summed. The most
frequent pre-tokens, `head` of them at most, go to all workers, which sum them on the spot; the rest,
each of them rare, is joined by a shuffle.

Defined results: null and empty texts have 0 tokens and 0 bytes; repeated rows and ids are counted each;
an empty table gives an empty result; special strings inside texts count as the library counts them by default (one token).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .tokens import END, library, pre_tokens

#: The most pre-tokens that are broadcast.
HEAD = 300_000
#: Distinct pre-tokens that a worker holds before it passes them on.
HELD = 400_000


def frequencies(text: str | None, split) -> Counter:
    """Pre-tokens of a text; each special string is one of its own."""
    parts = (text or "").split(END)
    out: Counter = Counter()
    for part in parts:
        out.update(split(part))
    if len(parts) > 1:
        out[END] = len(parts) - 1
    return out


def pre_token_counts(docs: DataFrame) -> DataFrame:
    """Each distinct pre-token of all texts with its occurrences and its tokens: piece, n, tokens."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split_text, held = pre_tokens(), Counter()
        for batch in batches:
            for text in batch["text"]:
                parts = (text or "").split(END)
                for part in parts:
                    held.update(split_text(part))  # lists are counted natively, other counters aren't
                if len(parts) > 1:
                    held[END] += len(parts) - 1
                if len(held) > HELD:
                    yield pd.DataFrame({"piece": list(held), "n": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"piece": list(held), "n": list(held.values())})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = library()
        for batch in batches:
            batch["tokens"] = [len(e) for e in encoder.encode_batch_fast(batch["piece"].tolist(), add_special_tokens=False)]
            yield batch

    distinct = docs.select("text").mapInPandas(split, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return distinct.mapInPandas(count, "piece string, n long, tokens int")


def head_of(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent pre-tokens, at most `most`, by a threshold from a histogram of fixed size."""
    level = F.floor(F.log2("n") * 8).cast("int")
    total, floor = 0, None
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        floor = row["level"]
    return counts.where(level >= (floor if floor is not None else 1 << 30)).select("piece", "tokens")


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024, head: int = HEAD) -> DataFrame:
    """Per document: id, n_bytes, n_tokens, over_limit (more than `limit` tokens)."""
    kind = dict(docs.dtypes)[id_col]
    # ids travel as text: whole numbers with nulls would become floating point
    docs = docs.selectExpr(f"CAST(`{id_col}` AS string) AS id", f"`{text_col}` AS text")
    counts = cut(pre_token_counts(docs))
    frequent = head_of(counts, head).toPandas()
    known = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent["piece"], frequent["tokens"].tolist(), strict=True)))

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split_text, table = pre_tokens(), known.value
        for batch in batches:
            done, rest = [], []
            for text in batch["text"]:
                tokens, rare = 0, []
                for piece, n in frequencies(text, split_text).items():
                    each = table.get(piece)
                    if each is None:
                        rare.append({"piece": piece, "n": n})
                    else:
                        tokens += each * n
                done.append(tokens)
                rest.append(rare)
            sizes = [0 if t is None else len(t.encode("utf-8", "surrogatepass")) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "n_bytes": np.array(sizes, "int64"), "done": np.array(done, "int64"), "rest": rest})

    reduced = docs.mapInPandas(reduce, "id string, n_bytes long, done long, rest array<struct<piece:string,n:long>>")
    reduced = reduced.withColumn("row", F.monotonically_increasing_id())
    # each document also sends one entry with what is summed already, under a key that no pre-token has
    own = F.array(F.struct(F.concat(F.lit("\x00"), F.col("row")).alias("piece"), F.lit(0).cast("long").alias("n")))
    entries = reduced.select("row", "id", "n_bytes", "done", F.explode(F.concat("rest", own)).alias("e")).select(
        "row", "id", "n_bytes", "e.piece", "e.n", F.when(F.col("e.n") == 0, F.col("done")).otherwise(0).alias("done")
    )
    lost = F.raise_error(F.lit("a pre-token has no count")).cast("long")
    summed = (
        entries.join(counts.select("piece", "tokens"), "piece", "left")
        .groupBy("row", "id", "n_bytes")
        .agg(F.sum(F.when(F.col("n") == 0, F.col("done")).otherwise(F.coalesce(F.col("n") * F.col("tokens"), lost))).alias("n_tokens"))
    )
    return summed.select(F.col("id").cast(kind).alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
