"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

A text is described by counts of byte-class trigrams (what stands beside what: letters by kind, digits,
marks, white space, bytes beyond ASCII) and by shares of repeated words, word pairs and lines. Log
counts, inverse document frequencies and a truncated singular value decomposition, all from a bounded
sample of labelled rows (`SAMPLE` rows, least hash of the id first), give the latent space. The sample's
vectors and labels are broadcast; every document's cosines with all of them are computed exactly, block
by block, and its nearest neighbours vote, weighted by similarity.

Defined results: null and empty texts, and texts of white space only, score 0; without usable labels
every other text scores 0.5; rows of labels without an id or a quality are left out, ids with
contradicting labels too; repeated documents are scored each; the whole of every text is used.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget

#: The most labelled rows that the space and the votes are made from.
SAMPLE = 6000
RANK = 48
NEIGHBOURS = 24
#: Texts that are described and compared at once: their cosines with the sample take three times 24 KB each.
BLOCK = 128
CLASSES = 16
TRIGRAMS = CLASSES**3
BINS = 16
WIDTH = TRIGRAMS + 4 * BINS


def byte_classes() -> np.ndarray:
    """Class of each byte: white space, letters by kind, digits, marks by use, bytes beyond ASCII."""
    out = np.zeros(256, np.uint16)
    for name, chars in enumerate((b" ", b"\n\r\t\x0b\x0c", b"aeiouy", b"bcdfghjklmnpqrstvwxz", b"AEIOUY", b"BCDFGHJKLMNPQRSTVWXZ", b"0123456789", b".", b",", b"!?", b"'\"-:;", b"()[]{}|", b"#$%&*+=<>@^~_/\\`"), 1):
        out[list(chars)] = name
    out[0x80:0xC0], out[0xC0:] = 14, 15
    return out


KINDS = byte_classes()


def shares(raw: bytes) -> tuple[float, float, float, float]:
    """Share of words, word pairs and lines that stood before in the text, and of words equal to the one before."""
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    pairs = list(zip(words, words[1:], strict=False))
    repeated = lambda xs: 1 - len(set(xs)) / len(xs) if xs else 0.0
    return repeated(words), repeated(pairs), repeated(lines), sum(a == b for a, b in pairs) / max(1, len(pairs))


def describe(texts: list[str | None]) -> np.ndarray:
    """A row of features for each text; a row of zeros for texts without words."""
    out = np.zeros((len(texts), WIDTH), np.float32)
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if not raw.split(None, 1):
            continue
        kinds = KINDS[np.frombuffer(b"\n" + raw + b"\n", np.uint8)]
        codes = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
        counts = np.bincount(codes, minlength=TRIGRAMS)
        out[i, :TRIGRAMS] = np.log1p(counts * (1000.0 / len(codes)))
        for j, x in enumerate(shares(raw)):
            at = np.sqrt(x) * (BINS - 1)
            out[i, TRIGRAMS + j * BINS : TRIGRAMS + (j + 1) * BINS] = 3.0 * np.exp(-((np.arange(BINS) - at) ** 2) / 2)
    return out


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


@dataclass
class Space:
    """The latent space with the labelled vectors in it."""

    into: np.ndarray  # features x rank, inverse document frequencies included
    vectors: np.ndarray
    labels: np.ndarray

    def scores(self, texts: list[str | None], neighbours: int = NEIGHBOURS, sharpness: float = 16.0) -> np.ndarray:
        out = np.zeros(len(texts))
        for a in range(0, len(texts), BLOCK):
            rows = describe(texts[a : a + BLOCK])
            there = rows.any(axis=1)
            if not len(self.labels):
                out[a : a + BLOCK] = np.where(there, 0.5, 0.0)
                continue
            cosines = unit(rows @ self.into) @ self.vectors.T
            k = min(neighbours, len(self.labels))
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosines, near, axis=1).astype(float), 1e-3) ** sharpness
            out[a : a + BLOCK] = np.where(there, (weight * self.labels[near]).sum(1) / weight.sum(1), 0.0)
        return out


def fit_space(rows: np.ndarray, labels: np.ndarray, rank: int = RANK, seed: int = 7) -> Space:
    """Truncated SVD of the weighted rows, by subspace iteration from a fixed seed. The rows are overwritten."""
    if not len(rows):
        return Space(np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0, np.float32))
    idf = np.log((1 + len(rows)) / (1 + np.count_nonzero(rows, axis=0))).astype(np.float32) + 1
    idf[TRIGRAMS:] = 1
    x = rows
    x *= idf
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    basis = np.linalg.qr(x.T @ np.random.default_rng(seed).standard_normal((len(x), min(rank + 16, len(x)))).astype(np.float32))[0]
    for _ in range(4):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
    turn = (basis @ right.T)[:, :rank]
    return Space((idf[:, None] * turn).astype(np.float32), unit(x @ turn).astype(np.float32), labels.astype(np.float32))


def squeeze(row: np.ndarray) -> bytes:
    at = np.flatnonzero(row)
    return zlib.compress(at.astype("<u2").tobytes() + row[at].astype("<f4").tobytes(), 1)


def unsqueeze(raw: bytes) -> np.ndarray:
    raw = zlib.decompress(raw)
    n = len(raw) // 6
    out = np.zeros(WIDTH, np.float32)
    out[np.frombuffer(raw[: 2 * n], "<u2")] = np.frombuffer(raw[2 * n :], "<f4")
    return out


def held_out(id_col: Column) -> Column:
    """Rows that no label is learnt from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Space:
    """The space from at most `sample` labelled documents that aren't held out, of the 2 x `sample` labels of least hash."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where("id IS NOT NULL AND label IS NOT NULL AND label IN (0, 1)")
    known = known.where(~held_out(F.col("id"))).groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other").drop("other")
    # twice as many, as some of their documents may not be there; so few go to all workers and no table is shuffled
    known = known.orderBy(F.xxhash64("id"), "id").limit(2 * sample)

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        forget()
        return pd.Series([squeeze(r) for a in range(0, len(texts), BLOCK) for r in describe(texts.iloc[a : a + BLOCK].tolist())], index=texts.index)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    rows = texts.select("id", "label", features("text").alias("row")).groupBy("id").agg(F.min("row").alias("row"), F.min("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    rows.sort(key=lambda r: r["id"])
    matrix = np.empty((len(rows), WIDTH), np.float32)
    for i, r in enumerate(rows):
        matrix[i] = unsqueeze(r["row"])
    there = matrix.any(axis=1)
    matrix = matrix if there.all() else matrix[there]
    return fit_space(matrix, np.array([r["label"] for r in rows], np.float32)[there])


def scorer(docs: DataFrame, space: Space) -> Callable[[Column | str], Column]:
    """A column function that scores texts in the broadcast space."""
    shared = docs.sparkSession.sparkContext.broadcast((space.into, space.vectors, space.labels))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        forget()
        return pd.Series(Space(*shared.value).scores(texts.tolist()), index=texts.index)

    return score


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    score = scorer(docs, learn(docs, labels, id_col, text_col))
    scored = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
