"""Toxicity by logistic regression, trained with FTRL-proximal.

Features are hashed words, beginnings of longer words (inflected forms share
them), pairs of neighbours and pairs with one word left out; each counts once in
a text.  Every coordinate has its own learning rate and an
L1 penalty, so few weights are left and they are sent to all executors.  The
model is fitted on at most about ``sample`` labelled rows, chosen by a hash of
the id, in one task; scoring covers all texts.

Defined cases: null and empty texts get the score of the bias; labels without
value or id teach nothing, a document labelled twice counts as toxic if one
label says so; without labels the score is 0.5; rows without id are held out;
repeated rows get a row each; empty tables give no rows; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import held_out, read, small_batches
from millrace.llm.tokens import MARKS, Piece, mix, pieces
from millrace.session import materialized


@dataclass(frozen=True)
class Params:
    bits: int = 20            # of a feature's hash
    sample: int = 20_000      # labelled rows that are learned from
    beginnings: tuple[int, ...] = (5, 6, 7, 8, 9, 10)   # bytes
    passes: int = 5
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 1.0


_PAIR, _SKIP, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def features(piece: Piece, p: Params) -> Iterator[np.ndarray]:
    """For each row of a piece its hashed features, with repeats."""
    begins = np.stack([piece.beginnings(n) for n in p.beginnings])
    for lo, hi in zip(piece.bounds[:-1], piece.bounds[1:]):
        words, cut = piece.words[lo:hi], begins[:, lo:hi].ravel()
        pair = mix(words[:-1] * _PAIR + words[1:])
        skip = mix(words[:-2] * _SKIP + words[2:] * _STEP)
        yield (np.concatenate([words, cut[cut != 0], pair, skip]) >> np.uint64(64 - p.bits)).astype(np.int64)


def fit(texts: Iterator[tuple[np.ndarray, int]], p: Params) -> np.ndarray:
    """Weights by coordinate, the bias last; ``texts`` are distinct features and labels."""
    rows = list(texts)
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    rng = np.random.Generator(np.random.PCG64(3))

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == size - 1, 0.0, p.l1)  # the bias is not made sparse
        w = -(z[at] - np.sign(z[at]) * l1) / ((p.beta + np.sqrt(n[at])) / p.alpha + p.l2)
        return np.where(np.abs(z[at]) <= l1, 0.0, w)

    for _ in range(p.passes):
        for r in rng.permutation(len(rows)):
            at, y = rows[r]
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / p.alpha * w
            n[at] += g * g
    return weights(np.arange(size))


def train(docs: DataFrame, labels: DataFrame, parts: int, part: int, p: Params, label: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and values of the weights that are not 0."""
    marked = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), parts, part))
    marked = materialized(marked.groupBy(F.col("doc_id").alias("_id")).agg(F.max(label).cast("int").alias("y")))
    share = min(1.0, p.sample / max(marked.count(), 1))
    # the sample is bounded, so it can be sent to every executor
    sample = materialized(marked.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 20)) < int(share * (1 << 20))).limit(p.sample))
    rows = docs.join(F.broadcast(sample), F.col("id") == F.col("_id")).select("id", "y", "text").repartition(1).sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts():
            for batch in batches:
                ys = batch.column(1).to_pylist()
                for piece in pieces(batch.column(2), blank=MARKS):
                    for r, at in enumerate(features(piece, p)):
                        yield np.append(np.unique(at), 1 << p.bits), ys[piece.first + r]

        w = fit(texts(), p)
        at = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at])], ["at", "w"])

    got = rows.mapInArrow(run, "at bigint, w double").toArrow()
    return got["at"].to_numpy(), got["w"].to_numpy()


def scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 5, part: int = 0,
           params: Params = Params()) -> DataFrame:
    """A row per document; only labels of rows that do not leave ``part`` by ``parts`` teach."""
    p, spark = params, docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    model = spark.sparkContext.broadcast(train(docs, labels, parts, part, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros((1 << p.bits) + 1, np.float32)
        weights[model.value[0]] = model.value[1]
        for batch in batches:
            for piece in pieces(batch.column(2), blank=MARKS):
                total = np.zeros(len(piece))
                for r, at in enumerate(features(piece, p)):
                    total[r] = weights[np.unique(at[weights[at] != 0])].sum(dtype=np.float64)
                score = 1 / (1 + np.exp(-np.clip(total + weights[-1], -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(piece.first, len(piece)), batch.column(1).slice(piece.first, len(piece)), pa.array(score),
                     pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select("id", held_out(F.col("id"), parts, part).alias("held"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, score double, predicted int")


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
