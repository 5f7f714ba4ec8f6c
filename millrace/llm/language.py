"""Language by a bidirectional gated recurrent network over bytes.

A text is cut into windows of ``window`` bytes.  Two recurrent layers read a
window forwards and backwards, and at every byte a softmax of both states gives
the probabilities of the languages; a document's probabilities are the mean
over all its bytes.  The network is trained in numpy by backpropagation through
time, on windows of at most about ``sample`` documents chosen by a hash of the
id, in one task; prediction reads whole texts.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
rows without language or id teach nothing; rows without id are held out;
without training rows every text is ``und``; ties go to the first language by
name; repeated rows get a row each; empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from millrace.llm.text import held_out, read, small_batches
from millrace.llm.tokens import LOWER, PIECE, buffer

UNKNOWN = "und"


@dataclass(frozen=True)
class Params:
    hidden: int = 12
    window: int = 64
    sample: int = 3000        # documents that are learned from
    per_text: int = 6         # windows of one document that are learned from
    batch: int = 256
    steps: int = 300
    rate: float = 0.02
    columns: int = 4096       # windows that are read at once


class Network:
    """Weights as a dictionary; arrays are (units, windows)."""

    def __init__(self, languages: int, p: Params):
        rng = np.random.Generator(np.random.PCG64(11))
        h = p.hidden
        draw = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.w = {}
        for d in "fb":
            self.w |= {f"x{d}": draw(0.3, 3 * h, 256), f"u{d}": draw(h**-0.5, 3 * h, h), f"b{d}": np.zeros((3 * h, 1), np.float32),
                       f"o{d}": draw(0.3, languages, h)}
        self.w["c"] = np.zeros((languages, 1), np.float32)

    def read(self, d: str, data: np.ndarray, keep: list | None = None) -> list[np.ndarray]:
        """States after each byte; data is (time, windows), read in its order."""
        x, u, b = (self.w[k + d] for k in "xub")
        n = u.shape[1]
        table = x + b
        h, out = np.zeros((n, data.shape[1]), np.float32), []
        for row in data:
            a, q = table[:, row], u @ h
            gates = 0.5 + 0.5 * np.tanh(0.5 * (a[:2 * n] + q[:2 * n]))
            z, r = gates[:n], gates[n:]
            new = np.tanh(a[2 * n:] + r * q[2 * n:])
            if keep is not None:
                keep.append((h, z, r, new, q[2 * n:]))
            h = new + z * (h - new)
            out.append(h)
        return out

    def probabilities(self, fwd: np.ndarray, bwd: np.ndarray) -> np.ndarray:
        logits = self.w["of"] @ fwd + self.w["ob"] @ bwd + self.w["c"]
        e = np.exp(logits - logits.max(0))
        return e / e.sum(0)

    def gradients(self, data: np.ndarray, used: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over used bytes; backpropagation through time in both directions."""
        steps, share = len(data), 1 / used.sum()
        kept = {"f": [], "b": []}
        states = {"f": self.read("f", data, kept["f"]), "b": self.read("b", data[::-1], kept["b"])}
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        errors = []
        for t in range(steps):
            fwd, bwd = states["f"][t], states["b"][steps - 1 - t]
            e = self.probabilities(fwd, bwd)
            e[y, np.arange(len(y))] -= 1
            e *= used[t] * share
            g["of"] += e @ fwd.T
            g["ob"] += e @ bwd.T
            g["c"] += e.sum(1, keepdims=True)
            errors.append(e)
        for d in "fb":
            u, n = self.w["u" + d], self.w["u" + d].shape[1]
            dh = np.zeros_like(states[d][0])
            order = data if d == "f" else data[::-1]
            for t in range(steps - 1, -1, -1):
                h, z, r, new, q = kept[d][t]
                dh = dh + self.w["o" + d].T @ errors[t if d == "f" else steps - 1 - t]
                dnew = dh * (1 - z) * (1 - new * new)
                da = np.concatenate([dh * (h - new) * z * (1 - z), dnew * q * r * (1 - r), dnew])
                dq = np.concatenate([da[:2 * n], dnew * r])
                g["u" + d] += dq @ h.T
                dh = dh * z + u.T @ dq
                np.add.at(g["x" + d].T, order[t], da.T)
                g["b" + d] += da.sum(1, keepdims=True)
        return g


def windows(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes as (time, windows), used lengths, and the row of each window."""
    lengths = np.diff(offsets)
    count = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = offsets[:-1][row] + nth * size
    used = np.minimum(size, offsets[1:][row] - start)
    at = np.minimum(start + np.arange(size)[:, None], max(len(data) - 1, 0))
    out = LOWER[data[at]] if len(data) else np.zeros((size, 0), np.uint8)
    out[np.arange(size)[:, None] >= used] = 32
    return out, used, row


def fit(data: np.ndarray, used: np.ndarray, y: np.ndarray, languages: int, p: Params) -> Network:
    """Adam over random batches of windows; rare languages are drawn as often as common ones."""
    net, rng = Network(languages, p), np.random.Generator(np.random.PCG64(5))
    first, second = ({k: np.zeros_like(v) for k, v in net.w.items()} for _ in range(2))
    weight = 1 / np.sqrt(np.bincount(y, minlength=languages)[y])
    weight /= weight.sum()
    for step in range(1, p.steps + 1):
        pick = rng.choice(len(y), p.batch, p=weight)
        mask = (np.arange(p.window)[:, None] < used[pick]).astype(np.float32)
        rate = p.rate * min(1, step / 20) * (1 - 0.9 * step / p.steps)
        for k, g in net.gradients(data[:, pick], mask, y[pick]).items():
            g = np.clip(g, -1, 1)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.001 * (g * g - second[k])
            net.w[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def train(docs: DataFrame, parts: int, part: int, p: Params) -> tuple[list[str], dict[str, np.ndarray]]:
    rows = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("id"), parts, part) & F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").count().collect()  # one row per language
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return [], {}
    # at most about sample / languages documents of each
    share = F.lit(0.0)
    for r in sizes:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, p.sample / len(names) / r["count"]))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20)).select(
        "id", "lang", "text").repartition(1).sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.Generator(np.random.PCG64(9))
        parts_ = []
        for batch in batches:
            langs = np.array([names.index(x) for x in batch.column(1).to_pylist()], np.int64)
            data, used, row = windows(*buffer(batch.column(2)), p.window)
            # a few windows of each text
            order = rng.permutation(len(row))
            order = order[np.argsort(row[order], kind="stable")]
            count = np.bincount(row, minlength=len(langs))
            nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            pick = order[nth < p.per_text]
            parts_.append((data[:, pick], used[pick], langs[row[pick]]))
        if not parts_:
            return
        net = fit(np.concatenate([x[0] for x in parts_], 1), np.concatenate([x[1] for x in parts_]),
                  np.concatenate([x[2] for x in parts_]), len(names), p)
        for k, v in net.w.items():
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([v.shape[1]], pa.int32()), pa.array([v.astype(np.float32).tobytes()])],
                                             ["name", "width", "value"])

    got = sample.mapInArrow(run, "name string, width int, value binary").collect()
    return names, {r["name"]: np.frombuffer(r["value"], np.float32).reshape(-1, r["width"]) for r in got}


def predictions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", parts: int = 3, part: int = 1,
                params: Params = Params()) -> DataFrame:
    """A row per document; rows that leave ``part`` by ``parts`` do not teach."""
    p, spark = params, docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    model = spark.sparkContext.broadcast(train(docs, parts, part, p))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, weights = model.value
        net = Network(max(len(names), 1), p)
        net.w = weights or net.w
        for batch in batches:
            data, offsets = buffer(batch.column(3))
            rows, first = batch.num_rows, 0
            while first < rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
                known = batch.column(2).slice(first, last - first).to_numpy(zero_copy_only=False)
                mean = pooled(net, data, offsets[first:last + 1])
                best = mean.argmax(1)
                known = known & bool(weights)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i).slice(first, last - first) for i in (0, 1)]
                    + [pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)]),
                       pa.array(np.where(known, mean[np.arange(len(best)), best], 0.0).astype(np.float64))],
                    ["doc_id", "held_out", "lang_pred", "score"])
                first = last

    def pooled(net: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean probabilities of each row over its bytes."""
        out = np.zeros((len(offsets) - 1, len(net.w["c"])))
        cut, used, row = windows(data[offsets[0]:offsets[-1]], offsets - offsets[0], p.window)
        for i in range(0, len(row), p.columns):
            part_, n = cut[:, i:i + p.columns], used[i:i + p.columns]
            fwd, bwd = net.read("f", part_), net.read("b", part_[::-1])
            total = np.zeros((len(net.w["c"]), part_.shape[1]))
            for t in range(p.window):
                total += net.probabilities(fwd[t], bwd[p.window - 1 - t]) * (t < n)
            np.add.at(out, row[i:i + p.columns], total.T)
        return out / np.maximum(np.diff(offsets), 1)[:, None]

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("id", held_out(F.col("id"), parts, part).alias("held"), letters.alias("known"), "text")
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def op4_language(spark, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return predictions(read(spark, sf_dir, "documents"))
