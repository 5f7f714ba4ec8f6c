"""Language model scores from a probabilistic suffix tree.

Symbols are the bytes of lower-cased words, a blank after each word and one
end; states are contexts of up to ``depth`` symbols.  A context stays in the
tree if it was seen a fixed number of times and its next-symbol distribution
diverges from that of its longest proper suffix by a likelihood-ratio test, or
if a longer context that ends in it stays; so the tree grows with the input.
Distributions are smoothed with the suffix's.  A text is scored with the longest
state that ends each position; the probability of a word is mixed half and half
with the unigram one, whose counts come from all training texts.

Words have to meet their counts, and symbols their probabilities.  Counting keeps
each part of the input as a block with the distinct words and the distinct runs
of ``depth + 1`` symbols in it.  The tree is a distributed table with the
probability of each run's last symbol; the counts of a block's words and the
probabilities of its runs go to the block, not to every place of the text, and
the block is scored in one stream: its tables first, then its texts.  No part of
the tree is broadcast.  Words are 64-bit hashes.

Defined cases: null texts are empty and have the end only; rows that are
repeated get a row each and train as often as they stand there; rows without id
are held out; with no training text all tokens are unknown; empty tables give
no rows; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.llm.text import read, small_batches, stored
from millrace.llm.tokens import BLANK, LOWER, Piece, pieces

END = 65          # no lower-cased text holds an A
PAD = 32
END_WORD = -1     # code of the end as a token


@dataclass(frozen=True)
class Params:
    depth: int = 5
    least: int = 20             # training positions that a context precedes
    divergence: float = 20.0    # log-likelihood ratio by which a context must improve on its suffix
    smoothing: float = 4.0      # observations that a suffix's distribution counts as
    block_words: int = 1_000_000


def held_out(ids: list, parts: int, part: int) -> np.ndarray:
    """Rows whose crc32 of the id as text leaves the remainder ``part``; rows without id are held out."""
    return np.array([i is None or zlib.crc32(str(i).encode()) % parts == part for i in ids], bool)


def stream(piece: Piece, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all rows (``depth`` pads before each), where their tokens start, and the token bounds of the rows."""
    lengths = piece.ends - piece.starts
    rows = len(piece)
    row_of = np.repeat(np.arange(rows), np.diff(piece.bounds))
    words = len(lengths)
    first = np.cumsum(lengths) - lengths
    begins = first + np.arange(words) + row_of + depth * (row_of + 1)
    total = int(lengths.sum()) + words + rows * (1 + depth)
    out = np.full(total, PAD, np.uint8)
    letters = LOWER[piece.data[~BLANK[piece.data]]]
    out[np.arange(len(letters)) + np.repeat(begins - first, lengths)] = letters
    size = np.bincount(row_of, lengths + 1, minlength=rows).astype(np.int64) + 1 + depth
    ends = np.cumsum(size) - 1
    out[ends] = END
    bounds = piece.bounds + np.arange(rows + 1)
    starts = np.empty(words + rows, np.int64)
    starts[np.arange(words) + row_of] = begins
    starts[bounds[1:] - 1] = ends
    return out, starts, bounds


def runs(symbols: np.ndarray, starts: np.ndarray, bounds: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Code of the run that ends in each symbol from the ``depth``-th on, and whether that symbol is no pad."""
    code = np.zeros(len(symbols) - depth, np.int64)
    for j in range(depth + 1):
        code = (code << 8) | symbols[j:len(symbols) - depth + j]
    use = np.ones(len(symbols), bool)
    row_starts = np.append(0, starts[bounds[1:] - 1][:-1] + 1)
    for j in range(depth):
        use[row_starts + j] = False
    return code, use[depth:]


class _Tally:
    """Sum of counts by code; parts are merged when many have come together."""

    def __init__(self):
        self.codes, self.counts, self.size = [], [], 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        self.codes.append(codes)
        self.counts.append(counts)
        self.size += len(codes)
        if self.size > 4_000_000:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, back = np.unique(np.concatenate(self.codes), return_inverse=True)
        counts = np.bincount(back, np.concatenate(self.counts), minlength=len(codes)).astype(np.int64)
        self.codes, self.counts, self.size = [codes], [counts], 0
        return codes, counts


_COUNTED = "kind int, block bigint, code bigint, n bigint, blob binary"
_WORD, _GRAM, _TEXTS = 0, 1, 2


def _rows(kind: int, block: int, codes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(codes), 100_000):
        c = codes[i:i + 100_000]
        yield _batch(np.full(len(c), kind, np.int32), np.full(len(c), block), c.view(np.int64), counts[i:i + 100_000], [None] * len(c))


def _batch(kind, block, code, n, blob) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(block, pa.int64()), pa.array(code, pa.int64()),
                                       pa.array(n, pa.int64()), pa.array(blob, pa.binary())], ["kind", "block", "code", "n", "blob"])


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def counted(docs: DataFrame, parts: int, part: int, p: Params) -> DataFrame:
    """Blocks of ``id, text`` rows: training counts of the words and symbol runs in each, and their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        words, grams = _Tally(), _Tally()
        for batch in batches:
            held = held_out(batch.column(0).to_pylist(), parts, part)
            yield _batch([_TEXTS], [block], [0], [0], [_packed(batch)])
            for piece in pieces(batch.column(1)):
                train = ~held[piece.first:piece.first + len(piece)]
                row_of = np.repeat(np.arange(len(piece)), np.diff(piece.bounds))
                found, back = np.unique(piece.words, return_inverse=True)
                counts = np.bincount(back, train[row_of], minlength=len(found)).astype(np.int64)
                words.add(found.view(np.int64), counts)
                words.add(np.array([END_WORD]), np.array([train.sum()]))
                symbols, starts, bounds = stream(piece, p.depth)
                # held out rows do not train, but their runs are looked up
                code, use = runs(symbols, starts, bounds, p.depth)
                sizes = np.diff(starts[bounds[1:] - 1], prepend=-1)
                both, n = np.unique((code[use] << 1) | np.repeat(train, sizes)[p.depth:][use], return_counts=True)
                grams.add(both >> 1, n * (both & 1))
            if words.size > p.block_words and len((merged := words.merge())[0]) > p.block_words:
                yield from _rows(_WORD, block, *merged)
                yield from _rows(_GRAM, block, *grams.merge())
                words, grams, block = _Tally(), _Tally(), block + 1
        yield from _rows(_WORD, block, *words.merge())
        yield from _rows(_GRAM, block, *grams.merge())

    return docs.mapInArrow(run, _COUNTED)


@dataclass
class Tree:
    """``child`` and ``logp`` by state and symbol column; state 0 is the empty context, the last one is no state."""

    depth: int
    column: np.ndarray   # symbol to column
    child: np.ndarray
    logp: np.ndarray

    def word_logp(self, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of each token of a stream."""
        column, wide, none = self.column[symbols], self.child.shape[1], len(self.child) - 1
        at, state = np.zeros(len(symbols), np.int32), np.zeros(len(symbols), np.int32)
        child, logp = self.child.ravel(), self.logp.ravel()
        for k in range(1, self.depth + 1):
            at[k:] = child[at[k:] * wide + column[:-k]]
            at[:k] = none
            np.copyto(state, at, where=at != none)
        return token_sums(logp[state * wide + column], symbols, starts)


def token_sums(scores: np.ndarray, symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the symbols' scores of each token of a stream."""
    # pads before a row come after the last token of the row before: its end is one symbol
    ends = np.append(starts[1:], len(symbols))
    last = symbols[starts] == END
    ends[last] = starts[last] + 1
    total = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    return total[ends] - total[starts]


def _sorted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes in order with their values, and one that is larger than all."""
    codes = np.concatenate([x[0] for x in parts] or [np.zeros(0, np.int64)])
    values = np.concatenate([x[1] for x in parts] or [np.zeros(0, np.int64)])
    order = np.argsort(codes)
    return np.append(codes[order], np.iinfo(np.int64).max), np.append(values[order], values.dtype.type(0))


def grown(grams: DataFrame, p: Params) -> Tree:
    """The tree of counted symbol runs ``code, n`` in one process: for small corpora, and to compare :func:`predicted` with."""
    level = stored(grams.groupBy("code").agg(F.sum("n").alias("n")), "suffix-tree-runs")
    total = level.agg(F.sum("n")).first()[0] or 0
    tables: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(p.depth, -1, -1):
        level = level.groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n"))
        frequent = level.groupBy(F.shiftright("code", 8).alias("context")).agg(F.sum("n").alias("of")).where(
            F.col("of") >= p.least)
        got = level.join(frequent, F.shiftright("code", 8) == F.col("context")).select("code", "n").toArrow()
        order = np.argsort(codes := got["code"].to_numpy())
        tables.append((codes[order], got["n"].to_numpy()[order].astype(np.float64)))
    tables.reverse()

    seen = np.unique(tables[0][0]) if total else np.zeros(0, np.int64)
    column = np.full(256, len(seen), np.int32)
    column[seen] = np.arange(len(seen))
    wide = len(seen) + 1
    root = np.zeros(256)
    root[tables[0][0]] = tables[0][1]
    root = (root + p.smoothing / 256) / (root.sum() + p.smoothing)
    unseen = np.setdiff1d(np.arange(256), seen)
    dist = [np.append(root[seen], root[unseen[0]] if len(unseen) else 1e-12)[None, :]]
    contexts, parents, worth = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.full(1, np.inf)]
    for k in range(1, p.depth + 1):
        codes, n = tables[k]
        ctx, of = np.unique(codes >> 8, return_inverse=True)
        parent = np.searchsorted(contexts[-1], ctx & ((1 << 8 * (k - 1)) - 1)) if len(ctx) else np.zeros(0, np.int64)
        below = dist[-1][parent] if len(ctx) else np.zeros((0, wide))
        counts = np.zeros((len(ctx), wide))
        counts[of, column[codes & 255]] = n
        own = (counts + p.smoothing * below) / (counts.sum(1, keepdims=True) + p.smoothing)
        gain = (counts * np.log(np.where(counts > 0, own / below, 1.0))).sum(1)
        contexts.append(ctx)
        parents.append(parent)
        worth.append(gain)
        dist.append(own.astype(np.float32))
    keep = [w >= p.divergence for w in worth]
    for k in range(p.depth, 0, -1):
        keep[k - 1][parents[k][keep[k]]] = True
    number, states = [np.where(keep[0], 0, -1)], 1
    for k in range(1, p.depth + 1):
        number.append(np.where(keep[k], np.cumsum(keep[k]) - 1 + states, -1))
        states += int(keep[k].sum())
    child = np.full((states + 1, wide), states, np.int32)
    for k in range(1, p.depth + 1):
        kept = keep[k]
        oldest = contexts[k][kept] >> 8 * (k - 1)
        child[number[k - 1][parents[k][kept]], column[oldest]] = number[k][kept]
    logp = np.concatenate([d[keep[k]] for k, d in enumerate(dist)] + [np.ones((1, wide))])
    return Tree(p.depth, column, child, np.log10(logp).astype(np.float32))


def predicted(grams: DataFrame, p: Params) -> DataFrame:
    """Rows ``code, q`` of counted runs ``code, n``: log10 probability of a run's last symbol in the longest state before it."""
    masked = lambda bytes_: F.col("code").bitwiseAND(F.lit((1 << 8 * bytes_) - 1))
    levels = [stored(grams.groupBy("code").agg(F.sum("n").alias("n")), "suffix-tree-runs")]
    for k in range(p.depth - 1, -1, -1):
        levels.append(stored(levels[-1].groupBy(masked(k + 1).alias("code")).agg(F.sum("n").alias("n")), "suffix-tree-runs"))
    levels.reverse()
    total = levels[0].agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # from short to long: smoothed probabilities, and whether a context improves on its suffix
    table = levels[0].select("code", ((F.col("n") + p.smoothing / 256) / (total + p.smoothing)).alias("p"))
    tables = [table]
    of_context = W.partitionBy("context")  # at most 256 rows
    for k in range(1, p.depth + 1):
        rows = levels[k].withColumn("suffix", masked(k)).join(table.toDF("suffix", "below"), "suffix")
        rows = rows.withColumn("context", F.shiftright("code", 8)).withColumn("of", F.sum("n").over(of_context))
        rows = rows.withColumn("p", (F.col("n") + p.smoothing * F.col("below")) / (F.col("of") + p.smoothing))
        gain = F.sum(F.col("n") * F.log(F.col("p") / F.col("below"))).over(of_context)
        whole = stored(rows.withColumn("good", (F.col("of") >= p.least) & (gain >= p.divergence)).select("code", "context", "p", "good"), "suffix-tree-states")
        tables.append(whole)
        table = whole.select("code", "p")
    # from long to short: a context stays with a longer one that ends in it
    stay: list[DataFrame | None] = [None] * (p.depth + 1)
    for k in range(p.depth, 0, -1):
        own = tables[k].where("good").select("context")
        if k < p.depth:
            own = own.unionByName(stay[k + 1].select(F.col("context").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("context")))
        stay[k] = stored(own.distinct(), "suffix-tree-kept")
    # from short to long: the probability in the longest state
    found = tables[0].select("code", F.col("p").alias("q"))
    for k in range(1, p.depth + 1):
        rows = tables[k].withColumn("suffix", masked(k)).join(found.toDF("suffix", "shorter"), "suffix")
        rows = rows.join(stay[k].withColumn("stays", F.lit(True)), "context", "left")
        found = rows.select("code", F.when(F.col("stays"), F.col("p")).otherwise(F.col("shorter")).alias("q"))
    return found.select("code", F.log10("q").cast("float").alias("q"))


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", parts: int = 10, part: int = 0,
           params: Params = Params()) -> DataFrame:
    """A row per document; texts whose crc32 of the id leaves ``part`` by ``parts`` do not train."""
    spark, p = docs.sparkSession, params
    small_batches(spark)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    raw = stored(counted(docs, parts, part, p), "suffix-tree")
    # a word has a row per block that holds it; one shuffle by word brings them together
    word = W.partitionBy("code").orderBy("block")
    totals = raw.where(f"kind = {_WORD}").select(
        "block", "code", F.sum("n").over(word.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("c"),
        (F.row_number().over(word) == 1).alias("first"))
    known = stored(totals.where("c > 0"), "suffix-tree-words")
    n_all, n_distinct = known.where("first").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    grams = raw.where(f"kind = {_GRAM}").select("block", "code", "n")
    none = lambda kind: F.lit(None).cast(kind)
    known = known.select("block", F.lit(_WORD).alias("kind"), "code", "c", none("float").alias("q"), none("binary").alias("blob"))
    chances = grams.join(predicted(grams, p), "code").select(
        "block", F.lit(_GRAM).alias("kind"), "code", none("bigint").alias("c"), "q", none("binary").alias("blob"))
    texts = raw.where(f"kind = {_TEXTS}").select("block", "kind", none("bigint").alias("code"), none("bigint").alias("c"),
                                                none("float").alias("q"), "blob")
    rows = known.unionByName(chances).unionByName(texts).repartition("block").sortWithinPartitions("block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, tables, maps = None, ([], []), None
        for batch in batches:
            blocks, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(blocks) | np.diff(kinds)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(blocks)]):
                if lo == hi:
                    continue
                if blocks[lo] != at:
                    at, tables, maps = blocks[lo], ([], []), None
                if kinds[lo] != _TEXTS:
                    value = batch.column(3 if kinds[lo] == _WORD else 4).slice(lo, hi - lo).to_numpy()
                    tables[kinds[lo]].append((batch.column(2).slice(lo, hi - lo).to_numpy(), value))
                    continue
                if maps is None:
                    maps = [_sorted(x) for x in tables]
                    tables = ([], [])
                for i in range(lo, hi):
                    for texts_ in pa.ipc.open_stream(batch.column(5)[i].as_py()):
                        yield from scored(texts_, *maps[0], *maps[1])

    def scored(texts_: pa.RecordBatch, codes: np.ndarray, values: np.ndarray, ends_in: np.ndarray, chance: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, rest = texts_.column(0), math.log10(n_all + 0.1 * (n_distinct + 1))
        held = held_out(ids.to_pylist(), parts, part)
        for piece in pieces(texts_.column(1)):
            symbols, starts, bounds = stream(piece, p.depth)
            word = np.full(len(starts), END_WORD, np.int64)
            inner = np.ones(len(starts), bool)
            inner[bounds[1:] - 1] = False
            word[inner] = piece.words.view(np.int64)
            place = np.searchsorted(codes, word)
            c = np.where(codes[place] == word, values[place], 0)
            base = np.log10(c + 0.1) - rest
            run_codes, use = runs(symbols, starts, bounds, p.depth)
            places = np.zeros(len(symbols), np.float64)
            distinct, back = np.unique(run_codes[use], return_inverse=True)
            places[p.depth:][use] = chance[np.searchsorted(ends_in, distinct)][back]
            mixed = np.log10(0.5 * 10.0 ** base + 0.5 * 10.0 ** token_sums(places, symbols, starts))
            n = np.diff(bounds)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(piece.first, len(piece)), pa.array(held[piece.first:piece.first + len(piece)]), pa.array(n),
                 pa.array(np.add.reduceat((c > 0).astype(np.int64), bounds[:-1])), pa.array(np.full(len(n), n_all, np.int64)),
                 pa.array(np.add.reduceat(base, bounds[:-1])), pa.array(np.add.reduceat(mixed, bounds[:-1]))],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                "base_score double, score double")


def op5_suffix_tree_scores(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents."""
    return scores(read(spark, sf_dir, "documents"))
