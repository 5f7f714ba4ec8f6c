"""Encoding and decoding with a sentencepiece model, by a table of distinct chunks.

The library puts a marker before a text and a marker in the place of every space.  Where no piece of the model holds a
marker after another character, no merge crosses the place before a run of markers: a text is cut there, and its
chunks are encoded on their own.  Tasks cut texts into blocks; a block numbers its distinct chunks and keeps, per document,
the numbers by position.  Chunks that a block has several times go, dealt by chunk, to one table, where each is encoded once
for all blocks; the ids return to the blocks that hold it.  A chunk that stands once in its block is encoded in place, which
moves less than sending it.  In a block the ids are put together by position and decoded as a whole.

A block is named by its task and a checksum of its chunks, so if a task is run again on rows in another order, ids and
numbers that don't belong together fail and are not mixed.  Rows of a stored table come in one order.

For a model that is not like this (pieces across markers, a normalizer that changes more than spaces) whole
texts are encoded by the library; the result is the same by definition, the table of chunks is not used.

Defined cases: null and empty texts have the begin and end id only; rows that repeat and rows without id have rows of
their own; U+2581 in a text is a marker, as in the library; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from sentencepiece import sentencepiece_model_pb2

from millrace.llm.text import read, small_batches, whole

MARK = "▁"
#: bytes of text in a block, but for a longer document, which is a block of its own
BLOCK = 16 << 20
#: chunks that are encoded at once
SLICE = 10_000
#: one marker, then what is encoded as a text of its own
CHUNK = re.compile(r" ( *[^ ]*)")
OUT = "doc_id bigint, ids binary, decoded string"


@lru_cache(maxsize=2)
def _processor(model: bytes) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def separable(model: bytes) -> bool:
    """Whether texts can be cut before runs of markers."""
    proto = sentencepiece_model_pb2.ModelProto.FromString(model)
    spec, trained = proto.normalizer_spec, proto.trainer_spec
    plain = (not spec.precompiled_charsmap and not proto.denormalizer_spec.precompiled_charsmap and spec.add_dummy_prefix
             and not spec.remove_extra_whitespaces and spec.escape_whitespaces and not trained.treat_whitespace_as_suffix)
    # a model without byte fallback makes one unknown id of neighbours
    return plain and trained.byte_fallback and not any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)


def chunks(text: str) -> list[str]:
    """The chunks of a text, each without its first marker."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    return CHUNK.findall(" " + text) if "  " in text or text[-1] == " " or text[0] == " " else text.split(" ")


class _Numbers(dict):
    """Numbers of chunks by first occurrence."""

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        return n


_CUT = "block bigint, code int, chunk string, texts binary, known binary"
_PAIRS = "block bigint, code int, chunk string"


def _packed(columns: dict[str, pa.Array]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pydict(columns)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _chunk_ids(sp, found: list[str]) -> list[np.ndarray]:
    """Ids of chunks with their marker: an empty text has no marker, a chunk without more than its marker has one."""
    alone = [sp.piece_to_id(MARK)]
    return [np.array(i or alone, "<u4") for i in sp.encode(found, num_threads=1)]


def cut(docs: DataFrame, model: bytes, size: int = BLOCK) -> DataFrame:
    """Blocks of documents ``doc_id, text``: a row with the documents, and a row per chunk that the block has again.

    The numbers of these chunks come first; ``known`` has the ids of the others in order.
    """
    names = [c.split()[0] for c in _CUT.split(", ")]
    types = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()]

    def closed(name: int, numbers: _Numbers, ids: list, codes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, flat = np.array(list(numbers), object), np.concatenate(codes)
        times = np.bincount(flat, minlength=len(found))
        order = np.argsort(-times, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        again = int((times > 1).sum())
        sp, once, sizes = _processor(model), [np.zeros(0, "<u4")], [np.zeros(0, np.uint32)]
        for lo in range(again, len(found), SLICE):
            ids_ = _chunk_ids(sp, found[order[lo:lo + SLICE]].tolist())
            once.append(np.concatenate(ids_))
            sizes.append(np.array([len(i) for i in ids_], np.uint32))
        number, ends = place[flat], np.cumsum([0, *map(len, codes)])
        planes = {f"b{i}": pa.LargeListArray.from_arrays(ends, pa.array((number >> 8 * i & 255).astype(np.uint8))) for i in range(4)}
        chunk = found[order[:again]].tolist()
        block = name << 16 | zlib.crc32(chr(0).join(chunk).encode()) & 0xFFFF
        row = [[block], [None], [None], [_packed({"doc_id": pa.array(ids, pa.int64()), **planes})],
               [_packed({k: pa.array([np.concatenate(v)], pa.large_list(pa.uint32())) for k, v in (("ids", once), ("sizes", sizes))})]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, types)], names)
        if again:
            rows = [[block] * again, range(again), chunk, None, None]
            yield pa.RecordBatch.from_arrays([pa.nulls(again, t) if c is None else pa.array(c, t) for c, t in zip(rows, types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n = TaskContext.get().partitionId(), 0
        numbers, ids, codes, held = _Numbers(), [], [], 0
        for rows in batches:
            for doc_id, text in zip(*(c.to_pylist() for c in rows.columns)):
                codes.append(np.array(list(map(numbers.__getitem__, chunks(text))), np.int32))
                ids.append(doc_id)
                held += len(text)
                if held >= size:
                    yield from closed(task << 16 | n, numbers, ids, codes)
                    n, numbers, ids, codes, held = n + 1, _Numbers(), [], [], 0
        if ids:
            yield from closed(task << 16 | n, numbers, ids, codes)

    return docs.mapInArrow(run, _CUT)


def segmented(blocks: DataFrame, model: bytes) -> DataFrame:
    """``of, code, ids``: the ids of the chunks that blocks sent, each distinct chunk encoded once."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            yield rows.filter(rows.column("chunk").is_valid()).select(["block", "code", "chunk"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, last, known = _processor(model), None, None
        for rows in batches:  # in order of chunk
            found = rows.column(2).to_pylist()
            new = [c for c, before in zip(found, [last, *found]) if c != before]
            encoded_ = iter([i.tobytes() for i in _chunk_ids(sp, new)])
            ids = []
            for c in found:
                if c != last:
                    last, known = c, next(encoded_)
                ids.append(known)
            yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(ids, pa.binary())], ["of", "code", "ids"])

    # the filter is in Python so that both uses of the blocks read one shuffle
    pairs = blocks.mapInArrow(sent, _PAIRS).repartition("chunk").sortWithinPartitions("chunk")
    return pairs.mapInArrow(run, "of bigint, code int, ids binary")


def _rows(sp, doc_ids: list, ids: list[np.ndarray]) -> pa.Table:
    decoded = [sp.decode(i.tolist()) for i in ids]
    return pa.table([pa.array(doc_ids, pa.int64()), pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"])


def put_together(blocks: DataFrame, known: DataFrame, model: bytes) -> DataFrame:
    """Documents of :func:`cut` with the ids of their chunks in order, between the begin and end id."""
    def run(block: pa.Table, sent: pa.Table) -> pa.Table:
        sp = _processor(model)
        here = block.filter(block["texts"].is_valid())
        if here.num_rows != 1 or block.num_rows - 1 != sent.num_rows:
            raise ValueError("a block and the ids of its chunks are from different runs of a task")
        docs, once = _unpacked(here["texts"][0].as_py()), _unpacked(here["known"][0].as_py())
        again: list = [b""] * sent.num_rows
        for code, ids in zip(sent["code"].to_pylist(), sent["ids"].to_pylist()):
            again[code] = ids
        flat = np.concatenate([np.frombuffer(b"".join(again), "<u4"), once["ids"][0].values.to_numpy()])
        sizes = np.concatenate([np.array([len(i) // 4 for i in again], np.int64), once["sizes"][0].values.to_numpy()])
        starts = np.cumsum(sizes) - sizes
        planes = [docs[f"b{i}"].combine_chunks() for i in range(4)]
        ends = planes[0].offsets.to_numpy()
        number = sum(p.values.to_numpy().astype(np.int64) << 8 * i for i, p in enumerate(planes))
        out = []
        for lo, hi in zip(ends, ends[1:]):
            at = number[lo:hi]
            n = sizes[at]
            upto = np.cumsum(n)
            ids = np.empty(2 + n.sum(), np.int64)
            ids[0], ids[-1] = sp.bos_id(), sp.eos_id()
            ids[1:-1] = flat[np.arange(n.sum()) + np.repeat(starts[at] - (upto - n), n)]
            out.append(ids)
        return _rows(sp, docs["doc_id"].to_pylist(), out)

    return blocks.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(run, OUT)


def encoded(docs: DataFrame, model: bytes, block: int = BLOCK) -> DataFrame:
    """``doc_id, ids, decoded`` of the documents of a stored table: ids, with begin and end, as little-endian unsigned 32-bit
    integers, and the text they decode to."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole(F.col("text")).alias("text"))
    if separable(model):
        blocks = cut(docs, model, block).repartition("block")
        return put_together(blocks, segmented(blocks, model), model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(model)
        for rows in batches:
            ids = [np.array(sp.encode(t, add_bos=True, add_eos=True), np.int64) for t in rows.column(1).to_pylist()]
            yield from _rows(sp, rows.column(0).to_pylist(), ids).to_batches()

    return docs.mapInArrow(run, OUT)


def op12_piece_ids(spark, sf_dir: str, model_file: str | None = None) -> DataFrame:
    """Digests of the ids and the decoded text of all documents."""
    if model_file is None:
        import public_tokenizers
        model_file = public_tokenizers.path("piece_bpe_32k.model")
    with open(model_file, "rb") as file:
        model = file.read()
    out = encoded(read(spark, sf_dir, "documents"), model)
    return out.select("doc_id", F.floor(F.length("ids") / 4).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
