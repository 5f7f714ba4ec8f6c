"""Ids and decoded texts against the library over whole texts."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from sentencepiece import sentencepiece_model_pb2

from millrace.llm import pieces

MODEL = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
SP = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ODD = ["", " ", "  ", "a ", " a", "a  b", "▁", "▁a", "a▁ ▁b", "\x00a", "a\nb\t c", "　x", "<s> x </s> <0x0A> <unk>", "é́ ﬁ 東京 \U0001F600 z", "x" * 5000, "word " * 4000,
       " ".join(f"w{i}" for i in range(3000)), "a" + " " * 40 + "b", "\n\n", "the cat the cat the"]


def expected(text):
    ids = SP.encode(text or "", add_bos=True, add_eos=True)
    return np.array(ids, "<u4").tobytes(), SP.decode(ids)


def rows_of(df):
    return sorted(((r.doc_id, bytes(r.ids), r.decoded) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [1, 200, pieces.BLOCK])
def test_equals_the_library(docs, wide, block):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "a "), (3, "a "), (77, None)]
    assert rows_of(pieces.encoded(wide(docs(rows)), MODEL, block)) == sorted(((i, *expected(t)) for i, t in rows), key=str)


def test_a_model_with_pieces_across_markers_encodes_whole_texts(docs):
    proto = sentencepiece_model_pb2.ModelProto.FromString(MODEL)
    assert pieces.separable(MODEL)
    proto.pieces.add(piece="e▁t", score=0.0, type=1)
    crossing = proto.SerializeToString()
    assert not pieces.separable(crossing)
    other = sentencepiece.SentencePieceProcessor(model_proto=crossing)
    text = "we take the tea"
    ids = other.encode(text, add_bos=True, add_eos=True)
    assert ids != SP.encode(text, add_bos=True, add_eos=True)
    assert rows_of(pieces.encoded(docs([(1, text)]), crossing)) == [(1, np.array(ids, "<u4").tobytes(), other.decode(ids))]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab ▁\n.é東", max_size=30))
def test_chunks_encode_to_the_whole(text):
    alone = SP.piece_to_id("▁")
    assert [i for c in pieces.chunks(text) for i in SP.encode(c) or [alone]] == SP.encode(text)


def test_digests_of_all_documents(spark, sf_dir):
    import hashlib
    want = {}
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids, decoded = expected(r.text)
        want[r.doc_id] = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in pieces.op12_piece_ids(spark, sf_dir).collect()} == want


def test_no_documents(docs):
    assert pieces.encoded(docs([]), MODEL).collect() == []
