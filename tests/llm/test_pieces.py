from __future__ import annotations

import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kpiloom.llm import pieces
from tests.llm.conftest import documents, prose

public = pytest.importorskip("public_tokenizers")
MODEL = open(pieces.default_model(), "rb").read()
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
HARD = ["", " ", "  a  b ", "a\nb\tc", "\n \n", "Ａﬁ", "a▁b", "▁", "\x00x", "<s> x </s> <unk> <0x41>", "日本😀‍ é", "�", " " * 40, "a" * 300, "0123456789", "́́", "I'm\r\n--== {x};"]


@pytest.mark.parametrize("text", HARD)
def test_like_the_library(text):
    codec = pieces.codec_of(MODEL)
    assert codec.encode(text) == LIBRARY.encode(text)
    assert codec.decode(LIBRARY.encode(text)) == LIBRARY.decode(LIBRARY.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n▁aehist.<>0x")), max_size=60))
def test_like_the_library_on_any_text(text):
    codec = pieces.codec_of(MODEL)
    ids = LIBRARY.encode(text)
    assert codec.agenda(LIBRARY.normalize(text)) == ids == codec.encode(text)
    assert codec.decode(ids) == LIBRARY.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(3, 600), max_size=12))
def test_decodes_any_ids(ids):
    assert pieces.codec_of(MODEL).decode(ids) == LIBRARY.decode(ids)


def test_a_difference_is_found():
    codec = pieces.PieceCodec(MODEL)
    codec.order[:] = pieces.NONE
    with pytest.raises(ValueError, match="the library"):
        codec.encode("the thing to try")


def test_query_over_texts(spark, rng, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 500)
    texts = [*HARD, None, prose(rng, 3000) + "\n\n " + prose(rng, 4000), *(prose(rng, 40) for _ in range(60))]
    docs = documents(spark, texts, ids=[None, *range(1, len(texts))]).withColumns({"ids": F.lit(1), "n_tokens": F.lit("x")})
    got = {r.doc_id: r for r in pieces.tokenised(docs, pieces.default_model(), with_ids=True).collect()}
    for i, t in enumerate(texts):
        ids, r = LIBRARY.encode(t or ""), got[i or None]
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
    assert pieces.tokenised(docs.limit(0), pieces.default_model()).collect() == []


def test_long_texts_are_cut_into_windows(rng, monkeypatch):
    monkeypatch.setattr(pieces, "WINDOW", 300)
    codec, text = pieces.PieceCodec(MODEL), prose(rng, 900) + " " * 700 + "\n" * 400 + "é" * 700
    assert codec.encode(text) == LIBRARY.encode(text)
    assert codec.digests(["", text])[1][2] == hashlib.sha256(text.encode()).hexdigest()


def test_the_cache_is_bounded(rng, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 50)
    codec = pieces.PieceCodec(MODEL)
    for _ in range(5):
        texts = [prose(rng, 40), "", prose(rng, 30) + " x" * 50]
        assert [n for n, _, _ in codec.digests(texts)] == [len(LIBRARY.encode(t)) for t in texts]
        assert len(codec.known) <= 200
