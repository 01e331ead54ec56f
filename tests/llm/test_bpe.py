"""The encoder against the tokenizers library on whole tables, odd texts and random ones."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import bpe, queries

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary(bpe.read_description()))


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


ODD = [
    None, "", " \n\t", "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaa", "It's we'll I'M they'Re 'tis", "ΣΑΣ Σ ΟΔΟΣ İstanbul ǅ ß ẞ",
    "é Å ﬁ ẛ̣", "12 345 6٣", "<|endoftext|>a<|startoftext|><|endoftext|", "x<|ENDOFTEXT|>y",
    "日本語 テスト 한국어 🙂👩‍👩‍👧", "  ​﻿\x00\x01\x85 ", "...---!!! $%&| a|b", "\U0001f1e9\U0001f1ea\U000e0067",
    "the " * 30_000, "abcabcabc" * 20_000, "_foo_bar-baz__", "İİ Ⅷ ª º ʰ ǈ",
    ":\U0003d000a", "x\u1c89Y\ua7da \U00010d50 \u088f", "É<|endoftext|>\ua7ceB",
]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(library, codec, text):
    ids, decoded = expected(library, text)
    (mine,) = codec.encode([text])
    assert np.frombuffer(mine, "<u4").tolist() == ids
    assert codec.decode(mine) == decoded


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_random_texts(library, codec, texts):
    for text, mine in zip(texts, codec.encode(texts)):
        ids, decoded = expected(library, text)
        assert (np.frombuffer(mine, "<u4").tolist(), codec.decode(mine)) == (ids, decoded)


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 10_000)
    monkeypatch.setattr(bpe, "BATCH_WORDS", 20)
    codec = bpe.Codec(bpe.Vocabulary(bpe.read_description()))
    texts = [f"word{i} and other{i} again" for i in range(200)] * 2
    for text, mine in zip(texts, codec.encode(texts)):
        assert np.frombuffer(mine, "<u4").tolist() == expected(library, text)[0]
    assert len(codec.known) <= 100


def test_every_document(spark, library):
    rows = {r.doc_id: r for r in queries.QUERIES["op10_bpe"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids, decoded = expected(library, doc.text)
        packed = np.array(ids, "<u4").tobytes()
        assert rows[doc.doc_id][1:] == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
        )


def test_columns(spark, library):
    docs = spark.createDataFrame([(1, "A test<|endoftext|>", 3), (1, None, 4), (None, "", 5)], "doc_id long, text string, ids int")
    found = docs.withColumn("coded", bpe.encode(F.col("text"), bpe.read_description()))
    found = found.withColumn("n", bpe.token_count(F.col("coded"))).withColumn("back", bpe.decode("coded", bpe.read_description()))
    assert sorted((r.ids, r.n, r.back) for r in found.collect()) == [(3, 3, "a</w> test</w> <|endoftext|>"), (4, 0, ""), (5, 0, "")]
    assert bpe.code(docs.limit(0), bpe.read_description()).count() == 0
    coded = bpe.code(docs, bpe.read_description(), keep=["ids", "text"], with_ids=True)
    assert coded.columns == ["ids", "text", "ids_1", "n_tokens", "ids_sha256", "decoded_sha256"]
    packed = {r.ids: bytes(r.ids_1) for r in coded.collect()}
    assert packed == {r.ids: bytes(r.coded) for r in found.collect()}
