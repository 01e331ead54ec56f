"""Length histogram and suffix sums against plain counting."""

from __future__ import annotations

import random

import pytest

from millrace.llm import queries, tokens


def check(sums, lengths):
    rows = {r.length: r for r in sums.collect()}
    assert set(rows) == set(lengths)
    for size, r in rows.items():
        assert r.docs == lengths.count(size)
        assert r.docs_at_least == sum(n >= size for n in lengths)
        assert r.tokens_at_least == sum(n for n in lengths if n >= size)
        assert r.truncated_tokens == sum(min(n, size) for n in lengths)
    limits = [0, 1, 7, 1023, 1024, 5000, 10**9]
    for r in tokens.at_limits(sums, limits).collect():
        want = sum(min(n, r.limit) for n in lengths)
        assert (r.docs_over, r.truncated_tokens, r.lost_tokens) == (sum(n > r.limit for n in lengths), want, sum(lengths) - want)
    for r in tokens.quantiles(sums, [0.0, 0.1, 0.5, 0.99, 1.0]).collect():
        want = min((x for x in lengths if sum(n <= x for n in lengths) >= r.share * len(lengths)), default=None)
        assert r.length == want


@pytest.mark.parametrize("seed", range(3))
def test_suffix_sums(spark, seed):
    rnd = random.Random(seed)
    lengths = [rnd.choice([0, 3, rnd.randrange(5000), 1024, 2048, 100_000]) for _ in range(200)]
    frame = spark.createDataFrame([(n,) for n in lengths], "n long")
    check(tokens.suffix_sums(tokens.length_histogram(frame, frame["n"])), lengths)


def test_texts(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import public_tokenizers

    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    texts = [None, "", "a b  c\n\n d", "<|endoftext|>", "é" * 500, "x" * 20_000, "word " * 30_000, "word " * 30_000]
    docs = spark.createDataFrame([(t, 1) for t in texts], "text string, length int")
    lengths = [len(library.encode(t or "", add_special_tokens=False).ids) for t in texts]
    check(tokens.token_counts(docs), lengths)
    empty = tokens.token_counts(docs.limit(0))
    assert empty.count() == 0
    assert [tuple(r) for r in tokens.at_limits(empty, [5]).collect()] == [(5, 0, 0, 0)]
    assert tokens.quantiles(empty, [0.5]).first().length is None


def test_documents(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    texts = [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    lengths = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    check(queries.QUERIES["op1_token_counts"](spark, folder), lengths)
