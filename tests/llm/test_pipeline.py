"""The pipeline stage by stage against brute force, and as a whole."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm import mixing, simhash
from tests.llm.test_quality import brute as judged
from tests.llm.test_simhash import brute, slow_print

FOLDER = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """Input and result of every stage, each result written and read again."""
    from millrace import session

    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = session.settle(stage(spark, docs, FOLDER), name)
        out[name] = (docs, done)
        docs = done
    return out


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "simhash", "mixing", "bpe"]
    assert all(done.columns == COLUMNS for n, (_, done) in steps.items() if n != "bpe")


def test_quality(steps):
    docs, done = steps["quality"]
    kept = {r.doc_id: r.text for r in done.collect()}
    whole = {r.doc_id: r.text for r in docs.collect()}
    assert set(kept) == {i for i, t in whole.items() if not judged(t)[5]}  # no boilerplate at this size
    assert all(whole[i] == t for i, t in kept.items())


def test_language(steps):
    docs, done = steps["language"]
    assert done.count() == docs.where("text rlike '[\\\\p{L}]'").count()


def test_simhash(steps):
    docs, done = steps["simhash"]
    prints = {r.doc_id: slow_print(r.text) for r in docs.collect()}
    assert sorted(r.doc_id for r in done.collect()) == sorted(set(brute(prints).values()))


def test_mixing(steps):
    docs, done = steps["mixing"]
    planned = {r.doc_id: r.mix_copies for r in mixing.plan_mix(docs).collect()}
    assert Counter(r.doc_id for r in done.collect()) == Counter({i: n for i, n in planned.items() if n})


def test_bpe(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs, done = steps["bpe"]
    want = Counter()
    for r in docs.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        packed = np.array(ids, "<u4").tobytes()
        want[r.doc_id, packed, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()] += 1
    got = Counter((r.doc_id, bytes(r.ids), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in done.collect())
    assert got == want


def test_run_gives_the_last_stage(spark, steps):
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.drop("ids").collect())) == sorted(map(tuple, steps["bpe"][1].drop("ids").collect()))


def test_odd_tables(spark, tmp_path):
    """Empty tables, NULLs in every column, repeated rows, extra columns with the operators' own names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, cut int, language string, mix_size int, kept_id int"
    text = " ".join(f"w{i} kind" for i in range(40))
    rows = [(None,) * 10, (1, text, "en", None, 3, "", 1, "", 1, 1), (1, text, "en", None, 3, "", 1, "", 1, 1), (2, "", None, "s", 0, "", 1, "", 1, 1), (3, None, "en", "s", 0, "", 1, "", 1, 1)]
    for name, data in (("empty", []), ("odd", rows)):
        folder = str(tmp_path / name)
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/documents.parquet")
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, folder)
            assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert {r.doc_id for r in docs.collect()} == ({1} if data else set())
        assert corpus_pipeline.run(spark, folder).count() == docs.count()


def test_whole_tables(spark):
    """Fingerprint components of a larger table with many near copies against all pairs in blocks."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    least: dict[int, int] = {}
    for doc, fp, _ in rows:
        least[fp] = min(doc, least.get(fp, doc))
    fps = sorted(least)
    values = np.array(fps, dtype=np.int64).view(np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(values[i] ^ values[i + 1 :]) <= 3) + i + 1:
            root[find(int(j))] = find(i)
    smallest: dict[int, int] = {}
    for i, fp in enumerate(fps):
        r = find(i)
        smallest[r] = min(least[fp], smallest.get(r, least[fp]))
    place = {fp: smallest[find(i)] for i, fp in enumerate(fps)}
    assert {(doc, fp, comp) for doc, fp, comp in rows} == {(doc, fp, place[fp]) for doc, fp, _ in rows}
