"""Language prediction: brute-force shares, held-out accuracy, odd texts."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, queries

LINES = {
    "xx": "bada gada dabo gobad dagob abogad",
    "yy": "mini mono nomi nimon omin imono",
    "zz": "susu rusu ursus rurus surus usur",
}


def slow_grams(text):
    out = []
    folded = "\x01" + "".join(c.lower()[0] if c.isalpha() else "\x01" for c in text) + "\x01"
    for size in langid.SIZES:
        for i in range(len(folded) - size + 1):
            gram = folded[i : i + size]
            if "\x01" not in gram[1:-1] and not (gram[0] == "\x01" == gram[-1]):
                out.append(gram)
    return out


def test_grams_in_pieces(monkeypatch):
    text = "Ab c, Déf ghij—x! éé 12 a" * 40
    whole = np.sort(np.concatenate(list(langid.grams(text))))
    assert len(whole) == len(slow_grams(text))
    assert len(set(whole.tolist())) == len(set(slow_grams(text)))
    for chunk in (4, 7, 64):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert (np.sort(np.concatenate(list(langid.grams(text)))) == whole).all()


def test_masks_hold_every_language_of_a_gram():
    filters = {k: np.unique(np.concatenate(list(langid.grams(v)))) for k, v in LINES.items()}
    model = langid.Model.build(filters)
    for i, name in enumerate(model.languages):
        shares = model.shares(LINES[name])
        assert shares[i] > 0.999 and shares.argmax() == i
    many = {f"l{i:03d}": filters["xx"] if i == 70 else filters["yy"] for i in range(100)}
    assert langid.Model.build(many).predict(LINES["xx"])[0] == "l070"
    assert langid.Model.build(many).predict(LINES["yy"])[0] == "l000"  # ties: the lesser name


def test_learning_and_odd_texts(spark):
    rows = [(i, line, name, "x") for name, line in LINES.items() for i in range(5)] + [(9, "bada", None, ""), (9, None, "xx", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, language string")
    model = langid.learn(docs)
    odd = spark.createDataFrame(
        [(None, "", 0), (1, None, 0), (2, "12 !? \n", 0), (3, "Gobad dagob", 0), (4, "susu " * 500_000, 0), (4, "MONO nomi", 0)],
        "doc_id long, text string, language int",
    )
    found = langid.identify(odd, model)
    assert found.columns == ["doc_id", "text", "language", "language_1"]
    got = [tuple(r) for r in found.select("language_1.*").collect()]
    assert [g[0] for g in got] == ["und", "und", "und", "xx", "zz", "yy"]
    assert all(0 <= g[1] <= 1 for g in got) and got[0][1] == 0
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and kept.count() == 3
    nothing = langid.learn(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(odd, nothing).select("language_1.*").collect()} == {"und"}
    assert langid.identify(odd.limit(0), model).count() == 0


def test_predictions_match_brute_force():
    """Shares counted gram by gram against plain sets: within the filters' false positives."""
    rnd = np.random.default_rng(3)
    filters = {k: np.unique(np.concatenate(list(langid.grams(v)))) for k, v in LINES.items()}
    model = langid.Model.build(filters)
    sets = {k: set(v.tolist()) for k, v in filters.items()}
    words = " ".join(LINES.values()).split()
    for _ in range(50):
        text = " ".join(rnd.choice(words, 12)) + " qqq"
        held = np.concatenate(list(langid.grams(text))).tolist()
        want = [sum(g in sets[k] for g in held) / len(held) for k in model.languages]
        assert np.abs(model.shares(text) - want).max() < 1e-3
        name, score, share = model.predict(text)
        best = int(np.argmax(want))
        assert name == model.languages[best] or abs(max(want) - want[model.languages.index(name)]) < 1e-3
        assert abs(share - max(want)) < 1e-3 and abs(score - max(want) / sum(want)) < 1e-3


def test_no_language_is_left_out(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    langs = [a + b for a in letters for b in letters][:300]
    rows = [(f"{x * 3} {x}q{x} {x}{x}z", x) for x in langs for _ in range(2)]
    rows = [(f"{t} {t[:2] * 2}w" if n % 2 else t, x) for n, (t, x) in enumerate(rows)]
    model = langid.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert model.languages == langs and len(model.tables) == 5
    assert sum(model.predict(t)[0] == x for t, x in rows) >= 0.95 * len(rows)


def test_texts_of_no_learned_script_go(spark):
    rows = [(line, name) for name, line in LINES.items() for _ in range(5)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    model = langid.learn(docs)
    least = langid.least_share(docs, model)
    assert 0.2 < least <= 0.5
    some = spark.createDataFrame([("日本語の文章です",), ("bada gobad",), ("qxqx wvwv",), (None,), ("bada 日本語",)], "text string")
    assert {r.text for r in langid.keep_identified(some, model, least=0.2).collect()} == {"bada gobad", "bada 日本語"}
    assert langid.least_share(docs.limit(0), model) == 0.0


def test_every_labelled_text_counts(spark):
    # more texts than any sample holds, one of each kind with words that nothing else has
    rows = [(f"mini mono nomi {'omin ' * (i % 7)}{i}", "yy") for i in range(9000)] + [("susu rusu", "zz")]
    rows += [(f"quxel dravo {i}", "yy") for i in range(3)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    for tell in ("quxel", "dravo"):
        assert langid.learn(docs).predict(tell)[2] == 1.0
    odd = docs.unionAll(spark.createDataFrame([("mini kkkkkkkkkkkkkkk", "yy"), ("mini kkkkkkkkkkkkkkk", "yy")], docs.schema))
    model = langid.learn(docs)
    shares = [model.predict(t) for t in {t for t, _ in rows} | {"mini kkkkkkkkkkkkkkk"}]
    right = [share for _, _, share in shares]  # all are predicted right
    assert langid.least_share(odd, model) == pytest.approx(np.quantile(right, langid.FALSE_SHARE) / 2, rel=1e-9)


def test_values_at_ranks(spark):
    values = [0.0, 0.5, 0.5, 0.5, 0.50000001, 0.9, 1.0, *(i / 5000 for i in range(1500))]
    rows = spark.createDataFrame([(v,) for v in values], "share double")
    assert [langid._at_rank(rows, k) for k in (0, 1, 700, 1506)] == [sorted(values)[k] for k in (0, 1, 700, 1506)]


def test_copies_count_once(spark):
    # a language of a few texts in many copies, and copies that would drown the other texts of theirs
    texts = [("susu rusu", "zz", 30_000), ("mini mono nomi", "yy", 20_000), *((f"omin imono nimon {'nomi ' * k}", "yy", 1) for k in range(40))]
    docs = spark.createDataFrame(texts, "text string, lang string, n int").selectExpr("text", "lang", "explode(sequence(1, n))")
    every = langid.learn(docs.dropDuplicates(["text"]), sample_docs=100)
    model = langid.learn(docs, sample_docs=100)
    assert model.languages == ["yy", "zz"]
    assert all((a == b).all() for a, b in zip(model.tables, every.tables))


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    found = queries.QUERIES["op8_language"](spark, folder).join(docs, "doc_id").where("held_out")
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.98
