"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, bit-sliced: slot s of the table holds a mask with one bit for each
language, so that the AND of an n-gram's slots is the set of all languages whose filter has it. A
text counts, for each language, the n-grams whose mask has its bit; the count expected from chance
(the filter's false-positive rate) is taken off, and the language with the largest rest wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import session
from millrace.llm.text import free_name

UNKNOWN = "und"
SIZES = (2, 3, 4)  # characters of an n-gram; a word's edge counts as one character
SLOT_BITS = 20  # 2**20 slots: 8 MB for up to 64 languages, whatever the corpus
HASHES = 3
TOP_GRAMS = 30_000  # most frequent n-grams that one language may put into its filter
LEAST_SHARE = 0.5  # of the n-gram's largest frequency among languages; below, it says too little
FALSE_SHARE = 0.001  # of labelled texts that may lie below the share from which `least_share` is taken
CHUNK = 1 << 20  # characters handled at a time
BINS = 1000  # counts taken at a time to find the value at a rank

_EDGE = np.uint32(1)
_TABLE: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point its lower-case letter, or the edge mark for anything but a letter."""
    if not _TABLE:
        codes = np.full(0x110000, _EDGE, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                codes[code] = ord(char.lower()[0])
        _TABLE.append(codes)
    return _TABLE[0]


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def grams(text: str):
    """Hashes (uint64) of the character n-grams inside each word of a text, in pieces of bounded size."""
    table, longest = _letters(), max(SIZES)
    for start in range(0, len(text), CHUNK):
        piece = text[max(0, start - longest + 1) : start + CHUNK]
        codes = table[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
        codes = np.pad(codes, (int(not start), int(start + CHUNK >= len(text))), constant_values=_EDGE)
        edge = codes == _EDGE
        new = longest - 1 if start else 0  # characters that the piece before has dealt with
        for size in SIZES:
            if len(codes) < size:
                continue
            ends = len(codes) - size + 1
            value, inner = np.zeros(ends, np.uint64), np.ones(ends, bool)
            for k in range(size):
                value = (value << np.uint64(16)) * np.uint64(3) + value + codes[k : k + ends]
                if 0 < k < size - 1:
                    inner &= ~edge[k : k + ends]
            whole = inner & ~(edge[:ends] & edge[size - 1 :])
            if new:
                whole[: max(0, new - size + 1)] = False
            yield _mix(value[whole] * np.uint64(8) + np.uint64(size))


def _slots(hashes: np.ndarray):
    mask = np.uint64((1 << SLOT_BITS) - 1)
    for k in range(HASHES):
        yield ((hashes >> np.uint64(k * SLOT_BITS)) & mask).astype(np.int64)


@dataclass
class Model:
    """The learned languages in ascending order and their sliced filters, one table for 64 languages."""

    languages: list[str]
    tables: list[np.ndarray] = field(default_factory=list)
    chance: np.ndarray = field(default_factory=lambda: np.zeros(0))

    @classmethod
    def build(cls, filters: dict[str, np.ndarray]) -> Model:
        languages = sorted(filters)
        tables = [np.zeros(1 << SLOT_BITS, np.uint64) for _ in range(-(-len(languages) // 64))]
        for i, name in enumerate(languages):
            for slots in _slots(filters[name]):
                tables[i // 64][slots] |= np.uint64(1 << (i % 64))
        fill = [(tables[i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(languages))]
        return cls(languages, tables, np.array(fill) ** HASHES)

    def shares(self, text: str | None) -> np.ndarray | None:
        """Corrected share of the text's n-grams in each language's filter; None without letters."""
        hits, total = np.zeros(len(self.languages)), 0
        for hashes in grams(text) if text else ():
            total += len(hashes)
            for t, table in enumerate(self.tables):
                found = np.full(len(hashes), ~np.uint64(0))
                for slots in _slots(hashes):
                    found &= table[slots]
                for i in range(t * 64, min(len(hits), t * 64 + 64)):
                    hits[i] += np.count_nonzero(found & np.uint64(1 << (i % 64)))
        if not total:
            return None
        return np.clip((hits / total - self.chance) / np.maximum(1 - self.chance, 1e-9), 0, None)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """The best language, its part of all corrected shares and its own share; ties go to the lesser name."""
        shares = self.shares(text)
        if shares is None or not len(shares):
            return UNKNOWN, 0.0, 0.0
        best = int(np.argmax(shares))
        total = float(shares.sum())
        return self.languages[best], float(shares[best]) / total if total else 1.0 / len(shares), float(shares[best])


def _count(batches):
    """Sums of each language's n-grams over some documents at a time."""

    def summed(pieces):
        values, counts = np.unique(np.concatenate(pieces), return_counts=True)
        columns = [pa.array([lang] * len(values)), pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    for batch in batches:
        texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in dict.fromkeys(langs):
            pieces, held = [], 0
            for text in (t for t, x in zip(texts, langs) if x == lang):
                for piece in grams(text):
                    pieces.append(piece)
                    held += len(piece)
                    if held > 2 * CHUNK:
                        yield summed(pieces)
                        pieces, held = [], 0
            if held:
                yield summed(pieces)


def _sampled(known: DataFrame, sample_docs: int) -> DataFrame:
    """Rows of about so many distinct texts (`digest`) of each language."""
    sizes = (
        known.groupBy("lang", "digest").agg(F.count("*").alias("rows"))
        .groupBy("lang").agg(F.count("*").alias("texts"))
    )
    parts = [F.lit(x) for r in sizes.collect() for x in (r.lang, min(10**6, -(-sample_docs * 10**6 // r.texts)))]
    if not parts:
        return known
    return known.where(F.pmod("digest", F.lit(10**6)) < F.try_element_at(F.create_map(*parts), F.col("lang")))


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", sample_docs: int | None = None) -> Model:
    """Filters from the rows of `docs` with a language: all distinct texts, or about `sample_docs` for each language.

    Copies count once, so every language with a text is learned and no text outweighs the others.
    N-grams are counted by Spark; a language keeps those that it uses at least LEAST_SHARE as often
    as the language that uses them most, the TOP_GRAMS most frequent of them. So the model's size
    depends on the number of languages alone (8 MB for each 64 of them); none is left out.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    known = known.withColumn("digest", F.xxhash64("text", F.lit(8)))
    picked = known if sample_docs is None else _sampled(known, sample_docs)
    picked = picked.dropDuplicates(["lang", "digest"])
    counted = picked.select("text", "lang").mapInArrow(_count, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where("n > 1")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counted.join(totals, "lang").withColumn("rate", F.col("n") / F.col("total"))
    best = F.max("rate").over(Window.partitionBy("gram"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram"))
    kept = rated.withColumn("best", best).where(F.col("rate") >= LEAST_SHARE * F.col("best"))
    kept = kept.withColumn("rank", rank).where(F.col("rank") <= TOP_GRAMS).select("lang", "gram").toPandas()
    return Model.build({k: g["gram"].to_numpy(np.int64).view(np.uint64) for k, g in kept.groupby("lang")})


def language(model: Model, text: Column) -> Column:
    """Struct (lang_pred, score, share) of every whole text. The model travels with the task: 8 MB for 64 languages."""

    @F.pandas_udf("lang_pred string, score double, share double")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang_pred", "score", "share"])

    # so marked, a filter on the result stays above the prediction: pushed into the joins and arrays that
    # made the text it could not be evaluated, and a text would be predicted once for each condition
    return predicted.asNondeterministic()(text)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """`docs` with a struct column `language` (lang_pred, score, share); a number is added to a name that is taken.

    NULL texts and texts without a letter are `und` with score 0, and so is every text if nothing
    was learned. The score is the winner's part of all corrected shares, from 0 to 1, share the
    winner's corrected share of the text's n-grams; ties go to the lesser language. Texts of any
    length are read whole. Repeated rows are predicted alike; an empty table gives an empty result.
    """
    return docs.withColumn(free_name(docs.columns, "language"), language(model, F.col(text)))


def _at_rank(values: DataFrame, rank: int) -> float:
    """The value of the only column at a rank (from 0) of its ascending order, from ever finer counts of BINS bins at most."""
    value = F.col(values.columns[0])
    ends = [F.min(value).alias("low"), F.max(value).alias("high")]
    low, high = values.agg(*ends).first()
    while low < high:
        place = F.least(F.floor((value - F.lit(low)) / F.lit((high - low) / BINS)), F.lit(BINS - 1))
        bins = values.where(value.between(low, high)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"), *ends)
        for found in sorted(bins.collect()):
            if rank < found.n:
                low, high = found.low, found.high
                break
            rank -= found.n
    return low


def least_share(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> float:
    """The share of its n-grams that a text must have in its language's filter, from labelled texts not learned from.

    Half of what all but FALSE_SHARE of them have that are predicted right, 0 where there is none.
    Takes every labelled text, copies once: texts are predicted where they are and only shares are moved.
    """
    known = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    if not model.languages:
        return 0.0
    found = known.select("lang", F.xxhash64("text", F.lit(9)).alias("digest"), language(model, F.col("text")).alias("found"))
    right = found.where("found.lang_pred = lang").select("lang", "digest", "found.share").distinct()
    with session.workspace(docs.sparkSession) as settle:
        shares = settle(right.select("share"), "language-shares")
        count = shares.count()
        if not count:
            return 0.0
        place = FALSE_SHARE * (count - 1)
        below = int(place)
        low = _at_rank(shares, below)
        high = _at_rank(shares, below + 1) if place > below else low
        return (low + (high - low) * (place - below)) / 2


def keep_identified(docs: DataFrame, model: Model, text: str = "text", least: float = 0.0) -> DataFrame:
    """The documents with a language that has more than `least` of their n-grams; same columns.

    Texts without a letter and texts of a script or language that was not learned go. For NULL and
    long texts, ties, repeated rows and empty tables see `identify`.
    """
    found = identify(docs, model, text)
    name = found.columns[-1]
    return found.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.share") > least)).drop(name)
