"""Ranked lexical search with MaxScore, its bounds tightened by pairs of terms.

Three written tables, each a row for a block of documents and none shuffled: the index (terms with
their postings), the impacts (for the terms of the queries what each posting adds to a score), and
with them, for pairs of terms that queries hold, the joint maximum over the list of documents that
have both. A query's bound in a block is put together when it is asked: a pair adds at most its
joint maximum or the larger of its two terms' maxima, whichever is more, and never more than both;
the pairs that save most are taken first, each term once. Blocks whose bound is below the query's
tenth best score so far are skipped; inside a block the terms and pairs of least bound are not
essential as long as they cannot lift a document over that score together, and are looked up only
for documents that the others leave in reach (`_Block.search`). Only skipped work differs: results
are exact. Each task keeps the best documents of every query and hands on no more.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.llm.text import free_name

K = 10
BLOCK_BYTES = 4 << 20  # text of a block; a longer text is a block of its own
BATCH_BYTES = 1 << 20  # text of the queries that are asked together; they travel with every task
SLICE = 256  # rows that become Python objects at a time
REACH = 3  # a term is paired with so many of the next more frequent ones of its query
_LEAST = 10  # 100 - 90, what the shortest document's length counts
_SLOPE = 90

#: Bytes of a term as they are, A-Z as a-z, all others blank.
_FOLD = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and everything beyond ASCII, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def _pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in the fewest of 1, 2, 4 or 8 bytes each, the width in front."""
    most = int(values.max(initial=0))
    width = 1 if most < 2**8 else 2 if most < 2**16 else 4 if most < 2**32 else 8
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class _Numbers(dict):
    def __missing__(self, term: bytes) -> int:
        number = self[term] = len(self)
        return number


_INDEX = T.StructType([
    T.StructField("ids", T.BinaryType()), T.StructField("sizes", T.BinaryType()), T.StructField("terms", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("docs", T.BinaryType()), T.StructField("tfs", T.BinaryType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType()),
])


def _index_row(ids: list, texts: list) -> tuple | None:
    """The inverted index of some documents: ids and sizes of those with a term; for each term its postings."""
    numbers = _Numbers()
    held, sizes, tokens = [], [], []
    for doc_id, text in zip(ids, texts):
        found = terms_of(text)
        if found:
            held.append(doc_id)
            sizes.append(len(found))
            tokens.append(np.fromiter(map(numbers.__getitem__, found), np.int64, len(found)))
    if not held:
        return None
    size = np.array(sizes, np.int64)
    keys = np.concatenate(tokens) * len(held) + np.repeat(np.arange(len(held)), size)
    keys, tfs = np.unique(keys, return_counts=True)
    counts = np.bincount(keys // len(held), minlength=len(numbers))
    null = np.array([i is None for i in held])
    id_bytes = np.packbits(null).tobytes() + np.array([i or 0 for i in held], "<i8").tobytes()
    return (
        id_bytes, _pack(size), b" ".join(numbers), _pack(counts), _pack(keys % len(held)), _pack(tfs),
        len(held), int(size.sum()),
    )


def _ids(data: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The documents' ids and which of them are NULL."""
    bits = (size + 7) // 8
    return np.frombuffer(data, "<i8", offset=bits), np.unpackbits(np.frombuffer(data[:bits], np.uint8), count=size).astype(bool)


def build_index(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Inverted index, a row for each block of documents; not written yet. Rows without a term are left out."""

    def index(batches):
        ids, texts, size = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(i)
                    texts.append(t)
                    size += len(t or "")
                    if size >= BLOCK_BYTES:
                        yield from _rows([_index_row(ids, texts)], _INDEX)
                        ids, texts, size = [], [], 0
        yield from _rows([_index_row(ids, texts)], _INDEX)

    return docs.select(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`").cast("string")).mapInArrow(index, _INDEX)


_ARROW = {"binary": pa.binary(), "bigint": pa.int64(), "int": pa.int32()}


def _rows(rows: list[tuple | None], schema: T.StructType):
    rows = [r for r in rows if r is not None]
    if rows:
        kinds = [_ARROW[f.dataType.simpleString()] for f in schema.fields]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=schema.names)


def _records(batches):
    """The rows one at a time, as each holds a block."""
    for batch in batches:
        for n in range(batch.num_rows):
            yield {name: column[n].as_py() for name, column in zip(batch.schema.names, batch.columns)}


@dataclass
class Queries:
    """Some queries that are asked together: bounded by BATCH_BYTES, whatever the number of documents."""

    ids: list
    copies: list[int]  # equal queries are asked once
    vocabulary: list[bytes]
    terms: list[np.ndarray]  # of each query, numbers in the vocabulary, from rare to frequent
    weights: np.ndarray | None = None  # of each word of the vocabulary
    pairs: np.ndarray | None = None  # (n, 2) numbers of words
    pairs_of: list[np.ndarray] | None = None  # (place of one term, of the other, number of the pair) of each query

    def weigh(self, frequencies: dict[int, int], n_docs: int) -> None:
        """Sets the weights, the order of the terms and the pairs."""
        self.weights = np.array([
            math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequencies.get(i, 0) + 1))) for i in range(len(self.vocabulary))
        ], np.int64)
        numbers: dict[tuple[int, int], int] = {}
        ordered, pairs_of = [], []
        for terms in self.terms:
            terms = np.array([t for t in terms.tolist() if frequencies.get(t) and self.weights[t]], np.int64)
            terms = terms[np.argsort(-self.weights[terms], kind="stable")]
            held = [
                (a, b, numbers.setdefault((int(min(terms[a], terms[b])), int(max(terms[a], terms[b]))), len(numbers)))
                for a in range(len(terms)) for b in range(a + 1, min(a + 1 + REACH, len(terms)))
            ]
            ordered.append(terms)
            pairs_of.append(np.array(held, np.int64).reshape(-1, 3))
        self.terms, self.pairs_of = ordered, pairs_of
        self.pairs = np.array(list(numbers), np.int64).reshape(-1, 2)


def _query_batches(queries: DataFrame, text: str, item_id: str):
    """The queries in batches of about BATCH_BYTES text, dealt by hash; a batch at a time is on the driver."""
    held = queries.select(F.col(f"`{item_id}`").alias("item_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    held = held.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    size = queries.agg(F.sum(F.octet_length(F.col(f"`{text}`").cast("string")))).first()[0] or 0
    batches = max(1, math.ceil(size / BATCH_BYTES))
    for n in range(batches):
        rows = held.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(batches)) == n).collect()
        numbers = _Numbers()
        terms = [np.array(sorted({numbers[t] for t in terms_of(r.text)}), np.int64) for r in rows]
        yield Queries([r.item_id for r in rows], [r.copies for r in rows], list(numbers), terms)


def _frequencies(index: DataFrame, vocabulary: list[bytes]) -> dict[int, int]:
    """In how many documents each word of the vocabulary occurs; words that occur nowhere are missing."""
    wanted = {t: n for n, t in enumerate(vocabulary)}

    def count(batches):
        found = np.zeros(len(wanted), np.int64)
        for row in _records(batches):
            for term, times in zip(row["terms"].split(b" "), _unpack(row["counts"]).tolist()):
                if term in wanted:
                    found[wanted[term]] += times
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], names=["term", "df"])

    counted = index.select("terms", "counts").mapInArrow(count, "term long, df long")
    return dict(map(tuple, counted.groupBy("term").agg(F.sum("df")).collect()))


_IMPACTS = T.StructType([
    T.StructField("ids", T.BinaryType()), T.StructField("n_docs", T.LongType()), T.StructField("words", T.BinaryType()),
    T.StructField("counts", T.BinaryType()), T.StructField("docs", T.BinaryType()), T.StructField("impacts", T.BinaryType()),
    T.StructField("joint", T.BinaryType()),
])


def _impacts(tfs: np.ndarray, sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 8 m), m = 10 + (90 n N) div L; in Python's integers where 64 bits do not do."""
    if int(sizes.max(initial=0)) * _SLOPE * n_docs >= 2**63:
        m = np.array([_LEAST + _SLOPE * int(n) * n_docs // n_terms for n in sizes], np.int64)
    else:
        m = _LEAST + _SLOPE * sizes * n_docs // n_terms
    return 1_000_000_000 * tfs // (1000 * tfs + 8 * m)


def _pair_maxima(lists: dict[int, tuple[np.ndarray, np.ndarray]], pairs: np.ndarray, n_docs: int) -> np.ndarray:
    """For each pair of words the most that a document with both gets from them, 0 where no document has both."""
    joint = np.zeros(len(pairs), np.int64)
    dense = np.zeros(n_docs, np.int64)
    before = -1
    for n in np.lexsort((pairs[:, 1], pairs[:, 0])).tolist() if len(pairs) else ():
        a, b = pairs[n].tolist()
        if a not in lists or b not in lists:
            continue
        if a != before:
            if before >= 0:
                dense[lists[before][0]] = 0
            dense[lists[a][0]] = lists[a][1]
            before = a
        docs, values = lists[b]
        own = dense[docs]
        joint[n] = ((own + values) * (own > 0)).max(initial=0)
    return joint


def impact_table(index: DataFrame, queries: Queries, n_docs: int, n_terms: int) -> DataFrame:
    """For each block the queries' words with what each posting adds to a score, and the pairs' joint maxima."""
    wanted = {t: n for n, t in enumerate(queries.vocabulary) if queries.weights[n]}
    weights, pairs = queries.weights, queries.pairs

    def weigh(batches):
        for row in _records(batches):
            size = row["n_docs"]
            terms = row["terms"].split(b" ")
            counts = _unpack(row["counts"])
            places = [(wanted[t], n) for n, t in enumerate(terms) if t in wanted]
            if not places:
                continue
            ends = np.cumsum(counts)
            docs, tfs, sizes = _unpack(row["docs"]), _unpack(row["tfs"]), _unpack(row["sizes"])
            lists = {}
            for word, n in sorted(places):
                at = slice(ends[n] - counts[n], ends[n])
                lists[word] = docs[at], weights[word] * _impacts(tfs[at], sizes[docs[at]], n_docs, n_terms)
            joint = _pair_maxima(lists, pairs, size)
            yield from _rows([(
                row["ids"], size, _pack(np.array(list(lists), np.int64)), _pack(np.array([len(d) for d, _ in lists.values()])),
                _pack(np.concatenate([d for d, _ in lists.values()])), _pack(np.concatenate([i for _, i in lists.values()])), _pack(joint),
            )], _IMPACTS)

    return index.select("ids", "n_docs", "terms", "counts", "docs", "tfs", "sizes").mapInArrow(weigh, _IMPACTS)


class _Best:
    """The k best documents of one query so far: highest score first, then lowest id, NULL ids last."""

    def __init__(self, k: int):
        self.k = k
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A document with a lower score is out."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        scores, ids, nulls = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        first = np.lexsort((ids, nulls, -scores))[: self.k]
        self.scores, self.ids, self.nulls = scores[first], ids[first], nulls[first]


class Block:
    """The queries' words in one block of documents."""

    def __init__(self, row: dict, words: int):
        self.n_docs = row["n_docs"]
        self.ids, self.nulls = _ids(row["ids"], self.n_docs)
        counts = _unpack(row["counts"])
        cuts = np.cumsum(counts)[:-1]
        docs, impacts = np.split(_unpack(row["docs"]), cuts), np.split(_unpack(row["impacts"]), cuts)
        self.lists = dict(zip(_unpack(row["words"]).tolist(), zip(docs, impacts)))
        self.most = np.zeros(words, np.int64)  # maximum of each word
        for word, (_, values) in self.lists.items():
            self.most[word] = values.max()
        self.joint = _unpack(row["joint"])

    def units(self, terms: np.ndarray, pairs: np.ndarray) -> list[tuple[int, list[int]]]:
        """(bound, words) by falling bound: pairs where they save most, single words else."""
        alone = self.most[terms]
        a, b = alone[pairs[:, 0]], alone[pairs[:, 1]]
        bound = np.maximum(np.maximum(a, b), self.joint[pairs[:, 2]])
        saved = a + b - bound
        free = (alone > 0).tolist()
        units = []
        for n in np.argsort(-saved, kind="stable").tolist():
            x, y = int(pairs[n, 0]), int(pairs[n, 1])
            if saved[n] <= 0:
                break
            if free[x] and free[y]:
                free[x] = free[y] = False
                units.append((int(bound[n]), [int(terms[x]), int(terms[y])]))
        units += [(int(alone[n]), [int(terms[n])]) for n, left in enumerate(free) if left]
        return sorted(units, key=lambda u: -u[0])

    def search(self, terms: np.ndarray, pairs: np.ndarray, best: _Best) -> int:
        """Adds the block's documents to the query's best ones; returns how many were scored."""
        if self.most[terms].sum() < best.least:
            return 0
        units = self.units(terms, pairs)
        rest = np.cumsum([b for b, _ in units[::-1]])[::-1].tolist()  # bound of a unit and all lesser ones
        if not units or rest[0] < best.least:
            return 0
        scores = np.zeros(self.n_docs, np.int64)
        essential = next((n for n, bound in enumerate(rest) if bound < best.least), len(units))
        for _, words in units[:essential]:
            for word in words:
                docs, values = self.lists[word]
                scores[docs] += values
        found = np.flatnonzero(scores)
        scored = len(found)
        for (_, words), bound in zip(units[essential:], rest[essential:]):
            found = found[scores[found] + bound >= best.least]
            if not len(found):
                return scored
            for word in words:
                docs, values = self.lists[word]
                if 8 * len(found) < len(docs):
                    place = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    scores[found] += np.where(docs[place] == found, values[place], 0)
                else:
                    scores[docs] += values
        found = found[scores[found] >= best.least]
        if len(found):
            best.add(scores[found], self.ids[found], self.nulls[found])
        return scored


_FOUND = "query int, doc_id long, score long"


def _ask(queries: Queries, k: int):
    words, terms, pairs_of = len(queries.vocabulary), queries.terms, queries.pairs_of

    def ask(batches):
        best = [_Best(k) for _ in terms]
        for row in _records(batches):
            block = Block(row, words)
            for held, own, pairs in zip(best, terms, pairs_of):
                block.search(own, pairs, held)
        number = np.repeat(np.arange(len(best)), [len(b.scores) for b in best]).astype(np.int32)
        ids = np.concatenate([np.zeros(0, np.int64), *[b.ids for b in best]])
        nulls = np.concatenate([np.zeros(0, bool), *[b.nulls for b in best]])
        scores = np.concatenate([np.zeros(0, np.int64), *[b.scores for b in best]])
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(ids, mask=nulls), pa.array(scores)], names=["query", "doc_id", "score"])

    return ask


def search(
    docs: DataFrame, queries: DataFrame, k: int = K, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id"
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents above score 0 for each row of `queries`.

    Scores as the contract of the registered query states them, in integers: rare terms weigh more,
    repeats and long documents less. Equal scores go to the smaller id, NULL ids last. NULL and
    empty texts, and texts without a term, are no documents and find nothing. Every row is a
    document of its own, also rows that repeat one; queries that repeat one get its ranks once
    more. Texts of any length are read whole. An empty table on either side gives an empty result;
    other columns are not read. Queries are asked in batches of bounded size; each reads the index
    again, but not the texts.
    """
    spark = docs.sparkSession
    kind = queries.schema[item_id].dataType
    name = free_name(["rank", "doc_id", "score"], item_id)
    with session.workspace(spark) as settle:
        index = settle(build_index(docs, text, doc_id), "lexical-index")
        totals = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("terms")).first()
        parts = []
        for batch in _query_batches(queries, text, item_id):
            if not totals.docs or not batch.ids:
                continue
            batch.weigh(_frequencies(index, batch.vocabulary), totals.docs)
            with session.workspace(spark) as keep:
                impacts = keep(impact_table(index, batch, totals.docs, totals.terms), "lexical-impacts")
                found = impacts.mapInArrow(_ask(batch, k), _FOUND)
                place = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
                ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
                asked = spark.createDataFrame(
                    list(enumerate(batch.copies)), "query int, copies long"
                ).join(spark.createDataFrame(list(zip(range(len(batch.ids)), batch.ids)), T.StructType([
                    T.StructField("query", T.IntegerType()), T.StructField("item", kind)])), "query")
                parts.append(session.settle(
                    ranked.join(asked, "query").select(
                        F.col("item").alias(name), "rank", "doc_id", "score", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
                    ).drop("copy"),
                    "lexical-found",
                ))
    if not parts:
        return spark.createDataFrame([], T.StructType([
            T.StructField(name, kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())
        ]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
