"""Language-model scores from a weighted backoff automaton.

The model is a bigram model over words and an end mark. Its states are the contexts (the last
token); a state's arcs are the bigrams seen in training, its failure arc leads to the root, whose
arcs are the single tokens. A text is scored in one pass from left to right: follow the arc of the
next token if the state has one, else add the failure weight and try the root.

Neither the counts nor the automaton are ever whole in one place. Texts are cut into blocks in
place. Each block sends the distinct n-grams of its texts, with their training counts, to the
parts of the n-gram space (by hash), every part adds up and answers each block with the totals in
the order it was asked, and each block builds the piece of automaton that its texts can reach.
N-grams travel as sorted arrays of 64-bit hashes, the answers as arrays of counts alone. A frequent
n-gram is one entry for each block. Parts grow in number with the corpus, blocks have a fixed size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import session

BLOCK_BYTES = 4 << 20  # text of a block; a longer text is a block of its own
SLICE = 256  # rows that become Python objects at a time
PART_BYTES = 8 << 20  # text for each part of the n-gram space
LEAST_PARTS = 64
TRUST = 0.6  # most that a context's own counts weigh against the root
DOUBT = 3.0  # occurrences of a context at which it gets half of that

_END = np.uint64(xxhash.xxh64_intdigest(b" end"))  # no word has a blank
_SCHEMA = "block long, part int, words binary, word_counts binary, pairs binary, pair_counts binary"


class _Numbers(dict):
    """Numbers words from 1 on in the order they are asked for."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self) + 1
        return number


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Token numbers of the texts in one array, an end (0) after each; the ends' places; the words from 1 on."""
    known = _Numbers()
    pieces, ends, place = [], [], 0
    end = np.zeros(1, np.int64)
    for text in texts:
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
        pieces += (np.fromiter(map(known.__getitem__, words), np.int64, len(words)), end)
        place += len(words) + 1
        ends.append(place)
    return np.concatenate(pieces) if pieces else np.zeros(0, np.int64), np.array(ends, np.int64), list(known)


def _hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.concatenate([[_END], np.fromiter(map(digest, words), np.uint64, len(words))])


def _contexts(tokens: np.ndarray) -> np.ndarray:
    """The token before each token; before a text stands the end of another."""
    return np.concatenate([[0], tokens[:-1]]).astype(np.int64) if len(tokens) else tokens


def _pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    value = before * np.uint64(0x9E3779B97F4A7C15) + after
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


class _Block:
    """The tokens of a block's texts and its distinct n-grams, sorted by hash."""

    def __init__(self, texts: list[str | None]):
        self.tokens, self.ends, words = _tokens(texts)
        hashes = _hashes(words)
        self.size = len(hashes)
        self.word_order = np.argsort(hashes, kind="stable")
        self.word_keys = hashes[self.word_order]
        # `arcs` gives each token's pair by its place among the distinct pairs
        pairs = _contexts(self.tokens) * self.size + self.tokens
        self.pairs, self.arcs = np.unique(pairs, return_inverse=True)
        keys = _pair_keys(hashes[self.pairs // self.size], hashes[self.pairs % self.size])
        self.pair_order = np.argsort(keys, kind="stable")
        self.pair_keys = keys[self.pair_order]

    def counts(self, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences in the training texts, in the order of the keys."""
        learned = np.repeat(train, np.diff(self.ends, prepend=0))
        words = np.bincount(self.tokens[learned], minlength=self.size)[self.word_order]
        pairs = np.bincount(self.arcs[learned], minlength=len(self.pairs))[self.pair_order]
        return words, pairs


def _blocks(batches, columns: int):
    """(block number, its rows as one list for each column): rows in their order, BLOCK_BYTES of text at least."""
    first, held, size, rows = TaskContext.get().partitionId() << 32, 0, 0, [[] for _ in range(columns)]
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            for row in zip(*(c.to_pylist() for c in batch.slice(start, SLICE).columns)):
                for kept, value in zip(rows, row):
                    kept.append(value)
                size += len(row[0] or "") + 1
                if size >= BLOCK_BYTES:
                    yield first + held, rows
                    held, size, rows = held + 1, 0, [[] for _ in range(columns)]
    if rows[0]:
        yield first + held, rows


def _requests(shift: int):
    def ask(batches):
        for block, (texts, train) in _blocks(batches, 2):
            asked = _Block(texts)
            words, pairs = asked.counts(np.array(train, bool))
            rows = []
            word_parts = (asked.word_keys >> np.uint64(shift)).astype(np.int64)
            pair_parts = (asked.pair_keys >> np.uint64(shift)).astype(np.int64)
            for part in np.union1d(word_parts, pair_parts).tolist():
                w = slice(*np.searchsorted(word_parts, [part, part + 1]))
                p = slice(*np.searchsorted(pair_parts, [part, part + 1]))
                rows.append((
                    block, part, asked.word_keys[w].tobytes(), words[w].astype("<u4").tobytes(),
                    asked.pair_keys[p].tobytes(), pairs[p].astype("<u4").tobytes(),
                ))
            schema = pa.schema([("block", pa.int64()), ("part", pa.int32())] + [
                (n, pa.binary()) for n in ("words", "word_counts", "pairs", "pair_counts")
            ])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return ask


_ANSWER = (
    "block long, part int, words binary, pairs binary, word_sum long, pair_sum long, "
    "n long, types long, once long, twice long"
)


def _answer(asked: pd.DataFrame) -> pd.DataFrame:
    """Totals of one part's n-grams, for each block in the order it asked; key sums to compare by."""
    asked = asked.sort_values("block")
    out = {"block": asked["block"], "part": asked["part"]}
    totals = {}
    for name, counts in (("words", "word_counts"), ("pairs", "pair_counts")):
        keys = [np.frombuffer(x, "<u8") for x in asked[name]]
        sizes = [len(k) for k in keys]
        values, place = np.unique(np.concatenate(keys), return_inverse=True)
        here = np.concatenate([np.frombuffer(x, "<u4") for x in asked[counts]])
        totals[name] = np.bincount(place, weights=here, minlength=len(values)).astype(np.int64)
        replies = np.split(totals[name][place].astype("<u8"), np.cumsum(sizes)[:-1])
        out[name] = [_pack(r) for r in replies]
        out[name[:-1] + "_sum"] = [int(k.sum(dtype=np.uint64).view(np.int64)) for k in keys]
    words = totals["words"]
    rows = len(asked)
    for name, value in (
        ("n", words.sum()), ("types", (words > 0).sum()), ("once", (words == 1).sum()), ("twice", (words == 2).sum())
    ):
        out[name] = [int(value)] + [0] * (rows - 1)
    return pd.DataFrame(out)


def _pack(counts: np.ndarray) -> bytes:
    """Counts as bytes: one byte below 255, else a mark and 8 bytes behind."""
    small = np.minimum(counts, 255).astype(np.uint8)
    return small.tobytes() + counts[small == 255].astype("<u8").tobytes()


def _unpack(data: bytes, size: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=size).astype(np.int64)
    return counts


class Automaton:
    """The piece of the model that one block's texts can reach."""

    def __init__(self, block: _Block, words: np.ndarray, pairs: np.ndarray, n: int, types: int, discount: float):
        counts = np.empty(block.size, np.int64)
        counts[block.word_order] = words
        self.counts = counts
        if n:
            root = np.maximum(counts - discount, 0) / n + discount * types / n / (types + 1)
        else:
            root = np.ones(block.size)
        trust = TRUST * counts / (counts + DOUBT)
        self.root = np.log10(root).tolist()  # arcs of the root
        self.failure = np.log10(1 - trust).tolist()  # of each state
        seen = np.empty(len(pairs), np.int64)
        seen[block.pair_order] = pairs
        before, after = block.pairs // block.size, block.pairs % block.size
        own = trust[before] * seen / np.maximum(counts[before], 1)
        weights = np.log10(own + (1 - trust[before]) * root[after]).astype(object)
        weights[seen == 0] = None  # no such arc
        self.arcs = weights.tolist()

    def score(self, tokens: list[int], arcs: list[int]) -> float:
        """log10 probability of a text's tokens, the end mark last; `arcs` number the pairs it goes through."""
        weight_of, failure, root = self.arcs, self.failure, self.root
        state, total = 0, 0.0
        for token, arc in zip(tokens, arcs):
            weight = weight_of[arc]
            if weight is None:  # the state has no arc for the token: fall back to the root
                weight = failure[state] + root[token]
            total += weight
            state = token
        return total


def _score(n: int, types: int, discount: float):
    def scored(key, texts: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        texts, answers = texts.sort_values("row"), answers.sort_values("part")
        block = _Block(texts["text"].tolist())
        shift = int(answers["shift"].iloc[0])
        totals = []
        for keys, name, check in ((block.word_keys, "words", "word_sum"), (block.pair_keys, "pairs", "pair_sum")):
            edges = np.searchsorted((keys >> np.uint64(shift)).astype(np.int64), answers["part"].to_numpy())
            pieces = np.split(keys, edges[1:])
            if edges[0] or [int(p.sum(dtype=np.uint64).view(np.int64)) for p in pieces] != answers[check].tolist():
                raise RuntimeError("the rows of a partition have changed between two reads of the texts")
            totals.append(np.concatenate([_unpack(d, len(p)) for d, p in zip(answers[name], pieces)]))
        words, pairs = totals
        model = Automaton(block, words, pairs, n, types, discount)
        base = np.log10((model.counts + 1.0) / (n + types + 1.0))
        rows = []
        for start, end in zip([0, *block.ends.tolist()], block.ends.tolist()):
            tokens, arcs = block.tokens[start:end], block.arcs[start:end]
            score = model.score(tokens.tolist(), arcs.tolist())
            rows.append((len(tokens), int((model.counts[tokens] > 0).sum()), float(base[tokens].sum()), score))
        out = pd.DataFrame(rows, columns=["n_tokens", "n_known", "base_score", "score"])
        out.insert(0, "doc_id", texts["doc_id"].to_numpy())
        out.insert(1, "train", texts["train"].to_numpy())
        return out

    return scored


def _place(batches):
    """Rows with their block and their place in it, the blocks as in `_requests`."""
    for block, (texts, train, ids) in _blocks(batches, 3):
        n = len(texts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(ids, pa.string()),
             pa.array(texts, pa.string()), pa.array(train, pa.bool_())],
            names=["block", "row", "doc_id", "text", "train"],
        )


def score(docs: DataFrame, train: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score) for each row of `docs`.

    Learns from the rows where `train` holds, scores all. Tokens are the words (A-Z lowered, parted
    at ASCII white space) and one end mark; NULL and blank texts are the end mark alone. base_score
    is the add-one unigram score, score that of the automaton: root probabilities discounted once
    and mixed with the uniform one over all types and one for the unknown, contexts mixed with the
    root by how often they occur. Where nothing was learned both are 0. Repeated rows count and come
    back repeated. doc_id may have any type that survives a cast to text and back. The texts are read twice and must come in the
    same partitions both times, as from files; a difference is found by key sums and raised.
    """
    rows = docs.select(
        F.col(text).alias("text"), F.coalesce(train, F.lit(False)).alias("train"), F.col(doc_id).cast("string").alias("doc_id")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(LEAST_PARTS, size / PART_BYTES)
    bits = math.ceil(math.log2(bits))
    shift = 64 - bits
    asked = rows.select("text", "train").mapInArrow(_requests(shift), _SCHEMA)
    answers = session.settle(asked.groupBy("part").applyInPandas(_answer, _ANSWER), "ngram-counts")
    n, types, once, twice = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "types", "once", "twice")]).first()
    discount = once / (once + 2 * twice) if once else 0.5
    placed = rows.mapInArrow(_place, "block long, row int, doc_id string, text string, train boolean")
    replies = answers.select("block", "part", "words", "pairs", "word_sum", "pair_sum", F.lit(shift).alias("shift"))
    found = placed.groupBy("block").cogroup(replies.groupBy("block")).applyInPandas(
        _score(n, types, discount),
        "doc_id string, train boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return found.select(
        F.col("doc_id").cast(docs.schema[doc_id].dataType), "train", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )
