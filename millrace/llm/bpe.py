"""BPE encoding and decoding with a pair occurrence index.

The words of a partition that are not known yet are merged together: an index maps each pair of
neighbouring symbols to all its positions in those words, the active ranks are applied in ascending
order from a heap, and a merge updates only the lists of the pairs it touches. Vocabulary files are
those of the `tokenizers` library (model BPE with an end-of-word suffix). The library itself only cuts
texts with characters that Python's Unicode tables do not know (`Vocabulary._cut_carefully`).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.text import free_name

CACHE_BYTES = 96 << 20  # of words and their ids that a task remembers, by `_cost`
PACK = 32  # bits of a symbol in a packed pair
SLICE = 512  # documents whose results leave a task together
BATCH_WORDS = 50_000  # new words that are merged together
HELD_WORDS = 400_000  # words of cut-up texts that are held at a time, or one text


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = (b for b in range(256) if b not in set(kept))
    return {b: chr(b) for b in kept} | {b: chr(256 + n) for n, b in enumerate(rest)}


class Vocabulary:
    """Symbols, merges and the text rules of one tokenizer file."""

    def __init__(self, description: str):
        spec = json.loads(description)
        self.description = json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []})
        model = spec["model"]
        if model["type"] != "BPE" or model.get("byte_fallback") or model.get("dropout") or spec.get("decoder") or model.get("ignore_merges"):
            raise ValueError("a BPE file without byte fallback, dropout and decoder is needed")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.unknown = self.ids.get(model.get("unk_token") or "")
        # by rank: left and right symbol and what they become; the rank of a pair, packed into one number
        self.pairs: list[tuple[int, int, int]] = []
        self.ranks: dict[int, int] = {}
        for rank, (left, right) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            a, b = self.ids[left], self.ids[right]
            self.pairs.append((a, b, self.ids[left + right]))
            self.ranks.setdefault(a << PACK | b, rank)
        self.tokens: dict[int, str] = {i: t for t, i in self.ids.items()}
        added = spec.get("added_tokens") or []
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must be matched as they are written")
        self.added = {t["content"]: t["id"] for t in added}
        self.tokens.update({t["id"]: t["content"] for t in added})
        longest = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.steps = _flat(spec.get("normalizer"), "normalizers")
        cuts = _flat(spec.get("pre_tokenizer"), "pretokenizers")
        if [c["type"] for c in cuts] != ["Split", "ByteLevel"] or cuts[1]["use_regex"] or cuts[1]["add_prefix_space"]:
            raise ValueError("the words must come from one pattern, then bytes")
        if cuts[0]["behavior"] != "Removed" or not cuts[0]["invert"]:
            raise ValueError("the pattern must match the words")
        self.pattern = cuts[0]["pattern"]["Regex"]
        self.ascii_word, self.word = _compiled(self.pattern, True), _compiled(self.pattern, False)
        symbols = byte_symbols()
        inner = [self.ids.get(symbols[b], self.unknown) for b in range(256)]
        last = [self.ids.get(symbols[b] + self.suffix, self.unknown) for b in range(256)]
        # symbol of each byte, from 256 on at a word's end; -1 where there is none
        self.byte_ids = np.array([-1 if i is None else i for i in inner + last], np.int64)
        by_symbol: dict[int, list[int]] = {}
        for code, symbol in enumerate(self.byte_ids.tolist()):
            by_symbol.setdefault(symbol, []).append(code)
        self.byte_ranks = np.full((512, 512), -1, np.int64)  # rank of each pair of them
        for pair, rank in self.ranks.items():
            for a in by_symbol.get(pair >> PACK, ()):
                for b in by_symbol.get(pair & ((1 << PACK) - 1), ()):
                    self.byte_ranks[a, b] = rank

    def normalise(self, text: str) -> str:
        for step in self.steps:
            kind = step["type"]
            if kind in ("NFC", "NFD", "NFKC", "NFKD"):
                text = unicodedata.normalize(kind, text)
            elif kind == "Lowercase":
                # letter by letter: a capital sigma does not look at its neighbours
                text = text.lower() if "Σ" not in text else "".join(map(str.lower, text))
            elif kind != "Replace" or step["pattern"] != {"Regex": r"\s+"} or step["content"] != " ":
                raise ValueError(f"unknown normalizer {step}")
            # folding white space changes no word: it is never part of one
        return text

    def words(self, text: str, careful: bool = False) -> list:
        """Words (str) and ids of added tokens (int) in order.

        Python and the library know different Unicode versions. `careful` asks the library about
        letters and lower case, for texts with code points that Python does not know (`is_newer`).
        """
        cut = self._cut_carefully if careful else self._cut
        if not any(mark in text for mark in self.added):
            return cut(text)
        found: list = []
        for piece in self.marks.split(text):
            if piece in self.added:
                found.append(self.added[piece])
            elif piece:
                found += cut(piece)
        return found

    def _cut(self, text: str) -> list[str]:
        return (self.ascii_word if text.isascii() else self.word).findall(self.normalise(text))

    def _cut_carefully(self, text: str) -> list[str]:
        from tokenizers import Regex, Tokenizer, pre_tokenizers

        split = pre_tokenizers.Split(Regex(self.pattern), "removed", invert=True)
        normalised = Tokenizer.from_str(self.description).normalizer.normalize_str(text)
        return [word for word, _ in split.pre_tokenize_str(normalised)]


def _ranges(codes: Iterable[int]) -> str:
    """A regular expression's set of the code points (ascending), without the brackets; holds the ranges alone."""
    out: list[str] = []
    start = end = -2
    for code in codes:
        if code != end + 1:
            if end >= 0:
                out.append(f"{re.escape(chr(start))}-{re.escape(chr(end))}")
            start = code
        end = code
    if end >= 0:
        out.append(f"{re.escape(chr(start))}-{re.escape(chr(end))}")
    return "".join(out)


def _compiled(pattern: str, ascii_only: bool) -> re.Pattern:
    """A pattern with \\p{L}, \\p{N} and \\s for Python's `re`, which knows no such classes."""
    codes, kind = range(0x80 if ascii_only else 0x110000), unicodedata.category

    def blank(code: int) -> bool:
        return 9 <= code <= 13 or code == 0x85 or kind(chr(code))[0] == "Z"

    for name in ("L", "N"):
        if f"\\p{{{name}}}" in pattern:
            pattern = pattern.replace(f"\\p{{{name}}}", _ranges(c for c in codes if kind(chr(c))[0] == name))
    return re.compile(pattern.replace(r"\s", _ranges(filter(blank, codes))))


@lru_cache(maxsize=1)
def _newer() -> re.Pattern:
    return re.compile("[" + _ranges(c for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn") + "]")


def is_newer(word) -> bool:
    """Whether a word has a code point that Python's Unicode version does not know."""
    return isinstance(word, str) and not word.isascii() and _newer().search(word) is not None


def _flat(step: dict | None, inside: str) -> list[dict]:
    if step is None:
        return []
    return [s for x in step[inside] for s in _flat(x, inside)] if step["type"] == "Sequence" else [step]


def merge_words(vocabulary: Vocabulary, words: list[str]) -> list[bytes]:
    """Ids of each word as bytes; the words are merged together over one pair occurrence index."""
    data = [w.encode("utf-8") for w in words]
    ends = np.cumsum(np.fromiter(map(len, data), np.int64, len(data)))
    codes = np.frombuffer(b"".join(data), np.uint8).astype(np.int64)
    final = np.zeros(len(codes), bool)
    final[ends - 1] = True
    codes[final] += 256
    known = vocabulary.byte_ids[codes] >= 0  # bytes without a symbol are left out
    ends = np.cumsum(known)[ends - 1]
    codes, final = codes[known], np.zeros(int(known.sum()), bool)
    final[ends[ends > 0] - 1] = True
    start = np.arange(len(codes))
    symbols = vocabulary.byte_ids[codes].tolist()
    after = np.where(final, -1, start + 1).tolist()
    before = np.where(np.concatenate([[True], final[:-1]]), -1, start - 1).tolist() if len(codes) else []

    rank_of, pairs = vocabulary.ranks.get, vocabulary.pairs
    index: dict[int, list[int]] = {}  # rank of a pair: its places
    ranks = np.where(final[:-1], -1, vocabulary.byte_ranks[codes[:-1], codes[1:]])
    places = np.argsort(ranks, kind="stable")
    places = places[np.searchsorted(ranks[places], 0) :]
    values, firsts = np.unique(ranks[places], return_index=True)
    index = dict(zip(values.tolist(), map(np.ndarray.tolist, np.split(places, firsts[1:])))) if len(values) else {}
    active = list(index)
    heapq.heapify(active)
    while active:
        now = heapq.heappop(active)
        left, right, new = pairs[now]
        places = index.pop(now, ())
        if len(places) > 1:
            places = sorted(places)
        for n, i in enumerate(places):
            j = after[i]
            if symbols[i] != left or j < 0 or symbols[j] != right:
                continue  # one of the two has been merged meanwhile
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            lower = False
            if k >= 0:
                before[k] = i
                if (rank := rank_of(new << PACK | symbols[k])) is not None:
                    if rank in index:
                        index[rank].append(i)
                    else:
                        index[rank] = [i]
                        heapq.heappush(active, rank)
                    lower = rank < now
            h = before[i]
            if h >= 0 and (rank := rank_of(symbols[h] << PACK | new)) is not None:
                if rank in index:
                    index[rank].append(h)
                else:
                    index[rank] = [h]
                    heapq.heappush(active, rank)
                lower = lower or rank < now
            if lower and n + 1 < len(places):  # a lower rank has become active: the rest waits
                if now not in index:
                    heapq.heappush(active, now)
                index[now] = places[n + 1 :] + index.get(now, [])
                break
    merged = np.array(symbols, np.int64)
    alive = merged >= 0
    ids = merged[alive].astype("<u4").tobytes()
    stops = (4 * np.concatenate([[0], np.cumsum(alive)])[np.concatenate([[0], ends])]).tolist()
    return [ids[a:b] for a, b in zip(stops, stops[1:])]


def _cost(words: dict) -> int:
    """Bytes that remembered words take: the string, its ids and their places in the table."""
    return sum(map(sys.getsizeof, words)) + sum(map(sys.getsizeof, words.values())) + 100 * len(words)


class Codec:
    """Encoder and decoder of one vocabulary with a memory of words that is bounded in bytes."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.forget()
        self.tokens = np.full(max(vocabulary.tokens) + 2, None, object)  # the last one is unknown
        for number, token in vocabulary.tokens.items():
            self.tokens[number] = token

    def forget(self) -> None:
        """Drop the words, so that an idle worker holds the vocabulary alone."""
        self.known: dict = {}
        self.older: dict = {}  # the generation before
        self.size = 0  # of the known words

    def _coded(self, words: list) -> dict:
        """The ids of words (and of added tokens, which are their ids) as bytes."""
        plain = [w for w in words if isinstance(w, str)]
        coded = {w: np.array([w], "<u4").tobytes() for w in words if not isinstance(w, str)}
        for start in range(0, len(plain), BATCH_WORDS):
            batch = plain[start : start + BATCH_WORDS]
            coded.update(zip(batch, merge_words(self.vocabulary, batch)))
        return coded

    def _learn(self, fresh: set) -> None:
        if self.size > CACHE_BYTES // 2:
            self.known, self.older, self.size = {}, self.known, 0
        older = self.older
        new = {w: older[w] for w in fresh if w in older}
        new.update(self._coded([w for w in fresh if w not in older]))
        self.known.update(new)
        self.size += _cost(new)

    def encode(self, texts: list[str | None]):
        """Ids of each text as little-endian unsigned 32-bit integers, some texts at a time."""
        start = 0
        while start < len(texts):
            cut, found, fresh, held = start, [], set(), 0
            while cut < len(texts) and len(fresh) < BATCH_WORDS and held < HELD_WORDS:
                text = texts[cut] or ""
                words = self.vocabulary.words(text)
                known = self.known
                new = {w for w in words if w not in known and w not in fresh}
                if any(map(is_newer, new)):
                    # never remembered, so that the next text with such a word comes here as well
                    words = self.vocabulary.words(text, careful=True)
                    coded = self._coded(list(dict.fromkeys(words)))
                    found.append([coded[w] for w in words])
                else:
                    fresh |= new
                    found.append(words)
                held += len(words)
                cut += 1
            if self.size > CACHE_BYTES // 2:
                # the words known so far are about to become the older generation
                fresh = {w for words in found for w in words if not isinstance(w, bytes)}
            self._learn(fresh)
            known = self.known
            for words in found:
                yield b"".join(words if words and isinstance(words[0], bytes) else map(known.__getitem__, words))
            start = cut

    def decode(self, ids: bytes) -> str:
        """Tokens of the ids, parted by blanks, special ones included; unknown ids are left out."""
        values = np.frombuffer(ids, "<u4")
        tokens = self.tokens[np.minimum(values, len(self.tokens) - 1)].tolist()
        return " ".join(tokens) if None not in tokens else " ".join(t for t in tokens if t is not None)


@lru_cache(maxsize=2)
def _codec(description: str) -> Codec:
    return Codec(Vocabulary(description))


def encode(text: Column, description: str) -> Column:
    """Ids of every whole text as binary (little-endian unsigned 32-bit); NULL counts as empty.

    `description` is the content of the tokenizer file, read once on the driver (1.7 MB), so that
    executors need no file. A worker keeps its words from batch to batch, CACHE_BYTES of them at
    most, and the vocabulary.
    """
    shared = _Shared(description)

    @F.pandas_udf("binary")
    def encoded(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_codec(shared.text).encode(texts.tolist())), dtype=object)

    return encoded(text)


def decode(ids: Column, description: str) -> Column:
    """The text that ids (as from `encode`) stand for."""
    shared = _Shared(description)

    @F.pandas_udf("string")
    def decoded(values: pd.Series) -> pd.Series:
        codec = _codec(shared.text)
        return pd.Series([codec.decode(v or b"") for v in values], dtype=object)

    return decoded(ids)


class _Shared:
    """Carries the tokenizer file into the tasks."""

    def __init__(self, text: str):
        self.text = text


def code(
    docs: DataFrame, description: str, text: str = "text", keep: Sequence[str] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """Columns `keep` of each row with n_tokens, ids_sha256 and decoded_sha256 of its whole text, encoded and decoded again.

    ids_sha256 is of the ids as little-endian unsigned 32-bit integers, which `with_ids` adds as
    `ids`; decoded_sha256 of the decoded text in UTF-8. NULL texts count as empty; repeated rows come
    back repeated; an empty table gives an empty result; texts of any length are coded whole. A number is added to a new name that `keep`
    has. Rows are handled SLICE at a time, so that a task holds few texts and ids whatever their number.
    """
    shared = _Shared(description)
    held = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(free_name(keep, "coded_text")))
    names = (["ids"] if with_ids else []) + ["n_tokens", "ids_sha256", "decoded_sha256"]
    kinds = {"ids": T.BinaryType(), "n_tokens": T.LongType()}
    schema = T.StructType(
        [*held.schema.fields[:-1], *[T.StructField(free_name(keep, n), kinds.get(n, T.StringType())) for n in names]]
    )
    fields = schema.names

    def coded(batches):
        codec = _codec(shared.text)
        try:
            yield from pieces(codec, batches)
        finally:
            codec.forget()

    def pieces(codec, batches):
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                rows = [
                    ((ids,) if with_ids else ())
                    + (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(codec.decode(ids).encode()).hexdigest())
                    for ids in codec.encode(part.column(part.num_columns - 1).to_pylist())
                ]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, zip(*rows))], names=fields)

    return held.mapInArrow(coded, schema)


def read_description(path: str | None = None) -> str:
    """Content of a tokenizer file; without a path, of the installed public `word_bpe_49k.json`."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as file:
        return file.read()


def token_count(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")
