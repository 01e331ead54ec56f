"""Removal of long repeated byte strings by distributed prefix doubling.

A string of `length` bytes that starts at two places or more, in one text or in several, is removed
wherever it stands. Ranking every byte position would shuffle many times the input, so the ranked
positions are chosen by content: the start of each string is owned by the position, among its first
WINDOW ones, whose eight bytes hash least. Equal strings choose their owner at the same place, so
two strings can only be equal if their owners' suffixes are.

1. Positions are ranked by a first prefix; Spark sorts (rank, hash of the bytes at the offset so
   far) pairs, ranks anew by the pair, and the offset doubles. Positions whose rank is unique are
   dropped after every round (`_ranked_again`).
2. Past the last offset a position stands for all strings it owns. Where their common bytes
   (all owned strings together) occur twice, all of them are repeats.
3. The strings of the other positions are ranked one by one, against each other and against one
   position of each group settled in step 2.

Only ranks, hashes and places are shuffled in 1 and 2. Positions whose common bytes occur twice in one
block of texts go on as one, their strings being repeats already; counts are combined before each
shuffle and joined back by rank, so that no group of equal positions is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import session
from millrace.llm.text import free_name

LENGTH = 400  # bytes of a string that counts as a repeat
WINDOW = 128  # starts of strings among which one position owns; at most 255
GRAM = 8  # bytes that are hashed to choose a position
BLOCK_BYTES = 4 << 20  # text that is worked on together; a longer text is a block of its own
SLICE = 256  # rows that become Python objects at a time
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def _window(length: int) -> int:
    if length < 2 * GRAM:
        raise ValueError(f"repeats of at least {2 * GRAM} bytes can be found, not {length}")
    return max(1, min(WINDOW, length // 3))


def _digests(data: Column) -> tuple[Column, Column]:
    """A text's 64-bit hash and a checksum of 32 bits, which together name it."""
    return F.xxhash64(data), F.crc32(data)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 32-bit hash of the eight bytes from each byte on, in the upper half of 64 bits; `data` is padded by GRAM."""
    size = len(data) - GRAM
    grams = np.empty(size, "<u8")
    for shift in range(GRAM):
        here = grams[shift::GRAM]
        here[:] = data[shift : shift + GRAM * len(here)].view("<u8")
    grams *= _MIX[0]
    grams ^= grams >> np.uint64(31)
    grams *= _MIX[1]
    return grams & np.uint64(0xFFFFFFFF00000000)


def _owners(data: bytes, window: int) -> np.ndarray:
    """For each byte the position of the least hash among the `window` from it on, the leftmost of equal ones.

    Found with running minima from both ends of stretches of `window` bytes.
    """
    size = len(data)
    keys = _gram_hashes(np.frombuffer(data + bytes(GRAM), np.uint8)) | np.arange(size, dtype=np.uint64)
    padded = np.full((-(-size // window) + 1) * window, np.uint64(2**64 - 1))
    padded[:size] = keys
    padded = padded.reshape(-1, window)
    behind = np.minimum.accumulate(padded, axis=1).ravel()
    ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(ahead[:size], behind[window - 1 : window - 1 + size]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def owned_runs(texts: Sequence[bytes], length: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, owner, first and last start it owns), places within the joined texts, in order."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths)
    owners = _owners(b"".join(texts), window)
    text = np.repeat(np.arange(len(texts)), np.maximum(lengths - length + 1, 0))
    # starts of whole strings: all but the last length - 1 bytes of each text
    counts = np.maximum(lengths - length + 1, 0)
    starts = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + (ends - lengths)[text]
    owners = owners[starts]
    new = np.flatnonzero((np.diff(owners, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0))
    last = np.concatenate([new[1:], [len(starts)]]) - 1 if len(new) else new
    return text[new], owners[new], starts[new], starts[last]


def _blocks(batches):
    """Rows as one list for each column, BLOCK_BYTES of the first column at least."""
    held, size = None, 0
    for batch in batches:
        held = held or [[] for _ in range(batch.num_columns)]
        for start in range(0, batch.num_rows, SLICE):
            columns = [c.to_pylist() for c in batch.slice(start, SLICE).columns]
            at = 0
            for n, data in enumerate(columns[0]):
                size += len(data)
                if size >= BLOCK_BYTES:
                    for kept, column in zip(held, columns):
                        kept += column[at : n + 1]
                    yield held
                    held, size, at = [[] for _ in columns], 0, n + 1
            for kept, column in zip(held, columns):
                kept += column[at:]
    if held and held[0]:
        yield held


def _offsets(length: int, window: int) -> list[int]:
    """Ends of the prefixes to rank by; each is twice the one before, the last is common to all strings a position owns."""
    common = length - window + 1
    ends = [common]
    while ends[0] >= 256:
        ends.insert(0, ends[0] // 2)
    return ends


#: text_hash, text_sum: the text; place: owner, steps back to its first start, starts owned; pieces: a
#: hash for each offset; whole: hash of all the bytes of the owned strings and of how they lie; times:
#: 2 if a block has the same bytes more than once. Rows with an end are repeats found inside a block,
#: from place to end.
_POSITIONS = T.StructType([
    T.StructField("text_hash", T.LongType()), T.StructField("text_sum", T.LongType()), T.StructField("place", T.LongType()),
    T.StructField("starts", T.IntegerType()), T.StructField("whole", T.LongType()), T.StructField("times", T.IntegerType()),
    T.StructField("end", T.LongType()),
])


def _positions(length: int, window: int, ends: list[int]):
    digest = xxhash.xxh3_64_intdigest
    names = [*_POSITIONS.names, *[f"piece{n}" for n in range(len(ends))]]

    def find(batches):
        for texts, hashes, sums in _blocks(batches):
            if not texts:
                continue
            joined = b"".join(texts)
            number, owner, first, last = owned_runs(texts, length, window)
            begin = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts))) - np.fromiter(map(len, texts), np.int64, len(texts))
            back = owner - first
            wholes = [
                digest(joined[a : b + length], seed=k) for a, b, k in zip(first.tolist(), last.tolist(), back.tolist())
            ]
            pieces, before = [], 0
            for end in ends:
                pieces.append([digest(joined[a + before : a + end]) for a in owner.tolist()])
                before = end
            # the owner's place in its text, and in the lower byte how far its first string starts before it
            place = (owner - begin[number]) << 8 | back
            hashes, sums = np.array(hashes, np.int64), np.array(sums, np.int64)
            kept, times = _once(np.array(wholes, np.uint64), np.array(pieces[-1], np.uint64))
            arrays = [
                hashes[number], sums[number], place, (last - first + 1).astype(np.int32), np.array(wholes, np.uint64).view(np.int64), times,
            ]
            pieces = [np.array(p, np.uint64).view(np.int64)[kept] for p in pieces]
            held = [pa.array(a[kept]) for a in arrays]
            yield pa.RecordBatch.from_arrays([*held, pa.nulls(len(kept), pa.int64()), *map(pa.array, pieces)], names=names)
            text, start, end = _joined(number, first - begin[number], last - begin[number] + length, times > 1)
            none = [pa.nulls(len(text), kind) for kind in (pa.int32(), pa.int64(), pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[text]), pa.array(sums[text]), pa.array(start), *none, pa.array(end), *[none[1]] * len(ends)], names=names
            )

    return find


def _once(whole: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first row of each pair of values, and for every row 2 if another has its pair, else 1."""
    order = np.lexsort((piece, whole))
    new = np.ones(len(order), bool)
    new[1:] = (whole[order][1:] != whole[order][:-1]) | (piece[order][1:] != piece[order][:-1])
    group = np.cumsum(new) - 1
    times = np.empty(len(order), np.int32)
    times[order] = np.minimum(np.bincount(group, minlength=1), 2)[group]
    return np.sort(order[new]), times


def _joined(text: np.ndarray, start: np.ndarray, end: np.ndarray, chosen: np.ndarray):
    """The chosen spans (in order, of one length about), those that overlap in one text as one."""
    text, start, end = text[chosen], start[chosen], end[chosen]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return text[first], start[first], np.maximum.reduceat(end, first) if len(first) else end


def _ranked_again(rows: DataFrame, by: Sequence[str], settle) -> DataFrame:
    """Rows whose values in `by` another row has as well, with a new rank that names those values.

    Sorted counts, combined before the shuffle, are written and joined back: between two plain
    exchanges Spark splits a rank that very many rows share, over an aggregate it would not.
    """
    often = settle(rows.groupBy(*by).agg(F.sum("times").alias("all")).where("all > 1").drop("all"), "shared-ranks")
    kept = rows.join(often, list(by))
    return kept.withColumn("rank", F.xxhash64(*by)) if list(by) != ["rank"] else kept


def _strings(length: int):
    """(rank, string, item) of each string that the wanted positions own; an unwanted copy of a text adds nothing."""
    digest = xxhash.xxh3_64_intdigest

    def spell(batches):
        seen = set()
        for batch in batches:
            ranks, strings, items = [], [], []
            for data, name, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if name in seen:
                    continue
                seen.add(name)
                for w in wanted:
                    back = w["place"] & 255
                    first = (w["place"] >> 8) - back
                    for n in range(w["starts"]):
                        # the seed is the string's start as seen from its owner: equal strings have it in common
                        strings.append(digest(data[first + n : first + n + length], seed=back - n + 256))
                    ranks += [w["rank"]] * w["starts"]
                    items += range(w["item"] << 8, (w["item"] << 8) + w["starts"]) if w["item"] >= 0 else [-1] * w["starts"]
                if len(strings) > 100_000:
                    yield _string_batch(ranks, strings, items)
                    ranks, strings, items = [], [], []
            yield _string_batch(ranks, strings, items)

    return spell


def _string_batch(ranks, strings, items) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(ranks, pa.int64()), pa.array(np.array(strings, np.uint64).view(np.int64)), pa.array(items, pa.int64())],
        names=["rank", "string", "item"],
    )


def repeated_spans(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """(text_hash, text_sum, spans) of each text with repeats: (start, end) of the bytes to remove, as a set, overlapping.

    `texts` has a column data (binary); equal texts are two occurrences. Written to the shared folder.
    """
    window = _window(length)
    ends = _offsets(length, window)
    hashed, summed = _digests(F.col("data"))
    named = texts.where(F.octet_length("data") >= length).select("data", hashed.alias("text_hash"), summed.alias("text_sum"))
    schema = T.StructType([*_POSITIONS.fields, *[T.StructField(f"piece{n}", T.LongType()) for n in range(len(ends))]])
    with session.workspace(texts.sparkSession) as settle:
        with session.workspace(texts.sparkSession) as early:
            rows = early(named.mapInArrow(_positions(length, window, ends), schema), "positions")
            inside = settle(rows.where("end is not null").select("text_hash", "text_sum", F.col("place").alias("start"), "end"), "inside")
            rows = rows.where("end is null").drop("end").withColumnRenamed("piece0", "rank")
            for n in range(len(ends)):
                rows = _ranked_again(rows, ["rank"] if n == 0 else ["rank", f"piece{n}"], early).drop(f"piece{n}")
                rows = (early if n + 1 < len(ends) else settle)(rows, "ranked")
        ranked = rows
        place = F.struct("text_hash", "text_sum", "place", "starts")
        groups = settle(
            ranked.groupBy("rank", "whole", "starts").agg(F.sum("times").alias("times"), F.min(place).alias("one")), "groups"
        )
        twice = groups.where("times > 1")
        both = ranked.join(twice.select("rank", "whole", "starts"), ["rank", "whole", "starts"], "left_semi")
        start = F.shiftright("place", 8) - F.col("place").bitwiseAND(255)
        repeats = both.select("text_hash", "text_sum", start.alias("start"), (start + F.col("starts") - 1 + length).alias("end"))

        single = groups.where("times = 1").select("rank", "one.*").withColumn("item", F.monotonically_increasing_id())
        open_ranks = settle(single.select("rank").distinct(), "open-ranks")
        shown = twice.select("rank", "one.*").join(open_ranks, "rank", "left_semi").withColumn("item", F.lit(-1).cast("long"))
        wanted = settle(single.unionByName(shown), "wanted")
        lists = wanted.groupBy("text_hash", "text_sum").agg(F.collect_list(F.struct("rank", "place", "starts", "item")).alias("wanted"))
        lists = settle(lists, "wanted-lists")  # so that the copies of a text with wanted positions are split
        name = F.concat_ws(":", "text_hash", "text_sum")
        spelled = named.join(lists, ["text_hash", "text_sum"]).select("data", name.alias("name"), "wanted")
        strings = settle(spelled.mapInArrow(_strings(length), "rank long, string long, item long"), "strings")
        known = F.coalesce(F.max((F.col("item") < 0).cast("int")), F.lit(0))
        often = strings.groupBy("rank", "string").agg(F.count("*").alias("times"), known.alias("known"))
        often = settle(often.where("times > 1").select("rank", "string"), "shared-strings")
        found = strings.where("item >= 0").join(often, ["rank", "string"]).select(
            F.shiftright("item", 8).alias("item"), F.col("item").bitwiseAND(255).alias("step")
        )
        # at most WINDOW steps for each item
        steps = found.groupBy("item").agg(F.collect_set("step").alias("steps"))
        pieces = wanted.where("item >= 0").join(steps, "item").select(
            "text_hash", "text_sum", start.alias("start"), F.explode("steps").alias("step")
        ).select("text_hash", "text_sum", (F.col("start") + F.col("step")).alias("start"), (F.col("start") + F.col("step") + length).alias("end"))
        spans = inside.unionByName(repeats).unionByName(pieces).groupBy("text_hash", "text_sum").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
        return session.settle(spans, "spans")


def _cut(data: bytes, spans) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of `data`, and the maximal runs that are gone (runs that touch are one)."""
    runs: list[list[int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    edges = [0, *[e for run in runs for e in run], len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])), [(a, b) for a, b in runs]


def remove_repeats(
    docs: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), length: int = LENGTH
) -> DataFrame:
    """Columns `keep` of each row with n_bytes, removed (array of start, end) and kept (binary).

    Every byte of the text's UTF-8 form that lies in a string of `length` bytes which also starts at
    another place is removed: in the same text (overlaps count) or in any other, equal texts and
    repeated rows being different places. Judged on the whole input, not on what is left; matches
    never cross texts. removed lists maximal runs; what is kept may end inside a character, hence
    binary. NULL texts count as empty; texts shorter than `length` stay whole; an empty table gives
    an empty result; a number is added to a new name that `keep` has. Texts of any length are whole;
    the longest one decides a task's memory (some 50 times its size). Strings count as equal by 128
    bits of hashes at least.
    """
    names = {n: free_name(keep, n) for n in ("n_bytes", "removed", "kept", "data", "text_hash", "text_sum", "spans", "hash_of", "sum_of")}
    data = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).cast("binary")
    found = repeated_spans(docs.select(data.alias("data")), length)
    found = found.toDF(names["hash_of"], names["sum_of"], names["spans"])
    held = docs.select(*[F.col(f"`{c}`") for c in keep], data.alias(names["data"]))
    hashed, summed = _digests(F.col(names["data"]))
    held = held.withColumn(names["text_hash"], hashed).withColumn(names["text_sum"], summed)
    joined = held.join(
        found, (F.col(names["text_hash"]) == F.col(names["hash_of"])) & (F.col(names["text_sum"]) == F.col(names["sum_of"])), "left"
    ).select(*[F.col(f"`{c}`") for c in keep], names["data"], names["spans"])
    run = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        *joined.schema.fields[:-2], T.StructField(names["n_bytes"], T.LongType()),
        T.StructField(names["removed"], T.ArrayType(run)), T.StructField(names["kept"], T.BinaryType()),
    ])

    def cut(batches):
        runs_of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts, spans = part.column(part.num_columns - 2).to_pylist(), part.column(part.num_columns - 1).to_pylist()
                left = [_cut(d, s) for d, s in zip(texts, spans)]
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:-2], pa.array(map(len, texts), pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in runs] for _, runs in left], runs_of),
                    pa.array([k for k, _ in left], pa.binary()),
                ], names=schema.names)

    return joined.mapInArrow(cut, schema)
