"""SimHash near-duplicates: fingerprints, links by the generalised pigeonhole, components.

Fingerprints are 64-bit longs. Two link if they differ in at most `distance` bits. The bits are cut
into partitions, each with its own threshold; the thresholds add up to `distance` - partitions + 1,
so two linked fingerprints lie within the threshold of at least one partition. Correlated bits share
a partition, and the number of partitions and their thresholds come from a dynamic programme over
candidate counts estimated on a bounded sample. The sample steers cost only: every fingerprint is
probed and every candidate verified, whatever the plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace import session
from millrace.llm import components
from millrace.llm.text import free_name

BITS = 64
SAMPLE = 4096  # fingerprints that the plan is estimated on
TILE = 8192  # fingerprints of one bucket that are compared in one piece
PROBE_COST = 1.0  # a probe row against ...
CANDIDATE_COST = 0.05  # ... one compared pair


# ---------------------------------------------------------------- fingerprints


def fingerprint_of(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """The signed 64-bit SimHash of one text (0 for NULL and for texts without words)."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, seed) for g in grams), np.uint64)
    cells = hashes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.uint16) + _OFFSETS
    counts = np.bincount(cells.ravel(), minlength=8 * 256).reshape(8, 256) @ _BYTE_BITS
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits.ravel(), bitorder="little").view("<i8")[0])


_OFFSETS = (np.arange(8, dtype=np.uint16) * 256)[None, :]
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """SimHash column over whole texts; A-Z is lowered, words part at ASCII white space."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle, seed) for t in texts], dtype="int64")

    return hashed(text)


# ---------------------------------------------------------------- plan


@dataclass(frozen=True)
class Partition:
    bits: tuple[int, ...]
    threshold: int  # -1: not probed

    def flips(self) -> list[int]:
        """Masks (as signed longs) to flip for every key within the threshold, the key itself first."""
        masks = [0]
        for t in range(1, self.threshold + 1):
            masks += [sum(1 << b for b in chosen) for chosen in combinations(self.bits, t)]
        return [_signed(m) for m in masks]

    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def group_bits(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Cut the 64 bits into `parts` near-equal groups, strongly correlated bits together."""
    bits = ((sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float64)
    spread = bits.std(axis=0)
    centred = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
    close = np.abs(centred.T @ centred) / max(len(sample), 1)
    free, groups = set(range(BITS)), []
    for left in range(parts, 0, -1):
        size = -(-len(free) // left)
        first = max(free, key=lambda b: (sum(close[b, c] for c in free if c != b), -b))
        group = [first]
        free.remove(first)
        while len(group) < size:
            best = max(free, key=lambda b: (close[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        groups.append(tuple(sorted(group)))
    return groups


def allocate(costs: list[dict[int, float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, one for each partition, that add up to `total` at the least cost."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for spent, (so_far, chosen) in best.items():
            for threshold, price in cost.items():
                key, value = spent + threshold, so_far + price
                if key not in step or value < step[key][0]:
                    step[key] = (value, [*chosen, threshold])
        best = step
    return best[total]


def plan(sample: np.ndarray, rows: int, distance: int) -> list[Partition]:
    """The cheapest partitions and thresholds for `rows` fingerprints that look like `sample`."""
    sample = sample.astype(np.uint64)
    choices = []
    pairs = max(len(sample) * (len(sample) - 1) / 2, 1)
    for parts in range(1, distance + 3):
        total = distance - parts + 1
        costs = []
        for group in (groups := group_bits(sample, parts)):
            mask = np.uint64(sum(1 << b for b in group))
            near = np.zeros(distance + 1)
            for i in range(1, len(sample)):
                d = np.bitwise_count((sample[i:] ^ sample[:-i]) & mask)
                near += np.bincount(np.minimum(d, distance + 1), minlength=distance + 2)[: distance + 1]
            # an unseen pair still counts as half a pair, spread by the size of the key space
            odds = [max(x, 0.5 * min(1.0, pairs / 2.0 ** len(group))) / pairs for x in np.cumsum(near)]
            ball = np.cumsum([_choose(len(group), t) for t in range(distance + 1)])
            costs.append({-1: 0.0} | {
                t: PROBE_COST * rows * ball[t] + CANDIDATE_COST * odds[t] * rows * (rows - 1) / 2
                for t in range(distance + 1)
            })
        price, thresholds = allocate(costs, total)
        choices.append((price, parts, [Partition(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(choices, key=lambda c: c[:2])[2]


def _choose(n: int, k: int) -> float:
    value = 1.0
    for i in range(k):
        value = value * (n - i) / (i + 1)
    return value


# ---------------------------------------------------------------- probe and verify


def _hang(values: np.ndarray, owner: np.ndarray, bucket: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket: (row, row it hangs on), a star for each component of each bucket.

    Compares every row with its bucket's later rows, shift by shift; at least one of the two must own
    the key. Pairs whose rows already hang together are skipped, so a dense bucket costs compares,
    not output.
    """
    n = len(values)
    ends = np.searchsorted(bucket, bucket, side="right")
    rows, parent = np.arange(n), np.arange(n)
    active, shift = rows, 1
    while True:
        active = active[active + shift < ends[active]]
        if not len(active):
            break
        other = active + shift
        hit = (np.bitwise_count(values[active] ^ values[other]) <= distance) & (owner[active] | owner[other])
        a, b = parent[active[hit]], parent[other[hit]]
        apart = a != b
        if apart.any():
            for x, y in zip(a[apart].tolist(), b[apart].tolist()):
                while parent[x] != x:
                    x = parent[x]
                while parent[y] != y:
                    y = parent[y]
                if x != y:
                    parent[max(x, y)] = min(x, y)
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
        shift += 1
    moved = rows[parent != rows]
    return moved, parent[moved]


def _link_batches(distance: int):
    def link(batches):
        rest = None
        for batch in batches:
            frame = pa.Table.from_batches([batch])
            piece = [frame.column(c).to_numpy() for c in ("bucket", "fp", "owner")]
            if rest is not None:
                piece = [np.concatenate(pair) for pair in zip(rest, piece)]
            if not len(piece[0]):
                continue
            cut = np.searchsorted(piece[0], piece[0][-1])  # the last bucket may go on
            rest = [p[cut:].copy() for p in piece]
            if cut:
                yield from found([p[:cut] for p in piece])
        if rest is not None:
            yield from found(rest)

    def found(piece):
        bucket, fp, owner = piece
        values = fp.astype(np.int64).view(np.uint64)
        moved, root = _hang(values, owner.astype(bool), bucket, distance)
        apart = fp[moved] != fp[root]
        yield pa.RecordBatch.from_arrays([pa.array(fp[moved][apart]), pa.array(fp[root][apart])], names=["u", "v"])

    return link


def _probes(number: int, part: Partition) -> Column:
    """Buckets of partition `number` that column fp probes; the first is the one it owns."""
    key = F.col("fp").bitwiseAND(F.lit(part.mask()))
    return F.transform(
        F.array(*[F.lit(m) for m in part.flips()]),
        lambda flip: F.struct(
            F.xxhash64(F.lit(number), key.bitwiseXOR(flip)).alias("bucket"), (flip == 0).alias("owner")
        ),
    )


def links(prints: DataFrame, distance: int = 3, tile: int = TILE) -> DataFrame:
    """Links (u, v) between the distinct fingerprints `prints` (fp) that keep every component whole.

    Inside a bucket the links form a star for each component instead of all pairs. A bucket of more
    than `tile` rows is cut into blocks by hash, and each pair of blocks is compared in its own
    piece, so that no task holds a hot bucket.
    """
    spark = prints.sparkSession
    rows = prints.count()
    if rows < 2:
        return spark.createDataFrame([], "u long, v long")
    sample = [r[0] for r in prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()]
    parts = plan(np.array(sample, dtype=np.int64).view(np.uint64), rows, distance)
    probes = F.concat(*[_probes(i, p) for i, p in enumerate(parts)])
    probed = prints.select("fp", F.explode(probes).alias("p")).select("p.bucket", "fp", "p.owner")
    hot = (
        probed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > tile)
        .select("bucket", F.ceil(F.col("n") / tile).cast("int").alias("blocks"))
    )
    block = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("blocks")).cast("int")
    tiles = F.when(
        F.col("blocks").isNull(), F.array(F.col("bucket"))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda other: F.xxhash64("bucket", F.least(other, block), F.greatest(other, block)),
        )
    )
    dealt = probed.join(hot, "bucket", "left").select(F.explode(tiles).alias("bucket"), "fp", "owner")
    return (
        dealt.repartition("bucket").sortWithinPartitions("bucket")
        .mapInArrow(_link_batches(distance), "u long, v long")
    )


def _components(
    docs: DataFrame, text: str, doc_id: str, shingle: int, distance: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Marked rows (doc_id, digest, fp), fingerprints with their root (fp, root), and the least row of each root."""
    marked = session.settle(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.xxhash64(F.col(text)).alias("digest"),
            fingerprint(F.col(text), shingle).alias("fp"),
        ),
        "fingerprints",
    )
    row = F.struct(F.isnull("doc_id").alias("unnamed"), "doc_id", "digest")
    prints = session.settle(marked.groupBy("fp").agg(F.min(row).alias("least")), "distinct-fingerprints")
    hung = components.connected(links(prints.select("fp"), distance))
    rooted = session.settle(
        prints.join(hung.withColumnRenamed("node", "fp"), "fp", "left").select(
            "fp", "least", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    return marked, rooted.select("fp", "root"), rooted.groupBy("root").agg(F.min("least").alias("least"))


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """One row (doc_id, fingerprint: long, component_id) for each row of `docs`.

    component_id is the least id of all documents reachable over links, the document itself included.
    Copies share a fingerprint, which is probed once however many there are. NULL texts and texts
    without words have fingerprint 0 and link like any other. Rows with a NULL id take part; where
    all ids of a component are NULL, so is component_id. Texts of any length are read whole. Repeated
    rows come back repeated. An empty table gives an empty result. Other columns are not read.
    """
    marked, rooted, least = _components(docs, text, doc_id, shingle, distance)
    placed = rooted.join(least, "root").select("fp", F.col("least.doc_id").alias("component_id"))
    return marked.join(placed, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "component_id")


def keep_one(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, distance: int = 3
) -> DataFrame:
    """`docs` without near-duplicates: one row of each component stays, the one with the least id.

    NULL ids come last; rows that share the id are told apart by a hash of their text, and of rows
    equal in both one stays. All columns are kept as they are.
    """
    _, _, least = _components(docs, text, doc_id, shingle, distance)
    kept_id, kept_digest, digest, place = (
        free_name(docs.columns, x) for x in ("kept_id", "kept_digest", "digest", "place")
    )
    kept = least.select(F.col("least.doc_id").alias(kept_id), F.col("least.digest").alias(kept_digest)).distinct()
    same = Window.partitionBy(doc_id, digest).orderBy(F.lit(0))
    return (
        docs.withColumn(digest, F.xxhash64(text))
        .join(kept, F.col(doc_id).eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_digest)), "left_semi")
        .withColumn(place, F.row_number().over(same))
        .where(F.col(place) == 1)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
