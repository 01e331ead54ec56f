"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import session


def _fingerprint(links: DataFrame):
    """Count and order-free checksum of a link table."""
    return links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def connected(links: DataFrame) -> DataFrame:
    """`links` (u, v: long) to (node, root): every linked node with the least node of its component.

    Each round hangs all larger neighbours of a node on its least neighbour (large star), then all
    smaller ones (small star); after some log n rounds every node hangs on its root. Minima are
    combined before the shuffle, so a node with very many neighbours does not gather them, and the
    joins are plain equi-joins that skew handling can split. Every round ends in a table under the
    checkpoint folder, emptied at the end. Links to oneself and repeated links are ignored; NULL ends are dropped; an
    empty table gives an empty result.
    """
    with session.workspace(links.sparkSession) as settle:
        current = settle(
            links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
            "links",
        )
        seen = _fingerprint(current)
        while seen[0]:
            both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
            large = (
                both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            )
            large = settle(large, "large-star")
            lowest = large.groupBy("u").agg(F.min("v").alias("m"))
            small = (
                large.join(lowest, "u")
                .where("v <> m")
                .select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(lowest.select("u", F.col("m").alias("v")))
                .distinct()
            )
            current = settle(small, "small-star")
            now = _fingerprint(current)
            if now == seen:
                break
            seen = now
        roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
        hung = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        return session.settle(hung.unionByName(roots), "components")
