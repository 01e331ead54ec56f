"""Exact top-k search by inner product with Fagin's threshold algorithm.

Vectors are integers. Candidates are cut into blocks, queries into query blocks, and each pair of
blocks is searched in one piece: the block keeps one sorted list for each dimension, a query reads
its lists from the end that helps it (the largest values where its own component is positive, the
smallest where it is negative), scores every vector met, and stops once the bound, the best score
that a vector not met yet can have, is below its kth best score.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES = 8192  # vectors of a block
QUERIES = 2048  # queries of a block
FIRST_DEPTH = 64  # rows read of each list before the first stop test is a 64th of the block; then four times more
_EXACT = 2**53


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; NULL for a vector with a NULL or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.when(~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def _matrix(rows, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def threshold_search(ids: np.ndarray, vectors: np.ndarray, own: np.ndarray, query: np.ndarray, order: np.ndarray, k: int):
    """The k best (score, id) of one query in one block, ties to the lesser id; `order` has a sorted list for each column.

    Rows in the mask `own` take no part. Also returns how many vectors were scored.
    """
    n = len(ids)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    met = own.copy()
    scored = depth = 0
    best_scores, best_ids = query[:0], ids[:0]
    while True:
        reach = min(n, max(4 * depth, n // FIRST_DEPTH, k)) if len(up) + len(down) else n
        fresh = np.full(n, reach == n)  # to the end of the lists: every vector is met
        if reach < n:
            fresh[order[up, n - reach : n - depth]] = True
            fresh[order[down, depth:reach]] = True
        fresh = np.flatnonzero(fresh & ~met)
        met[fresh] = True
        scored += len(fresh)
        scores = (vectors @ query)[fresh] if 2 * len(fresh) > n else vectors[fresh] @ query
        if len(best_scores) == k:
            good = scores >= best_scores[-1]
            fresh, scores = fresh[good], scores[good]
        best_scores, best_ids = np.concatenate([best_scores, scores]), np.concatenate([best_ids, ids[fresh]])
        first = np.lexsort((best_ids, -best_scores))[:k]
        best_scores, best_ids = best_scores[first], best_ids[first]
        depth = reach
        if depth == n:
            break
        if len(best_scores) == k:
            bound = (query[up] * vectors[order[up, n - 1 - depth], up]).sum()
            bound += (query[down] * vectors[order[down, depth], down]).sum()
            if bound < best_scores[-1]:
                break
    return best_scores, best_ids, scored


def _search(k: int):
    def search(key, candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "query_key", "asks", "vec_id", "score"]
        if not len(candidates) or not len(queries):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in columns})
        width = max(max(map(len, candidates["v"])), max(map(len, queries["v"])), 1)
        vectors, asked = _matrix(candidates["v"], width), _matrix(queries["v"], width)
        ids, digests, first = candidates["id"].to_numpy(), candidates["digest"].to_numpy(), candidates["copy"].to_numpy() == 0
        order = np.argsort(vectors.T, axis=1, kind="stable")
        limit = max(abs(int(vectors.min())), int(vectors.max())) * max(abs(int(asked.min())), int(asked.max())) * width
        # floats are exact and fast below 2**53; beyond, Python's integers
        kind = np.float64 if limit < _EXACT else object
        vectors, asked = vectors.astype(kind), asked.astype(kind)
        parts = []
        for query_id, query_key, times, query in zip(queries["id"], queries["digest"], queries["asks"], asked):
            own = first & (ids == query_id) & (digests == query_key)
            scores, found, _ = threshold_search(ids, vectors, own, query, order, k)
            whole = [min(max(int(s), -(2**63)), 2**63 - 1) for s in scores]
            parts += [(query_id, query_key, times, i, s) for i, s in zip(found.tolist(), whole)]
        return pd.DataFrame(parts, columns=columns).astype("int64")

    return search


def top_k(rows: DataFrame, is_query: Column, k: int = 5, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row where `is_query` holds.

    Scores are inner products of the quantised vectors; ties go to the smaller id; fewer than k rows
    if there are fewer candidates. NULL ids and vectors that are NULL or hold NULL or non-finite
    components take no part. Every row is a candidate but the query's own, so a repeated row finds
    its copies and comes back as often as it is there; as queries, equal rows get the same ranks
    each. Shorter vectors count as filled up with zeros. Scores beyond 64 bits are cut to the
    nearest long. Candidates are sent to every query block, queries to every candidate block; each
    block pair sends back k rows a query, and of equal rows k + 1 at most travel, as more cannot be
    among the k best.
    """
    held = (
        rows.select(F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where("id is not null and v is not null")
        .select("id", "v", "asks", F.xxhash64("v").alias("digest"))
        .groupBy("id", "digest").agg(F.any_value("v").alias("v"), F.count_if("asks").alias("asks"), F.count("*").alias("rows"))
    )
    sizes = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, sides = max(1, math.ceil(sizes.n / CANDIDATES)), max(1, math.ceil(sizes.q / QUERIES))

    def block(count: int) -> Column:
        return F.pmod(F.xxhash64("id", "digest"), F.lit(count)).cast("int")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    copies = F.sequence(F.lit(0), F.least("rows", F.lit(k + 1)).cast("int") - 1)
    candidates = held.select("id", "digest", "v", F.explode(copies).alias("copy"))
    candidates = candidates.select("id", "digest", "copy", "v", block(blocks).alias("block"), every(sides).alias("side"))
    queries = held.where("asks > 0").select("id", "digest", "v", "asks", block(sides).alias("side"), every(blocks).alias("block"))
    found = candidates.groupBy("block", "side").cogroup(queries.groupBy("block", "side")).applyInPandas(
        _search(k), "query_id long, query_key long, asks long, vec_id long, score long"
    )
    place = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select(
        "query_id", "rank", "vec_id", "score", F.explode(F.sequence(F.lit(1), F.col("asks").cast("int"))).alias("copy")
    ).drop("copy")
