"""Exact top-k by inner product with block-at-a-time pruning (operator 9)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise

#: Vectors in a block, vectors in a shard of blocks, queries handled together.
BLOCK, SHARD, QUERIES = 512, 16_384, 1_024


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", *carried: Column) -> DataFrame:
    """``(id, v array<long>)`` and what is ``carried``, with ``floor(256 * x)`` of each
    component; vectors that are null or hold a null or non-finite component are left out.
    A component beyond 2^62 / 256 fails the task: as an integer it would be another."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    large = F.raise_error(F.lit("a component is too large for a 64-bit integer")).cast("long")
    ints = F.transform(v, lambda x: F.when(F.abs(x.cast("double")) < 2.0**54, F.floor(x.cast("double") * 256)).otherwise(large))
    return vectors.where(v.isNotNull() & ~bad).select(F.col(id_col).cast("long").alias("id"), ints.alias("v"), *carried)


class Block:
    """A range of documents: forward index (rows), and for every term its extremes."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.high, self.low = rows.max(axis=0), rows.min(axis=0)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query a sum of term maxima that no score in the block exceeds."""
        return np.maximum(queries, 0) @ self.high + np.minimum(queries, 0) @ self.low


def exact_type(queries: np.ndarray, rows: np.ndarray) -> type:
    """float64 where every partial sum is below 2^53 and so exact, else int64; raises
    where one may not fit."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if largest >= 2.0**63:
        raise ValueError("inner products of these vectors do not fit a 64-bit integer")
    return np.float64 if largest < 2**53 else np.int64


def search(query_ids: np.ndarray, queries: np.ndarray, blocks: list[Block], k: int) -> Iterator[tuple]:
    """Per query the ``k`` best ``(query, id, score)``, scored block by block in
    descending order of bound until the next bound is below the k-th score."""
    bounds = np.stack([b.bounds(queries) for b in blocks], axis=1)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0), np.empty(0, np.int64))] * len(query_ids)
    kth = np.full(len(query_ids), -np.inf)
    active = np.arange(len(query_ids))
    for turn in range(len(blocks)):
        # a tie in score may still win by its smaller id, so only lower bounds stop
        active = active[bounds[active, order[active, turn]] >= kth[active]]
        if not len(active):
            break
        for b in np.unique(order[active, turn]):
            block = blocks[b]
            asked = active[order[active, turn] == b]
            scores = block.rows @ queries[asked].T
            for column, q in enumerate(asked):
                s, ids = scores[:, column], block.ids
                keep = (s >= kth[q]) & (ids != query_ids[q])
                s, ids = np.concatenate([best[q][0], s[keep]]), np.concatenate([best[q][1], ids[keep]])
                top = np.lexsort((ids, -s))[:k]
                best[q] = (s[top], ids[top])
                if len(top) == k:
                    kth[q] = s[top[-1]]
    for q, (s, ids) in zip(query_ids, best, strict=True):
        for score, i in zip(s, ids, strict=True):
            yield int(q), int(i), int(score)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row where ``is_query`` holds (a condition on ``id``), its ``k`` best rows.

    Rows are dealt by id range into shards of about 16,384, each cut into blocks of
    512; queries into groups of about 1,024.  One task takes one (shard, group), and
    what a task gives (k rows a query) meets in a window by query.  Nothing is
    sampled, and no list is capped but the k asked for.

    Returns ``query_id, rank, vec_id, score``.  Ties go to the smaller id.  Defined
    cases: null vectors, vectors with null or non-finite components and null ids
    take no part; components that a shorter vector lacks count as 0; components or scores too
    large for a 64-bit integer fail the task; a repeated id is listed as often as
    it has rows, never as its own neighbour, and asks once (with the smaller vector); fewer candidates than k give all; an
    empty table gives an empty result; further columns are not read.
    """
    table = quantised(vectors, id_col, vector_col).where("id is not null")
    table = materialise(table)
    n, d = table.agg(F.count("*"), F.max(F.size("v"))).first()
    if not n:
        return table.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")
        ).limit(0)
    # a shorter vector has zeros where it has no components
    table = table.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("v"))))
    shards = -(-n // SHARD)
    # the salt splits even an id that is repeated over many rows
    placed = materialise(
        table.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(shards, "id", "salt")
        .select("id", "v", F.spark_partition_id().alias("shard"))
    )
    last = placed.agg(F.max("shard")).first()[0]
    queries = placed.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    groups = -(-max(1, queries.count()) // QUERIES)
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.lit(last)))
    asks = queries.select("id", "v", group.alias("group")).select("*", each.alias("shard"))
    answers = placed.select("id", "v", "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))

    def run(key: tuple, ask: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(ask) or not len(rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        rows = rows.sort_values("id", kind="stable")
        q, r = np.stack(ask["v"].to_numpy()), np.stack(rows["v"].to_numpy())
        kind = exact_type(q, r)
        q, r, ids = q.astype(kind), r.astype(kind), rows["id"].to_numpy(np.int64)
        blocks = [Block(ids[i : i + BLOCK], r[i : i + BLOCK]) for i in range(0, len(ids), BLOCK)]
        found = list(search(ask["id"].to_numpy(np.int64), q, blocks, k))
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    found = (
        asks.groupBy("shard", "group")
        .cogroup(answers.groupBy("shard", "group"))
        .applyInPandas(run, "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
