"""Hard negatives by a norm-bucketed search for inner products (operator 13)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialise
from .topk import quantised

#: Vectors in a bucket of like norms, in a shard of buckets, and anchors handled together.
BUCKET, SHARD, ANCHORS = 512, 32_768, 4_096
#: Rounding of a norm and of the product of two, as a share of it; bounds are widened by it.
SLACK = 1e-9


class Bucket:
    """Rows of one label with norms up to ``norm``."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, norm: float):
        self.ids, self.rows, self.norm = ids, rows, norm


def buckets_of(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, size: int = BUCKET) -> dict[int, list[Bucket]]:
    """The rows of each label, sorted by descending norm and cut into buckets."""
    norms = np.sqrt((rows.astype(np.float64) ** 2).sum(axis=1))
    out: dict[int, list[Bucket]] = {}
    for label in np.unique(labels):
        at = np.flatnonzero(labels == label)
        at = at[np.lexsort((ids[at], -norms[at]))]
        out[int(label)] = [Bucket(ids[p], rows[p], float(norms[p[0]])) for p in (at[k : k + size] for k in range(0, len(at), size))]
    return out


def exact_rows(vectors: list, d: int) -> np.ndarray:
    """Integer rows as float64 where every partial sum is below 2^53, else as int64."""
    rows = np.stack(vectors) if len(vectors) else np.zeros((0, d), np.int64)
    largest = float(np.abs(rows.astype(np.float64)).max(initial=0))
    if largest * largest * max(1, d) >= 2.0**63:
        raise ValueError("inner products of these vectors do not fit a 64-bit integer")
    return rows.astype(np.float64 if largest * largest * max(1, d) < 2**53 else np.int64)


class Search:
    """One window: of what is between ``low`` and ``high`` the ``k`` first."""

    __slots__ = ("low", "high", "k", "scores", "ids")

    def __init__(self, low: float, high: float, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.empty(0), np.empty(0, np.int64)

    def limit(self) -> float:
        """No score below it can still come in."""
        return max(self.low, self.scores[-1]) if len(self.scores) == self.k else self.low

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = (scores >= self.limit()) & (scores <= self.high)
        if keep.any():
            s, i = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
            top = np.lexsort((i, -s))[: self.k]
            self.scores, self.ids = s[top], i[top]


def fill(anchor_id: int, anchor: np.ndarray, windows: list[Search], buckets: list[list[Bucket]]) -> None:
    """Fills the windows of an anchor from runs of buckets, each in descending norm.

    |anchor| x norm bounds every score of a bucket (Cauchy-Schwarz) and of those after
    it, so a run ends at the first bucket whose bound is below what all windows ask."""
    size = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
    for run in buckets:
        for b in run:
            bound = size * b.norm * (1 + SLACK)
            if bound < min(w.limit() for w in windows):
                break
            scores = b.rows @ anchor
            own = b.ids != anchor_id
            scores, ids = (scores, b.ids) if own.all() else (scores[own], b.ids[own])
            for w in windows:
                if bound >= w.limit():
                    w.offer(scores, ids)


def sharded(rows: DataFrame) -> DataFrame:
    """``rows(id, label, v, norm)`` dealt by norm into shards of some 32,768, written once;
    shard 0 has the greatest norms.  The salt parts rows of one norm."""
    n = rows.count()
    shards = max(1, -(-n // SHARD))
    dealt = rows.withColumn("salt", F.xxhash64("id", F.monotonically_increasing_id())).repartitionByRange(shards, F.desc("norm"), "salt")
    return materialise(dealt.select("id", "label", "v", "norm", F.spark_partition_id().alias("shard")))


def asked_shards(asks: DataFrame, stats: DataFrame) -> DataFrame:
    """``asks`` once for each shard that can hold one of its answers: those whose bound is
    not below ``least``.

    The greatest norms of all shards, one number for 32,768 rows, are looked up as an array."""
    heads = stats.agg(F.array_sort(F.collect_list(F.struct("shard", "top"))).alias("heads"))
    both = asks.join(F.broadcast(heads))  # one row
    reach = F.filter("heads", lambda x: x["top"] * F.col("size") * (1 + SLACK) >= F.col("least"))
    return both.withColumn("shard", F.explode(F.transform(reach, lambda x: x["shard"]))).drop("heads")


def ask(asks: DataFrame, table: DataFrame, stats: DataFrame, groups: int, schema: str, task: Callable) -> DataFrame:
    """``task(asks, buckets by label)`` for every pair of a shard and a group of anchors.

    Both sides of a pair are bounded; a shard is read by as many pairs as there are
    groups of 4,096 anchors."""
    group = F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int")
    left = asked_shards(asks, stats).withColumn("group", group)
    right = table.select("id", "label", "v", "shard", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    names = [x.split()[0] for x in schema.split(", ")]

    def run(key: tuple, a: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(rows):
            return pd.DataFrame({n: [] for n in names})
        d = len(rows["v"].iat[0])
        every = exact_rows([*rows["v"], *a["v"]], d)
        buckets = buckets_of(rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64), every[: len(rows)])
        return pd.DataFrame(list(task(a, every[len(rows) :], buckets)), columns=names)

    return left.groupBy("shard", "group").cogroup(right.groupBy("shard", "group")).applyInPandas(run, schema)


def first_rows(frame: DataFrame, keys: list[str], item: str, score: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), item)
    return frame.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """For each row where ``is_anchor`` holds (a condition on ``id``) and each of its first
    ``positives`` other rows of its label, the first ``negatives`` rows of other labels
    whose score is from ``low`` to ``high`` hundredths of the positive's.

    Scores are inner products of ``floor(256 x)``.  Rows are dealt by norm into shards; in
    a task the rows of each label are sorted by norm and cut into buckets, and an anchor
    leaves a run of buckets where |anchor| times their norm is below its window's lower
    limit and its running k-th score.  Whole shards are left out by the same bound.
    Positives are found first, with the anchor's own label only.  Nothing is sampled, and
    no list is capped but those asked for.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    Ties go to the smaller id.  Defined cases: null labels, ids and vectors, and vectors
    with null or non-finite components, take no part; components that a shorter vector
    lacks count as 0; a positive score below 0 has an empty window; a repeated id is
    listed as often as it has rows, is never its own positive or negative, and is an
    anchor once (with the smaller label and vector); components or scores too large for a
    64-bit integer fail the task; an empty table gives an empty result; further
    columns are not read.
    """
    labelled = vectors.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    table = quantised(labelled, id_col, vector_col, F.col(label_col).cast("long").alias("label"))
    table = materialise(table)
    d = table.agg(F.max(F.size("v"))).first()[0] or 0
    v = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(d) - F.size("v")))
    table = table.withColumn("v", v).withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x)))
    table = sharded(table)
    stats = table.groupBy("shard").agg(F.max("norm").alias("top"))
    anchors = table.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v", "norm")).alias("a"))
    anchors = materialise(anchors.select("id", "a.label", "a.v", F.col("a.norm").alias("size")))
    groups = -(-max(1, anchors.count()) // ANCHORS)

    def find_positives(a: pd.DataFrame, rows: np.ndarray, buckets: dict[int, list[Bucket]]) -> Iterator[tuple]:
        for q, (i, label) in enumerate(zip(a["id"], a["label"], strict=True)):
            w = Search(-np.inf, np.inf, positives)
            fill(int(i), rows[q], [w], [buckets.get(int(label), [])])
            for s, p in zip(w.scores, w.ids, strict=True):
                yield int(i), int(p), int(s)

    def find_negatives(a: pd.DataFrame, rows: np.ndarray, buckets: dict[int, list[Bucket]]) -> Iterator[tuple]:
        for q, (i, label, wanted) in enumerate(zip(a["id"], a["label"], a["wanted"], strict=True)):
            wanted = [int(p) for p in wanted]
            # whole numbers that the two inequalities allow
            windows = [Search(-(-low * p // 100), high * p // 100, negatives) for p in wanted]
            fill(int(i), rows[q], windows, [run for other, run in buckets.items() if other != label])
            for p, w in zip(wanted, windows, strict=True):
                for s, n in zip(w.scores, w.ids, strict=True):
                    yield int(i), p, int(n), int(s)

    asks = anchors.withColumn("least", F.lit(float("-inf")))
    found = ask(asks, table, stats, groups, "anchor_id long, positive_id long, positive_score long", find_positives)
    found = materialise(first_rows(found, ["anchor_id"], "positive_id", "positive_score", positives))
    # positives of one score share their window
    wanted = found.where("positive_score >= 0").groupBy("anchor_id").agg(
        F.collect_set("positive_score").alias("wanted"), (F.min("positive_score") * (low / 100)).alias("least")
    )
    asks = anchors.join(wanted.withColumnRenamed("anchor_id", "id"), "id")
    hits = ask(asks, table, stats, groups, "anchor_id long, positive_score long, negative_id long, negative_score long", find_negatives)
    hits = first_rows(hits, ["anchor_id", "positive_score"], "negative_id", "negative_score", negatives)
    joined = found.drop("rank").join(hits, ["anchor_id", "positive_score"])
    return joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
