"""Best-fit packing under conflicts (operator 2)."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact import WHITE_SPACE
from .storage import materialise

#: Pieces that one shard packs: bounds a task's memory and time.
SHARD_PIECES = 8_000


class Bins:
    """Open bins in order of residual space; each carries a bitmap of the sources
    and one of the duplicate clusters it holds."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (residual, bin), ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.used: list[int] = []

    def place(self, size: int, source_bit: int, cluster_bit: int) -> tuple[int, int]:
        """Puts a piece into the tightest compatible bin, a new one if there is
        none; returns the bin and the offset.

        The successor search starts at the smallest residual that fits and goes on
        to larger ones until no bit of the piece is set in the bin."""
        order, sources, clusters = self.order, self.sources, self.clusters
        at = bisect.bisect_left(order, (size, -1))
        while at < len(order):
            residual, b = order[at]
            if not (sources[b] & source_bit or clusters[b] & cluster_bit):
                del order[at]
                break
            at += 1
        else:
            residual, b = self.capacity, len(sources)
            sources.append(0)
            clusters.append(0)
            self.used.append(0)
        offset = self.used[b]
        self.used[b] += size
        sources[b] |= source_bit
        clusters[b] |= cluster_bit
        if residual > size:
            bisect.insort(order, (residual - size, b))
        return b, offset


def pack_shard(shard: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Best-fit decreasing over one shard's pieces.

    A bit is given to a source or cluster only where the shard holds it twice:
    what occurs once conflicts with nothing.  Full pieces fill a bin on their own."""
    shard = shard.sort_values(["size", "tie"], ascending=[False, True], kind="stable")

    def bits(column: str) -> list[int]:
        codes = shard[column].where(shard[column].duplicated(keep=False) & shard[column].notna())
        return [0 if c < 0 else 1 << int(c) for c in pd.factorize(codes)[0]]

    bins = Bins(capacity)
    placed = [
        bins.place(int(size), s, c)
        for size, s, c in zip(shard["size"], bits("source"), bits("cluster"), strict=True)
    ]
    out = shard[["doc_id", "piece", "pieces", "size", "shard"]].copy()
    out["bin"] = [b for b, _ in placed]
    out["offset"] = [o for _, o in placed]
    return out


def word_count(text: Column) -> Column:
    """Words of a text, separated by 0x20 and 0x09-0x0D."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def pack(
    docs: DataFrame,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str | None = None,
    cluster: Column | None = None,
    length: Column | None = None,
) -> DataFrame:
    """Packs ``docs`` into bins of ``capacity`` tokens.

    ``length`` counts a row's tokens (default: words) and ``cluster`` names its
    duplicate cluster (default: a 64-bit hash of the text without white space).  A
    bin never holds two documents of one cluster, nor two of one source where
    ``source_col`` is given.  A longer document is cut into pieces of ``capacity``;
    only its last piece can share a bin.

    Shards of about 8,000 pieces are packed independently, a row going to a shard
    by a hash of its id, text hash, length and, if it is repeated, number, so a hot
    source, cluster or row is dealt over all shards.  The loss against one global packing is a few open bins a shard.

    Returns ``bin_id, doc_id, piece, pieces, n_tokens, offset``, one row per piece.
    Defined cases: null, empty and blank texts have no tokens and give one row with
    bin_id null; a null source or null cluster conflicts with nothing; a null id is
    packed like any other; repeated rows are packed each (and are of one cluster);
    ties in length go by hash, then id; an empty table gives an empty result;
    further columns are not read.
    """
    text = F.col(text_col)
    norm = F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")
    rows = materialise(docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (length if length is not None else word_count(text)).cast("long").alias("len"),
        (F.col(source_col).cast("string") if source_col else F.lit(None).cast("string")).alias("source"),
        (cluster if cluster is not None else F.xxhash64(norm)).cast("long").alias("cluster"),
        F.xxhash64(id_col, text_col).alias("tie"),
    ).groupBy("doc_id", "len", "source", "cluster", "tie").agg(F.count("*").alias("n")))
    total = rows.agg(F.sum("n")).first()[0] or 0
    # repeated rows are counted before they are dealt, and each has a number of its own
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy")).drop("n")
    full = (F.col("len") / capacity).cast("long")
    last = F.col("len") - full * capacity
    # pieces that fill a bin need no search
    whole = rows.where(full > 0).select(
        "doc_id", "tie", "copy", F.explode(F.sequence(F.lit(0).cast("long"), full - 1)).alias("piece"), (full + (last > 0).cast("long")).alias("pieces")
    )
    whole = whole.select(
        F.concat_ws("-", F.lit("f"), F.hex("tie"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("piece").cast("string"),
                    F.col("copy").cast("string")).alias("bin_id"),
        "doc_id", "piece", "pieces", F.lit(capacity).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("offset"),
    )
    tails = rows.where((last > 0)).select(
        "doc_id", "tie", "copy", "source", "cluster", full.alias("piece"), (full + 1).alias("pieces"), last.alias("size")
    )
    empty = rows.where(F.coalesce("len", F.lit(0)) == 0).select(
        F.lit(None).cast("string").alias("bin_id"), "doc_id", F.lit(0).cast("long").alias("piece"),
        F.lit(0).cast("long").alias("pieces"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("offset"),
    )
    shards = max(1, -(-total // SHARD_PIECES))

    def run(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        return pack_shard(shard, capacity)

    packed = (
        tails.withColumn("shard", F.pmod(F.xxhash64("tie", "doc_id", "size", "copy"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(run, "doc_id long, piece long, pieces long, size long, shard long, bin long, offset long")
        .select(
            F.concat_ws("-", F.lit("s"), F.col("shard").cast("string"), F.col("bin").cast("string")).alias("bin_id"),
            "doc_id", "piece", "pieces", F.col("size").alias("n_tokens"), "offset",
        )
    )
    return whole.unionByName(packed).unionByName(empty)
