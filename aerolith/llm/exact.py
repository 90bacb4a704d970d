"""Exact deduplication by skew-safe combining (operator 5).

DataFrame functions only: no Python runs on the executors."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialise

WHITE_SPACE = r"[\x20\x09-\x0D]+"
#: A digest is hot when it has more than 1/HOT_SHARE of all rows, so fewer than
#: HOT_SHARE digests are: the bound of what is broadcast.
HOT_SHARE = 4096
NO_ID = 2**63 - 1


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 32,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per row of ``docs`` with the group of equal texts it belongs to.

    Texts are equal when identical after white space (0x20, 0x09-0x0D) is deleted;
    null counts as empty.  Of equal texts the one with the most code points in the
    original, then the smallest id, stays.

    Method.  Rows are combined before the shuffle, then by (digest, salt), then the
    salt winners by digest; every grouping key holds the full normalised text, so
    equality never rests on the digest.  Only hot digests (more than 1/4096 of the
    rows) are salted; the others meet in one group at the first shuffle.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256``.  Defined cases: a
    null id sorts after all others; repeated rows each give a row and count in
    group_size, and all rows with the winning id are ``kept``; an empty table gives
    an empty result; further columns of ``docs`` are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.char_length(text).alias("len"),
        F.regexp_replace(text, WHITE_SPACE, "").alias("norm"),
    ).withColumn("digest", digest(F.col("norm")))
    slim = materialise(rows.select("id", "digest", F.sha2("norm", 256).alias("sha")))

    total = slim.count()
    hot = materialise(
        slim.groupBy("digest").agg(F.count("*").alias("n")).where(F.col("n") > max(1000, total // HOT_SHARE))
    ).select("digest", F.lit(True).alias("hot"))

    # longest text first, then smallest id, as one number: 2^64 * len + (2^63 - 1 - id)
    rank = F.expr(
        f"cast(len as decimal(38, 0)) * 18446744073709551616 + ({NO_ID} - cast(coalesce(id, {NO_ID}) as decimal(20, 0)))"
    )
    salted = (
        rows.join(F.broadcast(hot), "digest", "left")
        .withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(-1))
        .withColumn("rank", rank)
    )
    local = salted.groupBy("digest", "salt", "norm").agg(
        F.max("rank").alias("rank"), F.count("*").alias("n")
    )
    # only the winners of salts have to meet again, so only they keep their text
    local = materialise(
        local.select("digest", "salt", "rank", "n", F.when(F.col("salt") >= 0, F.col("norm")).alias("norm"))
    )
    cold = local.where("salt < 0").select("digest", "rank", "n")
    merged = (
        local.where("salt >= 0")
        .groupBy("digest", "norm")
        .agg(F.max("rank").alias("rank"), F.sum("n").alias("n"))
        .select("digest", "rank", "n")
    )

    def winners(groups: DataFrame) -> DataFrame:
        """Turns rank back into the id that stays."""
        left = F.expr(f"cast({NO_ID} - (rank % 18446744073709551616) as long)")
        return groups.withColumn("keep_id", F.when(left != NO_ID, left)).drop("rank")

    def one_content(groups: DataFrame) -> DataFrame:
        """The digests under which there is one text only."""
        one = groups.groupBy("digest").agg(
            F.count("*").alias("texts"), F.max("rank").alias("rank"), F.max("n").alias("n")
        )
        return one.where("texts = 1").drop("texts")

    singles = winners(one_content(cold))
    hot_singles = winners(one_content(merged))
    marked = slim.join(F.broadcast(hot), "digest", "left")
    out = marked.where("hot is null").join(singles, "digest").select("id", "keep_id", "n", "sha").union(
        marked.where("hot").join(F.broadcast(hot_singles), "digest").select("id", "keep_id", "n", "sha")
    )
    # digests shared by different texts: those rows are matched by their text
    collided = materialise(
        cold.union(merged).groupBy("digest").count().where("count > 1").select("digest")
    )
    if not collided.isEmpty():
        met = salted.join(collided, "digest", "left_semi")
        groups = (
            met.groupBy("digest", "salt", "norm").agg(F.max("rank").alias("rank"), F.count("*").alias("n"))
            .groupBy("digest", "norm").agg(F.max("rank").alias("rank"), F.sum("n").alias("n"))
        )
        out = out.union(
            met.join(winners(groups), ["digest", "norm"]).select("id", "keep_id", "n", F.sha2("norm", 256).alias("sha"))
        )
    return out.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


#: Dropped rows up to which they are broadcast (about 100 bytes each).
BROADCAST_ROWS = 200_000


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row per group of equal texts; all columns stay.

    Rows that repeat both the id and the text of the row that stays are one row; the
    other cases are those of ``exact_groups``, and column names never clash."""
    groups = materialise(exact_groups(docs, id_col, text_col))
    name, sha = (f"{x}_{uuid.uuid4().hex}" for x in ("id", "sha"))
    keys = [F.coalesce("doc_id", F.lit(NO_ID)).alias(name), F.col("text_sha256").alias(sha)]

    def among(rows: DataFrame) -> DataFrame:
        rows = materialise(rows)
        return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows

    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), WHITE_SPACE, "")
    marked = docs.withColumns({name: F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)), sha: F.sha2(norm, 256)})
    left = marked.join(among(groups.where("not kept").select(*keys).distinct()), [name, sha], "left_anti")
    # whole rows are shuffled only where the row that stays is there more than once
    twice = among(groups.where("kept").select(*keys).groupBy(name, sha).count().where("count > 1").drop("count"))
    if not twice.isEmpty():
        again = left.join(twice, [name, sha], "left_semi").dropDuplicates([name, sha])
        left = left.join(twice, [name, sha], "left_anti").unionByName(again)
    return left.select(*docs.columns)
