"""Connected components, and links inside candidate buckets, as DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialise, part, passing


#: Ids up to which a filter's ids are broadcast (8 bytes each); beyond it the same
#: filter runs as a shuffled semi-join.
BROADCAST_IDS = 500_000


def only_ids(table: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``table`` whose ``id`` occurs in ``pairs(a, b)``."""
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct())
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return table.join(ids, "id", "left_semi")


def connected_components(links: DataFrame) -> DataFrame:
    """Components of the undirected graph ``links(a, b)``.

    Returns ``(id, component)`` for every id on some link; ``component`` is the
    smallest id reachable.  Alternates "large star" and "small star" rounds (each
    a map-side combined minimum and an equi-join), which ends after a number of
    rounds logarithmic in the longest path.  Self-links, repeated links and links
    with a null end are ignored; no links give an empty table.
    """
    edges = materialise(
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )

    def attach(pairs: DataFrame) -> DataFrame:
        """To each (node, other) the node's smallest neighbour, itself included."""
        low = pairs.groupBy("node").agg(F.min("other").alias("low"))
        low = low.withColumn("low", F.least("node", "low"))
        return pairs.join(low, "node")

    def checksum(e: DataFrame):
        return tuple(
            e.agg(F.count("*"), F.expr("sum(cast(xxhash64(u, v) as decimal(38, 0)))")).first()
        )

    before = checksum(edges)
    while before[0]:
        both = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).union(
            edges.select(F.col("v").alias("node"), F.col("u").alias("other"))
        )
        large = (
            attach(both)
            .where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("u"), F.col("low").alias("v"))
            .where("u != v")
            .distinct()
        )
        down = attach(large.select(F.col("u").alias("node"), F.col("v").alias("other")))
        small = down.select(F.col("other").alias("u"), F.col("low").alias("v")).union(
            down.select(F.col("node").alias("u"), F.col("low").alias("v"))
        )
        edges = materialise(small.where("u != v").distinct())
        after = checksum(edges)
        if after == before:
            break
        before = after
    leaves = edges.groupBy("u").agg(F.min("v").alias("component"))
    return leaves.select(F.col("u").alias("id"), "component").union(
        leaves.select(F.col("component").alias("id"), "component").distinct()
    )


def bucket_components(
    keys: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    condition: Callable[[str, str], Column] | None = None,
    detail: DataFrame | None = None,
    known: DataFrame | None = None,
    coarse: DataFrame | None = None,
    narrow: Callable[[DataFrame], DataFrame] | None = None,
    screen_hubs: bool = False,
    parts: int = 1,
    written: Callable[[], None] = lambda: None,
) -> tuple[DataFrame, DataFrame]:
    """Components of the graph whose links are the verified pairs that share a
    bucket of ``keys(bucket, id, weight)``; weight may be left out, further columns are
    carried along.

    A large bucket is not expanded into all its pairs.  Its members are first
    verified against two hubs, the member of the largest weight, if there are weights,
    and the one of the smallest id.  Members that the hubs already join need no further link among
    themselves; only pairs of one bucket whose components still differ are verified
    in a last pass.  No link between components is lost, but for pairs that
    ``condition`` rejects.

    ``verify`` takes distinct ``(a, b)`` and returns those that are links;
    ``condition(left, right)`` is a necessary condition of a link on the columns of
    ``detail(id, ...)``, or, with ``screen_hubs``, on the further columns of ``keys`` alone,
    and then pairs with a hub are held to it too; ``coarse(bucket, id, ...)`` are fewer and larger buckets that the
    last pass joins instead (``condition`` then says whether two rows share one of
    ``keys``); ``narrow`` takes the rows ``(bucket, id, component)``, with any
    further columns, and returns those that can have a link to another
    component of their bucket; ``known(a, b)`` are links given beforehand.  Members are
    written in so many ``parts`` of the buckets, one after the other, so that the disk holds the
    shuffle of one; ``written`` is called when ``keys`` are not read any more.  Returns
    ``(links(a, b), components(id, component))``.
    """
    extra = [c for c in keys.columns if c not in ("bucket", "id", "weight")]
    least = [F.min(F.struct("id", *extra)).alias("lo"), F.max("id").alias("hi")]
    heavy = F.max(F.struct("weight", (-F.col("id")).alias("minus"), "id", *extra)).alias("best")
    weighed = "weight" in keys.columns
    names = ("lo", "best") if weighed else ("lo",)

    def with_hubs(some: DataFrame) -> DataFrame:
        hubs = some.groupBy("bucket").agg(*least, *[heavy] * weighed).where("lo.id < hi").drop("hi")
        return some.join(hubs, "bucket").drop("weight")

    def apart_yet(some: DataFrame) -> DataFrame:
        """Members of buckets that ``found`` leaves in two components or more."""
        some = some.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
        if narrow is None:
            mixed = some.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1"))
            some = some.join(mixed.where("c0 < c1").select("bucket"), "bucket", "left_semi")
        else:
            some = narrow(some)
        return some if detail is None else some.join(detail, [c for c in ("id", "sid") if c in some.columns and c in detail.columns])

    with ExitStack() as held:  # a table of members goes when what is left of it is written, that when the links are
        owners = [held.enter_context(ExitStack()) for _ in range(parts)]
        tables = [own.enter_context(passing(with_hubs(part(keys, "bucket", k, parts)))) for k, own in enumerate(owners)]
        written()
        members = reduce(DataFrame.unionByName, tables)
        asked = None
        for hub in names:
            met = members.alias("l")
            if screen_hubs and condition is not None:
                met = met.where(condition("l", hub))
            ends = (F.col("id"), F.col(f"{hub}.id"))
            met = met.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b"))
            asked = met if asked is None else asked.union(met)
        first = verify(asked.where("a < b").distinct())
        first = materialise(first if known is None else first.union(known))
        found = connected_components(first)

        left_over = []
        for k, own in enumerate(owners):
            some = tables[k] if coarse is None else part(coarse, "bucket", k, parts)
            left_over.append(held.enter_context(passing(apart_yet(some))))
            own.close()
        rest = reduce(DataFrame.unionByName, left_over)
        left, right = rest.alias("l"), rest.alias("r")
        meet = (
            (F.col("l.bucket") == F.col("r.bucket"))
            & (F.col("l.id") < F.col("r.id"))
            & (F.col("l.component") != F.col("r.component"))
        )
        for hub in names if coarse is None else ():  # those pairs have been verified
            meet = meet & (F.col("l.id") != F.col(f"l.{hub}.id")) & (F.col("r.id") != F.col(f"r.{hub}.id"))
        if condition is not None:
            meet = meet & condition("l", "r")
        pairs = left.join(right, meet).select(F.col("l.id").alias("a"), F.col("r.id").alias("b"))
        second = materialise(verify(pairs.distinct()))
        links = first.union(second)
    if second.isEmpty():
        return links, found
    return links, connected_components(links)
