"""Append, backfill, repair and merge of retained tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import COMPLETE
from .reduce import FULL, LAST, hour_masks, ordered_sum


def missing_ranges(first: date, last: date, old: tuple[date, date] | None) -> list[tuple[date, date]]:
    """Date ranges to acquire so that retained and requested days are one range."""
    if first > last:
        raise ValueError("the first day is after the last")
    if old is None:
        return [(first, last)]
    out = []
    if first < old[0]:
        out.append((first, old[0] - timedelta(days=1)))
    if last > old[1]:
        out.append((old[1] + timedelta(days=1), last))
    return out


def missing_by_key(held: DataFrame, key: str) -> DataFrame:
    """``missing_ranges`` for every key of ``held(key, lo, hi)``, so that all keys cover
    the days from the first to the last that any has: ``key, start_date, end_date``."""
    whole = held.agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    both = held.join(F.broadcast(whole))  # one row
    ranges = F.array(
        F.when(F.col("first") < F.col("lo"), F.struct(F.col("first").alias("start_date"), F.date_sub("lo", 1).alias("end_date"))),
        F.when(F.col("last") > F.col("hi"), F.struct(F.date_add("hi", 1).alias("start_date"), F.col("last").alias("end_date"))),
    )
    return both.select(key, F.explode(F.array_compact(ranges)).alias("r")).select(key, "r.*")


def merge_retained(parts: Sequence[DataFrame], members: DataFrame, reasons: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Retained tables of successive days as one, for the cells of a membership.

    Rows of other cells go; the days must follow one another; a repeated key fails the
    task that meets it.  ``<value>__status`` is COMPLETE, or the reason why the row's part
    can have nulls: ``reasons`` has one for each part, all different."""
    if len(set(reasons)) != len(parts):
        raise ValueError("each part needs a reason of its own for its nulls")
    ids = members.select(F.col("h3_index").alias("H3_INDEX")).distinct()
    marked = [p.withColumn("why", F.lit(r)) for p, r in zip(parts, reasons, strict=True)]
    whole = union_contiguous(marked).join(ids, "H3_INDEX", "left_semi")
    keys = [c for c in ("H3_INDEX", "DATE", "DATETIME") if c in whole.columns]
    columns = [c for c in whole.columns if c not in keys]
    one = whole.groupBy(*keys).agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in columns])
    there = F.when(F.col("times") == 1, True).otherwise(F.raise_error(F.lit("a key is repeated")).cast("boolean"))
    status = {f"{c}__status": F.when(F.col(c).isNotNull(), COMPLETE).otherwise(F.col("why")) for c in values}
    return one.where(there).withColumns(status).drop("times", "why")


def align_backfill(retained: DataFrame, added: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New metric columns joined to the retained rows, which all stay as they are.
    ``unmatched`` marks rows whose key the new table lacks; a product needs none."""
    mark = added.withColumn("__there", F.lit(True))
    return retained.join(mark, list(keys), "left").withColumn("unmatched", F.col("__there").isNull()).drop("__there")


def fill_missing(retained: DataFrame, fresh: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Fresh values only where the retained one is null; nothing else changes."""
    new = fresh.select(*keys, F.col(column).alias("__fresh"))
    return retained.join(new, list(keys), "left").withColumn(column, F.coalesce(column, "__fresh")).select(*retained.columns)


def repaired_day(hourly: DataFrame, daily: DataFrame, column: str, expected: int = 24) -> DataFrame:
    """Daily sums that were null and whose hours are complete now, added up hour by hour."""
    total = hourly.groupBy("H3_INDEX", F.to_date("DATETIME").alias("DATE")).agg(
        F.when(F.count(column) == expected, ordered_sum(F.col(column), F.col("DATETIME"))).alias("__sum")
    )
    joined = daily.join(total, ["H3_INDEX", "DATE"], "left")
    return joined.withColumn(column, F.coalesce(column, "__sum")).select(*daily.columns)


def repair_faults(hourly: DataFrame, daily: DataFrame, fresh: DataFrame, column: str) -> DataFrame:
    """``H3_INDEX, DATE, fault`` of the days that cannot be repaired: those that lack other
    hours than the last, that have a daily value all the same, or whose last hour the
    fresh rows lack as well.  A repair needs none."""
    keys = ["H3_INDEX", "DATE"]
    masks = hour_masks(hourly, [column], "H3_INDEX", "DATETIME").select(*keys, F.col(column).alias("mask"))
    last = fresh.where(F.hour("DATETIME") == 23).select("H3_INDEX", F.to_date("DATETIME").alias("DATE"), F.col(column).alias("fresh"))
    both = daily.select(*keys, F.col(column).alias("total")).join(masks, keys, "left").join(last, keys, "left")
    fault = (
        F.when(F.coalesce(F.col("mask"), F.lit(0)) != FULL - LAST, "does not lack the last hour alone")
        .when(F.col("total").isNotNull(), "has a daily value although an hour is missing")
        .when(F.col("fresh").isNull(), "has no support for its last hour")
    )
    return both.select(*keys, fault.alias("fault")).where("fault is not null")


def changed_rows(before: DataFrame, after: DataFrame, keys: Sequence[str], may_fill: Sequence[str] = ()) -> DataFrame:
    """Keys whose row is missing on one side or differs in a value.  In the columns of
    ``may_fill`` a null may have become a value."""
    values = [c for c in before.columns if c not in keys]
    a = before.select(*keys, F.struct(*values).alias("__a"))
    b = after.select(*keys, F.struct(*values).alias("__b"))
    off = F.col("__a").isNull() | F.col("__b").isNull()
    for c in values:
        x, y = F.col(f"__a.{c}"), F.col(f"__b.{c}")
        same = x.eqNullSafe(y) | x.isNull() if c in may_fill else x.eqNullSafe(y)
        off = off | ~same
    return a.join(b, list(keys), "full").where(off).select(*keys)


def union_contiguous(parts: Sequence[DataFrame], date_column: str = "DATE") -> DataFrame:
    """Union of tables whose date ranges follow one another without gap or overlap.

    Only each part's first and last date come to the driver."""
    spans = []
    for part in parts:
        lo, hi = part.agg(F.min(date_column), F.max(date_column)).first()
        if lo is None:
            raise ValueError("a part without rows")
        spans.append((lo, hi, part))
    spans.sort(key=lambda s: s[0])
    for (_, end, _), (start, _, _) in zip(spans, spans[1:], strict=False):
        if start != end + timedelta(days=1):
            raise ValueError(f"gap or overlap between {end} and {start}")
    out = spans[0][2]
    for _, _, part in spans[1:]:
        if part.schema != out.schema:
            raise ValueError("parts differ in their schemas")
        out = out.unionByName(part)
    return out
