"""Hourly metrics and daily aggregates with complete support, at native points.

Everything here is built-in expressions and one map-side combined aggregation on
(point, day); sampling to cells comes afterwards, as fewer points than cells exist."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import weather as W
from ..specs import ACCUMULATED, CALM, COMPLETE, OUTSIDE_RH, PARTIAL, UNAVAILABLE, Metric

HOURS = 24


def clean(native: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Keys and fields only, as doubles, nulls for what is not finite."""
    return native.select("point_id", "valid_time", *[W.finite(F.col(f)).alias(f) for f in fields])


def end_of_hour(native: DataFrame, fields: Sequence[str], counted: bool = False) -> DataFrame:
    """Accumulated fields moved to the start of their hour.

    The value stamped exactly one hour later counts; a gap gives null, never the next
    value that happens to follow.  Each row is given out twice, for its own hour and for
    the one that it ends, so the source is scanned once.  Keys are unique (see
    ``day_faults``); ``counted`` adds ``rows``, how often a key is there, and ``ended``,
    how often the stamp an hour later is."""
    moved = [f for f in fields if f in ACCUMULATED]
    kept = [f for f in fields if f not in ACCUMULATED]
    if not moved and not counted:
        return native
    none = F.lit(None).cast("double")
    here = F.struct(F.col("valid_time"), F.lit(1).alias("here"), *[none.alias(f) if f in moved else F.col(f) for f in fields])
    ended = (F.col("valid_time") - F.expr("interval 1 hour")).alias("valid_time")
    later = F.struct(ended, F.lit(0).alias("here"), *[none.alias(f) if f in kept else F.col(f) for f in fields])
    both = native.select("point_id", F.inline(F.array(here, later)))
    # one value of each kind a key, so any aggregate picks it; no point's history is sorted
    met = both.groupBy("point_id", "valid_time").agg(
        F.sum("here").alias("rows"), F.sum(1 - F.col("here")).alias("ended"), *[F.max(f).alias(f) for f in fields]
    ).where("rows > 0")
    return met if counted else met.drop("rows", "ended")


#: A day whose 24 hours are there, as a bitmap with bit h for the hour that starts at h.
FULL = (1 << HOURS) - 1
LAST = 1 << (HOURS - 1)


def hour_masks(frame: DataFrame, columns: Sequence[str], key: str = "point_id", stamp: str = "valid_time") -> DataFrame:
    """Per key and day a bitmap of the hours with a value, for each column, and ``hours``
    of those with a row.  Of a frame with counts (``end_of_hour``) also ``ended``, the hours
    whose end has a stamp, ``off``, the rows that are not on the hour, and ``copies``, how
    often a key is there at most.  One combined aggregation."""
    t = F.col(stamp)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.hour(t))
    masks = [F.coalesce(F.bit_or(F.when(F.col(c).isNotNull(), bit)), F.lit(0)).alias(c) for c in columns]
    more = []
    if "ended" in frame.columns:
        more = [F.coalesce(F.bit_or(F.when(F.col("ended") > 0, bit)), F.lit(0)).alias("ended"), F.max("rows").alias("copies"),
                F.count_if((F.minute(t) != 0) | (F.second(t) != 0)).alias("off")]
    return frame.groupBy(key, F.to_date(t).alias("DATE")).agg(F.bit_or(bit).alias("hours"), *more, *masks)


def day_faults(masks: DataFrame, days: DataFrame, end: str, moved: bool, may_lack: bool = False) -> DataFrame:
    """``point_id, DATE, fault`` of the native days that a product cannot be made from, for
    every (point, day) of ``days``: repeated keys, rows off the hour, hours without a row,
    and hours whose end has no stamp, where a field is ``moved`` to the start of its hour.

    With ``may_lack`` the last day may lack the stamp that ends it, and nothing else."""
    got = lambda c: F.coalesce(F.col(c), F.lit(0))
    whole = got("ended") == FULL
    if may_lack:
        whole = whole | ((F.col("DATE") == F.lit(end).cast("date")) & (got("ended") == FULL - LAST))
    faults = [F.when(got("copies") > 1, "has repeated rows"), F.when(got("off") > 0, "has rows off the hour"), F.when(got("hours") != FULL, "lacks hours")]
    if moved:
        faults.append(F.when((got("hours") == FULL) & ~whole, "lacks the stamps that end its hours"))
    both = days.join(masks, ["point_id", "DATE"], "left")
    return both.select("point_id", "DATE", F.explode(F.array_compact(F.array(*faults))).alias("fault"))


def partial_days(masks: DataFrame, columns: Sequence[str], weight: str | None = None) -> DataFrame:
    """``DATE, field, affected, minimum_valid_hours, maximum_valid_hours`` of the days on
    which a key lacks an hour of a field; null masks count as no hours.  ``affected``
    counts keys, or adds up the column ``weight``, such as the cells of a point."""
    n = {c: F.bit_count(F.coalesce(F.col(c), F.lit(0))) for c in columns}
    each = F.lit(1).cast("long") if weight is None else F.col(weight)
    per = masks.groupBy("DATE").agg(*[
        F.struct(F.lit(c).alias("field"), F.coalesce(F.sum(F.when(x < HOURS, each)), F.lit(0)).alias("affected"), F.min(x).alias("minimum_valid_hours"),
                 F.max(x).alias("maximum_valid_hours")).alias(c)
        for c, x in n.items()
    ])
    return per.select("DATE", F.explode(F.array(*[F.col(c) for c in columns])).alias("r")).select("DATE", "r.*").where("affected > 0")


def hourly_values(frame: DataFrame, metrics: Sequence[Metric]) -> DataFrame:
    """Metric columns of each row, joined by ``<column>__status``."""
    t, td = F.col("t2m") - 273.15 if "t2m" in frame.columns else None, None
    if "d2m" in frame.columns:
        td = F.col("d2m") - 273.15
    columns: dict[str, Column] = {}
    for m in metrics:
        outside: Column = F.lit(False)
        calm: Column = F.lit(False)
        match m.column:
            case "TEMPERATURE_2M_C":
                value = t
            case "DEWPOINT_2M_C":
                value = td
            case "RELATIVE_HUMIDITY_2M_PCT":
                outside = W.humidity_outside(t, td)
                value = F.when(~outside, W.relative_humidity(t, td))
            case "WIND_SPEED_10M_MS":
                value = W.speed(F.col("u10"), F.col("v10"))
            case "WIND_DIRECTION_10M_DEG_FROM":
                calm = F.coalesce(W.is_calm(F.col("u10"), F.col("v10")), F.lit(False))
                value = W.direction_from(F.col("u10"), F.col("v10"))
            case "TOTAL_CLOUD_COVER_PCT":
                value = F.col("tcc") * 100
            case "MEAN_SEA_LEVEL_PRESSURE_HPA":
                value = F.col("msl") / 100
            case "PRECIPITATION_MM":
                value = F.col("tp") * 1000
            case _:
                value = F.col(m.inputs[0])
        columns[m.column] = value
        columns[f"{m.column}__status"] = (
            F.when(calm, CALM).when(outside, OUTSIDE_RH).when(value.isNotNull(), COMPLETE).otherwise(UNAVAILABLE)
        )
    return frame.select("point_id", "valid_time", *[v.alias(k) for k, v in columns.items()])


def ordered_sum(value: Column, order: Column) -> Column:
    """Sum as a left fold in the given order: the same bits on every run, unlike
    ``sum``, whose order follows the partitions.  Gathers one group's values (24)."""
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))))
    return F.aggregate(pairs, F.lit(0.0), lambda total, x: total + x["v"])


def complete(count: Column, value: Column, expected: int = HOURS) -> Column:
    return F.when(count == expected, value)


def daily_values(frame: DataFrame, metrics: Sequence[Metric], strict: bool = False, expected: int = HOURS) -> DataFrame:
    """Per point and day the aggregates of the metrics and their statuses.

    A value needs all ``expected`` hours.  Precedence of the status: calm mean, any
    hour outside the humidity domain, then COMPLETE, PARTIAL or UNAVAILABLE."""
    hourly = hourly_values(frame, metrics)
    names = {m.column for m in metrics}
    if "WIND_DIRECTION_10M_DEG_FROM" in names:  # its mean is that of the vectors
        hourly = hourly.join(frame.select("point_id", "valid_time", "u10", "v10"), ["point_id", "valid_time"]) if not {
            "U_WIND_10M_MS", "V_WIND_10M_MS"
        } <= names else hourly.withColumns({"u10": F.col("U_WIND_10M_MS"), "v10": F.col("V_WIND_10M_MS")})
    total = (lambda c: ordered_sum(c, F.col("valid_time"))) if strict else F.sum
    aggregates: dict[str, Column] = {}
    for m in metrics:
        c = F.col(m.column)
        aggregates[f"n_{m.column}"] = F.count(c)
        if m.column == "RELATIVE_HUMIDITY_2M_PCT":
            aggregates["outside"] = F.count_if(F.col(f"{m.column}__status") == OUTSIDE_RH)
        for a in m.daily:
            if a == "mean_vector":
                aggregates |= {"n_uv": F.count_if(F.col("u10").isNotNull() & F.col("v10").isNotNull())}
                both = lambda x: F.when(F.col("u10").isNotNull() & F.col("v10").isNotNull(), F.col(x))
                aggregates |= {"mean_u": total(both("u10")) / expected, "mean_v": total(both("v10")) / expected}
            else:
                aggregates[f"{a}_{m.column}"] = {"mean": lambda x: total(x) / expected, "sum": total, "min": F.min, "max": F.max}[a](c)
    grouped = hourly.groupBy("point_id", F.to_date("valid_time").alias("DATE")).agg(*[v.alias(k) for k, v in aggregates.items()])
    out: dict[str, Column] = {}
    for m in metrics:
        for column, a in m.daily_columns():
            n = F.col("n_uv") if a == "mean_vector" else F.col(f"n_{m.column}")
            status = F.when(n == expected, COMPLETE).when(n > 0, PARTIAL).otherwise(UNAVAILABLE)
            if a == "mean_vector":
                u, v = F.col("mean_u"), F.col("mean_v")
                out[column] = complete(n, W.direction_from(u, v), expected)
                status = F.when((n == expected) & W.is_calm(u, v), CALM).otherwise(status)
            else:
                out[column] = complete(n, F.col(f"{a}_{m.column}"), expected)
            if m.column == "RELATIVE_HUMIDITY_2M_PCT":
                status = F.when(F.col("outside") > 0, OUTSIDE_RH).otherwise(status)
            out[f"{column}__status"] = status
    return grouped.select("point_id", "DATE", *[v.alias(k) for k, v in out.items()])


def status_histogram(frame: DataFrame) -> DataFrame:
    """``metric, status, n`` over the ``__status`` columns of a frame."""
    columns = [c for c in frame.columns if c.endswith("__status")]
    long = frame.select(*columns).unpivot([], columns, "metric", "status")
    return long.groupBy(F.regexp_replace("metric", "__status$", "").alias("metric"), "status").agg(F.count("*").alias("n"))


def values_only(frame: DataFrame) -> DataFrame:
    return frame.select(*[c for c in frame.columns if not c.endswith("__status")])


def rounded(frame: DataFrame, digits: int) -> DataFrame:
    """Doubles rounded, without a negative zero."""
    return frame.select(*[(F.round(f.name, digits) + 0.0).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in frame.schema.fields])
