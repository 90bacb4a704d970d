"""Checks of a product, each a DataFrame of what is wrong or of counts."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.solar import phase
from ..functions.weather import finite
from ..specs import ACCUMULATED


def repeated_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def off_lattice(frame: DataFrame, expected: DataFrame) -> DataFrame:
    """Keys that are missing from the frame or that it should not have."""
    keys = expected.columns
    there = frame.select(*keys, F.lit(True).alias("__have"))
    both = expected.withColumn("__want", F.lit(True)).join(there, keys, "full")
    return both.where("__want is null or __have is null").select(
        *keys, F.when(F.col("__have").isNull(), "missing").otherwise("unexpected").alias("fault")
    )


def column_counts(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column ``rows, nulls, nonfinite``, in one pass and one row per column."""
    floating = {f.name for f in frame.schema.fields if f.dataType.typeName() in ("float", "double")}  # others are finite
    bad = lambda c: F.isnan(F.col(c)) | (F.abs(F.col(c)) == float("inf")) if c in floating else F.lit(False)
    one = frame.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns],
        *[F.count_if(bad(c)).alias(f"bad_{c}") for c in columns],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"null_{c}").alias("nulls"), F.col(f"bad_{c}").alias("nonfinite"))
        for c in columns
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def accounting_errors(histogram: DataFrame, counts: DataFrame) -> DataFrame:
    """Metrics whose statuses do not add up to the rows, or COMPLETE to the values."""
    per = histogram.groupBy("metric").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("status") == "COMPLETE", F.col("n")).otherwise(0)).alias("complete")
    )
    joined = per.join(counts, F.col("metric") == F.col("column"))
    return joined.where("total != rows or complete != rows - nulls").select("metric", "total", "complete", "rows", "nulls")


def solar_errors(hourly: DataFrame) -> DataFrame:
    """Rows whose angles leave their range or whose phase is not that of the elevation."""
    el, az = F.col("SOLAR_ELEVATION_DEG"), F.col("SOLAR_AZIMUTH_DEG")
    wrong = ~el.between(-90, 90) | ((az < 0) | (az >= 360)) | (F.col("SOLAR_PHASE") != phase(el))
    return hourly.where(F.coalesce(wrong, el.isNull()))


def cycle_errors(daily: DataFrame, durations: Sequence[str], events: Sequence[str]) -> DataFrame:
    """Days whose durations are negative or do not make 24 hours, or whose events lie
    on another day."""
    total = sum((F.col(d) for d in durations[1:]), F.col(durations[0]))
    wrong = F.abs(total - 24) > 1e-9
    for d in durations:
        wrong = wrong | (F.col(d) < -1e-10)
    for e in events:
        wrong = wrong | F.coalesce((F.col(e) < F.col("DATE").cast("timestamp_ntz")) | (F.col(e) > F.date_add("DATE", 1).cast("timestamp_ntz")), F.lit(False))
    return daily.where(wrong)


def boundary_days(epochs: Iterable[tuple[str, str]]) -> list[date]:
    """The first and last day of each epoch, and the leap days in them."""
    out = set()
    for start, end in epochs:
        a, b = date.fromisoformat(start), date.fromisoformat(end)
        leap = [date(y, 2, 29) for y in range(a.year, b.year + 1) if y % 4 == 0 and (y % 100 or y % 400 == 0)]
        out |= {a, b, *[d for d in leap if a <= d <= b]}
    return sorted(out)


def native_differences(native: DataFrame, crosswalk: DataFrame, hourly: DataFrame, columns: dict[str, str], days: Sequence[date]) -> DataFrame:
    """``H3_INDEX, DATETIME, metric`` of published values on ``days`` that are not, bit by bit,
    the native sample of the cell's point; ``columns`` gives each one's field.

    An accumulated field is looked up at the end of the hour, apart from how products
    are made.  Published rows meet the crosswalk, whose cells are few, and then the
    native rows at their points: the native sample is not laid over the cells first."""
    wanted = F.to_date("DATETIME").isin(list(days))
    point = crosswalk.select(F.col("h3_index").alias("H3_INDEX"), "point_id").where("point_id is not null")
    published = hourly.where(wanted).join(point.hint("shuffle_hash"), "H3_INDEX", "left")
    out = None
    for ended in (True, False):
        own = {c: f for c, f in columns.items() if (f in ACCUMULATED) == ended}
        if not own:
            continue
        stamp = F.col("valid_time") - F.expr("interval 1 hour") if ended else F.col("valid_time")
        rows = native.select("point_id", stamp.alias("DATETIME"), *[finite(F.col(f)).alias(f"native_{c}") for c, f in own.items()]).where(wanted)
        both = published.join(rows, ["point_id", "DATETIME"], "left")
        off = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"native_{c}")), c) for c in own]))
        found = both.select("H3_INDEX", "DATETIME", F.explode(off).alias("metric"))
        out = found if out is None else out.union(found)
    return out


def ids_sha256(frame: DataFrame, column: str) -> DataFrame:
    """Hash of the sorted ids, each followed by a line feed.  For registries, whose
    size is bounded by the study (some thousand ids)."""
    ids = F.array_sort(F.collect_set(column))
    text = F.concat(F.array_join(ids, "\n"), F.lit("\n"))
    return frame.agg(F.count_distinct(column).alias("ids"), F.sha2(text, 256).alias("sha256"))


def summary(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, min, max, mean`` in one pass."""
    one = frame.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])
    rows = [F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{c}").alias(n) for n in ("min", "max", "mean")]) for c in columns]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
