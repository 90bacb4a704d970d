"""Solar-radiation energy and irradiance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .reduce import HOURS, clean, end_of_hour, ordered_sum

# Field -> name of the metric.
FIELDS = {"ssrd": "DOWNWARD_SHORTWAVE", "fdir": "DIRECT_SOLAR"}


def hourly(native: DataFrame) -> DataFrame:
    """Energy of the hour that starts at ``valid_time`` and its mean irradiance.
    Signs and zeros stay as they are; the two fields are independent."""
    return energies(end_of_hour(clean(native, list(FIELDS)), list(FIELDS)))


def energies(moved: DataFrame) -> DataFrame:
    """``hourly`` of fields that stand at the start of their hour already."""
    return moved.select(
        "point_id",
        "valid_time",
        *[F.col(f).alias(f"{m}_ENERGY_J_M2") for f, m in FIELDS.items()],
        *[(F.col(f) / 3600).alias(f"{m}_IRRADIANCE_W_M2") for f, m in FIELDS.items()],
    )


def daily(hours: DataFrame, strict: bool = False) -> DataFrame:
    """Energy of days with all 24 hours, and the mean irradiance (energy / 86400)."""
    out = hours.groupBy("point_id", F.to_date("valid_time").alias("DATE")).agg(
        *[
            F.when(
                F.count(e) == HOURS, ordered_sum(F.col(e), F.col("valid_time")) if strict else F.sum(e)
            ).alias(e)
            for e in (f"{m}_ENERGY_J_M2" for m in FIELDS.values())
        ]
    )
    return out.withColumns({f"{m}_IRRADIANCE_W_M2_MEAN": F.col(f"{m}_ENERGY_J_M2") / 86400 for m in FIELDS.values()})


def quality(hours: DataFrame) -> DataFrame:
    """Per field: days that are partial, least hours, negative energies; and hours in
    which the direct part exceeds the whole by more than 1e-6."""
    whole, direct = (f"{m}_ENERGY_J_M2" for m in FIELDS.values())
    per_day = hours.groupBy("point_id", F.to_date("valid_time").alias("DATE")).agg(
        *[F.count(e).alias(f"n_{e}") for e in (whole, direct)],
        *[F.count_if(F.col(e) < 0).alias(f"neg_{e}") for e in (whole, direct)],
        F.count_if(F.col(direct) > F.col(whole) + 1e-6).alias("above"),
    )
    rows = [
        F.struct(
            F.lit(e).alias("metric"), F.col(f"n_{e}").alias("hours"), F.col(f"neg_{e}").alias("negative"), F.col("above")
        )
        for e in (whole, direct)
    ]
    return (
        per_day.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
        .groupBy("metric")
        .agg(
            F.count_if(F.col("hours") < HOURS).alias("partial_days"),
            F.min("hours").alias("minimum_valid_hours"),
            F.sum("negative").alias("negative_hours"),
            F.sum("above").alias("direct_above_downward"),
        )
    )


def reduction_errors(hours: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the daily table that differ from what the hourly one gives."""
    again = daily(hours)
    names = [c for c in again.columns if c not in ("point_id", "DATE")]
    both = again.select("point_id", "DATE", *[F.col(c).alias(f"again_{c}") for c in names]).join(days, ["point_id", "DATE"], "full")
    off = F.lit(False)
    for c in names:
        a, b = F.col(c), F.col(f"again_{c}")
        off = off | (a.isNull() != b.isNull()) | F.coalesce(F.abs(a - b) > 1e-8 + 1e-12 * F.abs(b), F.lit(False))
    return both.where(off).select("point_id", "DATE")
