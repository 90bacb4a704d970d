"""Running daily support and means from a stream of native rows (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weather import finite


def daily_support(stream: DataFrame, field: str, lateness: str = "2 days") -> DataFrame:
    """Per point and UTC day the hours seen, their mean and whether all 24 are there.
    Works on streams and tables alike; state is dropped ``lateness`` after the day."""
    v = finite(F.col(field))
    return (
        stream.withWatermark("valid_time", lateness)
        .groupBy("point_id", F.window("valid_time", "1 day").alias("w"))
        .agg(F.count(v).alias("hours"), F.avg(v).alias("mean"))
        .select("point_id", F.col("w.start").alias("day"), "hours", F.when(F.col("hours") == 24, F.col("mean")).alias("mean"))
    )
