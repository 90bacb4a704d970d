"""Lineage: the epochs of a metric must partition its dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def by_metric(epochs: DataFrame) -> DataFrame:
    """``frequency, metric, start_date, end_date`` from epochs with
    ``metrics struct<hourly: array<string>, daily: array<string>>``."""
    both = F.array(
        *[F.struct(F.lit(f).alias("frequency"), F.col(f"metrics.{f}").alias("names")) for f in ("hourly", "daily")]
    )
    return epochs.select("start_date", "end_date", F.explode(both).alias("m")).select(
        F.col("m.frequency").alias("frequency"), F.explode("m.names").alias("metric"), "start_date", "end_date"
    )


def breaks(spans: DataFrame, first, last) -> DataFrame:
    """Faults in ``spans(frequency, metric, start_date, end_date)`` against the range
    ``[first, last]``: one row per fault with its kind.  A metric has few epochs."""
    order = Window.partitionBy("frequency", "metric").orderBy("start_date", "end_date")
    seen = spans.withColumns(
        {"before": F.lag("end_date").over(order), "after": F.lead("start_date").over(order)}
    )
    kinds = F.array_compact(
        F.array(
            F.when(F.col("start_date") > F.col("end_date"), "reversed"),
            F.when(F.col("before").isNull() & (F.col("start_date") > F.lit(first)), "gap"),
            F.when(F.col("after").isNull() & (F.col("end_date") < F.lit(last)), "gap"),
            F.when(F.col("start_date") > F.date_add("before", 1), "gap"),
            F.when(F.col("start_date") <= F.col("before"), "overlap"),
            F.when((F.col("start_date") < F.lit(first)) | (F.col("end_date") > F.lit(last)), "outside"),
        )
    )
    return seen.select("frequency", "metric", "start_date", "end_date", F.explode(kinds).alias("fault"))
