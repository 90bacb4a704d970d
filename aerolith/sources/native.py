"""Native fields as Parquet: contract, frontier; and product tables by DATE."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..specs import ACCUMULATED, UNITS


def utc(frame: DataFrame, column: str = "valid_time") -> DataFrame:
    """The stamp as a zone-free UTC time, whatever the session's time zone is."""
    if frame.schema[column].dataType.typeName() == "timestamp_ntz":
        return frame
    there = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(column).cast("timestamp_ntz"))
    return frame.withColumn(column, there)


def read_native(spark: SparkSession, path: str, fields: Sequence[str], start: str, end: str) -> DataFrame:
    """Rows of the days ``start`` to ``end`` and, where a field is accumulated, the
    midnight after them, stamped in UTC.  Time and columns are pruned at the scan."""
    frame = spark.read.parquet(path)
    check_contract(frame, fields)
    kind = frame.schema["valid_time"].dataType.simpleString()
    zone = "" if kind == "timestamp_ntz" else " UTC"
    lower = F.lit(f"{start} 00:00:00{zone}").cast(kind)
    upper = F.lit(f"{date.fromisoformat(end) + timedelta(days=1)} 00:00:00{zone}").cast(kind)
    t = F.col("valid_time")
    late = t <= upper if any(f in ACCUMULATED for f in fields) else t < upper
    return utc(frame.where((t >= lower) & late).select("valid_time", "point_id", *fields))


def repeated_rows(frame: DataFrame) -> DataFrame:
    """``point_id, valid_time, n`` of native keys that occur more than once."""
    return frame.groupBy("point_id", "valid_time").agg(F.count("*").alias("n")).where("n > 1")


def check_keys(frame: DataFrame) -> DataFrame:
    """The frame, if no key is repeated and no day's stamps leave the hourly axis."""
    bad = repeated_rows(frame).first()
    if bad:
        raise ValueError(f"point {bad['point_id']} has {bad['n']} rows at {bad['valid_time']}")
    off = off_hours(frame).first()
    if off:
        raise ValueError(f"the stamp {off['t']} does not follow the one before by an hour")
    return frame


def coverage(frame: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``field, last_stamp, last_complete_day``, a row for each field.

    The last hour of a day ends at the midnight after it, where an accumulated field
    is stamped; other fields are stamped when the hour begins."""
    one = frame.agg(*[F.max(F.when(F.col(f).isNotNull() & ~F.isnan(f), F.col("valid_time"))).alias(f) for f in fields])
    rows = []
    for f in fields:
        begun = F.col(f) if f in ACCUMULATED else F.col(f) + F.expr("interval 1 hour")
        rows.append(F.struct(F.lit(f).alias("field"), F.col(f).alias("last_stamp"), F.date_sub(begun.cast("date"), 1).alias("last_complete_day")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def frontier_gate(frame: DataFrame, fields: Sequence[str], end: str, allow_incomplete_final_day: bool = False) -> dict:
    """What a catalog says of the final day; raises where the source ends before ``end``.

    With ``allow_incomplete_final_day`` the last day may lack its one terminal hour in
    some fields, whose daily values are then null."""
    rows = {r["field"]: r for r in coverage(frame, fields).collect()}
    last = date.fromisoformat(end)
    short = {f: r for f, r in rows.items() if r["last_complete_day"] is None or r["last_complete_day"] < last}
    if short and not allow_incomplete_final_day:
        raise ValueError(f"the source ends before {end} is complete: {sorted(short)}")
    for f, r in short.items():
        one_hour = datetime.combine(last, time(23)) - timedelta(hours=0 if f in ACCUMULATED else 1)
        if r["last_stamp"] is None or r["last_stamp"] != one_hour:
            raise ValueError(f"{f} lacks more than the terminal hour of {end}")
    return {
        "partial_fields": sorted(short),
        "latest_complete_day": str(last - timedelta(days=1) if short else last),
    }


def check_contract(frame: DataFrame, fields: Sequence[str]) -> None:
    """Raises where a field is absent, not floating or declared in another unit."""
    for name in ("valid_time", "point_id", *fields):
        if name not in frame.columns:
            raise ValueError(f"the native table has no {name}")
    for f in fields:
        field = frame.schema[f]
        if field.dataType.typeName() not in ("float", "double"):
            raise ValueError(f"{f} is not a floating field")
        if field.metadata.get("units", UNITS[f]) != UNITS[f]:
            raise ValueError(f"{f} is in {field.metadata['units']}, not in {UNITS[f]}")


def off_hours(frame: DataFrame) -> DataFrame:
    """Stamps that are not on the hour, or not one hour after the stamp before."""
    stamps = frame.select(F.col("valid_time").cast("timestamp_ntz").alias("t")).distinct()
    stamps = stamps.withColumn("day", F.to_date("t"))
    order = Window.partitionBy("day").orderBy("t")  # 24 stamps a day, so no long window
    step = F.timestamp_diff("MINUTE", F.lag("t").over(order), F.col("t"))
    return stamps.withColumn("step", step).where("step != 60 or minute(t) != 0 or second(t) != 0").select("t", "step")


def frontier(frame: DataFrame) -> DataFrame:
    """Last stamp with a value, for each field."""
    fields = [c for c in frame.columns if c in UNITS]
    return frame.agg(*[F.max(F.when(F.col(f).isNotNull(), F.col("valid_time"))).alias(f) for f in fields])


#: Cells whose rows of a day make one file.
CELLS_A_FILE = 20_000


def slice_bounds(cells: DataFrame, column: str = "h3_index", size: int = CELLS_A_FILE) -> list[str]:
    """The first ids of all slices of the registry but the first, in order: one id for
    ``size`` cells."""
    order = Window.orderBy(column)  # a registry, not its hours
    ranked = cells.select(column).distinct().withColumn("k", F.row_number().over(order))
    return [r[0] for r in ranked.where((F.col("k") > 1) & (F.col("k") % size == 1 % size)).orderBy("k").collect()]


def write_days(frame: DataFrame, path: str, bounds: Sequence[str] = (), counts: dict[str, Column] | None = None) -> dict:
    """Writes the DATE partitions that the frame has; returns ``counts`` over its rows.

    A day is a file for each slice of the cells, sorted by cell and hour: no day waits for
    one task, and a cell's rows of a day lie in one file, in few row groups by their bounds.
    The counts are observed in the tasks that write, after the shuffle, where a task that
    is run again counts once."""
    keys = [c for c in ("DATE", "H3_INDEX", "DATETIME") if c in frame.columns]
    part = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= F.col("H3_INDEX"))) if bounds else F.lit(0)
    dealt = frame.withColumn("__slice", part).repartition("DATE", "__slice").drop("__slice").sortWithinPartitions(*keys)
    seen = Observation(f"written-{uuid.uuid4().hex}")
    if counts:
        dealt = dealt.observe(seen, *[c.alias(n) for n, c in counts.items()])
    dealt = dealt.select(*[c for c in frame.columns if not c.endswith("__status")])
    dealt.write.mode("append").option("compression", "zstd").partitionBy("DATE").parquet(path)
    return seen.get if counts else {}


def remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def read_days(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("DATE").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def write_catalog(spark: SparkSession, path: str, catalog: dict) -> None:
    """Adds a version; nothing is deleted, so a crash leaves the one before."""
    last = _versions(spark, path)
    text = json.dumps(catalog, sort_keys=True, default=str)
    row = spark.createDataFrame([(text, last[0][0] + 1 if last else 1)], "value string, version int")
    row.coalesce(1).write.mode("append").partitionBy("version").text(path)


def read_catalog(spark: SparkSession, path: str) -> dict | None:
    """The newest version; None where there is none."""
    last = _versions(spark, path)
    return json.loads(last[0][1]) if last else None


def every_catalog(spark: SparkSession, path: str) -> list[dict]:
    """All versions, from the first."""
    return [json.loads(r["value"]) for r in spark.read.text(path, wholetext=True).orderBy("version").collect()]


def _versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    from pyspark.errors import AnalysisException

    try:
        every = spark.read.text(path, wholetext=True)
        newest = every.where(F.col("version") == every.agg(F.max("version")).first()[0]).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return []
        raise
    if len(newest) > 1:
        raise ValueError(f"two runs have written version {newest[0]['version']} of the catalog; one of them is to be removed")
    return [(int(r["version"]), r["value"]) for r in newest]
