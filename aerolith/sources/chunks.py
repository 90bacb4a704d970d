"""Native fields that are stored as chunks of an array: time x latitude x longitude.

A row is one chunk: ``t_chunk, y_chunk, x_chunk`` and its ``values`` in row-major order, at
the edges padded to the whole chunk; a table of several fields has a ``field`` as well."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spatial import POINTS


@dataclass(frozen=True)
class Grid:
    """Places of the array's indices: row 0 is the northernmost latitude, column 0 the
    westernmost longitude, ``start`` the first hour."""

    north: float
    west: float
    step: float
    rows: int
    columns: int
    chunk: tuple[int, int, int]
    start: datetime | None = None

    def rows_of(self, south: float, north: float) -> tuple[int, int]:
        """The first and last row whose latitude lies in the closed range (last < first: none)."""
        return max(0, math.ceil((self.north - north) / self.step - 1e-9)), min(self.rows - 1, math.floor((self.north - south) / self.step + 1e-9))

    def columns_of(self, west: float, east: float) -> tuple[int, int]:
        return max(0, math.ceil((west - self.west) / self.step - 1e-9)), min(self.columns - 1, math.floor((east - self.west) / self.step + 1e-9))

    def hours_of(self, start: datetime, end: datetime) -> tuple[int, int]:
        """The first and last hour index from ``start`` to ``end``, both included."""
        return tuple(int((t - self.start) / timedelta(hours=1)) for t in (start, end))


def region(chunks: DataFrame, grid: Grid, box: tuple[float, float, float, float], hours: tuple[datetime, datetime] | None = None, halo: float | None = None) -> DataFrame:
    """``[field,] [valid_time,] point_id, lat, lon, value`` of a closed box (west, south, east,
    north) with a halo of one step around it.

    The chunks that meet it follow from index arithmetic; the others are dropped by
    comparisons of their numbers, which reach the scan, before any value is taken out of an
    array.  A point is named by its place in the grid; the box must take 1 to 4,096."""
    west, south, east, north = box
    halo = grid.step if halo is None else halo
    (y0, y1), (x0, x1) = grid.rows_of(south - halo, north + halo), grid.columns_of(west - halo, east + halo)
    n = max(0, y1 - y0 + 1) * max(0, x1 - x0 + 1)
    if not 1 <= n <= POINTS:
        raise ValueError(f"the box takes {n} native points, not 1 to {POINTS}")
    ct, cy, cx = grid.chunk
    wanted = F.col("y_chunk").between(y0 // cy, y1 // cy) & F.col("x_chunk").between(x0 // cx, x1 // cx)
    if hours is not None:
        t0, t1 = grid.hours_of(*hours)
        wanted = wanted & F.col("t_chunk").between(t0 // ct, t1 // ct)
    carried = [c for c in ("field",) if c in chunks.columns]
    # whole rows of a chunk that the box crosses, then its columns: no value outside is made a row
    each = chunks.where(wanted).select(*carried, "t_chunk", "y_chunk", "x_chunk", F.posexplode("values").alias("p", "value"))
    y = (F.col("y_chunk") * cy + F.floor(F.col("p") / cx) % cy).cast("long")
    x = (F.col("x_chunk") * cx + F.col("p") % cx).cast("long")
    t = F.col("t_chunk") * ct + F.floor(F.col("p") / (cx * cy))
    placed = each.select(*carried, t.cast("long").alias("t"), y.alias("y"), x.alias("x"), F.col("value").cast("double").alias("value"))
    placed = placed.where(F.col("y").between(y0, y1) & F.col("x").between(x0, x1))
    stamp = []
    if hours is not None:
        placed = placed.where(F.col("t").between(t0, t1))
        origin = F.lit(grid.start.isoformat(" ")).cast("timestamp_ntz")
        stamp = [F.timestamp_add("HOUR", F.col("t").cast("int"), origin).alias("valid_time")]
    return placed.select(
        *carried, *stamp, (F.col("y") * grid.columns + F.col("x")).alias("point_id"), (F.lit(grid.north) - F.col("y") * grid.step).alias("lat"),
        (F.lit(grid.west) + F.col("x") * grid.step).alias("lon"), "value",
    )


def native_rows(values: DataFrame, fields: list[str]) -> DataFrame:
    """Native rows, a column for each field, of a region with ``field`` and ``valid_time``."""
    return values.groupBy("point_id", "valid_time").agg(*[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields])


def fingerprint(chunks: DataFrame, *asked: object) -> str:
    """A name for a crop: the files that the table is read from, with their lengths and
    times, and what is asked of them.  It changes with any of them."""
    spark = chunks.sparkSession
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for name in sorted(chunks.inputFiles()):
        path = jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(settings).getFileStatus(path)
        parts.append((name, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr((parts, asked)).encode()).hexdigest()[:32]


def kept_region(spark: SparkSession, path: str, kept: str, grid: Grid, box: tuple[float, float, float, float], hours: tuple[datetime, datetime] | None = None) -> DataFrame:
    """``region`` of the chunks at ``path``, written once under ``kept`` and read from there
    as long as neither the files nor the question change."""
    chunks = spark.read.parquet(path)
    where = f"{kept.rstrip('/')}/{fingerprint(chunks, grid, box, hours)}"
    done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{where}/_SUCCESS")
    if not done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        region(chunks, grid, box, hours).write.mode("overwrite").parquet(where)
    return spark.read.parquet(where)
