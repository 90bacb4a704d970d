"""Cells, the native grid and the crosswalk between them."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.weather import EARTH_RADIUS_M, haversine_m

STEP = 0.25


def within(frame: DataFrame, west: float, south: float, east: float, north: float, halo: float = 0.0) -> DataFrame:
    """Rows whose point lies in the closed box, widened by ``halo`` degrees."""
    return frame.where(
        F.col("lat").between(south - halo, north + halo) & F.col("lon").between(west - halo, east + halo)
    )


#: Native points that one region may take; a product of more is to be parted.
POINTS = 4096


def native_window(grid: DataFrame, west: float, south: float, east: float, north: float, halo: float = STEP) -> DataFrame:
    """The native points of a closed box with its halo, if there are 1 to 4,096."""
    points = within(grid, west, south, east, north, halo)
    n = points.limit(POINTS + 1).count()
    if not 1 <= n <= POINTS:
        raise ValueError("no native point lies in the box" if not n else f"the box holds more than {POINTS} native points")
    return points


def check_box(box: tuple[float, float, float, float], approved: tuple[float, float, float, float] | None = None) -> None:
    """Raises for a box (west, south, east, north) without extent or outside the approved one."""
    west, south, east, north = box
    if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
        raise ValueError(f"{box} is no box of west, south, east and north")
    if approved is not None and not (approved[0] <= west and approved[1] <= south and east <= approved[2] and north <= approved[3]):
        raise ValueError(f"{box} is not inside the approved box {approved}")


def nearest_point(cells: DataFrame, grid: DataFrame, step: float = STEP, allowance_m: float | None = None) -> DataFrame:
    """``h3_index, point_id, distance_m``: each cell's nearest native point.

    On a regular grid only the four corners around a cell can be nearest, so cells
    are joined by equality on corner indices; no cross join.  Equal distances go to the
    smaller point_id.  A cell without a point around it fails the task that meets it,
    and with ``allowance_m`` so does one whose point lies farther away."""
    corners = F.array(
        *[
            F.struct((F.floor(F.col("lat") / step) + i).alias("gy"), (F.floor(F.col("lon") / step) + j).alias("gx"))
            for i in (0, 1)
            for j in (0, 1)
        ]
    )
    wanted = cells.select("h3_index", "lat", "lon", F.explode(corners).alias("c")).select(
        "h3_index", "lat", "lon", "c.gy", "c.gx"
    )
    points = grid.select(
        "point_id",
        F.col("lat").alias("plat"),
        F.col("lon").alias("plon"),
        F.round(F.col("lat") / step).cast("long").alias("gy"),
        F.round(F.col("lon") / step).cast("long").alias("gx"),
    )
    near = wanted.join(points, ["gy", "gx"], "left").withColumn(
        "distance_m", haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    )
    found = F.when(F.col("point_id").isNotNull(), F.struct("distance_m", "point_id"))
    best = near.groupBy("h3_index").agg(F.min(found).alias("b"))
    fits = F.col("b").isNotNull()
    if allowance_m is not None:
        fits = fits & (F.col("b.distance_m") <= allowance_m)
    checked = F.when(fits, F.col("b")).otherwise(
        F.raise_error(F.concat(F.lit("no native point near "), "h3_index")).cast(best.schema["b"].dataType)
    )
    return best.select("h3_index", checked.alias("b")).select("h3_index", "b.point_id", "b.distance_m")


def nearest_anywhere(cells: DataFrame, grid: DataFrame, step: float = STEP, allowance_m: float | None = None) -> DataFrame:
    """``nearest_point`` for grids with holes, and across the date line: for every cell the
    nearest of all points, or of those within ``allowance_m``.

    The globe is parted into blocks, at first of one step; a cell meets the points of its
    own block and the eight around it by equality on block numbers, longitudes counted
    around the globe.  It is done when its best point is nearer than anything outside
    those blocks can be; for the others blocks of twice the size are taken, so few cells
    take more than one round.  Equal distances go to the smaller point_id; cells without a
    place, or without a point in reach, give null."""
    known = cells.select("h3_index", "lat", "lon")
    turned = lambda lon: F.pmod(F.col(lon), F.lit(360.0))
    points = grid.where("lat is not null and lon is not null").select("point_id", F.col("lat").alias("plat"), F.col("lon").alias("plon"))
    left, done, size = known, None, 1
    while True:
        tall, around = max(1, math.floor(180 / step / size + 1e-9)), max(1, math.floor(360 / step / size + 1e-9))
        high, wide = 180 / tall, 360 / around
        block = lambda lat, lon: (F.least(F.floor((F.col(lat) + 90) / high), F.lit(tall - 1)), F.floor(turned(lon) / wide) % around)  # noqa: B023, E731
        (by, bx), (py, px) = block("lat", "lon"), block("plat", "plon")
        ys = F.array(*[by + i for i in (-1, 0, 1)])
        xs = F.array_distinct(F.array(*[F.pmod(bx + j, F.lit(around)) for j in (-1, 0, 1)]))
        rows = left.select("*", F.explode(ys).alias("by"), xs.alias("xs")).select("h3_index", "lat", "lon", "by", F.explode("xs").alias("bx"))
        near = rows.join(points.select("*", py.alias("by"), px.alias("bx")), ["by", "bx"])
        near = near.withColumn("m", haversine_m(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon")))
        if allowance_m is not None:
            near = near.where(F.col("m") <= allowance_m)
        best = near.groupBy("h3_index").agg(F.min(F.struct("m", "point_id")).alias("b"))
        # the nearest place outside the nine blocks: a parallel, or the great circle of a meridian
        inf = F.lit(float("inf"))
        south = F.when(by > 1, F.col("lat") + 90 - (by - 1) * high).otherwise(inf)
        north = F.when(by < tall - 2, (by + 2) * high - F.col("lat") - 90).otherwise(inf)
        beside = F.least(turned("lon") - (bx - 1) * wide, (bx + 2) * wide - turned("lon"), F.lit(90.0))
        aside = F.asin(F.cos(F.radians("lat")) * F.sin(F.radians(beside))) if around > 3 else inf
        outside = EARTH_RADIUS_M * (F.least(F.radians(south), F.radians(north), aside) - 1e-9)
        sure = F.col("b.m") < outside
        if allowance_m is not None:
            sure = F.coalesce(sure, F.lit(False)) | (outside > allowance_m)
        found = left.join(best, "h3_index", "left").withColumn("sure", F.coalesce(sure, F.lit(False)))
        whole = tall <= 2 and around <= 3
        found = found if whole else found.persist()
        part = (found if whole else found.where("sure")).select("h3_index", "b.point_id", F.col("b.m").alias("distance_m"))
        done = part if done is None else done.union(part)
        left = found.where("not sure").select("h3_index", "lat", "lon")
        if whole or left.isEmpty():
            return done
        size *= 2


def in_polygons(places: DataFrame, edges: DataFrame, key: str = "h3_index", band: float = STEP) -> DataFrame:
    """``key, polygon_id`` of the places (``key, lat, lon``) inside each polygon of
    ``edges(polygon_id, lat0, lon0, lat1, lon1)``, by the even-odd rule: holes are rings of
    their own, and of two polygons with a common edge a place on it is in exactly one.

    Only edges that cross the place's band of latitude are met, by equality on the band;
    of those the ones are counted that a ray to the east crosses.  A latitude is counted
    to the edge that begins at it, so corners are neither lost nor counted twice."""
    low, high = F.least("lat0", "lat1"), F.greatest("lat0", "lat1")
    strips = F.sequence(F.floor(low / band), F.floor(high / band))
    crossed = edges.where("lat0 != lat1").select("*", F.explode(strips).alias("strip"))
    here = places.select(key, "lat", "lon", F.floor(F.col("lat") / band).alias("strip"))
    at = F.col("lon0") + (F.col("lat") - F.col("lat0")) * (F.col("lon1") - F.col("lon0")) / (F.col("lat1") - F.col("lat0"))
    meet = here.join(crossed, "strip").where((low <= F.col("lat")) & (F.col("lat") < high) & (at > F.col("lon")))
    return meet.groupBy(key, "polygon_id").agg(F.count("*").alias("n")).where("n % 2 = 1").select(key, "polygon_id")


#: Cells that are given one copy of their point's values.
CELLS_A_COPY = 2_000


def sample(values: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Values at points given to the cells that lie nearest (many to one).

    The result is many times what is joined, so its rows are dealt out before the join:
    the cells of a point are parted, and each part meets a copy of the point's values in
    a task of its own.  A point of up to ``CELLS_A_COPY`` cells is copied once, so copies
    are at most the values and one row in ``CELLS_A_COPY`` of the result."""
    tasks = 4 * values.sparkSession.sparkContext.defaultParallelism
    copies = crosswalk.groupBy("point_id").agg(F.ceil(F.count("*") / CELLS_A_COPY).cast("int").alias("__copies"))
    part = F.pmod(F.xxhash64("h3_index"), F.col("__copies")).cast("int").alias("__copy")
    cells = crosswalk.select("h3_index", "point_id").join(copies, "point_id").select("h3_index", "point_id", part)
    each = F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("__copy")
    copied = values.join(copies, "point_id").select(*values.columns, each)
    keys = ["point_id", "__copy"]
    met = cells.repartition(tasks, *keys).join(copied.repartition(tasks, *keys), keys)
    return met.drop(*keys).withColumnRenamed("h3_index", "H3_INDEX")


def lattice(cells: DataFrame, start: str, end: str, hourly: bool, key: str = "h3_index", name: str = "H3_INDEX", carry: tuple[str, ...] = ()) -> DataFrame:
    """Every cell at every hour or day from ``start`` to ``end`` (dates, inclusive).

    Cells are few and often one file: (cell, month) keys are dealt out first, so that
    the days and hours of many years are made in as many tasks as there are cores."""
    months = F.expr(f"sequence(trunc(date'{start}', 'MM'), date'{end}', interval 1 month)")
    tasks = cells.sparkSession.sparkContext.defaultParallelism
    dealt = cells.select(F.col(key).alias(name), *carry, F.explode(months).alias("month")).repartition(tasks, name, "month")
    first, last = F.greatest("month", F.lit(start).cast("date")), F.least(F.last_day("month"), F.lit(end).cast("date"))
    days = dealt.select(name, *carry, F.explode(F.sequence(first, last)).alias("DATE"))
    if not hourly:
        return days
    hours = F.expr("sequence(cast(DATE as timestamp_ntz), cast(DATE as timestamp_ntz) + interval 23 hours, interval 1 hour)")
    return days.select(name, *carry, F.explode(hours).alias("DATETIME"))


def densify(frame: DataFrame, keys: DataFrame) -> DataFrame:
    """A row for every key, null where the frame has none."""
    return keys.join(frame, keys.columns, "left")


def members_only(frame: DataFrame, members: DataFrame, key: str = "H3_INDEX") -> DataFrame:
    return frame.join(members.select(F.col("h3_index").alias(key)), key, "left_semi")


def not_on_lattice(members: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Members without a native point; a product needs this empty."""
    return members.join(crosswalk, "h3_index", "left_anti")
