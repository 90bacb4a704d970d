"""Nearest points, polygons and chunked arrays against brute force."""

import datetime as dt
import math
import os
import random

import pytest
from pyspark.sql import functions as F

from aerolith.operators import spatial
from aerolith.sources import chunks


def distance(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371008.8 * math.asin(math.sqrt(min(1, h)))


def nearest(spark, cells, points, step):
    frame = spark.createDataFrame([(f"c{k}", *c) for k, c in enumerate(cells)], "h3_index string, lat double, lon double")
    grid = spark.createDataFrame([(k, *p) for k, p in enumerate(points)], "point_id int, lat double, lon double")
    return {r["h3_index"]: (r["point_id"], r["distance_m"]) for r in spatial.nearest_anywhere(frame, grid, step).collect()}


def test_nearest_over_holes_and_the_date_line(spark):
    rng = random.Random(2)
    every = [(60 - y * 0.5, (178 + x * 0.5 + 180) % 360 - 180) for y in range(9) for x in range(9)]
    points = [p for k, p in enumerate(every) if k % 9 in (0, 8) or k < 9]  # a large hole
    cells = [(rng.uniform(55, 61), (rng.uniform(177, 183) + 180) % 360 - 180) for _ in range(60)] + [(58.0, 179.9), (58.0, -179.9), (50.0, 170.0)]
    got = nearest(spark, cells, points, 0.5)
    assert len(got) == len(cells)
    for k, c in enumerate(cells):
        best = min(distance(c, p) for p in points)
        assert got[f"c{k}"][1] == pytest.approx(best, abs=1e-3), c
    frame = spark.createDataFrame([("near", 60.0, 179.0), ("far", -10.0, 20.0)], "h3_index string, lat double, lon double")
    some = spark.createDataFrame([(1, 60.0, -179.0), (2, 59.0, -179.0)], "point_id int, lat double, lon double")
    got = {r["h3_index"]: r["point_id"] for r in spatial.nearest_anywhere(frame, some, 0.5, allowance_m=300_000).collect()}
    assert got == {"near": 1, "far": None}
    assert nearest(spark, [(1.0, 1.0)], [], 45.0) == {"c0": (None, None)}
    assert nearest(spark, [(0.0, 22.5)], [(0.0, 0.0), (0.0, 45.0)], 45.0)["c0"][0] == 0  # a tie


def test_polygons(spark):
    """A square with a hole, a neighbour with a common edge, and places on corners and edges."""
    def ring(i, corners):
        return [(i, *a, *b) for a, b in zip(corners, [*corners[1:], corners[0]], strict=True)]

    edges = ring("one", [(0, 0), (0, 4), (4, 4), (4, 0)]) + ring("one", [(1, 1), (3, 1), (3, 3), (1, 3)]) + ring("two", [(0, 4), (4, 4), (2, 9)])
    edges = [(i, *map(float, e)) for i, *e in edges]
    rng = random.Random(3)
    places = [(rng.uniform(-1, 5), rng.uniform(-1, 10)) for _ in range(300)] + [(2.0, 4.0), (1.0, 1.0), (0.0, 0.0), (4.0, 4.0), (2.0, 2.0), (0.0, 2.0)]
    frame = spark.createDataFrame([(f"p{k}", *p) for k, p in enumerate(places)], "h3_index string, lat double, lon double")
    table = spark.createDataFrame(edges, "polygon_id string, lat0 double, lon0 double, lat1 double, lon1 double")
    got = {(r[0], r[1]) for r in spatial.in_polygons(frame, table).collect()}
    want = set()
    for k, (y, x) in enumerate(places):
        for i in ("one", "two"):
            hits = [e for e in edges if e[0] == i and (e[1] <= y) != (e[3] <= y) and e[2] + (y - e[1]) * (e[4] - e[2]) / (e[3] - e[1]) > x]
            if len(hits) % 2:
                want.add((f"p{k}", i))
    assert got == want and {i for p, i in got if p == "p300"} == {"two"} and not {i for p, i in got if p == "p304"}


GRID = chunks.Grid(north=50.0, west=-10.0, step=0.5, rows=20, columns=24, chunk=(6, 4, 5), start=dt.datetime(2020, 1, 1))


def value(t, y, x, scale=1):
    return float(scale * (t * 10000 + y * 100 + x))


@pytest.fixture
def stored(spark, tmp_path):
    ct, cy, cx = GRID.chunk
    rows = [
        (name, a, b, c, [value(a * ct + t, b * cy + y, c * cx + x, scale) for t in range(ct) for y in range(cy) for x in range(cx)])
        for name, scale in (("t2m", 1), ("tp", -1)) for a in range(4) for b in range(5) for c in range(5)
    ]
    frame = spark.createDataFrame(rows, "field string, t_chunk int, y_chunk int, x_chunk int, `values` array<float>")
    frame.repartition(4).sortWithinPartitions("t_chunk", "y_chunk", "x_chunk").write.parquet(str(tmp_path / "chunks"))
    return str(tmp_path / "chunks")


def test_region_of_chunks(spark, stored, tmp_path):
    box, hours = (-6.2, 44.1, -3.9, 46.0), (dt.datetime(2020, 1, 1, 5), dt.datetime(2020, 1, 1, 13))
    frame = chunks.region(spark.read.parquet(stored), GRID, box, hours)
    want = {
        (name, hours[0] + dt.timedelta(hours=t - 5), y * 24 + x, 50 - y * 0.5, -10 + x * 0.5, value(t, y, x, scale))
        for name, scale in (("t2m", 1), ("tp", -1)) for t in range(5, 14) for y in range(20) for x in range(24)
        if 43.6 <= 50 - y * 0.5 <= 46.5 and -6.7 <= -10 + x * 0.5 <= -3.4
    }
    assert set(map(tuple, frame.collect())) == want
    plan = frame._jdf.queryExecution().executedPlan()
    taken = [n.metrics().apply("numOutputRows").value() for n in nodes(plan) if n.nodeName().startswith("Filter")]
    assert min(taken) == 2 * 3 * 3 * 2  # fields x time, latitude and longitude chunks, of 200
    assert "PushedFilters" in plan.toString() and "GreaterThanOrEqual(y_chunk" in plan.toString()
    native = chunks.native_rows(frame, ["t2m", "tp"])
    assert native.count() == len(want) // 2 and native.where("t2m != -tp").count() == 0
    for bad in ((60, 70, 61, 71), (-10.0, 0.0, -10.0, 10.0)):
        with pytest.raises(ValueError, match="native points"):
            chunks.region(spark.read.parquet(stored), GRID, bad)
    with pytest.raises(ValueError, match="native points"):
        chunks.region(spark.read.parquet(stored), chunks.Grid(90.0, -180.0, 0.25, 721, 1440, (1, 8, 8)), (-180.0, -90.0, 180.0, 90.0))


def nodes(plan):
    """A plan's nodes, of an adaptive plan those that ran."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        plan = plan.executedPlan()
    out = [plan]
    children = plan.children()
    for k in range(children.size()):
        out += nodes(children.apply(k))
    return out


def test_kept_region_follows_its_files(spark, stored, tmp_path):
    kept, box = str(tmp_path / "kept"), (-6.0, 44.0, -5.0, 45.0)
    one = chunks.kept_region(spark, stored, kept, GRID, box)
    again = chunks.kept_region(spark, stored, kept, GRID, box)
    assert one.count() == again.count() > 0 and len(os.listdir(kept)) == 1
    spark.read.parquet(stored).limit(1).write.mode("append").parquet(stored)
    chunks.kept_region(spark, stored, kept, GRID, box)
    chunks.kept_region(spark, stored, kept, GRID, (-6.0, 44.0, -5.0, 46.0))
    assert len(os.listdir(kept)) == 3
