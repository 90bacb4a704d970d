"""Golden numbers and null rules of the weather, radiation and solar operators."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.functions import solar as sun
from aerolith.operators import incremental, lineage, radiation, reduce, solar_cycle, spatial
from aerolith.plans import products
from aerolith.sources import native as source
from aerolith.sources import registry
from aerolith.specs import METRICS, selected

DAY = dt.datetime(2009, 1, 1)
FIELDS = ["t2m", "d2m", "u10", "v10", "msl", "tcc", "tp"]
SCHEMA = "valid_time timestamp_ntz, point_id int, " + ", ".join(f"{f} double" for f in FIELDS)


def cube(spark, change=None):
    rows = []
    for h in range(25):
        for p in (0, 1):
            row = {"t2m": 283.15, "d2m": 278.15, "u10": 3.0, "v10": 4.0, "msl": 101325.0, "tcc": 0.5, "tp": h / 1000}
            row |= (change or {}).get((h, p), {})
            rows.append((DAY + dt.timedelta(hours=h), p, *row.values()))
    return spark.createDataFrame(rows, SCHEMA)


def frame(native):
    out = reduce.end_of_hour(reduce.clean(native, FIELDS), FIELDS)
    return out.where(F.to_date("valid_time") == F.lit(DAY.date()))


def test_constant_day(spark):
    hours = reduce.hourly_values(frame(cube(spark)), METRICS).where("point_id = 0").orderBy("valid_time").collect()
    assert len(hours) == 24 and hours[0]["PRECIPITATION_MM"] == 1 and hours[-1]["PRECIPITATION_MM"] == 24
    day = reduce.daily_values(frame(cube(spark)), METRICS, strict=True).where("point_id = 0").first()
    assert day["PRECIPITATION_MM"] == 300 and abs(day["TEMPERATURE_2M_C_MEAN"] - 10) < 1e-9 and day["WIND_SPEED_10M_MS_MEAN"] == 5
    values = reduce.values_only(reduce.daily_values(frame(cube(spark)), METRICS))
    assert len(values.columns) == 16


def test_missing_rain_and_invalid_humidity(spark):
    native = cube(spark, {(24, 0): {"tp": float("nan")}, (2, 0): {"d2m": 300.0}})
    days = {r["point_id"]: r for r in reduce.daily_values(frame(native), METRICS).collect()}
    assert days[0]["PRECIPITATION_MM"] is None and days[0]["PRECIPITATION_MM__status"] == "PARTIAL" and days[1]["PRECIPITATION_MM"] is not None
    assert days[0]["RELATIVE_HUMIDITY_2M_PCT_MEAN"] is None
    assert days[0]["RELATIVE_HUMIDITY_2M_PCT_MEAN__status"] == "OUTSIDE_SUPPORTED_RH_DOMAIN"
    assert days[0]["TEMPERATURE_2M_C_MEAN__status"] == "COMPLETE"


def test_calm_mean_vector(spark):
    native = cube(spark, {(h, 0): {"u10": 3.0 if h % 2 else -3.0, "v10": 0.0} for h in range(25)})
    day = reduce.daily_values(frame(native), selected(["wind"])).where("point_id = 0").first()
    assert day["WIND_DIRECTION_10M_DEG_FROM_MEAN_VECTOR"] is None and day["WIND_SPEED_10M_MS_MAX"] == 3
    assert day["WIND_DIRECTION_10M_DEG_FROM_MEAN_VECTOR__status"] == "UNDEFINED_CALM_MEAN"


def test_families():
    assert [m.family for m in selected(["wind", "temperature"])] == ["temperature"] + ["wind"] * 4
    for bad in ("wind", [], ["wind", "wind"], ["snow"]):
        with pytest.raises(ValueError):
            selected(bad)


@pytest.mark.parametrize(
    "utc, lat, lon, elevation, azimuth",
    [
        ("2003-10-17T19:30:30", 39.742476, -105.1786, 39.87207442406391, 194.34258286147943),
        ("2024-06-20T20:00:00", 49.0, -125.0, 64.08029047662873, 168.5114481594614),
        ("2024-12-21T16:00:00", 49.0, -125.0, -2.4081340073754802, 123.94841151334785),
        ("2012-02-29T00:00:00", 49.0, -125.0, 17.318306277523206, 234.6957282900767),
    ],
)
def test_solar_position(spark, utc, lat, lon, elevation, azimuth):
    sec = dt.datetime.fromisoformat(utc + "+00:00").timestamp()
    el, az = sun.position(F.lit(sec), F.lit(lat), F.lit(lon))
    got = spark.range(1).select(el, az).first()
    assert abs(got[0] - elevation) < 1e-8 and abs(got[1] - azimuth) < 1e-8
    assert abs(solar_cycle.elevation(np.array([sec]), np.array([lat]), np.array([lon]))[0] - elevation) < 1e-8


def test_phases(spark):
    values = [0, -50 / 60, -1, -6, -7, -12, -13, -18, -19]
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "e double").select(sun.phase(F.col("e"))).collect()]
    assert [g.split("_")[0] for g in got] == ["daylight", "daylight", "civil", "civil", "nautical", "nautical", "astronomical", "astronomical", "night"]


def test_daily_cycle():
    midnight = np.array([dt.datetime(2024, 6, 20, tzinfo=dt.UTC).timestamp()] * 2)
    events, hours = solar_cycle.cycle(midnight, np.array([49.0, 48.5]), np.array([-125.0, -125.0]))
    assert np.allclose(hours.sum(axis=1), 24) and hours[0, 4] == 0 and 0 < hours[1, 4] < 1
    rise, down = events[0, 0]
    assert down < rise and abs(rise - (12 * 3600 + 15 * 60 + 57)) < 60 and abs(down - (4 * 3600 + 27 * 60 + 23)) < 60
    assert np.isnan(events[0, 3]).all() and math.isclose(hours[0, 0], (down + 86400 - rise) / 3600)


def test_radiation(spark):
    """A null hour empties its day for its own field; negative energies stay."""
    start = dt.datetime(2015, 7, 8)
    rows = [[start + dt.timedelta(hours=h), 4, 7200.0 + 50 * h, 100.0 * h] for h in range(49)]
    rows[7][3], rows[9][2] = -2.5, float("inf")
    native = spark.createDataFrame([tuple(r) for r in rows], "valid_time timestamp_ntz, point_id int, ssrd double, fdir double")
    days = radiation.daily(radiation.hourly(native)).orderBy("DATE").collect()
    assert days[0]["DOWNWARD_SHORTWAVE_ENERGY_J_M2"] is None
    assert days[0]["DIRECT_SOLAR_ENERGY_J_M2"] == pytest.approx(sum(r[3] for r in rows[1:25]))
    assert days[1]["DOWNWARD_SHORTWAVE_IRRADIANCE_W_M2_MEAN"] == pytest.approx(sum(r[2] for r in rows[25:49]) / 86400)


@pytest.mark.parametrize(
    "first, last, old, want", [(1, 3, (1, 1), [(2, 3)]), (1, 2, (3, 3), [(1, 2)]), (1, 3, (2, 2), [(1, 1), (3, 3)]), (3, 3, (1, 1), [(2, 3)]), (2, 2, (1, 3), [])]
)
def test_missing_ranges(first, last, old, want):
    d = lambda k: dt.date(2009, 1, k)
    assert incremental.missing_ranges(d(first), d(last), (d(old[0]), d(old[1]))) == [(d(a), d(b)) for a, b in want]


def test_repair(spark):
    """Nulls of one column are filled, and the day's sum with them; no other value moves."""
    keys, day = ["H3_INDEX", "DATETIME"], dt.datetime(2019, 3, 5)
    schema = "H3_INDEX string, DATETIME timestamp_ntz, PRECIPITATION_MM double, OTHER double"
    amounts = [0.25 * h for h in range(24)]
    rows = [(c, day + dt.timedelta(hours=h), a, 7.5) for c in "pq" for h, a in enumerate(amounts)]
    holes = {("p", 22), ("p", 23)}
    old = spark.createDataFrame([(c, t, None if (c, t.hour) in holes else a, o) for c, t, a, o in rows], schema)
    fresh = spark.createDataFrame([(c, t, a + (0 if (c, t.hour) in holes else 11), -1.0) for c, t, a, o in rows], schema)
    new = incremental.fill_missing(old, fresh, keys, "PRECIPITATION_MM")
    daily = spark.createDataFrame([("p", day.date(), None, 7.5), ("q", day.date(), -3.0, 7.5)], "H3_INDEX string, DATE date, PRECIPITATION_MM double, OTHER double")
    got = {r["H3_INDEX"]: r["PRECIPITATION_MM"] for r in incremental.repaired_day(new, daily, "PRECIPITATION_MM").collect()}
    assert got == {"p": sum(amounts), "q": -3.0}
    assert incremental.changed_rows(old, new, keys, ["PRECIPITATION_MM"]).count() == 0
    assert incremental.changed_rows(old, fresh, keys, ["PRECIPITATION_MM"]).count() == 48


def test_retained_merge(spark):
    schema = "H3_INDEX string, DATE date, v double"
    d = lambda k: dt.date(2020, 5, k)
    a = spark.createDataFrame([("x", d(1), 1.0), ("x", d(2), None), ("out", d(2), 5.0)], schema)
    b = spark.createDataFrame([("x", d(3), None), ("y", d(3), 2.0)], schema)
    members = spark.createDataFrame([("x",), ("y",)], "h3_index string")
    got = {(r["H3_INDEX"], r["DATE"].day): r["v__status"] for r in incremental.merge_retained([b, a], members, ["LATE", "EARLY"], ["v"]).collect()}
    assert got == {("x", 1): "COMPLETE", ("x", 2): "EARLY", ("x", 3): "LATE", ("y", 3): "COMPLETE"}
    with pytest.raises(ValueError):
        incremental.merge_retained([a, b], members, ["SAME", "SAME"], ["v"])
    with pytest.raises(Exception, match="repeated"):
        incremental.merge_retained([a.union(a), b], members, ["A", "B"], ["v"]).collect()


def test_membership_files():
    assert registry.parse_members(b"") == [] and registry.parse_members(b"a1\nb2\n") == ["a1", "b2"]
    for bad in (b"a1", b"a1\r\n", b"a1\n\nb2\n", b" a1\n", "ä\n".encode()):
        with pytest.raises(ValueError):
            registry.parse_members(bad)


def test_lineage_faults(spark):
    d = lambda k: dt.date(2009, 1, k)
    rows = [("daily", "ok", d(1), d(3)), ("daily", "ok", d(4), d(9)), ("daily", "hole", d(1), d(3)), ("daily", "hole", d(5), d(9)),
            ("daily", "twice", d(1), d(5)), ("daily", "twice", d(5), d(9)), ("daily", "short", d(2), d(9)), ("daily", "long", d(1), d(10))]
    spans = spark.createDataFrame(rows, "frequency string, metric string, start_date date, end_date date")
    got = {(r["metric"], r["fault"]) for r in lineage.breaks(spans, d(1), d(9)).collect()}
    assert got == {("hole", "gap"), ("twice", "overlap"), ("short", "gap"), ("long", "outside")}


def test_nearest_point_ties_go_to_the_smaller_id(spark):
    grid = spark.createDataFrame([(1, 48.0, -124.0), (2, 48.0, -123.75)], "point_id int, lat double, lon double")
    cells = spark.createDataFrame([("a", 48.0, -123.875), ("b", 48.1, -123.8)], "h3_index string, lat double, lon double")
    got = {r["h3_index"]: r["point_id"] for r in spatial.nearest_point(cells, grid).collect()}
    assert got == {"a": 1, "b": 2}


def test_products_append_and_check(spark, tmp_path):
    start = dt.datetime(2024, 6, 20)
    rows = [(start + dt.timedelta(hours=h), p, 280.0 + h, 270.0, 1.0, 2.0, 1e5, 0.3, 0.001, 3600.0, 1800.0) for h in range(73) for p in (0, 1)]
    native = spark.createDataFrame(rows, SCHEMA + ", ssrd double, fdir double")
    native.write.parquet(str(tmp_path / "native"))
    cells = spark.createDataFrame([("a", 0, 49.0, -125.0), ("b", 1, 48.5, -125.0)], "h3_index string, point_id int, lat double, lon double")
    out = str(tmp_path / "out")
    products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-20", "2024-06-20", ["temperature"])
    catalog = products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-20", "2024-06-20", ["temperature"])
    before = products.tables(spark, out + "/weather", catalog)["daily"].collect()
    catalog = products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-20", "2024-06-22", ["temperature"])
    assert [e["start_date"] for e in catalog["epochs"]] == ["2024-06-20", "2024-06-21"]
    assert products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-21", "2024-06-21", ["temperature"]) == catalog
    after = products.tables(spark, out + "/weather", catalog)["daily"].where("DATE = date'2024-06-20'").collect()
    assert sorted(map(tuple, before)) == sorted(map(tuple, after))
    products.get_radiation(spark, str(tmp_path / "native"), cells, out, "2024-06-20", "2024-06-22")
    products.get_solar(spark, cells, out, "2024-06-20", "2024-06-21")
    for name in ("weather", "radiation", "solar"):
        assert set(products.check_product(spark, out, name, cells).values()) == {0}
    before = {r["H3_INDEX"]: r for r in products.tables(spark, out + "/weather", catalog)["daily"].collect()}
    more = products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-20", "2024-06-22", ["wind"])
    assert more["families"] == ["temperature", "wind"] and set(products.check_product(spark, out, "weather", cells).values()) == {0}
    after = {r["H3_INDEX"]: r for r in products.tables(spark, out + "/weather", more)["daily"].collect()}
    assert before.keys() == after.keys()
    with pytest.raises(ValueError, match="other cells"):
        products.get_weather(spark, str(tmp_path / "native"), cells.where("h3_index = 'a'"), out, "2024-06-20", "2024-06-22", ["wind"])
    with pytest.raises(ValueError, match="source ends"):
        products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-20", "2024-06-29", ["wind"])
    short = products.get_weather(spark, str(tmp_path / "native"), cells, out, "2024-06-21", "2024-06-21", ["pressure"], rebuild=True)
    assert (short["start_date"], short["families"]) == ("2024-06-21", ["pressure"])
    assert set(products.check_product(spark, out, "weather", cells).values()) == {0}  # nothing stale is left


def test_incomplete_final_day_and_refresh(spark, tmp_path):
    start, path, out = dt.datetime(2024, 6, 20), str(tmp_path / "native"), str(tmp_path / "out")
    rows = [(start + dt.timedelta(hours=h), 0, 280.0 + h, 270.0, 1.0, 2.0, 1e5, 0.3, 0.001) for h in range(97)]
    cells = spark.createDataFrame([("a", 0, 49.0, -125.0)], "h3_index string, point_id int, lat double, lon double")
    spark.createDataFrame(rows[:48], SCHEMA).write.parquet(path)  # the midnight after the second day is to come
    with pytest.raises(ValueError, match="source ends"):
        products.get_weather(spark, path, cells, out, "2024-06-20", "2024-06-21", ["precipitation"])
    assert source.read_catalog(spark, out + "/weather/catalog") is None
    made = products.get_weather(spark, path, cells, out, "2024-06-20", "2024-06-21", ["precipitation"], allow_incomplete_final_day=True)
    assert made["partial_fields"] == ["tp"] and made["latest_complete_day"] == "2024-06-20"
    spark.createDataFrame(rows[48:], SCHEMA).write.mode("append").parquet(path)
    done = products.refresh_weather(spark, path, cells, out, "2024-06-23")
    days = products.tables(spark, out + "/weather", done)["daily"].orderBy("DATE").collect()
    assert done["partial_fields"] == [] and len(days) == 4 and all(r["PRECIPITATION_MM"] == pytest.approx(24) for r in days)
    assert products.refresh_weather(spark, path, cells, out, "2024-06-23") == source.read_catalog(spark, out + "/weather/catalog")
    assert set(products.check_product(spark, out, "weather", cells).values()) == {0}


def test_native_rows_are_checked(spark, tmp_path):
    native = cube(spark)
    with pytest.raises(ValueError, match="2 rows"):
        source.check_keys(native.union(native.where("point_id = 1 and hour(valid_time) = 3")))
    with pytest.raises(ValueError, match="follow"):
        source.check_keys(native.where("hour(valid_time) != 5"))
    far = spark.createDataFrame([("far", 10.0, 10.0)], "h3_index string, lat double, lon double")
    grid = spark.createDataFrame([(1, 48.0, -124.0)], "point_id int, lat double, lon double")
    with pytest.raises(Exception, match="no native point near far"):
        spatial.nearest_point(far, grid).collect()
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        zoned = native.withColumn("valid_time", F.expr("convert_timezone('UTC', current_timezone(), valid_time)").cast("timestamp"))
        zoned.write.parquet(str(tmp_path / "zoned"))
        read = source.read_native(spark, str(tmp_path / "zoned"), ["tp"], "2009-01-01", "2009-01-01")
        assert sorted(map(tuple, read.collect())) == sorted(map(tuple, native.select("valid_time", "point_id", "tp").collect()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_lattice_uses_all_cores(spark):
    cells = spark.createDataFrame([("a",), ("b",)], "h3_index string").coalesce(1)
    keys = spatial.lattice(cells, "2001-02-10", "2002-03-05", True)
    assert keys.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    got = keys.agg(F.count("*"), F.count_distinct("H3_INDEX", "DATETIME"), F.min("DATETIME"), F.max("DATETIME")).first()
    days = (dt.date(2002, 3, 5) - dt.date(2001, 2, 10)).days + 1
    assert tuple(got) == (days * 48, days * 48, dt.datetime(2001, 2, 10), dt.datetime(2002, 3, 5, 23))
