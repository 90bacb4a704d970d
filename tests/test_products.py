"""Maintenance of products: partial days, failed runs, repairs, merges and forged catalogs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from aerolith.operators import incremental, reduce, validate
from aerolith.plans import products
from aerolith.sources import manifest, registry
from aerolith.sources import native as source

START = dt.datetime(2024, 6, 20)
CELLS = [("a", 0, 49.0, -125.0), ("b", 1, 48.5, -125.0), ("c", 1, 48.4, -125.0)]
SCHEMA = "valid_time timestamp_ntz, point_id int, t2m double, msl double, tp double, ssrd double, fdir double"


def rows(hours, points=(0, 1), skip=()):
    return [(START + dt.timedelta(hours=h), p, 280.0 + h, 1e5 + p, 0.001 * (p + 1), 3600.0, -1.0 if h == 5 else 1800.0) for h in hours for p in points if (h, p) not in skip]


def day(k):
    return str((START + dt.timedelta(days=k)).date())


@pytest.fixture
def world(spark, tmp_path):
    class World:
        native, out = str(tmp_path / "native"), str(tmp_path / "out")
        cells = spark.createDataFrame(CELLS, "h3_index string, point_id int, lat double, lon double")

        def add(self, data):
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(self.native)

        def get(self, first, last, families=("precipitation",), **options):
            return products.get_weather(spark, self.native, self.cells, self.out, day(first), day(last), list(families), **options)

        def table(self, catalog, frequency="daily"):
            return products.tables(spark, self.out + "/weather", catalog)[frequency]

        def faults(self, name="weather"):
            return {k: n for k, n in products.check_product(spark, self.out, name, self.cells).items() if n}

    return World()


def test_partial_day_stays_partial_through_appends_and_prepends(spark, world):
    world.add(rows(range(24, 72)))
    made = world.get(1, 2, allow_incomplete_final_day=True)
    entry = {"date": day(2), "field": "tp", "affected": 3, "minimum_valid_hours": 23, "maximum_valid_hours": 23}
    assert made["partial_days"] == [entry] and made["partial_fields"] == ["tp"] and made["latest_complete_day"] == day(1)
    world.add(rows(range(24)))
    before = world.get(0, 0)  # another start does not make the end whole
    assert before["partial_fields"] == ["tp"] and (before["start_date"], before["end_date"], before["latest_complete_day"]) == (day(0), day(2), day(1))
    world.add(rows(range(72, 121)))
    after = world.get(3, 4)
    assert after["partial_days"] == [entry] and after["partial_fields"] == [] and after["latest_complete_day"] == day(4)
    nulls = {str(r["DATE"]) for r in world.table(after).where("PRECIPITATION_MM is null").collect()}
    assert nulls == {day(2)} and world.faults() == {} and after["totals"]["daily"]["nulls"]["PRECIPITATION_MM"] == 3
    again = products.refresh_weather(spark, world.native, world.cells, world.out, day(4))
    assert again == after  # a partial day that is no longer the last one is left


def test_failed_run_changes_nothing(spark, world, monkeypatch):
    world.add(rows(range(97)))
    made = world.get(0, 0)
    before = sorted(map(tuple, world.table(made).collect()))

    def fails(*args):
        raise OSError("killed")

    monkeypatch.setattr(source, "write_catalog", fails)
    for attempt in (lambda: world.get(0, 2), lambda: world.get(0, 0, ["temperature"])):
        with pytest.raises(OSError):
            attempt()
    monkeypatch.undo()
    assert source.read_catalog(spark, world.out + "/weather/catalog") == made and world.faults() == {}
    assert sorted(map(tuple, world.table(made).collect())) == before
    assert len(products.vacuum(spark, world.out, "weather")) == 2 and products.vacuum(spark, world.out, "weather") == []
    done = world.get(0, 2, ["temperature"])
    assert world.faults() == {} and done["families"] == ["temperature", "precipitation"] and world.table(done).count() == 9


def files(world, frequency="daily"):
    return {os.path.join(d, f) for d, _, names in os.walk(world.out + "/weather") for f in names if f.endswith(".parquet") and f"/{frequency}/" in d}


def test_runs_write_only_what_is_missing(spark, world):
    world.add(rows(range(73)))
    world.get(0, 1)
    kept = files(world)
    made = world.get(0, 1, ["pressure"])  # a family: no column of the others is written
    new = files(world) - kept
    names = set(spark.read.parquet(*new).columns)
    assert names == {"H3_INDEX", "MEAN_SEA_LEVEL_PRESSURE_HPA_MEAN", "MEAN_SEA_LEVEL_PRESSURE_HPA_MIN"} and len(new) == 2
    made = world.get(0, 2, ["pressure"])  # a day, with all families
    assert len(files(world) - kept - new) == 1 and world.faults() == {}
    assert [len(g) for _, _, g in made["days"]] == [2, 1] and world.table(made).count() == 9
    assert [(e["start_date"], e["families"]) for e in made["epochs"]] == [(day(0), ["precipitation"]), (day(0), ["pressure"]), (day(2), ["pressure", "precipitation"])]


def test_repair_writes_one_day_and_needs_one_missing_hour(spark, world, monkeypatch):
    world.add(rows(range(72)))
    made = world.get(0, 2, ["temperature", "precipitation"], allow_incomplete_final_day=True)
    kept = files(world)
    with pytest.raises(ValueError, match="source ends"):
        products.refresh_weather(spark, world.native, world.cells, world.out, day(2))
    world.add([(*r[:2], 0.0, 0.0, *r[4:]) for r in rows([72])])
    done = products.refresh_weather(spark, world.native, world.cells, world.out, day(2))
    assert len(files(world) - kept) == 1 and world.faults() == {}
    assert done["partial_days"] == [] and done["latest_complete_day"] == day(2) and made["totals"]["hourly"]["status"]["PRECIPITATION_MM"]["UNAVAILABLE"] == 3
    assert done["totals"]["daily"]["status"]["PRECIPITATION_MM"] == {"COMPLETE": 9, "PARTIAL": 0, "UNAVAILABLE": 0, "UNDEFINED_CALM_MEAN": 0, "OUTSIDE_SUPPORTED_RH_DOMAIN": 0}
    rain = {(r["H3_INDEX"], str(r["DATE"])): r["PRECIPITATION_MM"] for r in world.table(done).collect()}
    assert all(v == pytest.approx(24 if c == "a" else 48) for (c, _), v in rain.items()) and len(rain) == 9
    warm = [world.table(c).where(F.col("DATE") == day(2)).select("H3_INDEX", "TEMPERATURE_2M_C_MEAN") for c in (made, done)]
    assert warm[0].exceptAll(warm[1]).count() == 0


def test_repair_faults(spark):
    d = dt.datetime(2020, 1, 1)
    hourly = [(c, d + dt.timedelta(hours=h), None if h == 23 or (c, h) in {("two", 4)} else 1.0) for c in ("fine", "two", "had", "late") for h in range(24)]
    hourly += [("whole", d + dt.timedelta(hours=h), 1.0) for h in range(24)]
    frame = spark.createDataFrame(hourly, "H3_INDEX string, DATETIME timestamp_ntz, P double")
    days = spark.createDataFrame([(c, d.date(), 5.0 if c == "had" else None) for c in ("fine", "two", "had", "late", "whole")], "H3_INDEX string, DATE date, P double")
    fresh = frame.withColumn("P", F.when(F.col("H3_INDEX") != "late", 1.0))
    got = {r["H3_INDEX"]: r["fault"].split()[0] + r["fault"].split()[1] for r in incremental.repair_faults(frame, days, fresh, "P").collect()}
    assert got == {"two": "doesnot", "had": "hasa", "late": "hasno", "whole": "doesnot"}


@pytest.mark.parametrize("skip, why", [(((47, 1), (48, 1)), "lacks hours"), (((30, 0),), "lacks hours"), (((48, 1),), "lacks the stamps"), (tuple((h, 1) for h in range(24, 49)), "lacks the stamps"), (tuple((h, 1) for h in range(49)), "lacks hours")])
def test_each_point_is_held_to_the_gate(world, skip, why):
    """A point that ends earlier, or has a hole, is not hidden by the others."""
    world.add(rows(range(49), skip=skip))
    with pytest.raises(ValueError, match=f"point {skip[0][1]} {why}"):
        world.get(0, 1)


def test_null_values_are_listed_and_pass(spark, world):
    world.add([(*r[:4], None if r[0].hour in (3, 4) and r[1] == 1 and r[0].day == 20 else r[4], *r[5:]) for r in rows(range(49))])
    made = world.get(0, 1)
    assert made["partial_days"] == [{"date": day(0), "field": "tp", "affected": 2, "minimum_valid_hours": 22, "maximum_valid_hours": 24}]
    assert made["partial_fields"] == [] and world.faults() == {}


def test_covered_run_checks_the_product(spark, world):
    world.add(rows(range(49)))
    made = world.get(0, 1)
    assert world.get(1, 1) == made
    for forged in (
        {"totals": {**made["totals"], "daily": {**made["totals"]["daily"], "status": {"PRECIPITATION_MM": {"COMPLETE": 0}}}}},
        {"columns": {**made["columns"], "daily": [[c, t, "m" if u == "mm" else u] for c, t, u in made["columns"]["daily"]]}},
        {"partial_days": [{"date": day(0), "field": "tp", "affected": 1, "minimum_valid_hours": 23, "maximum_valid_hours": 24}]},
        {"epochs": made["epochs"] * 2},
    ):
        source.write_catalog(spark, world.out + "/weather/catalog", {**made, **forged})
        with pytest.raises(ValueError, match="faults"):
            world.get(1, 1)
    source.write_catalog(spark, world.out + "/weather/catalog", made)
    name = sorted(files(world))[0]
    wrong = spark.read.parquet(name).withColumn("PRECIPITATION_MM", F.col("PRECIPITATION_MM") + 1).toPandas()
    os.remove(name)
    os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
    wrong.to_parquet(name)
    with pytest.raises(ValueError, match="reductions"):
        world.get(1, 1)


def test_radiation_keeps_its_partial_day_and_quality(spark, world):
    world.add(rows(range(48)))
    get = lambda last, **o: products.get_radiation(spark, world.native, world.cells, world.out, day(0), day(last), **o)
    made = get(1, allow_incomplete_final_day=True)
    assert made["partial_fields"] == ["fdir", "ssrd"] and {p["field"] for p in made["partial_days"]} == {"ssrd", "fdir"}
    assert made["totals"]["hourly"]["quality"] == {"ssrd|negative": 0, "fdir|negative": 3, "above|count": 0}
    world.add(rows(range(48, 73)))
    done = get(2)
    assert done["partial_days"] == made["partial_days"] and done["latest_complete_day"] == day(2) and world.faults("radiation") == {}


def test_native_parity_on_boundary_days(spark, world):
    world.add(rows(range(97)))
    products.get_radiation(spark, world.native, world.cells, world.out, day(0), day(3))
    assert products.check_native(spark, world.native, world.cells, world.out, "radiation") == 0
    change = spark.read.parquet(world.native).withColumn("fdir", F.when((F.col("point_id") == 1) & (F.to_date("valid_time") == day(1)), 7.0).otherwise(F.col("fdir")))
    change.write.parquet(world.native + "2")
    # the first stamp of the second day ends the first day's last hour, of two cells
    assert products.check_native(spark, world.native + "2", world.cells, world.out, "radiation") == 2
    assert [str(d) for d in validate.boundary_days([("2012-02-01", "2012-03-01"), ("2013-01-01", "2013-12-31")])] == [
        "2012-02-01", "2012-02-29", "2012-03-01", "2013-01-01", "2013-12-31"]


def test_coastal_merge(spark, world, tmp_path):
    world.add(rows(range(97)))
    outs = [str(tmp_path / f"part{k}") for k in range(3)]
    for k, (first, last) in enumerate(((0, 0), (1, 2), (0, 1))):
        products.get_weather(spark, world.native, world.cells, outs[k], day(first), day(last), ["temperature", "precipitation"])
    members = spark.createDataFrame([("b",), ("c",)], "h3_index string")
    made = products.publish_coastal(spark, [outs[1], outs[0]], members, str(tmp_path / "merged"))
    assert (made["start_date"], made["end_date"], len(made["epochs"])) == (day(0), day(2), 2)
    got = products.tables(spark, str(tmp_path / "merged/weather"), made)
    assert got["daily"].count() == 6 and got["hourly"].count() == 144 and {r[0] for r in got["daily"].select("H3_INDEX").distinct().collect()} == {"b", "c"}
    assert set(products.check_product(spark, str(tmp_path / "merged"), "weather", members).values()) == {0}
    source_rows = products.tables(spark, outs[1] + "/weather", source.read_catalog(spark, outs[1] + "/weather/catalog"))["hourly"].where("H3_INDEX != 'a'")
    assert source_rows.exceptAll(got["hourly"].select(*source_rows.columns)).count() == 0
    with pytest.raises(ValueError, match="contiguous"):
        products.publish_coastal(spark, [outs[2], outs[1]], members, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="rows for"):
        products.publish_coastal(spark, outs[:2], spark.createDataFrame([("b",), ("zz",)], "h3_index string"), str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="own"):
        products.publish_coastal(spark, outs[:2], members, outs[0])


def test_regions(spark, world):
    world.add(rows(range(25)))
    box = lambda w, s, e, n, **o: products.get_data(spark, world.native, world.cells, world.out, day(0), day(0), w, s, e, n, ["temperature"], **o)
    made = box(-126, 48.45, -124, 49.5, approved=(-130, 45, -120, 50))
    assert made["totals"]["daily"]["rows"] == 2
    for bad, why in (((-126, 10, -124, 11), "no cell"), ((-126, 49, -126, 49.5), "no box"), ((-126, 48, -110, 49), "approved")):
        with pytest.raises(ValueError, match=why):
            box(*bad, approved=(-130, 5, -120, 50))
    with pytest.raises(ValueError, match="no native point"):
        products.get_weather(spark, world.native, world.cells, world.out, day(0), day(0), registered=world.cells.select("h3_index").union(spark.createDataFrame([("z",)], "h3_index string")))
    with pytest.raises(ValueError, match="repeated"):
        products.get_weather(spark, world.native, world.cells.union(world.cells), world.out, day(0), day(0))


def test_membership_manifest():
    ids = registry.parse_members(b"a1\nb2\n")
    digest = "90d0f1d1d5a0c7b0d4b0ce8a3b2e2a0f"
    assert registry.check_members(ids, 2) == ids
    for bad in (lambda: registry.check_members(["b2", "a1"]), lambda: registry.check_members(["a1", "a1"]), lambda: registry.check_members(ids, 3), lambda: registry.check_members(ids, 2, digest)):
        with pytest.raises(ValueError):
            bad()


def test_days_are_runs():
    d = lambda k: START.date() + dt.timedelta(days=k)
    one = manifest.replaced([], d(0), d(5), "x")
    assert one == [[day(0), day(5), ["x"]]]
    two = manifest.replaced(manifest.widened(one, "y"), d(2), d(3), "z")
    assert two == [[day(0), day(1), ["x", "y"]], [day(2), day(3), ["z"]], [day(4), day(5), ["x", "y"]]]
    assert manifest.clipped(two, d(3), d(4)) == [[day(3), day(3), ["z"]], [day(4), day(4), ["x", "y"]]]


def test_a_day_is_several_files_and_a_cell_in_one(spark, tmp_path):
    cells = spark.range(95).select(F.format_string("c%04d", "id").alias("h3_index"))
    bounds = source.slice_bounds(cells, size=30)
    assert bounds == ["c0030", "c0060", "c0090"]
    hours = F.explode(F.expr("sequence(timestamp_ntz'2024-06-20 00:00:00', timestamp_ntz'2024-06-20 23:00:00', interval 1 hour)"))
    frame = cells.select(F.col("h3_index").alias("H3_INDEX"), hours.alias("DATETIME")).withColumns({"DATE": F.to_date("DATETIME"), "v": F.rand(1), "v__status": F.lit("COMPLETE")})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        seen = source.write_days(frame, str(tmp_path / "t"), bounds, {"rows": F.count(F.lit(1)), "fine": F.count_if(F.col("v__status") == "COMPLETE")})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert seen == {"rows": 95 * 24, "fine": 95 * 24}
    got = spark.read.parquet(str(tmp_path / "t")).withColumn("file", F.input_file_name())
    assert got.columns == ["H3_INDEX", "DATETIME", "v", "DATE", "file"] and got.select("file").distinct().count() > 1
    assert got.groupBy("H3_INDEX").agg(F.count_distinct("file").alias("n")).where("n != 1").count() == 0


def test_hour_masks(spark):
    at = lambda h, m=0: START + dt.timedelta(hours=h, minutes=m)
    frame = spark.createDataFrame([(1, at(0), 1.0), (1, at(23), None), (1, at(24), 2.0), (2, at(5), 3.0)], "point_id int, valid_time timestamp_ntz, x double")
    got = {(r["point_id"], str(r["DATE"])): (r["hours"], r["x"]) for r in reduce.hour_masks(frame, ["x"]).collect()}
    assert got == {(1, day(0)): (1 | 1 << 23, 1), (1, day(1)): (1, 1), (2, day(0)): (32, 32)}
    rows_ = reduce.partial_days(reduce.hour_masks(frame, ["x"]), ["x"]).orderBy("DATE").collect()
    assert [(str(r["DATE"]), r["affected"], r["minimum_valid_hours"], r["maximum_valid_hours"]) for r in rows_] == [(day(0), 2, 1, 1), (day(1), 1, 1, 1)]
    twice = reduce.hour_masks(reduce.end_of_hour(frame.union(frame.limit(1)).withColumnRenamed("x", "tp"), ["tp"], counted=True), ["tp"]).where("point_id = 1").orderBy("DATE").first()
    assert (twice["copies"], twice["off"], twice["ended"]) == (2, 0, 1 << 23)
