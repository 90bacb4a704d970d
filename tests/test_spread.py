"""Values of few points are given to many cells by many tasks."""

from pyspark.sql import functions as F

from aerolith.operators import spatial, validate
from aerolith.plans import products


def test_cells_of_one_point_are_dealt_out(spark):
    cells = spark.range(20_000).select(F.format_string("c%06d", "id").alias("h3_index"), F.when(F.col("id") < 19_990, 1).otherwise(2).alias("point_id"))
    values = spark.createDataFrame([(p, d, p * 100.0 + d) for p in (1, 2, 3) for d in range(30)], "point_id int, d int, v double")
    got = spatial.sample(values, cells)
    assert got.columns == ["H3_INDEX", "d", "v"]
    sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 20_000 * 30 and max(sizes) < 20_000 * 30 / 2
    want = cells.join(values, "point_id").select(F.col("h3_index").alias("H3_INDEX"), "d", "v")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_values_are_rounded_once_for_all_cells(spark):
    values = spark.createDataFrame([(1, "2024-01-01", 1.23456789), (2, "2024-01-01", -0.0000001)], "point_id int, d string, v double")
    values = values.select("point_id", F.to_date("d").alias("DATE"), "v")
    cells = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "h3_index string, point_id int")
    got = products.on_cells(values, cells, "2024-01-01", "2024-01-02", False, digits=3)
    assert sorted((r["H3_INDEX"], str(r["DATE"])[-2:], str(r["v"])) for r in got.collect()) == [
        ("a", "01", "1.235"), ("a", "02", "None"), ("b", "01", "1.235"), ("b", "02", "None"), ("c", "01", "0.0"), ("c", "02", "None")]


def test_native_rows_are_not_laid_over_cells(spark):
    """Published rows meet the cells' points, so the crosswalk is joined once; unknown cells and cells without a point differ."""
    from datetime import date, datetime

    hours = [datetime(2024, 1, 1, h) for h in range(3)]
    ntz = lambda f, c: f.withColumn(c, F.col(c).cast("timestamp_ntz"))
    native = ntz(spark.createDataFrame([(1, h, 5.0) for h in hours[1:]], "point_id int, valid_time timestamp, ssrd double"), "valid_time")
    cells = spark.createDataFrame([("a", 1), ("b", None)], "h3_index string, point_id int")
    rows = [("a", hours[0], 5.0), ("a", hours[1], 6.0), ("a", hours[2], None), ("b", hours[0], 5.0), ("b", hours[1], None), ("x", hours[0], 5.0)]
    hourly = ntz(spark.createDataFrame(rows, "H3_INDEX string, DATETIME timestamp, W double"), "DATETIME")
    found = validate.native_differences(native, cells, hourly, {"W": "ssrd"}, [date(2024, 1, 1)])
    assert sorted((r["H3_INDEX"], r["DATETIME"].hour) for r in found.collect()) == [("a", 1), ("b", 0), ("x", 0)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2
