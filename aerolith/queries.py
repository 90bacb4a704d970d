"""Queries over the star-schema tables: weather stand-ins, and every operator on them.

The tables hold no weather, so native fields are built from ``events`` (5 points by
hour) and cells from ``customer``; all rows are used."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import solar as sun
from .functions import weather as W
from .operators import incremental, lineage, radiation, reduce, solar_cycle, spatial, validate
from .plans import products
from .sources import native as source
from .sources import chunks, registry
from .specs import CALM, METRICS, selected
from .streaming.hourly import daily_support

FIRST, LAST = "2024-01-01", "2024-01-30"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Stand-ins as DuckDB sees them; the functions below build the same in Spark.
NATIVE = r"""
e AS (SELECT CAST(user_id % 5 AS INTEGER) AS point_id, date_trunc('hour', ts) AS valid_time, value,
             CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) AS k FROM events),
g AS (SELECT point_id, valid_time, avg(value) AS v, avg(k) AS k FROM e GROUP BY ALL),
native AS (SELECT point_id, valid_time, 250 + v * 0.6 AS t2m, 245 + k * 0.5 AS d2m, v - 50 AS u10, k - 50 AS v10,
                  100000 + v * 10 AS msl, k / 100 AS tcc, v / 1000 AS tp, v * 3600 - 36000 AS ssrd, k * 1800 AS fdir FROM g)"""
HUMIDITY = "100 * exp(17.67 * td / (td + 243.5) - 17.67 * t / (t + 243.5))"
CELLS = """
cells AS (SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS h3_index, 46 + (c_custkey % 97) * 0.05 AS lat,
                 -129 + (c_custkey % 151) * 0.05 AS lon FROM customer),
grid AS (SELECT CAST(y * 100 + x AS INTEGER) AS point_id, 45.75 + y * 0.25 AS lat, -129.25 + x * 0.25 AS lon
         FROM range(22) ty(y), range(33) tx(x))"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def native(spark: SparkSession, sf: str) -> DataFrame:
    hour = F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:00:00"))
    e = table(spark, sf, "events").select(
        (F.col("user_id") % 5).cast("int").alias("point_id"), hour.alias("valid_time"), "value",
        F.regexp_extract("props", r"(\d+)", 1).cast("double").alias("k"),
    )
    g = e.groupBy("point_id", "valid_time").agg(F.avg("value").alias("v"), F.avg("k").alias("k"))
    v, k = F.col("v"), F.col("k")
    fields = {"t2m": 250 + v * 0.6, "d2m": 245 + k * 0.5, "u10": v - 50, "v10": k - 50, "msl": 100000 + v * 10,
              "tcc": k / 100, "tp": v / 1000, "ssrd": v * 3600 - 36000, "fdir": k * 1800}
    return g.select("point_id", "valid_time", *[c.alias(n) for n, c in fields.items()])


def cells(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.lpad(key.cast("string"), 9, "0")).alias("h3_index"),
        (46 + (key % 97) * 0.05).alias("lat"), (-129 + (key % 151) * 0.05).alias("lon"),
    )


def grid(spark: SparkSession) -> DataFrame:
    y, x = (F.floor(F.col("id") / 33), F.col("id") % 33)
    return spark.range(22 * 33).select(
        (y * 100 + x).cast("int").alias("point_id"), (45.75 + y * 0.25).alias("lat"), (-129.25 + x * 0.25).alias("lon")
    )


def crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 stand-in points given to the customers' cells."""
    return table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("h3_index"),
        (F.col("c_custkey") % 5).cast("int").alias("point_id"),
    )


def rounded(frame: DataFrame, digits: int = 6) -> DataFrame:
    return reduce.rounded(frame, digits)


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def weather_frame(spark: SparkSession, sf: str, fields) -> DataFrame:
    return reduce.end_of_hour(reduce.clean(native(spark, sf), fields), fields)


def r6(expression: str, name: str) -> str:
    return f"round({expression}, 6) + 0.0 AS {name}"


# ---- hourly layer -------------------------------------------------------------------------


@query(f"WITH {NATIVE} SELECT point_id, valid_time, {r6('t2m - 273.15', 'TEMPERATURE_2M_C')}, 'COMPLETE' AS status, "
       f"{r6('msl / 100', 'MEAN_SEA_LEVEL_PRESSURE_HPA')}, {r6('tcc * 100', 'TOTAL_CLOUD_COVER_PCT')} FROM native")
def hourly_convert(spark, sf):
    """Unit conversions with the hourly status."""
    metrics = selected(["temperature", "cloud_cover", "pressure"])
    out = reduce.hourly_values(weather_frame(spark, sf, ["t2m", "msl", "tcc"]), metrics)
    return rounded(out.select("point_id", "valid_time", "TEMPERATURE_2M_C", F.col("TEMPERATURE_2M_C__status").alias("status"), "MEAN_SEA_LEVEL_PRESSURE_HPA", "TOTAL_CLOUD_COVER_PCT"))


@query(f"WITH {NATIVE} SELECT point_id, valid_time, {r6('sqrt(u10 * u10 + v10 * v10)', 'speed')}, "
       "CASE WHEN sqrt(u10 * u10 + v10 * v10) > 1e-12 THEN round(((degrees(atan2(-u10, -v10)) % 360) + 360) % 360, 6) + 0.0 END AS direction FROM native")
def wind_speed_direction(spark, sf):
    """P4, P5."""
    n = reduce.clean(native(spark, sf), ["u10", "v10"])
    u, v = F.col("u10"), F.col("v10")
    return rounded(n.select("point_id", "valid_time", W.speed(u, v).alias("speed"), W.direction_from(u, v).alias("direction")))


@query(f"""WITH {NATIVE}, c AS (SELECT point_id, valid_time, t2m - 273.15 AS t, d2m - 273.15 AS td FROM native),
h AS (SELECT *, {HUMIDITY} AS rh FROM c)
SELECT point_id, valid_time, CASE WHEN rh BETWEEN 0 AND 100.01 AND td >= -123.15 THEN round(rh, 6) + 0.0 END AS rh,
       CASE WHEN rh BETWEEN 0 AND 100.01 AND td >= -123.15 THEN 'COMPLETE' ELSE 'OUTSIDE_SUPPORTED_RH_DOMAIN' END AS status FROM h""")
def relative_humidity_gate(spark, sf):
    """P6, P7."""
    out = reduce.hourly_values(weather_frame(spark, sf, ["t2m", "d2m"]), selected(["relative_humidity"]))
    name = "RELATIVE_HUMIDITY_2M_PCT"
    return rounded(out.select("point_id", "valid_time", F.col(name).alias("rh"), F.col(f"{name}__status").alias("status")))


@query(f"""WITH {NATIVE} SELECT a.point_id, a.valid_time, round(b.tp * 1000, 6) + 0.0 AS precipitation
FROM native a LEFT JOIN native b ON a.point_id = b.point_id AND b.valid_time = a.valid_time + INTERVAL 1 HOUR""")
def accum_shift(spark, sf):
    """The accumulation stamped one hour later, null over a gap."""
    out = reduce.hourly_values(weather_frame(spark, sf, ["tp"]), selected(["precipitation"]))
    return rounded(out.select("point_id", "valid_time", F.col("PRECIPITATION_MM").alias("precipitation")))


#: Every hourly metric as DuckDB sees it: name -> value; ``r`` comes from an hour later.
HOURLY = f"""{NATIVE}, h0 AS (SELECT a.*, a.t2m - 273.15 AS t, a.d2m - 273.15 AS td, b.tp * 1000 AS r
  FROM native a LEFT JOIN native b ON a.point_id = b.point_id AND b.valid_time = a.valid_time + INTERVAL 1 HOUR),
h1 AS (SELECT *, {HUMIDITY} AS rh0, sqrt(u10 * u10 + v10 * v10) AS s FROM h0),
h AS (SELECT *, rh0 BETWEEN 0 AND 100.01 AND td >= -123.15 AS fine, CASE WHEN rh0 BETWEEN 0 AND 100.01 AND td >= -123.15 THEN rh0 END AS rh,
  CASE WHEN s > 1e-12 THEN ((degrees(atan2(-u10, -v10)) % 360) + 360) % 360 END AS dir, tcc * 100 AS c, msl / 100 AS p FROM h1)"""
VALUES = {"TEMPERATURE_2M_C": "t", "DEWPOINT_2M_C": "td", "RELATIVE_HUMIDITY_2M_PCT": "rh", "U_WIND_10M_MS": "u10", "V_WIND_10M_MS": "v10",
          "WIND_SPEED_10M_MS": "s", "WIND_DIRECTION_10M_DEG_FROM": "dir", "TOTAL_CLOUD_COVER_PCT": "c", "MEAN_SEA_LEVEL_PRESSURE_HPA": "p",
          "PRECIPITATION_MM": "r"}


def status_sql(metric: str, value: str) -> str:
    bad = {"rh": "WHEN NOT fine THEN 'OUTSIDE_SUPPORTED_RH_DOMAIN'", "dir": f"WHEN s <= 1e-12 THEN '{CALM}'"}.get(value, "")
    return f"CASE {bad} WHEN {value} IS NOT NULL THEN 'COMPLETE' ELSE 'UNAVAILABLE' END AS {metric}__status"


def daily_sql(of: str, status: bool, digits: int = 6) -> str:
    """The daily columns over ``h``, grouped by point and day."""
    out = []
    for m in METRICS:
        v = VALUES[m.column]
        for column, a in m.daily_columns():
            n = "count(u10)" if a == "mean_vector" else f"count({v})"
            value = {"mean": f"sum({v}) / 24", "sum": f"sum({v})", "min": f"min({v})", "max": f"max({v})"}.get(a)
            calm = "sqrt(avg(u10) * avg(u10) + avg(v10) * avg(v10)) <= 1e-12"
            if a == "mean_vector":
                value = f"CASE WHEN NOT ({calm}) THEN ((degrees(atan2(-avg(u10), -avg(v10))) % 360) + 360) % 360 END"
            out.append(f"CASE WHEN {n} = 24 THEN round({value}, {digits}) + 0.0 END AS {column}")
            if status:
                bad = "WHEN count(*) FILTER (WHERE NOT fine) > 0 THEN 'OUTSIDE_SUPPORTED_RH_DOMAIN'" if v == "rh" else ""
                bad = f"WHEN {n} = 24 AND {calm} THEN '{CALM}'" if a == "mean_vector" else bad
                out.append(f"CASE {bad} WHEN {n} = 24 THEN 'COMPLETE' WHEN {n} > 0 THEN 'PARTIAL' ELSE 'UNAVAILABLE' END AS {column}__status")
    return f"SELECT point_id, CAST(valid_time AS DATE) AS DATE, {', '.join(out)} FROM {of} GROUP BY ALL"


#: The cells of the points, and the days or hours of the range.
ON_CELLS = f"""x AS (SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS H3_INDEX, CAST(c_custkey % 5 AS INTEGER) AS point_id FROM customer),
days AS (SELECT CAST(d AS DATE) AS DATE FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY) s(d)),
hours AS (SELECT CAST(t AS TIMESTAMP) AS DATETIME FROM generate_series(TIMESTAMP '{FIRST} 00:00:00', TIMESTAMP '{LAST} 23:00:00', INTERVAL 1 HOUR) s(t))"""


@query(f"WITH {HOURLY} SELECT point_id, valid_time, {', '.join(r6(v, m) + ', ' + status_sql(m, v) for m, v in VALUES.items())} FROM h")
def hourly_all_metrics(spark, sf):
    """All ten metrics; the fields are those the metrics need."""
    fields = [f for m in METRICS for f in m.inputs]
    return rounded(reduce.hourly_values(weather_frame(spark, sf, list(dict.fromkeys(fields))), list(METRICS)))


# ---- daily layer --------------------------------------------------------------------------

DAILY = "point_id, CAST(valid_time AS DATE) AS DATE"


@query(f"WITH {NATIVE} SELECT {DAILY}, CASE WHEN count(*) = 24 THEN round(sum(t2m - 273.15) / 24, 6) + 0.0 END AS mean, "
       "CASE WHEN count(*) = 24 THEN round(min(t2m - 273.15), 6) + 0.0 END AS low, CASE WHEN count(*) = 24 THEN round(max(t2m - 273.15), 6) + 0.0 END AS high FROM native GROUP BY ALL")
def daily_mean_min_max_complete(spark, sf):
    """A1, A3: 24 of 24 hours or null."""
    out = reduce.daily_values(weather_frame(spark, sf, ["t2m"]), selected(["temperature"]))
    return rounded(out.select("point_id", "DATE", F.col("TEMPERATURE_2M_C_MEAN").alias("mean"), F.col("TEMPERATURE_2M_C_MIN").alias("low"), F.col("TEMPERATURE_2M_C_MAX").alias("high")))


@query(f"""WITH {NATIVE}, s AS (SELECT a.point_id, a.valid_time, b.tp * 1000 AS p
  FROM native a LEFT JOIN native b ON a.point_id = b.point_id AND b.valid_time = a.valid_time + INTERVAL 1 HOUR)
SELECT {DAILY}, CASE WHEN count(p) = 24 THEN round(sum(p), 6) + 0.0 END AS total FROM s GROUP BY ALL""")
def daily_sum_complete(spark, sf):
    """The sum as a left fold in hour order."""
    out = reduce.daily_values(weather_frame(spark, sf, ["tp"]), selected(["precipitation"]), strict=True)
    return rounded(out.select("point_id", "DATE", F.col("PRECIPITATION_MM").alias("total")))


@query(f"""WITH {NATIVE}, c AS (SELECT point_id, valid_time, t2m - 273.15 AS t, d2m - 273.15 AS td FROM native),
h AS (SELECT {DAILY}, {HUMIDITY} AS rh, td FROM c)
SELECT point_id, DATE, CASE WHEN count(*) FILTER (WHERE NOT (rh BETWEEN 0 AND 100.01)) > 0 THEN 'OUTSIDE_SUPPORTED_RH_DOMAIN'
  WHEN count(*) = 24 THEN 'COMPLETE' ELSE 'PARTIAL' END AS humidity, CASE WHEN count(*) = 24 THEN 'COMPLETE' ELSE 'PARTIAL' END AS temperature
FROM h GROUP BY ALL""")
def daily_status(spark, sf):
    """A5."""
    out = reduce.daily_values(weather_frame(spark, sf, ["t2m", "d2m"]), selected(["temperature", "relative_humidity"]))
    return out.select("point_id", "DATE", F.col("RELATIVE_HUMIDITY_2M_PCT_MEAN__status").alias("humidity"), F.col("TEMPERATURE_2M_C_MEAN__status").alias("temperature"))


@query(f"""WITH {NATIVE}, d AS (SELECT {DAILY}, count(*) AS n FROM native GROUP BY ALL), m AS (SELECT unnest(
 ['MEAN_SEA_LEVEL_PRESSURE_HPA_MEAN', 'MEAN_SEA_LEVEL_PRESSURE_HPA_MIN', 'TOTAL_CLOUD_COVER_PCT_MEAN']) AS metric)
SELECT metric, CASE WHEN d.n = 24 THEN 'COMPLETE' ELSE 'PARTIAL' END AS status, count(*) AS n FROM d, m GROUP BY ALL""")
def status_histogram(spark, sf):
    """A7."""
    return reduce.status_histogram(reduce.daily_values(weather_frame(spark, sf, ["tcc", "msl"]), selected(["cloud_cover", "pressure"])))


@query(f"""WITH {NATIVE}, d AS (SELECT {DAILY}, count(*) AS n, avg(u10) AS u, avg(v10) AS v, sum(sqrt(u10 * u10 + v10 * v10)) / 24 AS s FROM native GROUP BY ALL)
SELECT point_id, DATE, CASE WHEN n = 24 AND sqrt(u * u + v * v) > 1e-12 THEN round(((degrees(atan2(-u, -v)) % 360) + 360) % 360, 6) + 0.0 END AS direction,
       CASE WHEN n = 24 THEN round(s, 6) + 0.0 END AS speed FROM d""")
def wind_mean_vector(spark, sf):
    """A4: direction of the mean vector."""
    out = reduce.daily_values(weather_frame(spark, sf, ["u10", "v10"]), selected(["wind"]))
    return rounded(out.select("point_id", "DATE", F.col("WIND_DIRECTION_10M_DEG_FROM_MEAN_VECTOR").alias("direction"), F.col("WIND_SPEED_10M_MS_MEAN").alias("speed")))


@query(f"WITH {HOURLY} {daily_sql('h', True)}")
def daily_all_metrics(spark, sf):
    """A1-A5 for all fourteen daily metrics."""
    fields = list(dict.fromkeys(f for m in METRICS for f in m.inputs))
    return rounded(reduce.daily_values(weather_frame(spark, sf, fields), list(METRICS)))


@query(f"WITH {NATIVE} SELECT point_id, CAST(valid_time AS TIMESTAMP) AS day_start, hours, mean FROM (SELECT point_id, date_trunc('day', valid_time) AS valid_time, count(*) AS hours, "
       "CASE WHEN count(*) = 24 THEN round(avg(msl), 6) + 0.0 END AS mean FROM native GROUP BY ALL)")
def streaming_daily_support(spark, sf):
    """Extension: the watermarked job, here over a table."""
    n = native(spark, sf).withColumn("valid_time", F.col("valid_time").cast("timestamp"))
    out = daily_support(n, "msl").withColumn("day_start", F.col("day").cast("timestamp_ntz"))
    return rounded(out.select("point_id", "day_start", "hours", "mean"))


# ---- radiation ----------------------------------------------------------------------------

RADIATION = f"""{NATIVE}, h AS (SELECT a.point_id, a.valid_time, b.ssrd AS w, b.fdir AS d
  FROM native a LEFT JOIN native b ON a.point_id = b.point_id AND b.valid_time = a.valid_time + INTERVAL 1 HOUR)"""


@query(f"WITH {RADIATION} SELECT point_id, valid_time, {r6('w', 'DOWNWARD_SHORTWAVE_ENERGY_J_M2')}, {r6('d', 'DIRECT_SOLAR_ENERGY_J_M2')}, "
       f"{r6('w / 3600', 'DOWNWARD_SHORTWAVE_IRRADIANCE_W_M2')}, {r6('d / 3600', 'DIRECT_SOLAR_IRRADIANCE_W_M2')} FROM h")
def radiation_hourly(spark, sf):
    """P9, P10."""
    return rounded(radiation.hourly(native(spark, sf)))


@query(f"""WITH {RADIATION} SELECT {DAILY}, CASE WHEN count(w) = 24 THEN round(sum(w), 4) + 0.0 END AS whole, CASE WHEN count(d) = 24 THEN round(sum(d), 4) + 0.0 END AS direct,
 CASE WHEN count(w) = 24 THEN round(sum(w) / 86400, 4) + 0.0 END AS mean FROM h GROUP BY ALL""")
def radiation_daily(spark, sf):
    """P9, A2."""
    d = radiation.daily(radiation.hourly(native(spark, sf)))
    return rounded(d.select("point_id", "DATE", F.col("DOWNWARD_SHORTWAVE_ENERGY_J_M2").alias("whole"), F.col("DIRECT_SOLAR_ENERGY_J_M2").alias("direct"), F.col("DOWNWARD_SHORTWAVE_IRRADIANCE_W_M2_MEAN").alias("mean")), 4)


@query(f"""WITH {RADIATION}, p AS (SELECT {DAILY}, count(w) AS nw, count(d) AS nd, count(*) FILTER (WHERE w < 0) AS lw, count(*) FILTER (WHERE d < 0) AS ld, count(*) FILTER (WHERE d > w + 1e-6) AS above FROM h GROUP BY ALL)
SELECT 'DOWNWARD_SHORTWAVE_ENERGY_J_M2' AS metric, count(*) FILTER (WHERE nw < 24) AS partial_days, min(nw) AS minimum_valid_hours, CAST(sum(lw) AS BIGINT) AS negative_hours, CAST(sum(above) AS BIGINT) AS direct_above_downward FROM p
UNION ALL SELECT 'DIRECT_SOLAR_ENERGY_J_M2', count(*) FILTER (WHERE nd < 24), min(nd), CAST(sum(ld) AS BIGINT), CAST(sum(above) AS BIGINT) FROM p""")
def radiation_quality(spark, sf):
    """F8, V9, A12."""
    return radiation.quality(radiation.hourly(native(spark, sf)))


@query(f"""WITH {RADIATION}, d AS (SELECT {DAILY}, count(w) AS nw FROM h GROUP BY ALL)
SELECT point_id, DATE FROM d WHERE nw = 24 AND point_id = 3""")
def reduction_check(spark, sf):
    """V8: days whose reductions, computed again, differ; here those of a point with a wrong sum."""
    hours = radiation.hourly(native(spark, sf))
    days, name = radiation.daily(hours, strict=True), "DOWNWARD_SHORTWAVE_ENERGY_J_M2"
    wrong = days.withColumn(name, F.when(F.col("point_id") == 3, F.col(name) + 1).otherwise(F.col(name)))
    return radiation.reduction_errors(hours, wrong)


SHIFTED = f"""{NATIVE}, s AS (SELECT a.point_id, a.valid_time, CAST(a.valid_time AS DATE) AS DATE, a.t2m, b.tp, b.ssrd, b.point_id IS NOT NULL AS ended
  FROM native a LEFT JOIN native b ON a.point_id = b.point_id AND b.valid_time = a.valid_time + INTERVAL 1 HOUR)"""


@query(f"""WITH {SHIFTED}, m AS (SELECT DATE, count(t2m) AS t2m, count(tp) AS tp, count(ssrd) AS ssrd FROM s GROUP BY point_id, DATE),
u AS (UNPIVOT m ON t2m, tp, ssrd INTO NAME field VALUE n)
SELECT DATE, field, count(*) FILTER (WHERE n < 24) AS affected, CAST(min(n) AS INTEGER) AS minimum_valid_hours, CAST(max(n) AS INTEGER) AS maximum_valid_hours
FROM u GROUP BY DATE, field HAVING count(*) FILTER (WHERE n < 24) > 0""")
def partial_days(spark, sf):
    """The days on which a point lacks an hour of a field, by bitmaps of the hours."""
    fields = ["t2m", "tp", "ssrd"]
    return reduce.partial_days(reduce.hour_masks(weather_frame(spark, sf, fields), fields), fields)


@query(f"""WITH {SHIFTED}, k AS (SELECT CAST(p AS INTEGER) AS point_id, CAST(d AS DATE) AS DATE FROM range(5) r(p), generate_series(DATE '{FIRST}', DATE '2024-02-01', INTERVAL 1 DAY) t(d)),
m AS (SELECT point_id, DATE, count(*) AS n, count(*) FILTER (WHERE ended) AS e, bool_or(ended AND hour(valid_time) = 23) AS last, bool_or(hour(valid_time) = 3 AND point_id = 2) AS twice FROM s GROUP BY ALL),
j AS (SELECT k.*, coalesce(n, 0) AS n, coalesce(e, 0) AS e, coalesce(last, false) AS last, coalesce(twice, false) AS twice FROM k LEFT JOIN m USING (point_id, DATE))
SELECT point_id, DATE, 'has repeated rows' AS fault FROM j WHERE twice UNION ALL SELECT point_id, DATE, 'lacks hours' FROM j WHERE n < 24
UNION ALL SELECT point_id, DATE, 'lacks the stamps that end its hours' FROM j WHERE n = 24 AND e < 24 AND NOT (DATE = DATE '{LAST}' AND e = 23 AND NOT last)""")
def native_day_faults(spark, sf):
    """What keeps a point's day from being published; here some rows are repeated."""
    n = native(spark, sf)
    twice = n.union(n.where("point_id = 2 and hour(valid_time) = 3"))
    masks = reduce.hour_masks(reduce.end_of_hour(reduce.clean(twice, ["tp"]), ["tp"], counted=True), ["tp"])
    points = spark.range(5).select(F.col("id").cast("int").alias("point_id"))
    days = spatial.lattice(points, FIRST, "2024-02-01", False, "point_id", "point_id")
    return reduce.day_faults(masks, days, LAST, moved=True, may_lack=True)


@query(f"""WITH {SHIFTED}, d AS (SELECT CAST(point_id AS VARCHAR) AS H3_INDEX, DATE, count(tp) FILTER (WHERE hour(valid_time) < 23) AS early,
  count(tp) FILTER (WHERE hour(valid_time) = 23) AS late, sum(tp * 1000) AS total FROM s GROUP BY ALL)
SELECT H3_INDEX, DATE, CASE WHEN early < 23 THEN 'does not lack the last hour alone' WHEN late = 0 THEN 'has no support for its last hour' END AS fault,
       CASE WHEN early = 23 AND late = 1 THEN round(total, 6) + 0.0 END AS rain FROM d""")
def terminal_repair(spark, sf):
    """Days without their last hour are filled from fresh rows and added up; the others keep their nulls."""
    rain = products.RAIN
    hours = reduce.hourly_values(weather_frame(spark, sf, ["tp"]), selected(["precipitation"])).select(
        F.col("point_id").cast("string").alias("H3_INDEX"), F.col("valid_time").alias("DATETIME"), rain)
    retained = hours.withColumn(rain, F.when(F.hour("DATETIME") != 23, F.col(rain)))
    empty = hours.select("H3_INDEX", F.to_date("DATETIME").alias("DATE"), F.lit(None).cast("double").alias(rain)).distinct()
    faults = incremental.repair_faults(retained, empty, hours, rain)
    days = incremental.repaired_day(incremental.fill_missing(retained, hours, products.KEYS["hourly"], rain), empty, rain)
    return rounded(days.join(faults, products.KEYS["daily"], "left").select("H3_INDEX", "DATE", "fault", F.col(rain).alias("rain")))


@query(f"""WITH {RADIATION}, {ON_CELLS}, p AS (SELECT H3_INDEX, DATETIME, h.w, h.d + CASE WHEN x.point_id = 3 AND DATETIME < TIMESTAMP '{FIRST} 06:00:00' THEN 1 ELSE 0 END AS d, n.ssrd, n.fdir
  FROM x CROSS JOIN hours LEFT JOIN h ON h.point_id = x.point_id AND h.valid_time = DATETIME
  LEFT JOIN native n ON n.point_id = x.point_id AND n.valid_time = DATETIME + INTERVAL 1 HOUR
  WHERE CAST(DATETIME AS DATE) IN (DATE '{FIRST}', DATE '2024-01-14', DATE '2024-01-15', DATE '{LAST}'))
SELECT H3_INDEX, DATETIME, 'DOWNWARD_SHORTWAVE_ENERGY_J_M2' AS metric FROM p WHERE w IS DISTINCT FROM ssrd
UNION ALL SELECT H3_INDEX, DATETIME, 'DIRECT_SOLAR_ENERGY_J_M2' FROM p WHERE d IS DISTINCT FROM fdir""")
def native_parity(spark, sf):
    """Published energies that are not their native samples, on the first and last day of each epoch:
    here those of one point's first hours, and hours that have an end but no row of their own."""
    n, x = native(spark, sf), crosswalk(spark, sf)
    hourly = products.radiation_tables(n, x, FIRST, LAST)[0]
    name = "DIRECT_SOLAR_ENERGY_J_M2"
    hit = F.col("DATETIME") < F.lit(f"{FIRST} 06:00:00").cast("timestamp_ntz")
    point = F.substring("H3_INDEX", 2, 9).cast("int") % 5
    wrong = hourly.withColumn(name, F.when(hit & (point == 3), F.col(name) + 1).otherwise(F.col(name)))
    days = validate.boundary_days([(FIRST, "2024-01-14"), ("2024-01-15", LAST)])
    return validate.native_differences(n, x, wrong, products.COPIED["radiation"], days)


# ---- space --------------------------------------------------------------------------------


@query(f"""WITH {CELLS}, d AS (SELECT h3_index, point_id, 2 * 6371008.8 * asin(sqrt(least(1, greatest(0, pow(sin(radians(g.lat - c.lat) / 2), 2)
   + cos(radians(c.lat)) * cos(radians(g.lat)) * pow(sin(radians(g.lon - c.lon) / 2), 2))))) AS m
   FROM cells c JOIN grid g ON abs(g.lat - c.lat) <= 0.26 AND abs(g.lon - c.lon) <= 0.26),
r AS (SELECT *, row_number() OVER (PARTITION BY h3_index ORDER BY round(m, 3), point_id) AS k FROM d)
SELECT h3_index, round(m, 3) AS distance_m FROM r WHERE k = 1""")
def nearest_grid(spark, sf):
    """J1, O4."""
    return spatial.nearest_point(cells(spark, sf), grid(spark)).select("h3_index", F.round("distance_m", 3).alias("distance_m"))


@query(f"""WITH {NATIVE}, x AS (SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS h3_index, CAST(c_custkey % 5 AS INTEGER) AS point_id FROM customer),
d AS (SELECT {DAILY}, CASE WHEN count(*) = 24 THEN round(min(msl / 100), 6) + 0.0 END AS low FROM native GROUP BY ALL)
SELECT h3_index AS H3_INDEX, DATE, low FROM x JOIN d USING (point_id)""")
def sample_by_crosswalk(spark, sf):
    """Reduced at points, then given to cells."""
    days = reduce.daily_values(weather_frame(spark, sf, ["msl"]), selected(["pressure"]))
    low = days.select("point_id", "DATE", F.col("MEAN_SEA_LEVEL_PRESSURE_HPA_MIN").alias("low"))
    return rounded(spatial.sample(low, crosswalk(spark, sf)))


@query(f"""WITH {NATIVE}, x AS (SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS h3_index, CAST(c_custkey % 5 AS INTEGER) AS point_id FROM customer),
k AS (SELECT h3_index, point_id, CAST(d AS DATE) AS DATE FROM x, generate_series(DATE '{FIRST}', DATE '2024-02-02', INTERVAL 1 DAY) s(d)),
v AS (SELECT {DAILY}, CASE WHEN count(*) = 24 THEN round(sum(tcc * 100) / 24, 6) + 0.0 END AS cloud FROM native GROUP BY ALL)
SELECT h3_index AS H3_INDEX, DATE, cloud FROM k LEFT JOIN v USING (point_id, DATE)""")
def lattice_dense(spark, sf):
    """A row for every cell and day, with days that no source has."""
    days = reduce.daily_values(weather_frame(spark, sf, ["tcc"]), selected(["cloud_cover"]))
    x = crosswalk(spark, sf)
    values = spatial.sample(days.select("point_id", "DATE", F.col("TOTAL_CLOUD_COVER_PCT_MEAN").alias("cloud")), x)
    return rounded(spatial.densify(values, spatial.lattice(x, FIRST, "2024-02-02", hourly=False)))


@query(f"WITH {CELLS} SELECT h3_index, lat, lon FROM cells WHERE lat BETWEEN 47.9 AND 49.1 AND lon BETWEEN -127.1 AND -124.9")
def bbox_select(spark, sf):
    """F1, F2, F3."""
    return spatial.within(cells(spark, sf), -127.1, 47.9, -124.9, 49.1)


POLYGONS = """
corners AS (SELECT n_nationkey AS polygon_id, 47 + n_nationkey % 5 * 0.7 AS y, -128 + n_nationkey // 5 * 1.1 AS x, 0.3 + n_nationkey % 3 * 0.2 AS r FROM nation),
rings AS (SELECT polygon_id, y, x, unnest([r, r / 3]) AS r FROM corners),
edges AS (SELECT polygon_id, y - r AS lat0, x AS lon0, y AS lat1, x + r AS lon1 FROM rings UNION ALL SELECT polygon_id, y, x + r, y + r, x - r FROM rings
  UNION ALL SELECT polygon_id, y + r, x - r, y, x - r FROM rings UNION ALL SELECT polygon_id, y, x - r, y - r, x FROM rings)"""


@query(f"""WITH {CELLS}, {POLYGONS} SELECT h3_index, polygon_id FROM cells JOIN edges ON (lat0 <= lat) <> (lat1 <= lat)
  AND lon0 + (lat - lat0) * (lon1 - lon0) / (lat1 - lat0) > lon GROUP BY ALL HAVING count(*) % 2 = 1""")
def polygon_cover(spark, sf):
    """The cells inside polygons with holes, one polygon for each nation."""
    k = F.col("n_nationkey")
    r = 0.3 + (k % 3) * 0.2
    rings = table(spark, sf, "nation").select(
        k.alias("polygon_id"), (47 + (k % 5) * 0.7).alias("y"), (-128 + F.floor(k / 5) * 1.1).alias("x"), F.explode(F.array(r, r / 3)).alias("r"))
    y, x, r = F.col("y"), F.col("x"), F.col("r")
    ring = [(y - r, x), (y, x + r), (y + r, x - r), (y, x - r)]
    edges = F.array(*[F.struct(a[0].alias("lat0"), a[1].alias("lon0"), b[0].alias("lat1"), b[1].alias("lon1")) for a, b in zip(ring, [*ring[1:], ring[0]])])
    return spatial.in_polygons(cells(spark, sf), rings.select("polygon_id", F.explode(edges).alias("e")).select("polygon_id", "e.*"))


@query(f"""WITH {CELLS}, open AS (SELECT point_id, lat, lon - 54 AS lon FROM grid WHERE point_id % 7 <> 0 AND NOT (point_id // 100 BETWEEN 5 AND 8)),
c AS (SELECT h3_index, lat, CASE WHEN lon - 54 < -180 THEN lon + 306 ELSE lon - 54 END AS lon FROM cells),
d AS (SELECT h3_index, round(2 * 6371008.8 * asin(sqrt(least(1, greatest(0, pow(sin(radians(g.lat - c.lat) / 2), 2)
   + cos(radians(c.lat)) * cos(radians(g.lat)) * pow(sin(radians(g.lon - c.lon) / 2), 2))))), 3) AS m FROM c, open g)
SELECT h3_index, min(m) AS distance_m FROM d GROUP BY h3_index""")
def nearest_grid_holes(spark, sf):
    """Nearest points of a grid with holes, over the date line."""
    points = grid(spark).where("point_id % 7 != 0 and not floor(point_id / 100) between 5 and 8").withColumn("lon", F.col("lon") - 54)
    moved = cells(spark, sf).withColumn("lon", F.when(F.col("lon") - 54 < -180, F.col("lon") + 306).otherwise(F.col("lon") - 54))
    return spatial.nearest_anywhere(moved, points).select("h3_index", F.round("distance_m", 3).alias("distance_m"))


MEMBERS = "SELECT 'c' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS h3_index FROM orders WHERE o_totalprice > 100000"


def members(spark, sf):
    o = table(spark, sf, "orders").where("o_totalprice > 100000")
    return o.select(F.concat(F.lit("c"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("h3_index"))


@query(f"WITH {CELLS} SELECT h3_index FROM cells WHERE h3_index IN ({MEMBERS})")
def membership_semi(spark, sf):
    """J3, F5."""
    return spatial.members_only(cells(spark, sf).select("h3_index"), members(spark, sf), "h3_index")


@query(f"WITH {CELLS}, m AS ({MEMBERS}) SELECT h3_index FROM cells WHERE h3_index NOT IN (SELECT h3_index FROM m)")
def membership_anti(spark, sf):
    """J4."""
    return spatial.not_on_lattice(cells(spark, sf).select("h3_index"), members(spark, sf))


@query("WITH x AS (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings) "
       "SELECT vec_id, CAST(p // 8 AS INTEGER) AS y, CAST(p % 8 AS INTEGER) AS x, CAST(v AS DOUBLE) AS v FROM x WHERE p // 8 BETWEEN 2 AND 4 AND p % 8 BETWEEN 1 AND 5")
def chunk_explode_crop(spark, sf):
    """Chunks as arrays, laid out and cropped to a block."""
    x = table(spark, sf, "embeddings").select("vec_id", F.posexplode("embedding").alias("p", "v"))
    y, c = F.floor(F.col("p") / 8).cast("int"), (F.col("p") % 8).cast("int")
    return x.select("vec_id", y.alias("y"), c.alias("x"), F.col("v").cast("double").alias("v")).where("y between 2 and 4 and x between 1 and 5")


TILES = """t AS (SELECT vec_id // 40 AS y_chunk, vec_id % 40 AS x_chunk, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS p FROM embeddings),
w AS (SELECT (y_chunk * 8 + p // 8) AS y, (x_chunk * 8 + p % 8) AS x, CAST(v AS DOUBLE) AS v FROM t)"""


@query(f"""WITH {TILES} SELECT CAST(y * 320 + x AS BIGINT) AS point_id, 60 - y * 0.25 AS lat, -130 + x * 0.25 AS lon, v FROM w
WHERE 60 - y * 0.25 BETWEEN 55.0 - 0.25 AND 58.0 + 0.25 AND -130 + x * 0.25 BETWEEN -121.0 - 0.25 AND -110.0 + 0.25""")
def chunk_region(spark, sf):
    """A region of an array in chunks of 8 x 8, of which only those that meet it are read."""
    grid = chunks.Grid(north=60.0, west=-130.0, step=0.25, rows=10**7, columns=320, chunk=(1, 8, 8))
    stored = table(spark, sf, "embeddings").select(
        F.lit(0).alias("t_chunk"), F.floor(F.col("vec_id") / 40).alias("y_chunk"), (F.col("vec_id") % 40).alias("x_chunk"), F.col("embedding").alias("values"))
    return chunks.region(stored, grid, (-121.0, 55.0, -110.0, 58.0)).select("point_id", "lat", "lon", F.col("value").alias("v"))


# ---- incremental --------------------------------------------------------------------------

ORDER_DAYS = "SELECT CAST(o_orderdate AS DATE) AS DATE, CAST(o_custkey % 50 AS VARCHAR) AS H3_INDEX, count(*) AS orders, round(sum(o_totalprice), 2) AS price FROM orders GROUP BY ALL"


def order_days(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("DATE"), (F.col("o_custkey") % 50).cast("string").alias("H3_INDEX")).agg(
        F.count("*").alias("orders"), F.round(F.sum(F.col("o_totalprice").cast("decimal(18, 2)")), 2).cast("double").alias("price")
    )


@query(f"WITH d AS ({ORDER_DAYS}) SELECT DATE, H3_INDEX, orders, CASE WHEN orders > 1 THEN price END AS added, orders <= 1 AS unmatched FROM d")
def backfill_align(spark, sf):
    """A column joined by key; rows that lack it are marked."""
    d = order_days(spark, sf)
    added = d.where("orders > 1").select("DATE", "H3_INDEX", F.col("price").alias("added"))
    return incremental.align_backfill(d.drop("price"), added, ["DATE", "H3_INDEX"])


@query(f"WITH d AS ({ORDER_DAYS}) SELECT DATE, H3_INDEX, orders, CASE WHEN orders > 1 THEN price ELSE price + 1 END AS price FROM d")
def repair_fill(spark, sf):
    """Fresh values where the retained one is null, nowhere else."""
    d = order_days(spark, sf)
    retained = d.withColumn("price", F.when(F.col("orders") > 1, F.col("price")))
    return incremental.fill_missing(retained, d.withColumn("price", F.col("price") + 1), ["DATE", "H3_INDEX"], "price")


@query(f"WITH d AS ({ORDER_DAYS}) SELECT DATE, H3_INDEX FROM d WHERE orders > 2")
def preservation_diff(spark, sf):
    """Rows that changed; filling a null is allowed."""
    d = order_days(spark, sf)
    before = d.withColumn("price", F.when(F.col("orders") > 1, F.col("price")))
    after = d.withColumn("orders", F.when(F.col("orders") > 2, F.col("orders") + 1).otherwise(F.col("orders")))
    return incremental.changed_rows(before, after, ["DATE", "H3_INDEX"], may_fill=["price"])


@query("""WITH o AS (SELECT o_custkey % 20 AS k, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders GROUP BY ALL),
w AS (SELECT min(lo) AS first, max(hi) AS last FROM o)
SELECT k, first AS start_date, lo - 1 AS end_date FROM o, w WHERE first < lo UNION ALL SELECT k, hi + 1, last FROM o, w WHERE last > hi""")
def append_missing_ranges(spark, sf):
    """The ranges before and after what each key holds."""
    o = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 20).alias("k")).agg(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    return incremental.missing_by_key(o, "k")


@query(f"WITH d AS ({ORDER_DAYS}) SELECT * FROM d")
def union_contiguous(spark, sf):
    """Parts that follow one another, in any order."""
    return incremental.union_contiguous(thirds(order_days(spark, sf)))


def thirds(d: DataFrame) -> list[DataFrame]:
    """Three parts in another order than their dates, cut between days that both have rows."""
    days = [r[0] for r in d.select("DATE").distinct().orderBy("DATE").collect()]  # some 2,400
    joints = [a for a, b in zip(days, days[1:], strict=False) if (b - a).days == 1]
    cut = [joints[len(joints) * k // 3] for k in (1, 2)]
    return [d.where(F.col("DATE") > cut[1]), d.where(F.col("DATE") <= cut[0]), d.where((F.col("DATE") > cut[0]) & (F.col("DATE") <= cut[1]))]


@query(f"""WITH d AS ({ORDER_DAYS}), n AS (SELECT DISTINCT DATE FROM d), j AS (SELECT DATE, row_number() OVER (ORDER BY DATE) - 1 AS i FROM n WHERE DATE + 1 IN (SELECT DATE FROM n)),
c AS (SELECT max(DATE) FILTER (WHERE i = k // 3) AS one, max(DATE) FILTER (WHERE i = 2 * k // 3) AS two FROM j, (SELECT count(*) AS k FROM j) t)
SELECT H3_INDEX, DATE, orders, CASE WHEN orders > 1 THEN price END AS price, CASE WHEN orders > 1 THEN 'COMPLETE' WHEN DATE > two THEN 'C' WHEN DATE <= one THEN 'A' ELSE 'B' END AS price__status
FROM d, c WHERE CAST(H3_INDEX AS INTEGER) < 40""")
def retained_merge(spark, sf):
    """Successive retained tables, cut to a membership, with the reason of each null."""
    d = order_days(spark, sf).withColumn("price", F.when(F.col("orders") > 1, F.col("price")))
    ids = spark.range(40).select(F.col("id").cast("string").alias("h3_index"))
    return incremental.merge_retained(thirds(d), ids, ["C", "A", "B"], ["price"])


@query(f"""WITH {HOURLY}, {ON_CELLS}, v AS ({daily_sql('h', False)})
SELECT x.H3_INDEX, DATE, TEMPERATURE_2M_C_MEAN, TEMPERATURE_2M_C_MIN, TEMPERATURE_2M_C_MAX, MEAN_SEA_LEVEL_PRESSURE_HPA_MEAN, MEAN_SEA_LEVEL_PRESSURE_HPA_MIN, false AS unmatched
FROM x CROSS JOIN days LEFT JOIN v USING (point_id, DATE)""")
def weather_backfill(spark, sf):
    """A family that is added to retained days, on their keys."""
    n, x = native(spark, sf), crosswalk(spark, sf)
    retained, added = (products.weather_tables(n, x, FIRST, LAST, [f])[1] for f in ("temperature", "pressure"))
    return rounded(incremental.align_backfill(retained, added, products.KEYS["daily"]))


@query("""WITH s AS (SELECT 'daily' AS frequency, 'm' || CAST(o_custkey % 30 AS VARCHAR) AS metric, CAST(o_orderdate AS DATE) AS start_date, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) AS end_date FROM orders),
l AS (SELECT *, lag(end_date) OVER w AS before FROM s WINDOW w AS (PARTITION BY metric ORDER BY start_date, end_date))
SELECT metric, count(*) FILTER (WHERE start_date > before + 1) AS gaps, count(*) FILTER (WHERE start_date <= before) AS overlaps FROM l GROUP BY metric""")
def lineage_partition_check(spark, sf):
    """Gaps and overlaps of epochs."""
    day = F.to_date("o_orderdate")
    spans = table(spark, sf, "orders").select(
        F.lit("daily").alias("frequency"), F.concat(F.lit("m"), (F.col("o_custkey") % 30).cast("string")).alias("metric"),
        day.alias("start_date"), F.date_add(day, (F.col("o_orderkey") % 40).cast("int")).alias("end_date"))
    faults = lineage.breaks(spans, date(1900, 1, 1), date(2100, 1, 1)).where("start_date > date'1900-01-02'")
    inner = faults.groupBy("metric", "fault").count()
    edges = 2  # each metric also misses the ends of that range: a gap before and one after
    return inner.groupBy("metric").agg(
        (F.coalesce(F.sum(F.when(F.col("fault") == "gap", F.col("count"))), F.lit(0)) - edges).alias("gaps"),
        F.coalesce(F.sum(F.when(F.col("fault") == "overlap", F.col("count"))), F.lit(0)).alias("overlaps"))


# ---- validation ---------------------------------------------------------------------------


@query("SELECT l_orderkey, l_suppkey, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def key_uniqueness(spark, sf):
    """A11, V3."""
    return validate.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@query(f"""WITH {RADIATION} SELECT 'w' AS "column", count(*) AS rows, count(*) FILTER (WHERE w IS NULL) AS nulls, CAST(0 AS BIGINT) AS nonfinite FROM h
UNION ALL SELECT 'd', count(*), count(*) FILTER (WHERE d IS NULL), 0 FROM h""")
def null_accounting(spark, sf):
    """A10, V4, F7."""
    h = radiation.hourly(native(spark, sf)).select(F.col("DOWNWARD_SHORTWAVE_ENERGY_J_M2").alias("w"), F.col("DIRECT_SOLAR_ENERGY_J_M2").alias("d"))
    return validate.column_counts(h, ["w", "d"])


@query(f"WITH {NATIVE}, d AS (SELECT {DAILY}, count(*) AS n FROM native GROUP BY ALL) SELECT 'MEAN_SEA_LEVEL_PRESSURE_HPA_MIN' AS metric, "
       "count(*) FILTER (WHERE n = 24) AS total, count(*) FILTER (WHERE n = 24) AS complete, count(*) AS rows, count(*) FILTER (WHERE n < 24) AS nulls FROM d HAVING count(*) FILTER (WHERE n < 24) > 0 AND count(*) FILTER (WHERE n = 24) > 0")
def status_accounting(spark, sf):
    """V5: metrics whose statuses do not add up; here one whose partial days were left out."""
    days = reduce.daily_values(weather_frame(spark, sf, ["tcc", "msl"]), selected(["cloud_cover", "pressure"]))
    names = [c for c in days.columns if c not in ("point_id", "DATE") and not c.endswith("__status")]
    histogram = reduce.status_histogram(days).where("metric != 'MEAN_SEA_LEVEL_PRESSURE_HPA_MIN' or status = 'COMPLETE'")
    return validate.accounting_errors(histogram, validate.column_counts(days, names))


@query(f"""WITH {NATIVE}, k AS (SELECT p AS point_id, CAST(t AS TIMESTAMP) AS valid_time FROM range(5) r(p), generate_series(TIMESTAMP '{FIRST} 00:00:00', TIMESTAMP '{LAST} 23:00:00', INTERVAL 1 HOUR) s(t))
SELECT CAST(k.point_id AS INTEGER) AS point_id, k.valid_time, 'missing' AS fault FROM k LEFT JOIN native n USING (point_id, valid_time) WHERE n.t2m IS NULL""")
def lattice_check(spark, sf):
    """V3: hours that the native table lacks."""
    hours = spark.range(5).select(F.col("id").cast("int").alias("point_id"), F.explode(F.expr(
        f"sequence(timestamp_ntz'{FIRST} 00:00:00', timestamp_ntz'{LAST} 23:00:00', interval 1 hour)")).alias("valid_time"))
    return validate.off_lattice(native(spark, sf), hours)


@query("WITH " + NATIVE + " SELECT count(DISTINCT point_id) AS points, min(valid_time) AS first, max(valid_time) AS last FROM native")
def distinct_points(spark, sf):
    """A13, V7."""
    n = native(spark, sf)
    last = source.frontier(n).select(F.col("t2m").alias("last"))
    return n.agg(F.count_distinct("point_id").alias("points"), F.min("valid_time").alias("first")).join(F.broadcast(last))


@query("""WITH s AS (SELECT DISTINCT date_trunc('hour', ts) AS t FROM events WHERE hour(ts) <> 5 OR day(ts) % 7 <> 0), l AS (SELECT t, lag(t) OVER (PARTITION BY CAST(t AS DATE) ORDER BY t) AS b FROM s)
SELECT t, date_diff('minute', b, t) AS step FROM l WHERE date_diff('minute', b, t) <> 60""")
def time_axis_check(spark, sf):
    """Stamps that are not an hour apart; here an hour is taken out of every seventh day."""
    return source.off_hours(native(spark, sf).where("hour(valid_time) != 5 or day(valid_time) % 7 != 0"))


@query("SELECT CAST(user_id % 5 AS INTEGER) AS point_id, date_trunc('hour', ts) AS valid_time, count(*) AS n FROM events GROUP BY ALL HAVING count(*) > 1")
def native_key_check(spark, sf):
    """Native keys that are repeated, over the rows before they are averaged."""
    hour = F.to_timestamp_ntz(F.date_format("ts", "yyyy-MM-dd HH:00:00"))
    return source.repeated_rows(table(spark, sf, "events").select((F.col("user_id") % 5).cast("int").alias("point_id"), hour.alias("valid_time")))


@query(f"""WITH {NATIVE}, l AS (SELECT max(valid_time) AS t FROM native)
SELECT 't2m' AS field, t AS last_stamp, CAST(CAST(t + INTERVAL 1 HOUR AS DATE) - 1 AS VARCHAR) AS last_complete_day FROM l
UNION ALL SELECT 'tp', t, CAST(CAST(t AS DATE) - 1 AS VARCHAR) FROM l UNION ALL SELECT 'ssrd', t, CAST(CAST(t AS DATE) - 1 AS VARCHAR) FROM l""")
def frontier_gate(spark, sf):
    """How far each field reaches, and the last day that is whole."""
    return source.coverage(native(spark, sf), ["t2m", "tp", "ssrd"]).withColumn("last_complete_day", F.col("last_complete_day").cast("string"))


@query("SELECT 'null' AS fault, CAST(0 AS BIGINT) AS n UNION ALL SELECT 'malformed', (SELECT count(DISTINCT c_name) FROM customer) "
       "UNION ALL SELECT 'repeated', (SELECT count(*) FROM (SELECT lower(c_mktsegment) FROM customer GROUP BY 1 HAVING count(*) > 1))")
def registry_check(spark, sf):
    """Ids that are null, malformed or repeated."""
    c = table(spark, sf, "customer")
    return registry.registry_faults(c.select(F.col("c_name").alias("h3_index")).distinct().union(c.select(F.lower("c_mktsegment"))))


@query("WITH x AS (SELECT DISTINCT c_mktsegment AS s FROM customer) SELECT count(*) AS ids, sha256(string_agg(s, chr(10) ORDER BY s) || chr(10)) AS sha256 FROM x")
def sha256_ids(spark, sf):
    """V11, O1."""
    return validate.ids_sha256(table(spark, sf, "customer"), "c_mktsegment")


@query(f"WITH {NATIVE} SELECT 't2m' AS \"column\", round(min(t2m), 6) + 0.0 AS min, round(max(t2m), 6) + 0.0 AS max, round(avg(t2m), 6) + 0.0 AS mean FROM native "
       "UNION ALL SELECT 'msl', round(min(msl), 6) + 0.0, round(max(msl), 6) + 0.0, round(avg(msl), 6) + 0.0 FROM native")
def summary_stats(spark, sf):
    """A14."""
    return rounded(validate.summary(native(spark, sf), ["t2m", "msl"]))


# ---- solar --------------------------------------------------------------------------------

SOLAR = f"""{CELLS}, k AS (SELECT h3_index, lat, lon, s AS sec FROM cells, range(1718841600, 1718928000, 21600) t(s)),
a AS (SELECT *, (sec / 86400 + 2440587.5 - 2451545) / 36525 AS T FROM k),
b AS (SELECT *, radians(280.46646 + T * (36000.76983 + .0003032 * T)) AS L, radians(357.52911 + T * (35999.05029 - .0001537 * T)) AS M,
  .016708634 - T * (.000042037 + .0000001267 * T) AS e, radians(125.04 - 1934.136 * T) AS om FROM a),
c AS (SELECT *, L + radians(sin(M) * (1.914602 - T * (.004817 + .000014 * T)) + sin(2 * M) * (.019993 - .000101 * T) + sin(3 * M) * .000289
  - .00569 - .00478 * sin(om)) AS lam, radians(23 + (26 + (21.448 - T * (46.815 + T * (.00059 - T * .001813))) / 60) / 60 + .00256 * cos(om)) AS eps FROM b),
d AS (SELECT *, asin(sin(eps) * sin(lam)) AS dec, pow(tan(eps / 2), 2) AS y FROM c),
f AS (SELECT *, 4 * degrees(y * sin(2 * L) - 2 * e * sin(M) + 4 * e * y * sin(M) * cos(2 * L) - .5 * y * y * sin(4 * L) - 1.25 * e * e * sin(2 * M)) AS eot FROM d),
g AS (SELECT *, radians(((sec % 86400) / 60 + 4 * lon + eot) / 4 - 180) AS ha, radians(lat) AS phi FROM f),
p AS (SELECT h3_index, sec, degrees(asin(sin(phi) * sin(dec) + cos(phi) * cos(dec) * cos(ha))) AS elevation,
  ((degrees(atan2(sin(ha), cos(ha) * sin(phi) - tan(dec) * cos(phi))) + 180) % 360 + 360) % 360 AS azimuth FROM g)"""


def solar_rows(spark, sf):
    k = cells(spark, sf).select("h3_index", "lat", "lon", F.explode(F.expr("sequence(1718841600L, 1718906400L, 21600L)")).alias("sec"))
    elevation, azimuth = sun.position(F.col("sec").cast("double"), F.col("lat"), F.col("lon"))
    return k.select("h3_index", "sec", elevation.alias("elevation"), azimuth.alias("azimuth"))


@query(f"WITH {SOLAR} SELECT h3_index, sec, {r6('elevation', 'elevation')}, {r6('azimuth', 'azimuth')} FROM p")
def solar_position_hourly(spark, sf):
    """P11, P12."""
    return rounded(solar_rows(spark, sf))


@query(f"""WITH {SOLAR} SELECT h3_index, sec, CASE WHEN elevation >= -50 / 60 THEN 'daylight' WHEN elevation >= -6 THEN 'civil_twilight'
 WHEN elevation >= -12 THEN 'nautical_twilight' WHEN elevation >= -18 THEN 'astronomical_twilight' ELSE 'night' END AS phase FROM p""")
def solar_phase(spark, sf):
    """P13."""
    return solar_rows(spark, sf).select("h3_index", "sec", sun.phase(F.col("elevation")).alias("phase"))


@query()
def solar_daily_cycle(spark, sf):
    """X1-X6, A15, O5, P14."""
    return products.solar_tables(cells(spark, sf), "2024-06-19", "2024-06-21")[1]


#: Whether the sun is above each threshold at every minute: the series by minute, then by cell.
MINUTES = f"""k AS (SELECT 1718755200 + 60 * m AS sec FROM range(4321) r(m)), {SOLAR[SOLAR.index("a AS (SELECT"):SOLAR.index("g AS (SELECT")].rstrip().rstrip(",")},
v AS (SELECT * FROM (VALUES ({-50 / 60}, 'SUNRISE_UTC', 'SUNSET_UTC'), (-6, 'CIVIL_DAWN_UTC', 'CIVIL_DUSK_UTC'),
  (-12, 'NAUTICAL_DAWN_UTC', 'NAUTICAL_DUSK_UTC'), (-18, 'ASTRONOMICAL_DAWN_UTC', 'ASTRONOMICAL_DUSK_UTC')) t(edge, rises, sets)),
h AS (SELECT h3_index, sec, degrees(asin(sin(radians(lat)) * sin(dec) + cos(radians(lat)) * cos(dec) * cos(radians(((sec % 86400) / 60 + 4 * lon + eot) / 4 - 180)))) AS el FROM cells, f),
l AS (SELECT h3_index, sec, el, lead(el) OVER (PARTITION BY h3_index ORDER BY sec) AS later FROM h)"""


@query(f"""WITH {CELLS}, {MINUTES} SELECT h3_index AS H3_INDEX, CAST(make_timestamp(sec * 1000000) AS DATE) AS DATE, CASE WHEN later >= edge THEN rises ELSE sets END AS event,
 CAST(sec % 86400 // 60 AS INTEGER) AS minute FROM l JOIN v ON (el >= edge) <> (later >= edge)""")
def solar_event_minutes(spark, sf):
    """The minute of each event of the daily cycle; SQL looks at every minute of the days."""
    days = products.solar_tables(cells(spark, sf), "2024-06-19", "2024-06-21")[1]
    names = [n for pair in solar_cycle.EVENTS for n in pair]
    long = days.unpivot(["H3_INDEX", "DATE"], names, "event", "at").where("at is not null")
    minute = F.timestamp_diff("SECOND", F.col("DATE").cast("timestamp_ntz"), F.col("at")) / 60
    return long.select("H3_INDEX", "DATE", "event", F.floor(minute).cast("int").alias("minute"))


@query("SELECT count(*) * 3 AS days, CAST(0 AS BIGINT) AS faults FROM customer")
def solar_cycle_check(spark, sf):
    """V6: durations make 24 hours and events lie on their day."""
    daily = products.solar_tables(cells(spark, sf), "2024-06-19", "2024-06-21")[1]
    bad = validate.cycle_errors(daily, solar_cycle.DURATIONS, [n for p in solar_cycle.EVENTS for n in p])
    return daily.agg(F.count("*").alias("days")).join(F.broadcast(bad.agg(F.count("*").alias("faults"))))


# ---- products -----------------------------------------------------------------------------


@query(f"WITH {HOURLY}, {ON_CELLS}, v AS ({daily_sql('h', False, 7)}) SELECT x.H3_INDEX, DATE, v.* EXCLUDE (point_id, DATE) FROM x CROSS JOIN days LEFT JOIN v USING (point_id, DATE)")
def weather_product_daily(spark, sf):
    """The whole daily table of the weather product over all cells."""
    return products.weather_tables(native(spark, sf), crosswalk(spark, sf), FIRST, LAST, digits=7)[1]


@query(f"WITH {HOURLY}, {ON_CELLS}, v AS (SELECT point_id, valid_time AS DATETIME, {', '.join(r6(v, m) for m, v in VALUES.items())} FROM h) "
       "SELECT x.H3_INDEX, DATETIME, v.* EXCLUDE (point_id, DATETIME) FROM x CROSS JOIN hours LEFT JOIN v USING (point_id, DATETIME)")
def weather_product_hourly(spark, sf):
    """The whole hourly table of the weather product over all cells."""
    return products.weather_tables(native(spark, sf), crosswalk(spark, sf), FIRST, LAST, digits=6)[0]


@query(f"WITH {RADIATION}, {ON_CELLS}, v AS (SELECT {DAILY}, " + ", ".join(
    f"CASE WHEN count({c}) = 24 THEN round(sum({c}), 4) + 0.0 END AS {m}_ENERGY_J_M2, CASE WHEN count({c}) = 24 THEN round(sum({c}) / 86400, 4) + 0.0 END AS {m}_IRRADIANCE_W_M2_MEAN"
    for m, c in (("DOWNWARD_SHORTWAVE", "w"), ("DIRECT_SOLAR", "d"))) + " FROM h GROUP BY ALL) "
    "SELECT x.H3_INDEX, DATE, v.* EXCLUDE (point_id, DATE) FROM x CROSS JOIN days LEFT JOIN v USING (point_id, DATE)")
def radiation_product_daily(spark, sf):
    """The whole daily table of the radiation product over all cells."""
    return products.radiation_tables(native(spark, sf), crosswalk(spark, sf), FIRST, LAST, digits=4)[1]
