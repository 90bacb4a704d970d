"""Days from a stream of native rows that come late and out of order."""

import datetime as dt
import random

from pyspark.sql import functions as F

from aerolith.operators import reduce
from aerolith.streaming.arrivals import whole_days

START = dt.datetime(2024, 6, 20)
SCHEMA = "valid_time timestamp, point_id int, t2m double, tp double"


def test_days_come_when_their_last_stamp_does(spark, tmp_path):
    rows = [(START + dt.timedelta(hours=h), p, 280.0 + h, None if h == 30 else 0.001 * h + p) for h in range(73) for p in (0, 1)]
    random.Random(1).shuffle(rows)
    late = [r for r in rows if r[0] == START + dt.timedelta(hours=24) or (r[0].day == 21 and r[0].hour == 7 and r[1] == 1)]
    source, out, state = (str(tmp_path / x) for x in ("source", "out", "state"))

    def arrive(batch):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = whole_days(spark.readStream.schema(SCHEMA).parquet(source), ["t2m", "tp"])
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        assert query.awaitTermination(240)
        got = spark.read.parquet(out)
        return sorted({(r["point_id"], r["day"].day) for r in got.select("point_id", F.to_date("valid_time").alias("day")).collect()})

    assert arrive([r for r in rows if r not in late]) == [(0, 22), (1, 22)]  # the others lack a stamp
    assert arrive(late[:1] + [r for r in rows if r not in late][:5]) != [] and arrive(late) == [(p, d) for p in (0, 1) for d in (20, 21, 22)]
    want = reduce.end_of_hour(reduce.clean(spark.createDataFrame(rows, SCHEMA), ["t2m", "tp"]), ["t2m", "tp"])
    want = want.where(F.col("valid_time") < F.lit(START + dt.timedelta(hours=72)))
    got = spark.read.parquet(out).select(*want.columns)
    assert got.count() == 144 and got.exceptAll(want).count() == 0
