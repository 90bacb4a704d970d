"""Days that become whole as their native rows arrive, in any order and late."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.weather import finite
from ..operators.reduce import HOURS
from ..specs import ACCUMULATED


def whole_days(stream: DataFrame, fields: Sequence[str], lateness: str = "5 days") -> DataFrame:
    """``point_id, valid_time, <fields>`` of each point's day, given out once, when the last
    of the stamps that it needs has come: its 24 hours and, where a field is accumulated,
    the midnight after them, whose value belongs to the hour before.

    Rows are what ``reduce.end_of_hour`` gives of the same day, so a day that was published
    without its last hour can be made again from them as soon as that hour is there.
    The state of a day, 25 stamps, is kept until it is given out or its midnight lies
    ``lateness`` behind the latest stamp; a stamp that comes twice counts once, the first."""
    fields = list(fields)
    moved = [f for f in fields if f in ACCUMULATED]
    need = HOURS + bool(moved)
    t = F.col("valid_time")
    day = F.date_trunc("DAY", t)
    own = F.struct(day.alias("day"), F.hour(t).alias("stamp"))
    before = F.struct((day - F.expr("interval 1 day")).alias("day"), F.lit(HOURS).alias("stamp"))
    places = F.when((F.hour(t) == 0) & F.lit(bool(moved)), F.array(own, before)).otherwise(F.array(own))
    dealt = (
        stream.where((F.minute(t) == 0) & (F.second(t) == 0)).withWatermark("valid_time", lateness)
        .select("point_id", "valid_time", F.explode(places).alias("p"), *[finite(F.col(f)).alias(f) for f in fields])
        .select("point_id", "valid_time", F.col("p.day").alias("day"), F.col("p.stamp").alias("stamp"), *fields)
    )
    width = len(fields)

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, flat = state.get if state.exists else (0, [float("nan")] * (width * (HOURS + 1)))
        if seen == -1:  # given out already
            return
        values = np.array(flat).reshape(HOURS + 1, width)
        for rows in batches:
            for stamp, *row in rows[["stamp", *fields]].itertuples(index=False):
                if not seen >> stamp & 1:
                    seen |= 1 << stamp
                    values[stamp] = row
        if seen.bit_count() == need:
            out = pd.DataFrame({"point_id": [key[0]] * HOURS, "valid_time": pd.Timestamp(key[1]) + pd.to_timedelta(np.arange(HOURS), "h")})
            for k, f in enumerate(fields):
                column = values[1:, k] if f in moved else values[:HOURS, k]
                out[f] = pd.array([None if np.isnan(v) else v for v in column], "Float64")
            seen, flat = -1, []
            yield out
        else:
            flat = values.reshape(-1).tolist()
        state.update((seen, flat))
        late = pd.Timestamp(key[1]) + pd.Timedelta(days=2)
        state.setTimeoutTimestamp(max(int(late.value // 10**6), state.getCurrentWatermarkMs() + 1))

    point = dealt.schema["point_id"].dataType.simpleString()
    return dealt.groupBy("point_id", "day").applyInPandasWithState(
        run, f"point_id {point}, valid_time timestamp, " + ", ".join(f"{f} double" for f in fields), "seen long, flat array<double>", "append",
        GroupStateTimeout.EventTimeTimeout,
    )
