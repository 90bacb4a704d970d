"""The weather, solar-radiation and solar-cycle products.

A run computes the days, or the families, that are missing and writes them as a new
generation; the catalog, written last, says which generation holds each day."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import solar as sun
from ..operators import incremental, lineage, radiation, reduce, solar_cycle, spatial, validate
from ..sources import manifest, registry
from ..sources import native as source
from ..specs import ACCUMULATED, CALM, COMPLETE, FAMILIES, OUTSIDE_RH, PARTIAL, UNAVAILABLE, inputs_of, selected


def on_cells(values: DataFrame, crosswalk: DataFrame, start: str, end: str, hourly: bool, digits: int | None = None) -> DataFrame:
    """Values at points, dense over the range, given to the cells of each point.

    The lattice is laid over the points, which are few; the one join at the size of
    cells x hours is that with the crosswalk.  ``digits`` rounds the values at the points,
    once for all their cells."""
    if digits is not None:
        values = reduce.rounded(values, digits)
    points = crosswalk.select("point_id").distinct()
    keys = spatial.lattice(points, start, end, hourly, "point_id", "point_id")
    return spatial.sample(spatial.densify(values, keys), crosswalk)


def within_days(frame: DataFrame, start: str, end: str) -> DataFrame:
    return frame.where(F.to_date("valid_time").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def stamped(frame: DataFrame) -> DataFrame:
    return frame.withColumnRenamed("valid_time", "DATETIME")


def weather_tables(native: DataFrame, crosswalk: DataFrame, start: str, end: str, families: Sequence[str] | None = None, strict: bool = True,
                   digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Dense hourly and daily tables: reduce at points, lay on the lattice, give to cells."""
    fields = inputs_of(selected(families))
    frame = reduce.end_of_hour(reduce.clean(source.utc(native), fields), fields)
    return tuple(map(reduce.values_only, weather_frames(within_days(frame, start, end), crosswalk, start, end, families, strict, digits)))


def weather_frames(frame: DataFrame, crosswalk: DataFrame, start: str, end: str, families: Sequence[str] | None, strict: bool = True,
                   digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``weather_tables`` of fields that stand at the start of their hour, with statuses."""
    metrics = selected(families)
    hours, days = stamped(reduce.hourly_values(frame, metrics)), reduce.daily_values(frame, metrics, strict)
    return on_cells(hours, crosswalk, start, end, True, digits), on_cells(days, crosswalk, start, end, False, digits)


def radiation_tables(native: DataFrame, crosswalk: DataFrame, start: str, end: str, digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    hours = within_days(radiation.hourly(source.utc(native)), start, end)
    return radiation_frames(hours, crosswalk, start, end, digits)


def radiation_frames(hours: DataFrame, crosswalk: DataFrame, start: str, end: str, digits: int | None = None) -> tuple[DataFrame, DataFrame]:
    days = radiation.daily(hours, strict=True)
    return on_cells(stamped(hours), crosswalk, start, end, True, digits), on_cells(days, crosswalk, start, end, False, digits)


def solar_tables(cells: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Hourly positions and daily cycles; computed, without any source."""
    hours = spatial.lattice(cells, start, end, hourly=True, carry=("lat", "lon"))
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("DATETIME")).cast("double")
    elevation, azimuth = sun.position(seconds, F.col("lat"), F.col("lon"))
    hourly = (
        hours.withColumn("__ok", F.assert_true(sun.in_domain(seconds, F.col("lat"), F.col("lon")), F.lit("outside the domain of the solar series")))
        .where("__ok is null")
        .select("H3_INDEX", "DATETIME", elevation.alias("SOLAR_ELEVATION_DEG"), azimuth.alias("SOLAR_AZIMUTH_DEG"))
        .withColumn("SOLAR_PHASE", sun.phase(F.col("SOLAR_ELEVATION_DEG")))
    )
    days = spatial.lattice(cells, start, end, hourly=False, carry=("lat", "lon"))
    return hourly, solar_cycle.daily_cycle(days)


#: Version of what the producers compute; a product of another version is not appended to.
PRODUCERS = {"weather": 2, "radiation": 2, "solar": 2}
KEYS = {"hourly": ["H3_INDEX", "DATETIME"], "daily": ["H3_INDEX", "DATE"]}
STATUSES = (COMPLETE, PARTIAL, UNAVAILABLE, CALM, OUTSIDE_RH)


@dataclass
class Built:
    """What a range of days, or of families, has: two tables, the days that lack hours, and
    the fields whose last day lacks the stamp that ends it."""

    hourly: DataFrame
    daily: DataFrame
    partial: list[dict] = field(default_factory=list)
    short: list[str] = field(default_factory=list)


Build = Callable[[str, str, Sequence[str] | None, bool], Built]


def region_of(cells: DataFrame) -> str:
    """Hash of the cells that a product is about."""
    return validate.ids_sha256(cells, "h3_index").first()["sha256"]


def expected_columns(name: str, families: Sequence[str] | None) -> dict[str, list[list[str]]]:
    """``[name, type, unit]`` of the columns of a product's tables, as its contract has them."""
    columns = {"hourly": [["DATETIME", "timestamp_ntz", ""]], "daily": []}
    if name == "weather":
        metrics = selected(families)
        columns["hourly"] += [[m.column, "double", m.unit] for m in metrics]
        columns["daily"] += [[c, "double", m.unit] for m in metrics for c, _ in m.daily_columns()]
    elif name == "radiation":
        for m in radiation.FIELDS.values():
            columns["hourly"] += [[f"{m}_ENERGY_J_M2", "double", "J/m2"], [f"{m}_IRRADIANCE_W_M2", "double", "W/m2"]]
            columns["daily"] += [[f"{m}_ENERGY_J_M2", "double", "J/m2"], [f"{m}_IRRADIANCE_W_M2_MEAN", "double", "W/m2"]]
    else:
        columns["hourly"] += [["SOLAR_ELEVATION_DEG", "double", "degrees"], ["SOLAR_AZIMUTH_DEG", "double", "degrees"], ["SOLAR_PHASE", "string", ""]]
        columns["daily"] += [[c, "double", "hours"] for c in solar_cycle.DURATIONS] + [[c, "timestamp_ntz", "UTC"] for pair in solar_cycle.EVENTS for c in pair]
    return {f: sorted([["H3_INDEX", "string", ""], ["DATE", "date", ""], *rows]) for f, rows in columns.items()}


def tables(spark: SparkSession, path: str, catalog: dict, start: str | None = None, end: str | None = None) -> dict[str, DataFrame]:
    """The tables that a catalog stands for, of all its days or of some."""
    days = catalog["days"]
    if start or end:
        days = manifest.clipped(days, date.fromisoformat(start or catalog["start_date"]), date.fromisoformat(end or catalog["end_date"]))
    return {f: manifest.read(spark, f"{path}/{catalog['data']}", f, KEYS[f], days, catalog["generations"]) for f in KEYS}


def counts_of(frame: DataFrame) -> dict[str, Column]:
    """Rows, and of each column nulls and statuses, as expressions to be observed."""
    out = {"rows": F.count(F.lit(1))}
    for c in frame.columns:
        if c in ("H3_INDEX", "DATE", "DATETIME") or c.endswith("__status"):
            continue
        out[f"{c}|null"] = F.count_if(F.col(c).isNull())
        if f"{c}__status" in frame.columns:
            status = F.coalesce(f"{c}__status", F.lit(UNAVAILABLE))  # where the source has no row
            out |= {f"{c}|{s}": F.count_if(status == s) for s in STATUSES}
    if "DIRECT_SOLAR_ENERGY_J_M2" in frame.columns and "DATETIME" in frame.columns:
        whole, direct = (F.col(f"{m}_ENERGY_J_M2") for m in radiation.FIELDS.values())
        out |= {f"{f}|negative": F.count_if(F.col(f"{m}_ENERGY_J_M2") < 0) for f, m in radiation.FIELDS.items()}
        out["above|count"] = F.count_if(direct > whole + 1e-6)
    return out


def totals_of(seen: dict[str, int]) -> dict:
    """``rows``, ``nulls`` by column, ``status`` by column and ``quality`` from observed counts."""
    out: dict = {"rows": seen["rows"], "nulls": {}, "status": {}, "quality": {}}
    for name, n in seen.items():
        column, _, kind = name.partition("|")
        if kind == "null":
            out["nulls"][column] = n
        elif kind in STATUSES:
            out["status"].setdefault(column, {})[kind] = n
        elif kind:
            out["quality"][name] = n
    return out


def added(a: dict, b: dict) -> dict:
    """Sums of nested counts; what only one has is taken over."""
    both = a.keys() & b.keys()
    return {**a, **b} | {k: added(a[k], b[k]) if isinstance(a[k], dict) else a[k] + b[k] for k in both}


def write_generation(built: Built, root: str, generation: str, cells: DataFrame, days: int) -> dict:
    """Writes both tables and returns their totals, counted in the writing tasks; raises
    unless every cell has all its hours and days."""
    bounds, n = source.slice_bounds(cells), cells.select("h3_index").distinct().count()
    out = {}
    for frequency, frame, each in (("hourly", built.hourly, 24), ("daily", built.daily, 1)):
        if frequency == "hourly" and "DATE" not in frame.columns:
            frame = frame.withColumn("DATE", F.to_date("DATETIME"))
        seen = source.write_days(frame, f"{root}/{frequency}/generation={generation}", bounds, counts_of(frame))
        if seen["rows"] != n * days * each:
            raise ValueError(f"the {frequency} table has {seen['rows']} rows for {n} cells and {days} days")
        out[frequency] = totals_of(seen)
    return out


@contextmanager
def stage(spark: SparkSession, frame: DataFrame, path: str) -> Iterator[DataFrame]:
    """The frame, written once: what is read more than once scans that, not the source."""
    where = f"{path}/stage/{uuid.uuid4().hex}"
    frame.write.parquet(where)
    try:
        yield spark.read.parquet(where)
    finally:
        source.remove(spark, where)


def prove_kept(before: DataFrame, after: DataFrame, keys: Sequence[str], may_fill: Sequence[str] = ()) -> None:
    """Raises unless every row of ``before`` is in ``after`` with the same values."""
    same = after.select(*before.columns).join(before.select(*keys), list(keys), "left_semi")
    lost = incremental.changed_rows(before, same, keys, may_fill).first()
    if lost:
        raise ValueError(f"a retained row would change: {lost.asDict()}")


def publish(
    spark: SparkSession, out: str, name: str, cells: DataFrame, build: Build, start: str, end: str, families: Sequence[str] | None = None,
    rebuild: bool = False, allow_incomplete_final_day: bool = False, check_covered: bool = True,
) -> dict:
    """Brings a product in ``out`` up to the range and the families; returns its catalog.

    ``build(start, end, families, may_lack)`` gives what a range has.  Days and families
    that are there are kept: days that are missing get all families, and families that
    are missing are computed for the retained days, whose other columns are not written
    again.  What is covered already is checked (``check_covered``) and left alone.  Another
    set of cells, or a product of another version of the producer, is refused.

    Every run writes generations of its own and then a new version of the catalog.
    A run that fails or is killed before leaves files that no catalog names: the product,
    as read and as checked, is what it was (``vacuum`` deletes them)."""
    path = f"{out.rstrip('/')}/{name}"
    old = None if rebuild else source.read_catalog(spark, f"{path}/catalog")
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    region = region_of(cells)
    held = None
    if old:
        if old["region"] != region:
            raise ValueError("the product is about other cells")
        if old["producer"] != PRODUCERS[name]:
            raise ValueError("the product is of another version of its producer; rebuild it")
        held = (date.fromisoformat(old["start_date"]), date.fromisoformat(old["end_date"]))
    had = old["families"] if old else None
    wanted = None if families is None else [f for f in FAMILIES if f in {*families, *(had or [])}]
    more = [f for f in wanted or [] if f not in (had or [])] if old else []
    ranges = incremental.missing_ranges(first, last, held)
    if not ranges and not more:
        if check_covered:
            refuse_faults(check_catalog(spark, path, old, cells))
        return old
    new = dict(old) if old else {
        "product": name, "producer": PRODUCERS[name], "region": region, "data": f"data-{uuid.uuid4().hex}", "days": [], "generations": {},
        "epochs": [], "partial_days": [], "partial_fields": [], "totals": {},
    }
    root = f"{path}/{new['data']}"
    steps = [(*held, more, True)] if more else []
    steps += [(lo, hi, wanted, False) for lo, hi in ranges]
    for lo, hi, names, widens in steps:
        generation = uuid.uuid4().hex
        may_lack = allow_incomplete_final_day and not (held and hi < held[1])
        # families added to a last day that is partial share its gap
        built = build(str(lo), str(hi), names, may_lack or widens and bool(old["partial_fields"]))
        totals = write_generation(built, root, generation, cells, (hi - lo).days + 1)
        if widens:
            new["days"] = manifest.widened(new["days"], generation)
            new["totals"] = {f: {**new["totals"][f], **{k: {**new["totals"][f][k], **totals[f][k]} for k in ("nulls", "status")}} for f in KEYS}
        else:
            new["days"] = manifest.replaced(new["days"], lo, hi, generation)
            new["totals"] = added(new["totals"], totals)
        new["generations"] = {**new["generations"], generation: names}
        new["epochs"] = sorted([*new["epochs"], {"start_date": str(lo), "end_date": str(hi), "families": names}], key=lambda e: (e["start_date"], str(e["families"])))
        known = {(p["date"], p["field"]) for p in new["partial_days"]}
        new["partial_days"] = sorted([*new["partial_days"], *[p for p in built.partial if (p["date"], p["field"]) not in known]], key=lambda p: (p["date"], p["field"]))
        if widens or not held or hi > held[1]:  # else the last day is not of this range
            new["partial_fields"] = sorted({*built.short, *(new["partial_fields"] if widens else [])})
    return commit(spark, path, name, new, wanted)


def commit(spark: SparkSession, path: str, name: str, catalog: dict, families: Sequence[str] | None) -> dict:
    """Writes the next version of the catalog; its range follows from its days."""
    end = date.fromisoformat(catalog["days"][-1][1])
    catalog = {
        **catalog, "families": families, "columns": expected_columns(name, families), "start_date": catalog["days"][0][0], "end_date": str(end),
        "latest_complete_day": str(end - timedelta(days=1) if catalog["partial_fields"] else end),
    }
    source.write_catalog(spark, f"{path}/catalog", catalog)
    return catalog


def prepared(spark: SparkSession, native_path: str, fields: Sequence[str], start: str, end: str) -> DataFrame:
    """The native rows of the days with accumulated fields at the start of their hour, and
    how often each key and the stamp after it are there: one scan, one aggregation."""
    native = source.read_native(spark, native_path, fields, start, end)
    return within_days(reduce.end_of_hour(reduce.clean(native, fields), fields, counted=True), start, end)


def gate(frame: DataFrame, crosswalk: DataFrame, fields: Sequence[str], start: str, end: str, may_lack: bool) -> tuple[list[dict], list[str]]:
    """The days that lack hours and the fields whose last day lacks its terminal stamp.

    Raises where a point lacks rows of a day, has them twice or off the hour, or where the
    source ends earlier: every point is held to it, not all of them together."""
    masks = reduce.hour_masks(frame, fields)
    points = crosswalk.groupBy("point_id").agg(F.count("*").alias("cells"))
    days = spatial.lattice(points.select("point_id"), start, end, False, "point_id", "point_id")
    moved = [f for f in fields if f in ACCUMULATED]
    bad = reduce.day_faults(masks, days, end, bool(moved), may_lack).orderBy("DATE", "point_id").first()
    if bad:
        raise ValueError(f"the source ends before {end} is complete, or has a gap: point {bad['point_id']} {bad['fault']} on {bad['DATE']}")
    partial = listed(reduce.partial_days(days.join(masks, ["point_id", "DATE"], "left").join(points, "point_id"), fields, "cells"))
    last = masks.where(F.col("DATE") == F.lit(end).cast("date")).where(F.col("ended").bitwiseAND(F.lit(reduce.LAST)) == 0)
    return partial, (moved if moved and may_lack and not last.isEmpty() else [])


def from_native(
    spark: SparkSession, native_path: str, crosswalk: DataFrame, out: str, name: str, made: Callable, start: str, end: str,
    families: Sequence[str] | None, rebuild: bool, allow_incomplete_final_day: bool,
) -> dict:
    """``publish`` with tables that ``made(frame, start, end, families)`` gives of native rows,
    which are scanned once, staged by the hour, and held to the gate."""
    with ExitStack() as staged:

        def build(lo: str, hi: str, names: Sequence[str] | None, may_lack: bool) -> Built:
            fields = list(radiation.FIELDS) if name == "radiation" else inputs_of(selected(names))
            frame = staged.enter_context(stage(spark, prepared(spark, native_path, fields, lo, hi), f"{out.rstrip('/')}/{name}"))
            partial, short = gate(frame, crosswalk, fields, lo, hi, may_lack)
            return Built(*made(frame.drop("rows", "ended"), lo, hi, names), partial, short)

        return publish(spark, out, name, crosswalk, build, start, end, families, rebuild, allow_incomplete_final_day)


def get_weather(
    spark: SparkSession, native_path: str, crosswalk: DataFrame, out: str, start: str, end: str, families: Sequence[str] | None = None,
    rebuild: bool = False, allow_incomplete_final_day: bool = False, registered: DataFrame | None = None,
) -> dict:
    """The weather product; None stands for all families.

    The native rows are checked for their contract, keys, time axis and frontier, point by
    point, before anything is written.  ``allow_incomplete_final_day`` lets the last day lack
    the midnight stamp that ends the hour of accumulated fields.  ``registered`` are cells
    that the crosswalk must have, without faults."""
    families = list(FAMILIES) if families is None else [f for f in FAMILIES if f in {m.family for m in selected(families)}]
    registry.check_registry(crosswalk if registered is None else registered, crosswalk)

    def made(frame: DataFrame, lo: str, hi: str, names: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
        return weather_frames(frame, crosswalk, lo, hi, names)

    return from_native(spark, native_path, crosswalk, out, "weather", made, start, end, families, rebuild, allow_incomplete_final_day)


def get_radiation(
    spark: SparkSession, native_path: str, crosswalk: DataFrame, out: str, start: str, end: str, rebuild: bool = False,
    allow_incomplete_final_day: bool = False,
) -> dict:
    """The radiation product, with the same checks as the weather product."""
    registry.check_registry(crosswalk)

    def made(frame: DataFrame, lo: str, hi: str, names: Sequence[str] | None) -> tuple[DataFrame, DataFrame]:
        return radiation_frames(radiation.energies(frame), crosswalk, lo, hi)

    return from_native(spark, native_path, crosswalk, out, "radiation", made, start, end, None, rebuild, allow_incomplete_final_day)


def get_solar(spark: SparkSession, cells: DataFrame, out: str, start: str, end: str, rebuild: bool = False) -> dict:
    return publish(spark, out, "solar", cells, lambda lo, hi, names, may: Built(*solar_tables(cells, lo, hi)), start, end, rebuild=rebuild)


def get_data(
    spark: SparkSession, native_path: str, crosswalk: DataFrame, out: str, start: str, end: str, west: float, south: float, east: float,
    north: float, families: Sequence[str] | None = None, approved: tuple[float, float, float, float] | None = None,
) -> dict:
    """The weather product of the cells in a closed box, which must lie in the approved one
    and take 1 to 4,096 native points; the crosswalk has lat and lon."""
    spatial.check_box((west, south, east, north), approved)
    inside = spatial.within(crosswalk, west, south, east, north)
    n = inside.select("point_id").distinct().limit(spatial.POINTS + 1).count()
    if not n:
        raise ValueError("no cell lies in the box")
    if n > spatial.POINTS:
        raise ValueError(f"the box takes more than {spatial.POINTS} native points")
    return get_weather(spark, native_path, inside, out, start, end, families)


#: What a missing terminal stamp empties, and what a repair fills.
RAIN, RAIN_FIELD = "PRECIPITATION_MM", "tp"


def refresh_weather(spark: SparkSession, native_path: str, crosswalk: DataFrame, out: str, end: str, allow_incomplete_final_day: bool = False) -> dict:
    """Repairs the retained final day and appends the days up to ``end``.

    A day that was published without the stamp that ends it gets the rain of its last
    hour and its daily sum from the source now.  Each cell must lack that hour alone and
    have no daily sum yet, and the source must have the hour for each.  One generation
    of that one day is written, and proved to change nothing but those nulls.  Nothing is
    done when the product is whole up to ``end``."""
    path = f"{out.rstrip('/')}/weather"
    old = source.read_catalog(spark, f"{path}/catalog")
    if old is None:
        raise ValueError("there is no product to refresh")
    if old["partial_fields"]:
        day = old["end_date"]
        with stage(spark, prepared(spark, native_path, [RAIN_FIELD], day, day), path) as frame:
            gate(frame, crosswalk, [RAIN_FIELD], day, day, False)
            fresh = weather_frames(frame.drop("rows", "ended"), crosswalk, day, day, ["precipitation"])[0]
            old = repair(spark, path, old, fresh, crosswalk)
    if date.fromisoformat(end) <= date.fromisoformat(old["end_date"]):
        return old
    return get_weather(spark, native_path, crosswalk, out, old["start_date"], end, old["families"], allow_incomplete_final_day=allow_incomplete_final_day)


def repair(spark: SparkSession, path: str, old: dict, fresh: DataFrame, cells: DataFrame) -> dict:
    """The last day of a product with the rain of its last hour from ``fresh``."""
    day = old["end_date"]
    before = tables(spark, path, old, day, day)
    bad = incremental.repair_faults(before["hourly"], before["daily"], fresh, RAIN).first()
    if bad:
        raise ValueError(f"{day} cannot be repaired: cell {bad['H3_INDEX']} {bad['fault']}")
    hourly = incremental.fill_missing(before["hourly"], fresh, KEYS["hourly"], RAIN)
    daily = incremental.repaired_day(hourly, before["daily"], RAIN)
    generation, root = uuid.uuid4().hex, f"{path}/{old['data']}"
    write_generation(Built(hourly, daily), root, generation, cells, 1)
    d = date.fromisoformat(day)
    new = {**old, "days": manifest.replaced(old["days"], d, d, generation), "generations": {**old["generations"], generation: old["families"]}, "partial_fields": []}
    after = tables(spark, path, new, day, day)
    for frequency, keys in KEYS.items():
        prove_kept(before[frequency], after[frequency], keys, [RAIN])
    n = before["daily"].count()
    moved = {"hourly": UNAVAILABLE, "daily": PARTIAL}
    new["totals"] = {
        f: added(old["totals"][f], {"rows": 0, "nulls": {RAIN: -n}, "status": {RAIN: {COMPLETE: n, moved[f]: -n}}, "quality": {}}) for f in KEYS
    }
    new["partial_days"] = [p for p in old["partial_days"] if (p["date"], p["field"]) != (day, RAIN_FIELD)]
    return commit(spark, path, "weather", new, old["families"])


def publish_coastal(spark: SparkSession, sources: Sequence[str], members: DataFrame, out: str) -> dict:
    """One weather product of the cells of a membership from retained products of successive
    days; every value is that of its source.

    ``sources`` are folders as given to ``get_weather``.  Their days must follow one another
    without gap or overlap, their columns be the same, and every member have all its hours
    and days in each.  A null's status is the one reason that the sources' own counts
    leave for it; if they leave several, nothing is written.  The result is checked before
    its catalog is."""
    ids = registry.check_registry(members.select("h3_index"))
    target = f"{out.rstrip('/')}/weather"
    if out.rstrip("/") in [s.rstrip("/") for s in sources]:
        raise ValueError("the retained products stay as they are; the merged one needs a folder of its own")
    parts = []
    for s in sources:
        catalog = source.read_catalog(spark, f"{s.rstrip('/')}/weather/catalog")
        if catalog is None:
            raise ValueError(f"{s} has no product")
        parts.append((f"{s.rstrip('/')}/weather", catalog))
    parts.sort(key=lambda p: p[1]["start_date"])
    for (_, a), (_, b) in zip(parts, parts[1:], strict=False):
        if date.fromisoformat(b["start_date"]) != date.fromisoformat(a["end_date"]) + timedelta(days=1):
            raise ValueError(f"the products are not contiguous: {a['end_date']} and {b['start_date']}")
        if a["columns"] != b["columns"]:
            raise ValueError("the products have different columns")
    first, last = parts[0][1], parts[-1][1]
    whole = {
        f: incremental.union_contiguous([spatial.members_only(tables(spark, p, c)[f], ids) for p, c in parts]) for f in KEYS
    }
    n_days = (date.fromisoformat(last["end_date"]) - date.fromisoformat(first["start_date"])).days + 1
    generation, data = uuid.uuid4().hex, f"data-{uuid.uuid4().hex}"
    totals = write_generation(Built(whole["hourly"], whole["daily"]), f"{target}/{data}", generation, ids, n_days)
    for f in KEYS:
        for column, nulls in totals[f]["nulls"].items():
            reasons = {s for _, c in parts for s, n in c["totals"][f]["status"].get(column, {}).items() if n and s != COMPLETE}
            if nulls and len(reasons) != 1:
                raise ValueError(f"the sources leave {sorted(reasons)} as reasons for the nulls of {column}")
            totals[f]["status"][column] = {COMPLETE: totals[f]["rows"] - nulls} | ({reasons.pop(): nulls} if nulls else {})
    catalog = {
        "product": "weather", "producer": PRODUCERS["weather"], "region": region_of(ids), "data": data, "totals": totals,
        "days": manifest.replaced([], date.fromisoformat(first["start_date"]), date.fromisoformat(last["end_date"]), generation),
        "generations": {generation: first["families"]}, "epochs": [{**e, "source": p} for p, c in parts for e in c["epochs"]],
        "partial_fields": last["partial_fields"],
    }
    catalog["partial_days"] = measured_partial_days(tables(spark, target, {**catalog, "start_date": first["start_date"]})["hourly"], "weather")
    draft = {**catalog, "families": first["families"], "columns": first["columns"], "start_date": first["start_date"], "end_date": last["end_date"]}
    refuse_faults(check_catalog(spark, target, draft, ids))
    return commit(spark, target, "weather", catalog, first["families"])


def vacuum(spark: SparkSession, out: str, name: str) -> list[str]:
    """Deletes the generations that no version of the catalog names, and staged rows; returns
    their names.  Not to be called while another run writes."""
    path = f"{out.rstrip('/')}/{name}"
    versions = source.every_catalog(spark, f"{path}/catalog")
    gone = []
    for data in {c["data"] for c in versions}:
        left = manifest.unnamed(spark, f"{path}/{data}", [c["days"] for c in versions if c["data"] == data])
        manifest.drop_generations(spark, f"{path}/{data}", left)
        gone += left
    source.remove(spark, f"{path}/stage")
    return sorted(gone)


#: Columns that have a value exactly where their native field has one.
MEASURED = {"weather": {RAIN_FIELD: RAIN}, "radiation": {f: f"{m}_ENERGY_J_M2" for f, m in radiation.FIELDS.items()}}


def check_product(spark: SparkSession, out: str, name: str, cells: DataFrame) -> dict[str, int]:
    """Counts of faults by kind; all zero for a sound product."""
    path = f"{out.rstrip('/')}/{name}"
    return check_catalog(spark, path, source.read_catalog(spark, f"{path}/catalog"), cells)


#: Columns that are a native field as it is, with the field.
COPIED = {"weather": {"U_WIND_10M_MS": "u10", "V_WIND_10M_MS": "v10"}, "radiation": {c: f for f, c in MEASURED["radiation"].items()}}


def check_native(spark: SparkSession, native_path: str, crosswalk: DataFrame, out: str, name: str) -> int:
    """Published values that differ, bit by bit, from the native samples of their cell, on the
    first and last day of each epoch and on leap days."""
    path = f"{out.rstrip('/')}/{name}"
    catalog = source.read_catalog(spark, f"{path}/catalog")
    days = validate.boundary_days([(e["start_date"], e["end_date"]) for e in catalog["epochs"]])
    n = 0
    for day in days:  # some for each run that has written; only these days are opened
        hourly = tables(spark, path, catalog, str(day), str(day))["hourly"]
        columns = {c: f for c, f in COPIED[name].items() if c in hourly.columns}
        native = source.read_native(spark, native_path, list(columns.values()), str(day), str(day)) if columns else None
        n += validate.native_differences(native, crosswalk, hourly, columns, [day]).count() if columns else 0
    return n


def refuse_faults(found: dict[str, int]) -> None:
    bad = {k: n for k, n in found.items() if n}
    if bad:
        raise ValueError(f"the product has faults: {bad}")


def check_catalog(spark: SparkSession, path: str, catalog: dict, cells: DataFrame) -> dict[str, int]:
    """``check_product`` of a version of the catalog, also one that is not written yet:
    region, columns with types and units against the contract, keys, values, totals of nulls
    and statuses, reductions, partial days and lineage."""
    name, lo, hi = catalog["product"], catalog["start_date"], catalog["end_date"]
    contract = expected_columns(name, catalog["families"])
    frames = tables(spark, path, catalog)
    found = {"region": int(catalog["region"] != region_of(cells)), "units": int(catalog["columns"] != contract)}
    for frequency, frame in frames.items():
        keys = spatial.lattice(cells, lo, hi, frequency == "hourly")
        found[f"{frequency}_schema"] = int(sorted([c, t] for c, t in frame.dtypes) != [[c, t] for c, t, _ in contract[frequency]])
        found[f"{frequency}_repeated"] = validate.repeated_keys(frame, keys.columns).count()
        found[f"{frequency}_off_lattice"] = validate.off_lattice(frame, keys).count()
        doubles = [f.name for f in frame.schema.fields if f.dataType.typeName() == "double"]
        counts = {r["column"]: r for r in validate.column_counts(frame, [c for c in frame.columns if c not in (*KEYS[frequency], "DATE")]).collect()}
        found[f"{frequency}_nonfinite"] = sum(counts[c]["nonfinite"] or 0 for c in doubles)
        total = catalog["totals"][frequency]
        found[f"{frequency}_totals"] = sum(total["nulls"].get(c) != r["nulls"] or total["rows"] != r["rows"] for c, r in counts.items())
        found[f"{frequency}_status"] = status_faults(spark, total, counts) if name == "weather" else 0
    if name == "solar":
        found["phases"] = validate.solar_errors(frames["hourly"]).count()
        found["cycles"] = validate.cycle_errors(frames["daily"], solar_cycle.DURATIONS, [n for p in solar_cycle.EVENTS for n in p]).count()
    fields, same = MEASURED.get(name, {}), lambda p: tuple(sorted(p.items()))
    said = {same(p) for p in catalog["partial_days"] if p["field"] in fields}
    found["partial_days"] = len({same(p) for p in measured_partial_days(frames["hourly"], name)} ^ said)
    if name == "radiation":
        hours = frames["hourly"].withColumnsRenamed({"H3_INDEX": "point_id", "DATETIME": "valid_time"}).drop("DATE")
        found["reductions"] = radiation.reduction_errors(hours, frames["daily"].withColumnRenamed("H3_INDEX", "point_id")).count()
        seen, said = radiation.quality(hours).collect(), catalog["totals"]["hourly"]["quality"]
        fields = {f"{m}_ENERGY_J_M2": f for f, m in radiation.FIELDS.items()}
        found["quality"] = sum(r["negative_hours"] != said[f"{fields[r['metric']]}|negative"] or r["direct_above_downward"] != said["above|count"] for r in seen)
    if name == "weather":
        metrics = selected(catalog["families"])
        sums = [m.column for m in metrics if "sum" in m.daily]
        if sums:
            again = frames["hourly"].groupBy("H3_INDEX", F.to_date("DATETIME").alias("DATE")).agg(
                *[F.when(F.count(c) == 24, reduce.ordered_sum(F.col(c), F.col("DATETIME"))).alias(f"again_{c}") for c in sums]
            )
            off = F.lit(False)
            for c in sums:
                off = off | ~F.col(c).eqNullSafe(F.col(f"again_{c}"))
            found["reductions"] = frames["daily"].join(again, ["H3_INDEX", "DATE"], "full").where(off).count()
    rows = [
        ("daily", family or name, date.fromisoformat(e["start_date"]), date.fromisoformat(e["end_date"]))
        for e in catalog["epochs"] for family in e["families"] or [None]
    ]
    spans = spark.createDataFrame(rows, "frequency string, metric string, start_date date, end_date date")
    found["lineage"] = lineage.breaks(spans, date.fromisoformat(lo), date.fromisoformat(hi)).count()
    return found


def measured_partial_days(hourly: DataFrame, name: str) -> list[dict]:
    """The partial days of the fields that an hourly table shows, as a catalog lists them."""
    columns = {c: f for f, c in MEASURED.get(name, {}).items() if c in hourly.columns}
    if not columns:
        return []
    masks = reduce.hour_masks(hourly, list(columns), "H3_INDEX", "DATETIME")
    return [{**p, "field": columns[p["field"]]} for p in listed(reduce.partial_days(masks, list(columns)))]


def listed(partial: DataFrame) -> list[dict]:
    """Partial days as a catalog lists them: at most one for each day and field."""
    rows = partial.orderBy("DATE", "field").collect()
    return [{"date": str(r["DATE"]), **{k: v for k, v in r.asDict().items() if k != "DATE"}} for r in rows]


def status_faults(spark: SparkSession, total: dict, counts: dict) -> int:
    """Columns whose statuses do not add up to the rows, or COMPLETE to the values."""
    rows = [(c, s, n) for c, each in total["status"].items() for s, n in each.items()]
    histogram = spark.createDataFrame(rows, "metric string, status string, n long")
    seen = spark.createDataFrame([(c, r["rows"], r["nulls"]) for c, r in counts.items()], "column string, rows long, nulls long")
    negative = sum(n < 0 for _, _, n in rows)
    return validate.accounting_errors(histogram, seen).count() + negative + len(set(counts) - set(total["status"]))
