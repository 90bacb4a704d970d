"""Which generation of files holds each day of a product.

A generation is a folder that one run has written and no later run changes.  The
catalog lists runs of days with the generations that hold them: usually one, and one
more for each time that families were added to days that were there.  Readers open only
what the catalog names, so files of a run that did not reach its catalog are never seen."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from .native import remove

ONE = timedelta(days=1)
#: ``[first day, last day, generations]``, in order, without overlaps.
Days = list[list]


def each_day(days: Days) -> dict[date, list[str]]:
    return {
        date.fromisoformat(lo) + ONE * k: list(generations)
        for lo, hi, generations in days
        for k in range((date.fromisoformat(hi) - date.fromisoformat(lo)).days + 1)
    }


def as_runs(held: dict[date, list[str]]) -> Days:
    """The shortest list of runs for days and their generations."""
    out: Days = []
    for day in sorted(held):
        if out and out[-1][2] == held[day] and date.fromisoformat(out[-1][1]) + ONE == day:
            out[-1][1] = str(day)
        else:
            out.append([str(day), str(day), held[day]])
    return out


def replaced(days: Days, first: date, last: date, generation: str) -> Days:
    """The days from ``first`` to ``last`` are in ``generation`` alone."""
    held = each_day(days)
    for k in range((last - first).days + 1):
        held[first + ONE * k] = [generation]
    return as_runs(held)


def widened(days: Days, generation: str) -> Days:
    """Every day is in ``generation`` as well, which has further columns of it."""
    return [[lo, hi, [*generations, generation]] for lo, hi, generations in days]


def clipped(days: Days, first: date, last: date) -> Days:
    return as_runs({d: g for d, g in each_day(days).items() if first <= d <= last})


def files_of(root: str, frequency: str, generation: str, days: Iterable[date]) -> list[str]:
    return [f"{root}/{frequency}/generation={generation}/DATE={d}" for d in days]


def read(spark: SparkSession, root: str, frequency: str, keys: Sequence[str], days: Days, holds: dict[str, list[str] | None]) -> DataFrame:
    """The table of the days; ``holds`` says which families a generation has.

    Folders of days are named one by one, so the product is not listed and nothing else is
    opened.  Days of which each family lies in a generation of the same families are one
    scan for each such group of columns, joined by key, however many runs have written
    them; a product whose families were never added to is a plain scan."""
    shapes: dict[tuple, dict[date, list[str]]] = {}
    for d, generations in each_day(days).items():
        shapes.setdefault(tuple(tuple(holds[g] or ()) for g in generations), {})[d] = generations
    out = None
    for shape, of in shapes.items():
        parts = [
            spark.read.option("basePath", f"{root}/{frequency}").parquet(*[f for d, gs in of.items() for f in files_of(root, frequency, gs[k], [d])]).drop("generation")
            for k in range(len(shape))
        ]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.join(part, list(dict.fromkeys([*keys, "DATE"])))
        out = whole if out is None else out.unionByName(whole)
    return out


def unnamed(spark: SparkSession, root: str, days: Sequence[Days]) -> list[str]:
    """Generations on disk that none of the manifests names."""
    named = {g for d in days for gs in each_day(d).values() for g in gs}
    jvm = spark.sparkContext._jvm
    found = set()
    for frequency in ("hourly", "daily"):
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{frequency}")
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if system.exists(path):
            found |= {s.getPath().getName().removeprefix("generation=") for s in system.listStatus(path) if s.getPath().getName().startswith("generation=")}
    return sorted(found - named)


def drop_generations(spark: SparkSession, root: str, generations: Iterable[str]) -> None:
    for g in generations:
        for frequency in ("hourly", "daily"):
            remove(spark, f"{root}/{frequency}/generation={g}")
