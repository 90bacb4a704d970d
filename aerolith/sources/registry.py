"""Registries of cells: files of one id a line, and what may be wrong with them."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.spatial import not_on_lattice

ID = re.compile(r"[0-9a-z]+")


def parse_members(raw: bytes) -> list[str]:
    """Ids of a membership file: ASCII, each line ended by a line feed, no blanks; an
    empty membership is a file of no bytes."""
    if not raw:
        return []
    if not raw.isascii():
        raise ValueError("a membership file is ASCII")
    if b"\r" in raw or not raw.endswith(b"\n"):
        raise ValueError("each line of a membership file ends with a line feed alone")
    ids = raw.decode("ascii")[:-1].split("\n")
    for line, i in enumerate(ids, 1):
        if not i or i.split() != [i]:
            raise ValueError(f"line {line} is blank or holds white space")
    return ids


def check_members(ids: list[str], count: int | None = None, sha256: str | None = None) -> list[str]:
    """The ids, if they are what a study's manifest declares: in strictly rising order,
    so many, and with that hash of the file's bytes."""
    for a, b in zip(ids, ids[1:], strict=False):
        if a >= b:
            raise ValueError(f"{b} does not rise over {a}, the id before it")
    if count is not None and len(ids) != count:
        raise ValueError(f"the membership has {len(ids)} ids, its manifest {count}")
    raw = "".join(f"{i}\n" for i in ids).encode("ascii")
    if sha256 is not None and hashlib.sha256(raw).hexdigest() != sha256:
        raise ValueError("the membership's hash is not that of its manifest")
    return ids


def read_members(spark: SparkSession, path: str, count: int | None = None, sha256: str | None = None) -> DataFrame:
    """``h3_index`` of the membership file at ``path``, checked against what the manifest
    says of it; a study has some thousand ids."""
    raw = spark.read.format("binaryFile").load(path).select("content").collect()
    if len(raw) != 1:
        raise ValueError("a membership is one file")
    return spark.createDataFrame([(i,) for i in check_members(parse_members(bytes(raw[0][0])), count, sha256)], "h3_index string")


def check_registry(cells: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    """The cells, if no id is null, malformed or repeated and, with a crosswalk, each has
    a native point."""
    bad = {r["fault"]: r["n"] for r in registry_faults(cells).collect() if r["n"]}
    if bad:
        raise ValueError(f"the registry has faults: {bad}")
    lost = None if crosswalk is None else not_on_lattice(cells.select("h3_index"), crosswalk).first()
    if lost:
        raise ValueError(f"{lost['h3_index']} has no native point")
    return cells


def registry_faults(cells: DataFrame, column: str = "h3_index") -> DataFrame:
    """``fault, n``: ids that are null, not lower-case letters and digits, or repeated."""
    each = cells.groupBy(column).agg(F.count("*").alias("times"))
    one = each.agg(
        F.count_if(F.col(column).isNull()).alias("null"),
        F.count_if(F.col(column).isNotNull() & ~F.col(column).rlike(f"^{ID.pattern}$")).alias("malformed"),
        F.count_if(F.col(column).isNotNull() & (F.col("times") > 1)).alias("repeated"),
    )
    return one.unpivot([], ["null", "malformed", "repeated"], "fault", "n")
