"""What five quality filters do in every order of applying them (operator 11).

Texts are read once, in DataFrame expressions; each document becomes a mask of the
filters it fails, and from then on only histograms of masks are handled."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Filter k of FILTERS is bit k of a mask.
FILTERS = "ABCDE"
MASKS, COPY = 1 << len(FILTERS), 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = [(order, step) for order in ORDERS for step in range(len(FILTERS))]
#: Histograms of a part, in the order of its rows in the incidence matrix.
KINDS = ("documents", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
#: Parts that one product takes: 3 x 64 rows by 32, and 64 x 600 rows out.
PARTS = 64


def outcomes() -> dict[str, np.ndarray]:
    """Four 0/1 matrices of 32 masks by 600 (order, step): whether a document with the
    mask is kept after the step, removed by it, fails it but is gone already, or fails
    its filter and no other."""
    mask = np.arange(MASKS)[:, None]
    own = np.array([1 << FILTERS.index(order[step]) for order, step in STEPS])
    before = np.array([sum(1 << FILTERS.index(f) for f in order[:step]) for order, step in STEPS])
    fails, gone = (mask & own) > 0, (mask & before) > 0
    tables = {"kept": ~fails & ~gone, "removed": fails & ~gone, "redundant": fails & gone, "unique": mask == own}
    return {name: table.astype(np.int64) for name, table in tables.items()}


def text_mask(text: Column) -> Column:
    """Bits A to D, which follow from the text alone."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (n < 200, distinct * 100 < n * 50, capitals.cast("long") * 100 > F.length(text).cast("long") * 3, text.rlike(r"[#$%&*|]"))
    mask = F.lit(0)
    for k, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << k).otherwise(0)
    return mask


def mask_histograms(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, documents, good, toxic``: how many documents of a part fail exactly
    the filters of a mask, and how many of them are labelled good or toxic.

    Equal documents are combined before every shuffle, so a text that a third of all
    rows share, or an id that repeats, is a few rows a task from then on."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask"),
    )
    rows = slim.groupBy("doc", "part", "digest", "mask").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("bad")
    )
    # rows without an id join nothing; their own hashes keep them out of a single task
    there = F.col("doc").isNotNull()
    rows = rows.withColumns({"key": F.coalesce("doc", F.xxhash64("part", "digest")), "there": there})
    marks = marks.select(F.col("doc").alias("key"), F.lit(True).alias("there"), "good", "bad")
    joined = rows.join(marks, ["key", "there"], "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "bad")})
    # of each text and part the rows, those without an id, and those of the smallest id
    texts = joined.groupBy("digest", "mask", "part", "good", "bad").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"),
        F.min(F.when(F.col("doc").isNotNull(), F.struct("doc", "n"))).alias("least"),
    )
    # a text has a row here for each part and labelling only, whatever the number of its copies
    first = texts.withColumn("lowest", F.min("least.doc").over(Window.partitionBy("digest")))
    at_first = F.col("least.doc") == F.col("lowest")
    fresh = F.col("unnamed") + F.when(at_first, F.coalesce(F.col("least.n"), F.lit(0))).otherwise(0)
    split = first.select("part", "mask", "good", "bad", fresh.alias("fresh"), (F.col("n") - fresh).alias("copies"))
    both = F.array(F.struct("mask", F.col("fresh").alias("n")), F.struct((F.col("mask") + COPY).alias("mask"), F.col("copies").alias("n")))
    long = split.select("part", "good", "bad", F.explode(both).alias("x")).select("part", "good", "bad", "x.*").where("n > 0")
    of = lambda c: F.coalesce(F.sum(F.when(F.col(c), F.col("n"))), F.lit(0))
    return long.groupBy("part", "mask").agg(F.sum("n").alias("documents"), of("good").alias("good"), of("bad").alias("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for every part, order of the filters and step: ``part, filter_order, step``
    and the counts of ``COUNTS``.

    The histograms of parts are stacked as rows of an incidence matrix (part and kind by
    32 masks) and multiplied by the integer matrices of ``outcomes``; what a filter
    removes, summed over all orders, is a sum over the product's columns.

    Defined cases: a null text is empty (it fails A alone); a null part is the empty
    string; a null id is smaller than no other and has no label, so the row neither fails E
    nor makes another fail it; rows that repeat an id and a text all count, and none of
    them fails E on account of the other; an id with several label rows is good or
    toxic if one of them says so, null labels say nothing; parts of no documents do not
    exist, so an empty table gives an empty result; further columns are not read.
    """
    histograms = mask_histograms(docs, labels, id_col, text_col, part_col)
    wide = histograms.groupBy("part").agg(F.collect_list(F.struct("mask", *KINDS)).alias("h"))  # at most 32 a part
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, letter = outcomes(), np.array([FILTERS.index(order[step]) for order, step in STEPS])
        orders, steps = [order for order, _ in STEPS], np.array([step + 1 for _, step in STEPS], np.int32)
        for batch in batches:
            for start in range(0, batch.num_rows, PARTS):
                part = batch.slice(start, PARTS)
                names = part.column(0).to_pylist()
                stack = np.zeros((len(names), len(KINDS), MASKS), np.int64)
                for p, h in enumerate(part.column(1).to_pylist()):
                    for row in h:
                        stack[p, :, row["mask"]] = [row[k] for k in KINDS]
                product = {name: stack.reshape(-1, MASKS) @ m for name, m in table.items()}
                product = {name: m.reshape(len(names), len(KINDS), len(STEPS)) for name, m in product.items()}
                removed = product["removed"][:, 0]
                shares = np.stack([removed[:, letter == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)[:, letter]
                counts = (product["kept"][:, 0], removed, product["redundant"][:, 0], product["unique"][:, 0], product["removed"][:, 1],
                          product["removed"][:, 2], shares)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(np.array(names, object), len(STEPS)), pa.string()), pa.array(orders * len(names)),
                        pa.array(np.tile(steps, len(names))), *[pa.array(np.ascontiguousarray(c).reshape(-1)) for c in counts],
                    ],
                    ["part", "filter_order", "step", *COUNTS],
                )

    return wide.mapInArrow(multiply, schema)
