"""Document pipeline: toxicity, exact dedup, near-dedup, substring dedup, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm import exact, minhash, packing, spans, toxicity
from aerolith.llm.storage import materialise


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from the labelled ones.

    Null, empty and wordless texts stay; without a usable label nothing is rejected;
    repeated rows and rows with a null id are judged by their text; an empty table stays
    empty.  The columns stay as they are."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal without white space the longest, then smallest id, stays.

    Null and empty texts are one group; a null id sorts last; of rows that repeat both
    id and text one stays; an empty table stays empty.  The columns stay as they are."""
    return exact.drop_exact_copies(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id.

    Null and blank texts and rows with a null id are in no group and stay; rows that
    repeat an id stay or go together; an empty table stays empty.  The columns stay."""
    return minhash.keep_one_per_group(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated spans are cut out; ``n_chars`` follows the text.

    Null texts stay null, a text may become empty, and rows that repeat id and text are
    one occurrence; ``n_chars`` of an unchanged text, null included, stays; an empty
    table stays empty.  No row goes, and the columns stay."""
    cut = spans.remove_repeated_spans(docs, **spans.FINE)
    changed = F.when(F.col("removed_sentences") > 0, F.char_length("text").cast("long"))
    return cut.withColumn("n_chars", F.coalesce(changed, F.col("n_chars"))).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece with its bin; a bin has no two documents of one source or
    duplicate cluster.

    Null, empty and blank texts have one row without a bin; a null source or id conflicts
    with nothing; repeated rows are packed each; an empty table gives no row."""
    return packing.pack(docs, capacity=2048, source_col="source")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("packing", packing_stage),
]

#: A trained classifier and hashed signatures have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
