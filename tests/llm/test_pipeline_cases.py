"""Cases of the pipeline, the tables it writes on its way, and what workers keep."""

import threading

import pytest
from pyspark.sql import functions as F

from aerolith.llm import storage, workers
from corpus_pipeline import STAGES, run

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    """A folder whose tables hold nulls, repeated rows, a long text and clashing columns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    row = docs.orderBy("doc_id").limit(1)
    nothing = row.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema])
    changed = [
        row,
        row,
        nothing,
        row.withColumn("doc_id", F.lit(None).cast("long")),
        row.withColumn("text", F.lit("")),
        row.withColumn("text", F.lit(" \n\t ")),
        row.withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(900_001).cast("long")),
        row.withColumn("text", F.repeat(F.lit("long words follow. here is "), 20_000)).withColumn("doc_id", F.lit(900_002).cast("long")),
    ]
    for more in changed:
        docs = docs.unionByName(more)
    # names that the operators use for columns of their own
    for name in ("id", "n", "kept", "drop", "tag", "component_id", "h1", "place", "score"):
        docs = docs.withColumn(name, F.lit(name))
    folder = str(tmp_path_factory.mktemp("odd"))
    docs.coalesce(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_runs_over_odd_rows(spark, odd):
    docs = spark.read.parquet(f"{odd}/documents.parquet")
    kept = docs
    for name, stage in STAGES[:-1]:
        kept = storage.materialise(stage(spark, kept, odd))
        assert kept.columns == docs.columns, name
        assert kept.where("n <> 'n' or drop <> 'drop' or h1 <> 'h1'").count() == 0
    got = run(spark, odd)
    # every row that the stages keep is packed, whole: its pieces are numbered from 0
    assert {r[0] for r in got.select("doc_id").collect()} == {r[0] for r in kept.select("doc_id").collect()}
    odd_pieces = got.where("pieces > 0").groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("piece").alias("d"), F.max("pieces").alias("p"))
    assert odd_pieces.where("doc_id is not null and (n <> d or n <> p)").count() == 0


def test_pipeline_on_empty_tables(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert run(spark, str(tmp_path)).count() == 0


def test_without_labels_nothing_is_rejected(spark, tmp_path):
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert STAGES[0][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_settings_of_writes_nest_and_come_back(spark):
    before = {k: spark.conf.get(k, None) for k in (storage.RELEASE, storage.ARROW)}
    inside, leave = threading.Event(), threading.Event()

    def other():
        with storage.write_settings(spark):
            inside.set()
            leave.wait(10)

    thread = threading.Thread(target=other)
    thread.start()
    inside.wait(10)
    with pytest.raises(ZeroDivisionError), storage.write_settings(spark):
        1 / 0
    assert spark.conf.get(storage.ARROW) == str(storage.BATCH) and spark.conf.get(storage.RELEASE) == "true"
    leave.set()
    thread.join()
    assert {k: spark.conf.get(k, None) for k in before} == before
    spark.conf.set(storage.ARROW, "7")  # a smaller setting of the session stays
    try:
        with storage.write_settings(spark):
            assert spark.conf.get(storage.ARROW) == "7"
        assert spark.conf.get(storage.ARROW) == "7"
    finally:
        spark.conf.unset(storage.ARROW)


def test_workers_hold_one_memo():
    made = []

    def build(name):
        made.append(name)
        return {name: 1}

    first = workers.kept("a", lambda: build("a"))
    assert workers.kept("a", lambda: build("again")) is first and made == ["a"]
    workers.kept("b", lambda: build("b"))
    assert list(workers._held) == ["b"]
    workers.release()
    assert not workers._held and workers.kept("a", lambda: build("a")) is not first


def test_clean_deletes_the_tables(spark):
    from pathlib import Path

    table = storage.materialise(spark.range(10).toDF("x"))
    assert table.count() == 10
    folder = Path(storage.shared_folder(spark).removeprefix("file:"))
    assert folder.exists()
    storage.clean(spark)
    assert not folder.exists()
    assert storage.materialise(spark.range(3).toDF("x")).count() == 3
