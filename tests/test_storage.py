import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fraudlens.session import new_path, shared_dir, stage
from fraudlens.sources import runs, tables, topics


def test_replacement_may_read_the_table_it_replaces(spark):
    path = new_path(spark, "t")
    assert tables.read_current(spark, path) is None
    tables.replace_table(spark.range(10), path)
    old = tables.read_current(spark, path)
    tables.replace_table(old.filter("id < 3"), path)
    assert tables.read_current(spark, path).count() == 3
    assert old.count() == 10  # readers of the old version are not disturbed


def test_unfinished_version_is_not_read(spark):
    path = new_path(spark, "t")
    tables.replace_table(spark.range(2), path)
    broken = spark.range(1).withColumn("id", F.raise_error(F.lit("boom")).cast("bigint"))
    with pytest.raises(Exception, match="boom"):
        tables.replace_table(broken, path)
    assert tables.read_current(spark, path).count() == 2


def test_missing_table_is_none(spark):
    assert tables.read_table_or_none(spark, new_path(spark, "none")) is None


def test_csv_keeps_every_digit(spark):
    path = new_path(spark, "csv")
    df = spark.range(50).select(F.rand(1).alias("V1"), (F.col("id") % 2).cast("string").alias("Class"))
    tables.write_csv(df, path, label="Class")
    schema = df.withColumn("Class", F.col("Class").cast("int")).schema
    assert {tuple(r) for r in tables.read_csv(spark, path, schema).collect()} == {
        (r.V1, int(r.Class)) for r in df.collect()
    }


def test_latest_run_of_an_experiment(spark):
    path = new_path(spark, "runs")
    now = datetime(2024, 1, 1)
    for i, name in enumerate(["a", "b", "a", "b"]):
        runs.log_run(spark, path, name, {"i": i}, {"f1": i / 10}, now + timedelta(hours=i))
    row = runs.latest_run(spark, path, "a").first()
    assert row.params == {"i": "2"} and row.metrics == {"f1": 0.2}
    assert runs.latest_run(spark, path, "c").count() == 0


def test_staged_table_lies_in_the_shared_folder(spark):
    files = stage(spark.range(5), "x").inputFiles()
    assert files and all(shared_dir(spark) in f for f in files)


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default):
        return self.values.get(key, default)


class _Session:
    """Only what shared_dir reads."""

    def __init__(self, master, **values):
        self.conf = _Conf(values)
        self.sparkContext = type("Context", (), {"master": master})()


def test_shared_folder_is_the_one_the_cluster_names():
    session = _Session("spark://host:7077", **{"spark.checkpoint.dir": "hdfs://x/share/"})
    assert shared_dir(session) == "hdfs://x/share"


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://host:7077"))


def test_rows_of_a_file_are_numbered_in_file_order(spark, tmp_path):
    for part, low in (("b", 3000), ("a", 0)):
        lines = "".join(f"{i}\n" for i in range(low, low + 3000))
        (tmp_path / f"{part}.csv").write_text("v\n" + lines)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = tables.read_csv(spark, str(tmp_path), "v int")
        assert rows.rdd.getNumPartitions() > 4
        numbered = tables.number_rows(rows)
        assert numbered.filter("row_id = v").count() == 6000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_only_the_newest_versions_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        tables.replace_table(spark.range(n), path, keep=2)
    assert len(list((tmp_path / "t").iterdir())) == 2
    assert tables.read_latest(spark, path).count() == 4
    spark.range(7).write.parquet(str(tmp_path / "plain"))
    assert tables.read_latest(spark, str(tmp_path / "plain")).count() == 7
    with pytest.raises(ValueError, match="at least one"):
        tables.replace_table(spark.range(1), path, keep=0)


def test_latest_skips_files_written_before_the_first_start(spark, tmp_path):
    topic, out, checkpoint = (str(tmp_path / n) for n in ("topic", "out", "checkpoint"))
    schema = spark.range(1).schema

    def drain():
        stream = topics.read_topic(
            spark, path=topic, starting="latest", schema=schema, checkpoint=checkpoint
        )
        topics.drain(topics.append_stream(stream, out, checkpoint))

    spark.range(5).write.mode("append").parquet(topic)
    time.sleep(1.1)  # file systems may keep whole seconds
    drain()
    time.sleep(1.1)
    for low in (10, 20):  # also what came while the stream was down is read after a restart
        spark.range(low, low + 2).write.mode("append").parquet(topic)
    drain()
    assert {r.id for r in spark.read.parquet(out).collect()} == {10, 11, 20, 21}
    with pytest.raises(ValueError, match="checkpoint"):
        topics.read_topic(spark, path=topic, starting="latest", schema=schema)


def test_staged_tables_can_be_dropped(spark, monkeypatch, tmp_path):
    import os

    from fraudlens import session

    monkeypatch.setattr(session, "shared_dir", lambda _: str(tmp_path))
    staged = session.stage(spark.range(5), "x")
    assert staged.count() == 5
    (root,) = (tmp_path / "fraudlens").iterdir()
    session.drop_staged(spark)
    assert not os.path.exists(root)


def test_unstaged_tables_are_gone_and_others_stay(spark):
    from fraudlens.session import exists, stage, unstage

    kept, dropped = stage(spark.range(5), "kept"), stage(spark.range(6), "dropped")
    folder = dropped.inputFiles()[0].rsplit("/", 1)[0]
    unstage(dropped)
    assert not exists(spark, folder) and kept.count() == 5
    outside = new_path(spark, "x").replace("/fraudlens/", "/other/")
    spark.range(3).write.parquet(outside)
    table = spark.read.parquet(outside)
    unstage(table)  # not a staged table
    assert table.count() == 3
