"""Publishing by pointer and the ordered sink."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from innsight.plans.ordered import file_positions, stored_rows, write_ordered_csv
from innsight.plans.publish import POINTER, current_version, publish, read_published


def _write(df, path):
    df.write.option("header", True).csv(path)


def _read(spark, path):
    return spark.read.option("header", True).schema("x long").csv(path)


def rows(spark, location):
    return sorted(r.x for r in read_published(spark, location, _read).collect())


def test_a_published_version_replaces_the_one_before(spark):
    location = tempfile.mkdtemp(prefix="innsight-publish-")
    with pytest.raises(FileNotFoundError):
        read_published(spark, location, _read)
    first = publish(spark.range(3).withColumnRenamed("id", "x"), location, _write)
    old = read_published(spark, location, _read)  # a reader that opened the first version
    publish(spark.range(5).withColumnRenamed("id", "x"), location, _write)
    assert rows(spark, location) == [0, 1, 2, 3, 4] and old.count() == 3
    third = publish(spark.range(0).withColumnRenamed("id", "x"), location, _write)
    assert rows(spark, location) == [] and current_version(spark, location) == third
    names = [n for n in os.listdir(location) if n.startswith("v-")]
    assert len(names) == 2 and os.path.basename(first) not in names
    assert [n for n in os.listdir(location) if n.startswith(POINTER)] == [POINTER]


def test_a_write_that_fails_half_way_leaves_the_old_content(spark):
    location = tempfile.mkdtemp(prefix="innsight-publish-")
    publish(spark.range(4).withColumnRenamed("id", "x"), location, _write)
    broken = spark.range(0, 100, 1, 4).select(
        F.when(F.col("id") < 70, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("x"))
    with pytest.raises(Exception, match="lost"):
        publish(broken, location, _write)

    def dies(df, path):
        _write(df, path)
        raise RuntimeError("after the write, before the pointer")

    with pytest.raises(RuntimeError):
        publish(spark.range(9).withColumnRenamed("id", "x"), location, dies)
    assert rows(spark, location) == [0, 1, 2, 3]
    publish(spark.range(2).withColumnRenamed("id", "x"), location, _write)
    assert rows(spark, location) == [0, 1]


def test_ordered_files_read_in_key_order(spark):
    path = tempfile.mkdtemp(prefix="innsight-ordered-") + "/out"
    df = spark.range(0, 5000, 1, 7).select(
        (F.col("id") * 7919 % 1000).alias("k"), F.when(F.col("id") % 11 != 0, F.col("id") % 13).alias("j"))
    write_ordered_csv(df, path, ("k", "j"), rows_per_file=300)
    files = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    assert len(files) >= 17
    lines = []
    for name in files:
        with open(os.path.join(path, name)) as f:
            body = f.read().splitlines()[1:]
        assert len(body) <= 300
        lines += body
    keys = [tuple(-1 if x == "NA" else int(x) for x in line.split(",")) for line in lines]
    assert keys == sorted(keys) and len(keys) == 5000
    placed = file_positions(spark, path, df.schema).collect()
    assert sorted(r.position for r in placed) == list(range(5000))
    assert all(keys[r.position] == (r.k, -1 if r.j is None else r.j) for r in placed)


def test_stored_rows_are_made_once_for_an_ordered_write(spark):
    """The sample of the sort and the sort itself read the stored rows; what made them runs once."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    df = spark.range(0, 900, 1, 3).withColumnRenamed("id", "k").mapInArrow(count, "k long")
    folder = tempfile.mkdtemp(prefix="innsight-ordered-")
    rows = stored_rows(df, f"{folder}/rows")
    write_ordered_csv(rows, f"{folder}/out", ("k",), rows_per_file=100)
    assert made.value == 900 and rows.schema == df.schema
    assert [r.position for r in file_positions(spark, f"{folder}/out", df.schema).orderBy("k").collect()] == list(range(900))


def test_shuffles_of_stored_rows_go_when_they_are_stored(spark):
    """What is made of the rows doesn't share the disk with the shuffles that made them; the session keeps its setting."""
    from innsight.plans.ordered import SHUFFLES_GO

    dirs = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffles():
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(SHUFFLES_GO, None)
    df = spark.range(20000).groupBy((F.col("id") % 700).alias("k")).agg(F.count("*").alias("n"))
    rows = stored_rows(df, tempfile.mkdtemp(prefix="innsight-ordered-") + "/rows")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before and spark.conf.get(SHUFFLES_GO, None) == setting
    assert rows.count() == df.count() == 700


def test_ordered_files_of_report_rows_sort_the_stored_rows(spark, monkeypatch):
    from innsight.plans import queries

    plans = []

    def write(df, *args, **kw):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write_ordered_csv(df, *args, **kw)

    monkeypatch.setattr(queries, "write_ordered_csv", write)
    assert queries.QUERIES["report_ordered_files"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(plans) == 1 and "Join" not in plans[0]


def test_ordered_files_of_one_and_no_rows(spark):
    for n in (0, 1):
        path = tempfile.mkdtemp(prefix="innsight-ordered-") + "/out"
        df = spark.range(n).withColumnRenamed("id", "k")
        write_ordered_csv(df, path, ("k",))
        assert [r.position for r in file_positions(spark, path, df.schema).collect()] == list(range(n))
