"""Slices are replaced as a whole or not at all; rows are counted by the write."""

import os

import pytest
from pyspark.sql import functions as F

from perfmart.plans.report import run_report
from perfmart.sources import published
from perfmart.sources.standins import STANDIN_CONFIG, standin_inputs

from conftest import SF001


def frame(spark, n, dates, value):
    return spark.range(n).select("id", F.lit(value).alias("v"), F.element_at(
        F.array(*[F.lit(d) for d in dates]), (F.col("id") % len(dates) + 1).cast("int")).cast("date").alias("date"))


def table(spark, path):
    return sorted((r.id, r.v, str(r.date)) for r in published.read(spark, path).collect())


def test_crash_between_write_and_pointer_keeps_the_slice(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    published.publish(frame(spark, 6, ["2024-01-01", "2024-01-02"], "old"), path)
    before = table(spark, path)
    with monkeypatch.context() as m:
        m.setattr(published, "_set_pointer", lambda *a: (_ for _ in ()).throw(OSError("crashed")))
        with pytest.raises(OSError):
            published.publish(frame(spark, 4, ["2024-01-02"], "new"), path)
    assert table(spark, path) == before
    # a pointer that was cut short does not count either
    (tmp_path / "t" / "_current" / "000000000002").write_text("date=2024-01-02\tversion-that-is-not-there\n")
    assert table(spark, path) == before
    done = published.publish(frame(spark, 4, ["2024-01-02"], "new"), path)
    assert done.rows == 4 and done.slices == ("date=2024-01-02",)
    want = [r for r in before if r[2] == "2024-01-01"] + [(i, "new", "2024-01-02") for i in range(4)]
    assert table(spark, path) == sorted(want)
    # the files of the publication that crashed are gone when two later ones are there
    published.publish(frame(spark, 4, ["2024-01-02"], "newer"), path)
    published.publish(frame(spark, 4, ["2024-01-02"], "newest"), path)
    assert len([n for n in os.listdir(path) if n.startswith("version=")]) == 3
    assert {r[1] for r in table(spark, path)} == {"old", "newest"}


def test_a_task_that_fails_publishes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish(frame(spark, 3, ["2024-01-01"], "old"), path)
    bad = frame(spark, 50, ["2024-01-01"], "new").withColumn(
        "id", F.when(F.col("id") == 49, F.raise_error(F.lit("no"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        published.publish(bad, path)
    assert {r[1] for r in table(spark, path)} == {"old"}


def test_two_publications_from_one_pointer(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    published.publish(frame(spark, 3, ["2024-01-01"], "a"), path)
    set_pointer = published._set_pointer

    def late(folder, number, slices):
        monkeypatch.setattr(published, "_set_pointer", set_pointer)
        published.publish(frame(spark, 3, ["2024-01-02"], "b"), path)  # another one is first
        set_pointer(folder, number, slices)

    monkeypatch.setattr(published, "_set_pointer", late)
    with pytest.raises(published.ConcurrentPublication):
        published.publish(frame(spark, 3, ["2024-01-01"], "c"), path)
    assert {r[1] for r in table(spark, path)} == {"a", "b"}


def test_nothing_published(spark, tmp_path):
    path, df = str(tmp_path / "t"), frame(spark, 0, ["2024-01-01"], "x")
    with pytest.raises(FileNotFoundError):
        published.read(spark, path)
    assert published.publish(df, path).version is None
    assert published.read(spark, path, schema=df.schema).collect() == []
    published.publish(frame(spark, 2, ["2024-01-01"], "x"), path)
    assert published.publish(df, path).rows == 0 and len(table(spark, path)) == 2
    assert published.read(spark, path, schema=df.schema).dtypes == df.dtypes


def test_null_slice_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, None), (2, 7)], "v int, part int")
    published.publish(df, path, "part")
    assert sorted(map(tuple, published.read(spark, path).collect()), key=str) == [(1, None), (2, 7)]


def test_rows_are_counted_without_a_second_job(spark, tmp_path):
    sc = spark.sparkContext
    df = frame(spark, 1000, ["2024-01-01", "2024-01-02"], "x").repartition(4)
    jobs = {}
    for name, act in (("write", lambda p: df.write.partitionBy("date").parquet(p)), ("publish", lambda p: published.publish(df, p))):
        sc.setJobGroup(f"count-{name}", name)
        done = act(str(tmp_path / name))
        jobs[name] = len(sc.statusTracker().getJobIdsForGroup(f"count-{name}"))
    sc._jsc.clearJobGroup()
    assert done.rows == 1000 and jobs["publish"] == jobs["write"]


def test_run_report_counts_its_rows(spark, tmp_path):
    done = run_report(standin_inputs(spark, SF001), STANDIN_CONFIG, str(tmp_path / "report"))
    back = published.read(spark, done.path)
    assert done.rows == back.count() > 0 and len(done.slices) == back.select("date").distinct().count() == 1
