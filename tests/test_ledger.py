"""Appends that can be repeated and aborted."""

import os

import pytest
from pyspark.sql import functions as F

from perfmart.sources import ledger


def frame(spark, n, tag="x"):
    return spark.range(n).select("id", F.when(F.col("id") % 3 > 0, F.lit(tag)).alias("tag"))


def stored(spark, path, df):
    return sorted(map(str, ledger.read_appended(spark, path, df.schema).collect()))


def test_repeated_appends_leave_one_copy(spark, tmp_path):
    path, df = str(tmp_path / "t"), frame(spark, 100).repartition(4)
    want = sorted(map(str, df.collect()))
    ledger.append_once(df, path, "2024-01-05")
    ledger.append_once(df, path, "2024-01-05")
    ledger.append_once(df.repartition(7, "id").orderBy(F.desc("id")), path, "2024-01-05")
    assert stored(spark, path, df) == want
    assert len([n for n in os.listdir(path) if n.startswith("batch=")]) == 1
    ledger.append_once(df, path, "2024-01-12")  # another slice
    ledger.append_once(frame(spark, 100, "y"), path, "2024-01-05")  # other rows
    assert len(stored(spark, path, df)) == 300 and len(ledger.batches(path)) == 3


def test_an_aborted_append_leaves_nothing(spark, tmp_path):
    path, df = str(tmp_path / "t"), frame(spark, 100).repartition(4)
    ledger.append_once(df, path, "a")
    before = stored(spark, path, df)
    bad = df.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken row"))).otherwise(F.col("id") + 1000))
    with pytest.raises(Exception, match="broken row"):
        ledger.append_once(bad, path, "b")
    assert stored(spark, path, df) == before and len([n for n in os.listdir(path) if n.startswith("batch=")]) == 1
    ledger.append_once(df.withColumn("id", F.col("id") + 1000), path, "b")
    assert len(stored(spark, path, df)) == 200


def test_files_of_a_lost_attempt_do_not_count(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    path, schema = str(tmp_path / "t"), frame(spark, 1).schema
    writer = ledger.LedgerWriter({"path": path, "slice": "a"}, schema)
    os.makedirs(f"{path}/batch={writer.batch}")
    for name in ("part-000000-1.parquet", "part-000000-2.parquet"):  # the first attempt's file was left behind
        pq.write_table(pa.table({"id": [1], "tag": ["x"]}), f"{path}/batch={writer.batch}/{name}")
    assert stored(spark, path, frame(spark, 1)) == []  # not committed yet
    writer.commit([ledger.Part("part-000000-2.parquet", 1, (5, 6)), None, ledger.Part(None, 0, (0, 0))])
    assert os.listdir(f"{path}/batch={writer.batch}") == ["part-000000-2.parquet"]
    assert [tuple(r) for r in ledger.read_appended(spark, path, schema).collect()] == [(1, "x")]


def test_two_commits_at_the_same_moment(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "t"), frame(spark, 20)
    seen, batch_of = [], ledger._batch_of

    def late(fs, entry):  # both have looked before either entered
        seen.append(entry)
        return None if len(seen) in (1, 3) else batch_of(fs, entry)

    names = []
    for name in ("b" * 32, "a" * 32):
        writer = ledger.LedgerWriter({"path": path, "slice": "s"}, df.schema)
        writer.batch = name
        os.makedirs(f"{path}/batch={name}")
        ledger.pq.write_table(ledger.pa.table({"id": [1], "tag": [name]}), f"{path}/batch={name}/p.parquet")
        names.append(writer)
    monkeypatch.setattr(ledger, "_batch_of", late)
    for writer in names:
        writer.commit([ledger.Part("p.parquet", 1, (1, 2))])
    monkeypatch.undo()
    assert [r.tag for r in ledger.read_appended(spark, path, df.schema).collect()] == ["a" * 32]


def test_nothing_to_append(spark, tmp_path):
    path, df = str(tmp_path / "t"), frame(spark, 0)
    assert stored(spark, path, df) == []
    ledger.append_once(df, path, "a")
    assert stored(spark, path, df) == [] and ledger.batches(path) == {}
    for name in ("", "a/b", "1.2"):
        with pytest.raises(ValueError):
            ledger.append_once(df, path, name)
    with pytest.raises(Exception, match="appended to"):
        df.write.format(ledger.FORMAT).mode("overwrite").option("path", path).option("slice", "a").save()
