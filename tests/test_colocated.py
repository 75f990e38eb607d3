"""Bucketed cuts: joined without an exchange of the stored rows, hot keys included."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perfmart.operators import periods
from perfmart.operators.colocated import SPREAD, bucketed_cut, colocated_join

from test_plans import plan


@pytest.fixture
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def key(df):
    return sorted(map(str, df.collect()))


def test_a_hot_key_lies_in_many_buckets_and_joins_where_it_lies(spark, static_plans):
    df = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 9 > 0, F.lit("b")).alias("k"), "id")
    lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("c", 3), (None, 4)], "k string, v int")
    cut = bucketed_cut(df, ["k"], buckets=8)
    for how in ("inner", "left", "left_semi", "left_anti"):
        assert key(colocated_join(cut, lookup, ["k"], how).select(*(["k", "id", "v"] if how in ("inner", "left") else ["k", "id"]))) == key(
            df.join(lookup, ["k"], how).select(*(["k", "id", "v"] if how in ("inner", "left") else ["k", "id"])))
    out = colocated_join(cut, lookup, ["k"], "left")
    stored, dealt = plan(out).split("Exchange", 1)
    assert "Bucketed: true" in stored and "FileScan" not in dealt and plan(out).count("Exchange") == 1
    sizes = [r["count"] for r in out.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 0.5 * sum(sizes)


def test_stored_dates_equal_the_plain_step(spark, static_plans):
    day = dt.date(2024, 1, 5)
    rows = []
    for i in range(200):  # one key holds most rows
        peer = "CI" if i % 4 else f"P{i % 7}"
        group = [f"{peer} Index", f"{peer} Category Average", "IA SECTOR", "Fund", None][i % 5]
        rows.append((day if i % 11 else None, peer, "1 - R", "EUR", "1 week", group, day - dt.timedelta(i % 3), day, i))
    df = spark.createDataFrame(rows, "date date, peersValue string, reportName string, reportCurrency string, periodType string, "
                                     "groupInvestment string, periodStartDate date, periodEndDate date, i int")
    cut = bucketed_cut(df, periods.DATE_KEYS, buckets=6)
    out = periods.propagate_stored_dates(cut, distinct=False)
    assert key(out) == key(periods.propagate_dates(df, distinct=False)) and out.columns == df.columns
    p = plan(out)
    wide = [x for x in p.split("\n") if "Exchange" in x and "groupInvestment" in x]
    assert wide == [] and SPREAD in p
    assert "i#" not in "".join(x for x in p.split("\n") if "Exchange" in x)


def test_files_of_a_bucket_hold_bounded_rows(spark, static_plans, monkeypatch):
    """A scan without a join packs files, not buckets, into its tasks."""
    from perfmart.sources import files

    monkeypatch.setattr(files, "ROWS_A_FILE", 7)
    df = spark.range(300).select(F.concat(F.lit("k"), F.col("id") % 20).alias("k"), "id")
    lookup = df.select("k", F.length("k").alias("v")).distinct()
    cut = bucketed_cut(df, ["k"], buckets=4)
    assert cut.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 7
    assert key(cut.drop(SPREAD)) == key(df)
    out = colocated_join(cut, lookup, ["k"])
    assert "Bucketed: true" in plan(out) and plan(out).count("FileScan") == 1
    assert key(out.select("k", "id", "v")) == key(df.join(lookup, "k").select("k", "id", "v"))
