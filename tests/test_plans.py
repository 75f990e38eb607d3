"""Plan shapes that matter at scale (checked on the physical plan text)."""

import re

import pytest
from pyspark.sql import functions as F

from perfmart.plans.catalog import QUERIES
from perfmart.plans.report import report_stages
from perfmart.sources.standins import STANDIN_CONFIG, standin_inputs

from conftest import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stages(spark):
    inputs = standin_inputs(spark, SF001)
    return report_stages(inputs, STANDIN_CONFIG, dedupe_each_step=False, upto="cloned")


def test_no_cartesian_or_nested_loop_anywhere(stages):
    for name, df in stages.items():
        p = plan(df)
        assert "CartesianProduct" not in p, name
        assert "BroadcastNestedLoopJoin" not in p, name


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def before_pivot(spark):
    return report_stages(standin_inputs(spark, SF001), STANDIN_CONFIG, upto="pivoted")["pivoted"]


def deals(p: str) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.sub(r"#\d+L?", "", p))


def test_distinct_and_pivot_share_one_exchange(spark):
    """The wide rows are dealt out once, by columns that stay unchanged; the
    label filter in between broadcasts its few codes."""
    p = plan(before_pivot(spark))
    assert "pivotfirst" not in p.lower()
    assert [d for d in deals(p) if "sourceFileName" in d or "metric" in d] == [
        "sourceFileName, isin, groupInvestment, morningstarCategory, calculatedOn, startDate, endDate"]
    assert re.search(r"BroadcastHashJoin \[metricPeriodType#\d+\]", p) and "__salt" not in p


def test_large_lookups_never_partition_rows_by_label(spark, no_broadcast):
    """Beyond the threshold rows meet the labels by label and salt; the result
    is the same."""
    df = before_pivot(spark)
    p = plan(df)
    assert re.search(r"Join \[metricPeriodType#\d+, __salt#\d+\]", p)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    small = before_pivot(spark)
    assert df.exceptAll(small).count() == 0 and small.exceptAll(df).count() == 0


def test_lookups_are_planned_by_the_bytes_of_their_cuts(spark):
    from perfmart.operators import relational
    from pyspark.sql import functions as F

    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    lookup = df.groupBy("k").agg(F.max("id").alias("m"))
    out = relational.lookup_join(df, lookup, ["k"])
    assert "BroadcastHashJoin" in plan(out) and out.count() == 100
    for limit, salted in (("1b", True), ("0", True), ("-1", True), ("10MB", False)):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            assert ("__salt" in plan(relational.lookup_join(df, lookup, ["k"], "left"))) == salted, limit
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nested_filter_and_columns_reach_the_stored_envelope(spark):
    p = plan(QUERIES["stored_reference"](spark, SF001))
    assert "StringStartsWith(data.Lib" in p and "IsPartPrinc" not in p


def test_run_report_leaves_no_scratch(spark, tmp_path):
    import os

    from perfmart.plans.report import run_report
    from perfmart.session import ensure_checkpoint_dir

    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    run_report(standin_inputs(spark, SF001), STANDIN_CONFIG, str(tmp_path / "report"))
    assert set(os.listdir(top)) == before and (tmp_path / "report").exists()


def test_latest_row_uses_partial_window_limit(spark):
    inputs = standin_inputs(spark, SF001)
    p = plan(report_stages(inputs, STANDIN_CONFIG, upto="dated")["dated"])
    assert p.count("WindowGroupLimit") == 2   # partial (map side) + final


def test_scan_pushdown_and_pruning(spark):
    p = plan(QUERIES["filter_compare"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), EqualTo(l_quantity,10.0)" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_returnflag:string>" in p


def test_building_the_report_collects_no_rows(spark):
    """No rows come to the driver while a plan is built: the names of metrics,
    one date and one number of buckets are all that does."""
    import ast
    import pathlib

    import perfmart.operators as ops
    for path in pathlib.Path(ops.__file__).parent.glob("*.py"):
        for node in ast.walk(ast.parse(path.read_text())):
            name = getattr(getattr(node, "func", None), "attr", None) if isinstance(node, ast.Call) else None
            if name in ("collect", "limit", "toPandas", "first", "head", "take", "count") and isinstance(node.func.value, ast.Call):
                where = [f.name for f in ast.walk(ast.parse(path.read_text()))
                         if isinstance(f, ast.FunctionDef) and f.lineno <= node.lineno <= f.end_lineno]
                assert where and set(where) <= {"discover_values", "latest_counted_date", "buckets_of"}, (path.name, node.lineno)


def test_registered_queries_read_whole_tables(spark):
    """No row caps: no limit operator in any single-operator query or in the
    whole report."""
    from perfmart.plans import primitives
    for key, fn in [*primitives.QUERIES.items(), ("report_mart", QUERIES["report_mart"])]:
        p = plan(fn(spark, SF001))
        # (WindowGroupLimit is the per-key newest-row pick, not a row cap)
        for cap in ("GlobalLimit", "LocalLimit", "CollectLimit", "TakeOrderedAndProject", "Sample"):
            assert cap not in p, (key, cap)


def test_wide_rows_are_dealt_out_by_their_number(spark, monkeypatch):
    """The partitions in which wide rows are compared follow the number of rows,
    not the session's partitions (8 here), and the rows are dealt out once."""
    from perfmart.operators import recode, relational, snapshot

    monkeypatch.setattr(relational, "ROWS_A_TASK", 5)
    cores = spark.sparkContext.defaultParallelism
    n = 5 * (cores + 12)
    rows = spark.range(n).selectExpr(*[f"concat('{c}', id % 500) AS {c}" for c in recode.DEAL_BY], "id * 1.5D AS value",
                                     "date_add(date'2024-01-01', int(id % 2)) AS day")

    def parts(df) -> list[int]:
        return [int(x) for x in re.findall(r"Exchange hashpartitioning\(.*?, (\d+)\)", plan(df))]

    assert parts(recode.distinct_staging(rows)) == [cores + 12]
    assert parts(relational.distinct_rows(rows)) == [cores + 12]
    twice = rows.unionByName(rows)
    assert relational.distinct_rows(twice).count() == recode.distinct_staging(twice).count() == n
    newest = snapshot.latest_calculation(rows.unionByName(rows.withColumn("day", rows["day"] + F.expr("interval 7 days"))),
                                         ["isin", "startDate", "value"], "day")
    assert parts(newest) == [2 * (cores + 12)]
    assert newest.count() == n and newest.where("day < date'2024-01-08'").isEmpty()


def test_rows_with_peer_names_are_made_distinct_once(spark):
    """They stay distinct, with one (partial and final) aggregate over the wide rows."""
    from perfmart.operators import peers, relational

    feed = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y")], "Cod string, Lib string")
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)], "peersValue string, k int")
    want = [("a", 1, "x"), ("a", 1, "y"), ("b", 2, None), (None, 3, None)]
    for given in (df, relational.distinct_rows(df)):
        named = peers.attach_peer_name(given, feed)
        assert plan(named).count("HashAggregate") == 2
        assert sorted(map(tuple, named.collect()), key=str) == sorted(want, key=str)


def test_wide_rows_after_the_peer_names_are_dealt_out_by_their_number(spark, monkeypatch):
    """Sector rows, propagated dates and output columns: no distinct compares the
    rows of a file split, and the output columns need no exchange of their own."""
    from perfmart.operators import peers, periods, publish, relational
    from perfmart.operators.colocated import bucketed_cut
    from perfmart.sources.files import stage_to_parquet

    monkeypatch.setattr(relational, "ROWS_A_TASK", 5)
    n = 5 * (spark.sparkContext.defaultParallelism + 12)
    rows = spark.range(n).selectExpr(
        "concat('p', id % 3) AS peersValue", "if(id % 2 = 0, 'IA SECTOR', concat('IA France ', id)) AS groupInvestment",
        "concat('i', id) AS isin", "'r' AS reportName", "'EUR' AS reportCurrency", "'YTD' AS periodType", "date'2024-01-07' AS date",
        "if(id % 2 = 0, null, date'2024-01-01') AS periodStartDate", "if(id % 2 = 0, null, date'2024-01-07') AS periodEndDate", "id * 1.5D AS value")
    twice = stage_to_parquet(rows.unionByName(rows))

    def wide(df) -> list[int]:
        found = re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\)", re.sub(r"#\d+L?", "", plan(df)))
        return [int(k) for by, k in found if "isin" in by]

    def first(df) -> str:   # what a wide exchange reads: no partial aggregate
        p = re.sub(r"#\d+L?", "", plan(df))
        return p[p.index("Exchange hashpartitioning(" + re.search(r"Exchange hashpartitioning\((.*?isin.*?), \d+\)", p)[1]):].splitlines()[1]

    sectors = spark.createDataFrame([("q", "France")], "peersValue string, sector string")
    fan = peers.sector_fanout(twice, sectors)
    assert wide(fan) == [2 * n // 5] and "Aggregate" not in first(fan)   # n / 2 rows, twice, under two peers
    assert fan.count() == n // 2 * 2   # under its own peer and under q
    dated = periods.propagate_dates(twice)
    stored = periods.propagate_stored_dates(bucketed_cut(twice, periods.DATE_KEYS))
    for df in (dated, stored):
        assert wide(df) == [2 * n // 5] and "Aggregate" not in first(df)
        assert df.count() == n and df.where("periodStartDate IS NULL").isEmpty()
    columns = [c for c in rows.columns if c != "peersValue"]
    out = publish.final_projection(periods.propagate_dates(twice.withColumnRenamed("value", "return"), by=[c for c in columns if c not in (
        "value", "reportName")]), [{"value": "return"}.get(c, c) for c in columns])
    report = publish.scale_and_label(out, "House Fund", renames=(("periodType", "period"),))
    for df in (out, report):
        assert wide(df) == [2 * n // 5] and df.count() == n


def test_cuts_are_files_of_bounded_rows(spark, monkeypatch):
    from perfmart.sources import files

    monkeypatch.setattr(files, "ROWS_A_FILE", 7)
    kept = files.stage_to_parquet(spark.range(20, numPartitions=1))
    assert len(kept.inputFiles()) == 3 and sorted(r.id for r in kept.collect()) == list(range(20))
