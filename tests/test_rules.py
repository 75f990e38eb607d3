"""One small in-memory case per report rule (FIXTURES.md section 4)."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.operators import benchmark, peers, periods, publish, recode, relational, reshape, snapshot
from perfmart.session import scratch_path

D = dt.date


def _key(t):
    return tuple((x is not None, str(x)) for x in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def srt(items):
    return sorted(items, key=_key)


def staging(spark, recs):
    cols = ["scopeName", "peerGroup", "metricPeriodType", "groupInvestment", "currency",
            "morningstarRatingOverall"]
    full = [dict(zip(cols, r)) for r in recs]
    schema = ", ".join(f"{c} string" for c in cols)
    df = spark.createDataFrame([tuple(r[c] for c in cols) for r in full], schema)
    return df.withColumns({"calculatedOn": F.lit(None).cast("date"),
                           "exportedOn": F.lit(None).cast("date")})


def test_clean_labels(spark):
    df = staging(spark, [("1 - X", "Peers CI", "YTD", "g", "Euro", "ÙÙÙ"),
                         ("1 - X", "Peer CS", "YTD", "g", "Pound Sterling", "Ù"),
                         ("1 - X", "CC", "YTD", "g", "USD", None),
                         ("1 - X", "Peers x Peers y", "YTD", "g", "Euros", None)])
    out = recode.clean_labels(df)
    assert rows(out, "peersValue", "currency", "reportCurrency", "morningstarRating") == srt([
        ("CI", "EUR", "EUR", "***"), ("CS", "GBP", "GBP", "*"), ("CC", "USD", "USD", None),
        ("x y", "EURs", "EURs", None)])


def test_scoped_recode(spark):
    df = recode.clean_labels(staging(spark, [
        ("2 - X", "CI", "UK Funds W-1", "g", "USD", None),
        ("1 - X", "CI", "CI", "g", "USD", None),
        ("6 - X", "CSEM", "CSEM EUR", "g", "USD", None),
        ("6%", "CSEM", "CSEM EUR", "g", "USD", None)]))
    out = recode.scoped_recode(df)
    assert rows(out, "reportName", "peersValue", "metricPeriodType") == srt([
        ("2 - X", "UKCI", "Since UK Funds W-1"), ("1 - X", "CI", "CI"),
        ("6 - X", "CSEM", "CSEM EUR"), ("6%", "CSEM", "Ret since launch")])


def test_duplicate_reassign_normalise(spark):
    df = recode.scoped_recode(recode.clean_labels(staging(spark, [
        ("1 - X", "CI", "CGC & CFG", "EAA Fund A", "USD", None),
        ("3 - X", "CCR", "CFB", "EAA Fund A", "USD", None),
        ("1 - X", "CFB", "CCR & CEMD", "EAA Fund A", "USD", None),
        ("1 - X", "CSEM", "CS", "Other", "USD", None),
        ("1 - X", "CI", "CHX", "Other", "USD", None)])))
    out = recode.normalise_period(recode.reassign_peer(recode.duplicate_relabel(df)))
    assert rows(out, "peersValue", "metricPeriodType") == srt([
        ("CFG", C.SINCE_PM), ("CGC", C.SINCE_PM),       # CI relabelled copy + rewrite
        ("CCR", "CFB"), ("CFB", C.SINCE_PM),            # original kept, copy normalised
        ("CCR", C.SINCE_PM),                            # CFB rewritten to CCR
        ("CSEM", C.SINCE_PM),                           # CS special pair
        ("CI", "CHX")])                                 # group not EAA: unchanged


def test_drop_foreign_labels_keeps_null_period(spark):
    df = spark.createDataFrame([("CI", "CC"), ("CI", None), ("CI", "YTD"),
                                ("CI", "x CEL UKCE UKCED UKCP UKCGB y")],
                               "peersValue string, metricPeriodType string")
    peers_df = spark.createDataFrame([("CI",), ("CC",), (None,)], "peersValue string")
    out = recode.drop_foreign_labels(df, peers_df)
    assert rows(out, "metricPeriodType") == srt([(None,), ("YTD",)])


def test_coalesce_families(spark):
    df = spark.createDataFrame([(None, 1.5, 2.0, 9.0)],
                               "`Return (Cum)` double, `Return (Ann)` double, `Sharpe Ratio` double, "
                               "`Return` double")
    out = reshape.coalesce_families(df)
    r = out.collect()[0]
    # first non-null in sorted name order: "Return" < "Return (Ann)" < "Return (Cum)"
    assert r["return"] == 9.0
    assert r["sharpeRatio"] == 2.0 and r["sortinoRatio"] is None
    assert "Return" not in out.columns  # replaced case-insensitively by `return`


def test_pivot_matches_builtin(spark):
    df = spark.createDataFrame([("a", "m1", 1.0), ("a", "m1", 2.0), ("a", "m2", None),
                                (None, "m2", 3.0), ("b", "m3", 4.0)],
                               "k string, metricType string, metricValue double")
    ours = reshape.pivot_sum(df, ["k"], "metricType", "metricValue", ["m1", "m2"])
    builtin = df.groupBy("k").pivot("metricType", ["m1", "m2"]).sum("metricValue")
    assert rows(ours, "k", "m1", "m2") == rows(builtin, "k", "m1", "m2")
    assert rows(ours, "k", "m1", "m2") == srt([("a", 3.0, None), (None, None, 3.0),
                                                  ("b", None, None)])


def test_attach_report_date_and_latest(spark):
    df = spark.createDataFrame([
        ("f1", "r1", "1 week", D(2024, 1, 7), D(2024, 1, 1), "k"),
        ("f1", "r1", "YTD", D(2024, 1, 7), D(2024, 1, 2), "k"),
        ("f1", "r1", "YTD", D(2024, 1, 7), D(2024, 1, 3), "k"),
        ("f2", "r1", "YTD", D(2024, 1, 7), D(2024, 1, 3), "k")],
        "sourceFileName string, reportName string, periodType string, periodEndDate date, "
        "calculationDate date, key string")
    dated = snapshot.attach_report_date(df)
    assert dated.where("sourceFileName = 'f2'").count() == 0   # no 1 week row: dropped
    latest = snapshot.latest_calculation(dated, ["date", "periodType", "key"])
    assert rows(latest, "periodType", "calculationDate") == srt([
        ("1 week", D(2024, 1, 1)), ("YTD", D(2024, 1, 3))])


def _feed(spark):
    return spark.createDataFrame([
        Row(isin="I1", Cod="CI", Lib="House CI", DevCot="EUR", Dat=D(2024, 1, 7), bench1W=0.01,
            bench3M=None, benchYtd=0.2, bench1Y=0.3, bench3Y=0.4, bench5Y=0.5, benchPm=0.6,
            IsPartPrinc=None)],
        "isin string, Cod string, Lib string, DevCot string, Dat date, bench1W double, "
        "bench3M double, benchYtd double, bench1Y double, bench3Y double, bench5Y double, "
        "benchPm double, IsPartPrinc int")


def test_unpivot_and_index_rows(spark):
    feed = _feed(spark)
    bench = reshape.unpivot_benchmarks(feed)
    assert bench.count() == 7
    assert bench.where(F.col("return").isNull()).count() == 1   # 3 months kept with null
    s1 = reshape.unpivot_structs(feed, ["isin", "Dat"], C.BENCH_PERIODS, "periodType", "return")
    assert rows(s1, "periodType", "return") == rows(bench, "periodType", "return")
    base = spark.createDataFrame([
        ("I1", "CI", D(2024, 1, 6), D(2024, 1, 6), "EUR", "1 - X", D(2024, 1, 7)),
        ("I2", "CI", D(2024, 1, 6), D(2024, 1, 6), "EUR", "1 - X", D(2024, 1, 7))],
        "isin string, peersValue string, calculationDate date, exportDate date, "
        "reportCurrency string, reportName string, date date")
    flagged = benchmark.membership_flag(base, feed, "flag")
    assert rows(flagged, "isin", "flag") == [("I1", 1), ("I2", 0)]
    idx = benchmark.index_rows(flagged, bench, "flag")
    assert idx.count() == 6
    r = idx.where("periodType = '1 week'").collect()[0]
    assert r["groupInvestment"] == "CI Index" and r["isin"] is None and r["return"] == 0.01


def _eaa_frame(spark, recs):
    return spark.createDataFrame(recs, "reportName string, peersValue string, groupInvestment string, "
                                       "morningstarCategory string, isin string, v int")


def test_category_label(spark):
    df = _eaa_frame(spark, [("1 - X", "CI", "EAA Fund X EUR Hedged", "c", "i", 1),
                            ("1 - X", "CI", "EAA Fund X", "c", "i", 2),
                            ("1 - X", "CI", "Japan Fund Y", "c", "i", 3),
                            ("5 - DCP", "CI", "EAA Fund X", "c", "i", 4),
                            ("1 - X", "CI", "Other", "c", "i", 5)])
    out = peers.category_label(df, "5 - DCP")
    assert rows(out, "v", "categoryLabel") == [
        (1, "CI Category Average EUR Hedged"), (2, "CI Category Average"),
        (3, "CI Category Average"), (4, "EAA Fund X"), (5, "Other")]


def test_category_fallback(spark):
    df = _eaa_frame(spark, [("1 - X", "P", "House A", "EAA Fund X", "i1", 1),
                            ("1 - X", "Q", "EAA Fund X", "EAA Fund Z", "i2", 2),
                            ("1 - X", "R", "House B", "Missing Cat", "i3", 3)])
    out = peers.category_fallback(peers.category_label(df, "none"), "House")
    got = rows(out, "peersValue", "groupInvestment", "v")
    assert ("P", "P Category Average", 2) in got       # borrowed Q's EAA Fund X row
    assert ("R", "R Category Average", None) in got    # no donor: null attributes
    assert ("Q", "Q Category Average", 2) in got       # Q has its own average


def test_uncovered_and_sector_fanout(spark):
    ci = spark.createDataFrame([("A", None, "IA Y"), ("B", "i", "IA Y"), ("P", "i", "x"),
                                (None, "i", "z")],
                               "peersValue string, isin string, groupInvestment string")
    assert rows(peers.uncovered_peers(ci), "peersValue") == srt([("B",), ("P",), (None,)])
    named = spark.createDataFrame([("CI", "IA Global Y Sector", "i1"), ("CI", "IA Other", "i2"),
                                   ("CI", "Y IA", "i3")],
                                  "peersValue string, groupInvestment string, isin string")
    ps = spark.createDataFrame([("P", "Y")], "peersValue string, sector string")
    fan = peers.sector_fanout(named, ps)
    assert rows(fan, "peersValue", "groupInvestment", "isin") == [
        ("CI", C.IA_SECTOR, "i1"), ("P", C.IA_SECTOR, "i1")]


def test_collapse_sector_label(spark):
    df = spark.createDataFrame([("IA Y", None), ("IA Y", "i"), ("ASIA fund", None)],
                               "groupInvestment string, isin string")
    out = peers.collapse_sector_label(df)
    assert rows(out, "groupInvestment", "isin") == srt(
        [(C.IA_SECTOR, None), ("IA Y", "i"), (C.IA_SECTOR, None)])


def test_propagate_dates(spark):
    df = spark.createDataFrame([
        (D(2024, 1, 7), "CI", "r", "EUR", "YTD", "House A", D(2024, 1, 1), D(2024, 1, 7)),
        (D(2024, 1, 7), "CI", "r", "EUR", "YTD", "CI Index", None, None),
        (D(2024, 1, 7), "CI", "r", "EUR", "YTD", "CI Category Average EUR Hedged", D(2023, 1, 1), None),
        (D(2024, 1, 7), "CX", "r", "EUR", "YTD", "CX Category Average", D(2023, 1, 1), None)],
        "date date, peersValue string, reportName string, reportCurrency string, periodType string, "
        "groupInvestment string, periodStartDate date, periodEndDate date")
    out = periods.propagate_dates(df)
    assert rows(out, "groupInvestment", "periodStartDate", "periodEndDate") == srt([
        ("House A", D(2024, 1, 1), D(2024, 1, 7)), ("CI Index", D(2024, 1, 1), D(2024, 1, 7)),
        # a hedged average is not synthetic: it keeps its dates and feeds the lookup,
        # so the index row fans out over both date pairs
        ("CI Index", D(2023, 1, 1), None),
        ("CI Category Average EUR Hedged", D(2023, 1, 1), None), ("CX Category Average", None, None)])


def test_scale_label_slice_clone(spark):
    df = spark.createDataFrame([
        (D(2024, 1, 7), "1 - dcp x", "CI Index", "CI", "YTD", 0.01),
        (D(2024, 1, 7), "1 - x", "CI Category Average", "CI", "YTD", 2.0),
        (D(2024, 1, 7), "1 - x", "CI Category Average", "CI", C.SINCE_PM, 3.0),
        (D(2024, 1, 7), "3 - x", "CCR Category Average", "CCR", "YTD", 4.0),
        (D(2024, 1, 14), "1 - x", "Special Fund", "S", "YTD", 5.0),
        (D(2023, 1, 7), "1 - x", "Other", "O", "YTD", 6.0)],
        "date date, reportName string, groupInvestment string, peersValue string, "
        "periodType string, `return` double")
    rep = publish.scale_and_label(df, "Special Fund", renames=())
    assert rows(rep.where("groupInvestment = 'CI Index'"), "reportName", "return") == [("1 - Dcp X", 1.0)]
    sl = snapshot.snapshot_slice(rep, "Special")
    assert {r["date"] for r in sl.collect()} == {D(2024, 1, 7)}
    cl = publish.clone_rows(sl, C.default_clone_rules(C.HouseNames(clone_report="3 - Latam")))
    got = rows(cl.where("groupInvestment NOT LIKE 'CI %' AND groupInvestment NOT LIKE 'CCR %'"),
               "peersValue", "reportName", "periodType")
    # Since PM* rows are not cloned; the clone report name is set after the title-casing
    assert got == srt([("CFG", "1 - X", "YTD"), ("CGC", "1 - X", "YTD"), ("CHX", "1 - X", "YTD"),
                       ("CFB", "3 - Latam", "YTD")])


def test_snapshot_of_empty_frame_publishes_nothing(spark):
    df = spark.createDataFrame([], "date date, groupInvestment string, v int")
    assert snapshot.snapshot_slice(df, "X").count() == 0


def test_publish_slice_is_idempotent(spark):
    target = scratch_path(spark, "test-publish")
    a = spark.createDataFrame([(D(2024, 1, 7), 1), (D(2024, 1, 14), 2)], "date date, v int")
    publish.publish_slice(a, target)
    b = spark.createDataFrame([(D(2024, 1, 14), 20)], "date date, v int")
    publish.publish_slice(b, target)
    publish.publish_slice(b, target)
    back = publish.read_published(spark, target)
    assert rows(back, "date", "v") == [(D(2024, 1, 7), 1), (D(2024, 1, 14), 20)]


@pytest.mark.parametrize("texts,patterns", [
    (["IA Asia Pacific", "IA UK Smaller", "IAUK", "IA", "", "xIA UK"], ["UK", "Asia", "", "A", "Pacific x"]),
    (["IA a%b", "IA ab", "IA a_b"], ["a%b", "a_b", "%"]),
])
def test_contains_join_matches_brute_force(spark, texts, patterns):
    t = spark.createDataFrame([(x, i) for i, x in enumerate(texts)], "g string, i int")
    p = spark.createDataFrame([(x, j) for j, x in enumerate(patterns)], "s string, j int")
    got = rows(relational.contains_join(t, "g", p, "s", offset=2), "i", "j")
    want = sorted((i, j) for i, x in enumerate(texts) for j, y in enumerate(patterns) if y in x[2:])
    assert got == want


def test_contains_candidates_are_matches_however_alike_patterns_begin(spark):
    """Patterns that share ten leading characters meet only the texts that hold them."""
    t = spark.createDataFrame([(f"IA SAMEPREFIX{i:03d} Sector",) for i in range(60)], "g string")
    p = spark.createDataFrame([(f"SAMEPREFIX{i:03d}",) for i in range(60)], "s string")
    pairs = relational.contains_pairs(t, "g", p, "s", offset=2)
    assert sorted(r.s for r in pairs.collect()) == [f"SAMEPREFIX{i:03d}" for i in range(60)]
    joins = [x for x in pairs._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x]
    assert all("Contains" not in x for x in joins)  # equality decides, not a filter on candidates


def test_salted_join_spreads_a_hot_key(spark):
    """All rows under one key, and nulls: same rows as a plain join, many tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(4000).select(F.when(F.col("id") % 5 > 0, F.lit("hot")).alias("k"), "id")
        lookup = spark.createDataFrame([("hot", 1), ("hot", 2), ("other", 3)], "k string, v int")
        for how in ("inner", "left"):
            out = relational.salted_join(df, lookup, ["k"], how)
            want = df.join(lookup, ["k"], how)
            assert rows(out, "k", "id", "v") == rows(want, "k", "id", "v")
        sizes = [r["count"] for r in relational.salted_join(df, lookup, ["k"], "left")
                 .groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 0.6 * sum(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metrics_by_discovery_without_percentile_rows(spark):
    """No metric list and no percentile rows: the percentile is a typed null."""
    df = spark.createDataFrame([("a", "Return (Cum)", 1.0), ("a", "Sharpe Ratio (1Y)", 2.0)], "k string, metricType string, metricValue double")
    out = reshape.coalesce_families(reshape.pivot_sum(df, ["k"], "metricType", "metricValue"))
    assert out.schema["Morningstar category percentile"].dataType.typeName() == "double"
    assert out.first()["Morningstar category percentile"] is None and out.first()["return"] == 1.0


def test_discovery_follows_the_session_limit(spark):
    df = spark.range(6).select(F.col("id").cast("string").alias("m"))
    assert reshape.discover_values(df, "m") == list("012345")
    spark.conf.set("spark.sql.pivotMaxValues", "5")
    try:
        with pytest.raises(ValueError):
            reshape.discover_values(df, "m")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")


def test_scratch_is_refused_off_the_local_machine(monkeypatch):
    from perfmart import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_empty_publish_can_be_read(spark, tmp_path):
    df = spark.createDataFrame([], "v int, date date")
    target = publish.publish_slice(df, str(tmp_path / "t"))
    assert publish.read_published(spark, target, schema=df.schema).count() == 0


def test_fixed_rule_values():
    """Literal expectations, so that a wrong constant in the config shows."""
    from perfmart import config as C
    assert [(x.group, x.report_prefix, x.new_peer, x.new_group, x.skip_period) for x in C.default_clone_rules(C.HouseNames())] == [
        ("CI Category Average", "1", "CHX", "CHX Category Average", C.SINCE_PM),
        ("CI Category Average", "1", "CGC", "CGC Category Average", C.SINCE_PM),
        ("CI Category Average", "1", "CFG", "CFG Category Average", C.SINCE_PM),
        ("CFB Category Average", "1", "CCR", "CCR Category Average", C.SINCE_PM),
        ("CCR Category Average", "3", "CFB", "CFB Category Average", C.SINCE_PM)]
    schema = C.ReportSchema()
    assert (len(schema.pivot_keys), len(schema.window_keys), len(schema.output_columns("flag"))) == (53, 45, 57)
    assert C.PERCENTILE_METRIC == "Morningstar category percentile"
    assert (C.INDEX_SUFFIX.strip(), C.CATEGORY_AVERAGE.strip(), C.IA_SECTOR) == ("Index", "Category Average", "IA SECTOR")
