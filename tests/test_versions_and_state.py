"""Versioned staging, the incremental newest row, dates from file footers."""

import datetime as dt
import random
import re
import uuid

import pytest
from pyspark.sql import functions as F

from perfmart.operators import latest_state, snapshot
from perfmart.operators.relational import contains_pairs, latest_per_key
from perfmart.sources import versions
from perfmart.sources.files import stage_to_parquet

from test_plans import plan


def rows(df):
    return sorted(map(str, df.collect()))


# -- versions ------------------------------------------------------------------

def test_only_files_of_the_latest_version_are_read(spark, tmp_path):
    path = str(tmp_path / "staging")
    for k, day in enumerate(("2024-01-05", "2024-01-19", "2024-01-12")):
        versions.write_version(spark.range(k, 10).select("id", F.lit(day).alias("said")), path, day)
    schema = spark.range(1).select("id", F.lit("").alias("said")).schema
    want = {("2024-01-19", i) for i in range(1, 10)}
    for day in ("2024-01-05", "2024-01-12"):  # files that cannot be read
        for f in (tmp_path / "staging" / f"version={day}").glob("*.parquet"):
            f.write_bytes(b"broken")
            (f.parent / f".{f.name}.crc").unlink()
    df = versions.read_latest(spark, path, schema=schema)
    assert {(r.said, r.id) for r in df.collect()} == want and df.columns == ["id", "said"]
    assert re.search(r"PartitionFilters: \[isnotnull\(version#\d+\), \(version#\d+ = .*[Ss]ubquery", plan(df))
    with pytest.raises(Exception, match="(?i)already exists"):
        versions.write_version(spark.range(1), path, "2024-01-05")


def test_versions_as_of(spark, tmp_path):
    path = str(tmp_path / "n")
    for v in (2, 10, 9):
        versions.write_version(spark.range(v), path, str(v))
    assert versions.read_latest(spark, path).count() == 10  # as numbers, not as strings
    assert versions.read_latest(spark, path, as_of=9).count() == 9
    assert versions.read_latest(spark, path, as_of=1).count() == 0


# -- incremental newest row ------------------------------------------------------

KEYS = ["k", "part"]


def events(spark, seed, n):
    rng = random.Random(seed)
    data = [(rng.choice(["hot", "hot", "a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice([None, 1, 2, 3, 4]), rng.choice("xyz")) for _ in range(n)]
    return spark.createDataFrame(data, "k string, part int, ts int, v string")


def test_batches_give_what_one_run_gives(spark, tmp_path):
    one, two = events(spark, 1, 300), events(spark, 2, 200)
    run = uuid.uuid4().hex[:8]
    a = latest_state.merge_batch(one, KEYS, "ts", f"s_{run}_a", str(tmp_path / "a"), buckets=5)
    assert rows(a) == rows(latest_per_key(one, KEYS, "ts"))
    b = latest_state.merge_batch(two, KEYS, "ts", f"s_{run}_b", str(tmp_path / "b"), f"s_{run}_a")
    want = rows(latest_per_key(one.unionByName(two), KEYS, "ts"))
    assert rows(b) == want
    c = latest_state.merge_batch(two, KEYS, "ts", f"s_{run}_c", str(tmp_path / "c"), f"s_{run}_b")  # a repeated batch
    d = latest_state.merge_batch(two.limit(0), KEYS, "ts", f"s_{run}_d", str(tmp_path / "d"), f"s_{run}_c")
    assert rows(c) == rows(d) == want and rows(a) == rows(latest_per_key(one, KEYS, "ts"))
    assert latest_state.buckets_of(spark, f"s_{run}_d") == 5


def test_the_state_side_is_not_shuffled(spark, tmp_path):
    run = uuid.uuid4().hex[:8]
    latest_state.merge_batch(events(spark, 1, 300), KEYS, "ts", f"t_{run}", str(tmp_path / "a"), buckets=4)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(latest_state.merged_latest(spark.table(f"t_{run}"), events(spark, 2, 50), KEYS, "ts", 4))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    state, batch = p.split("Union")[1].split("Exchange", 1)
    assert "Bucketed: true" in state and "SelectedBucketsCount: 4 out of 4" in state
    assert "Exchange" not in p.split("Union")[0]  # nor is anything dealt out above


def test_a_state_without_buckets_is_refused(spark, tmp_path):
    name = f"plain_{uuid.uuid4().hex[:8]}"
    spark.range(3).write.option("path", str(tmp_path / "p")).saveAsTable(name)
    with pytest.raises(ValueError, match="not bucketed"):
        latest_state.buckets_of(spark, name)


# -- the snapshot date from footers ------------------------------------------------

def dated(spark, values):
    return spark.createDataFrame([(dt.date.fromisoformat(d) if d else None, g, i) for i, (d, g) in enumerate(values)],
                                 "date date, groupInvestment string, id int")


@pytest.mark.parametrize("values", [
    [("2024-01-05", "A"), ("2024-01-19", "B"), ("2024-01-19", "Special X"), (None, "A")],
    [("2024-01-05", "A"), ("2024-01-19", "Special"), ("2024-01-12", "B"), ("2024-01-26", None)],
    [("2024-01-05", "Special"), (None, "A")], [(None, "A")], []])
def test_slice_by_footers_equals_the_slice_by_rows(spark, values):
    df = dated(spark, values)
    cut = stage_to_parquet(df)
    assert rows(snapshot.stored_slice(cut, "Special")) == rows(snapshot.snapshot_slice(df, "Special"))
    assert rows(snapshot.stored_slice(df, "Special")) == rows(snapshot.snapshot_slice(df, "Special"))  # not stored


def test_the_date_is_read_from_footers_and_pushed_to_the_scan(spark):
    cut = stage_to_parquet(dated(spark, [("2024-01-05", "A"), ("2024-01-19", "B")]))
    p = snapshot.footer_max_frame(cut, "date")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(date)]" in p
    assert re.search(r"PushedFilters: \[IsNotNull\(date\), EqualTo\(date,2024-01-19\)\]", plan(snapshot.stored_slice(cut, "Special")))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


# -- pattern search by rare pieces -----------------------------------------------

def pairs(spark, texts, patterns, offset=0):
    t = spark.createDataFrame([(x,) for x in texts], "g string")
    p = spark.createDataFrame([(x,) for x in patterns], "s string")
    return contains_pairs(t, "g", p, "s", offset)


def test_rare_pieces_find_what_like_finds(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab %_é") for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "same", "same"]
    patterns = [t[i:i + n] for t in texts[:40] if t for i, n in [(rng.randrange(len(t)), n) for n in range(31)]]
    patterns += ["".join(rng.choice("ab %_é") for _ in range(n)) for n in range(1, 31)] + [None, ""]
    for offset in (0, 2):
        got = sorted((r.g, r.s) for r in pairs(spark, texts, patterns, offset).collect())
        assert got == sorted({(t, p) for t in texts for p in patterns if t is not None and p is not None and p in t[offset:]})


def test_emitted_pieces_do_not_grow_with_the_lengths_of_patterns(spark):
    text = "".join(chr(97 + i % 26) for i in range(200))
    made = {}
    for lengths in (range(10, 12), range(10, 40)):
        df = pairs(spark, [text], [text[i:i + n] for i, n in enumerate(lengths)])
        df.collect()
        made[len(lengths)] = max(int(x.replace(",", "")) for x in re.findall(
            r"number of output rows: ([\d,]+)", generated(df)))
    assert made[2] == made[30] == 200 - 8 + 1


def generated(df):
    """The row counts of the generators over the texts after a run."""
    out, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
        said = node.toString().split("\n")[0]
        if node.nodeName() == "Generate" and "sequence" in said and "posexplode" not in said:  # of the texts, not of the patterns
            out.append(f"number of output rows: {node.metrics().apply('numOutputRows').value()}")
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return "\n".join(out) or "number of output rows: 0"
