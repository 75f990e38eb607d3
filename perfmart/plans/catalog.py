"""Query catalogue: every operator of the report as a named query over the
driver's tables, with its independent SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE[name] -> SQL``.
Report steps run on the stand-in inputs (``perfmart.sources.standins``);
generic operators run directly on the TPC-H-like tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from perfmart.operators import peers, reshape
from perfmart.plans import oracle, primitives
from perfmart.plans.report import current_report, doubles, report_stages
from perfmart.sources.standins import STANDIN_CONFIG, standin_inputs

Query = Callable[[SparkSession, str], DataFrame]

# query key -> report stage it returns (SURVEY operator keys where they exist)
STAGE_KEYS: dict[str, str] = {
    "struct_flatten": "staging",
    "regex_clean": "cleaned",
    "scoped_recode": "scoped",
    "duplicate_relabel": "relabelled",
    "case_expr": "reassigned",
    "like_dynamic": "normalised",
    "foreign_label_filter": "filtered",
    "project_alias": "prepared",
    "pivot_sum": "pivoted",
    "metric_family_coalesce": "families",
    "attach_report_date": "with_date",
    "latest_per_key": "dated",
    "union_by_name": "feed",
    "membership_flag": "flagged",
    "unpivot_columns": "bench",
    "special_rows": "special",
    "index_rows": "index",
    "union_ragged": "ci_index",
    "category_label": "labelled",
    "category_fallback": "eaa",
    "join_left_expr": "named",
    "except_values": "uncovered",
    "group_first": "peer_sector",
    "sector_fanout": "sector",
    "propagate_dates": "periods",
    "project_subset": "projected",
    "conditional_scale": "report",
    "snapshot_slice": "slice",
    "clone_rules": "cloned",
}

# Spark stage name -> oracle CTE name where they differ.
_ORACLE_STAGE = {"index": "index_rows"}


# The same steps where several peers have no sector row of their own, sectors lie
# in one another's names and foreign periods carry their marker.
WIDE_KEYS: dict[str, str] = {
    "foreign_label_filter_wide": "filtered",
    "except_values_wide": "uncovered",
    "group_first_wide": "peer_sector",
    "sector_fanout_wide": "sector",
    "category_fallback_wide": "eaa",
}


def stage_query(stage: str, csv: bool = False, wide: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = standin_inputs(spark, sf_dir, csv=csv, wide=wide)
        return doubles(report_stages(inputs, STANDIN_CONFIG, upto=stage)[stage])
    run.__name__ = f"stage_{stage}"
    return run


def report_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report (C1-C28) as the job runs it: one final distinct, lineage
    cut at the reuse points, the transcoding table read from its CSV file."""
    inputs = standin_inputs(spark, sf_dir, csv=True)
    return doubles(current_report(inputs, STANDIN_CONFIG))


def report_mart_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report on the wide stand-in (see ``WIDE_KEYS``)."""
    return doubles(current_report(standin_inputs(spark, sf_dir, csv=True, wide=True), STANDIN_CONFIG))


def propagate_dates_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C24 on a bucketed cut: the rows are dealt out once, when they are stored."""
    from perfmart.operators.colocated import bucketed_cut
    from perfmart.operators.periods import DATE_KEYS, propagate_stored_dates

    sector = report_stages(standin_inputs(spark, sf_dir), STANDIN_CONFIG, upto="sector")["sector"]
    return doubles(propagate_stored_dates(bucketed_cut(sector, DATE_KEYS)))


def empty_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No peer is uncovered, so the sector rows come from an empty frame of
    (peersValue, sector) and only the label collapse is left."""
    from pyspark.sql import functions as F

    named = report_stages(standin_inputs(spark, sf_dir), STANDIN_CONFIG, upto="named")["named"]
    none = spark.range(0).select(F.lit(None).cast("string").alias("peersValue"), F.lit(None).cast("string").alias("sector"))
    return doubles(peers.sector_rows(named, none))


def report_mart_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report with the production schema: 53 pivot keys, 45 window
    keys, 57 output columns with the three shortened names."""
    from perfmart.config import ESG_ATTRIBUTES
    from perfmart.sources.standins import FULL_CONFIG

    inputs = standin_inputs(spark, sf_dir, csv=True, attributes=ESG_ATTRIBUTES)
    return doubles(current_report(inputs, FULL_CONFIG))


def publish_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C29 on the real report: build, publish the snapshot slice into a
    date-partitioned table under the shared scratch folder (twice: the
    second run replaces the same partition), read the table back."""
    from perfmart.operators.publish import read_published
    from perfmart.plans.report import run_report
    from perfmart.session import scratch_path

    target = scratch_path(spark, "report-table")
    for _ in range(2):
        run_report(standin_inputs(spark, sf_dir, csv=True), STANDIN_CONFIG, target)
    back = read_published(spark, target)
    return doubles(back.select(*[c for c in back.columns if c != "date"], "date"))


def published_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 without a job of its own: the rows and slices that the publication of
    the report has counted while it wrote them."""
    from pyspark.sql import functions as F

    from perfmart.plans.report import run_report
    from perfmart.session import scratch_path

    done = run_report(standin_inputs(spark, sf_dir, csv=True), STANDIN_CONFIG, scratch_path(spark, "report-table"))
    return spark.range(1).select(F.lit(done.rows).cast("bigint").alias("rows"), F.lit(len(done.slices)).cast("bigint").alias("slices"))


def staging_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staging feed stored in three versions, each with more rows than
    the one before; the latest is found by its folder and read alone."""
    from pyspark.sql import functions as F

    from perfmart.session import scratch_path
    from perfmart.sources.envelope import flatten
    from perfmart.sources.files import stage_to_parquet
    from perfmart.sources.versions import read_latest, write_version

    path = scratch_path(spark, "staging-versions")
    rows = stage_to_parquet(standin_inputs(spark, sf_dir).staging)
    part = F.pmod(F.xxhash64("data.isin", "data.calculatedOn"), F.lit(3))
    for k, day in enumerate(("2024-01-05", "2024-01-12", "2024-01-19")):
        write_version(rows.where(part <= k), path, day)
    return doubles(flatten(read_latest(spark, path, schema=rows.schema), "data", ["sourceFileName"]).distinct())


def latest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1/C10 batch by batch: the dated rows arrive in three batches, the last
    of which repeats rows of the first; each is merged into the kept state."""
    import uuid

    from pyspark.sql import functions as F

    from perfmart.operators.latest_state import merge_batch
    from perfmart.session import scratch_path
    from perfmart.sources.files import stage_to_parquet

    rows = stage_to_parquet(report_stages(standin_inputs(spark, sf_dir), STANDIN_CONFIG, upto="with_date")["with_date"])
    keys = STANDIN_CONFIG.schema.window_keys
    part = F.pmod(F.datediff("calculationDate", F.lit("2000-01-01").cast("date")), F.lit(3))
    run, state = uuid.uuid4().hex[:12], None
    for k, batch in enumerate((part == 0, part == 1, part != 1)):
        name = f"latest_{run}_{k}"
        out = merge_batch(rows.where(batch), keys, "calculationDate", name, scratch_path(spark, name), state)
        state = name
    return doubles(out)


def report_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report from stored envelopes: all three feeds are written as
    ``{data: struct}`` Parquet to the shared scratch folder and read back."""
    from perfmart.session import scratch_path
    from perfmart.sources.envelope import read_table
    from perfmart.sources.standins import ReportInputs

    made = standin_inputs(spark, sf_dir, csv=True)

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, f"envelope-{name}")
        df.write.parquet(path)
        return read_table(spark, path)

    inputs = ReportInputs(stored(made.staging, "staging"), stored(made.main_feed, "main"),
                          stored(made.share_feed, "share"), made.transco)
    return doubles(current_report(inputs, STANDIN_CONFIG))


def stored_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 from storage: the share-level envelope written to the shared scratch
    folder and read back; the filter on ``data.Lib`` reaches the scan."""
    from perfmart.session import scratch_path
    from perfmart.sources.envelope import flatten, read_table

    path = scratch_path(spark, "envelope")
    standin_inputs(spark, sf_dir).share_feed.write.parquet(path)
    stored = read_table(spark, path)
    found = stored.where(stored["data.Lib"].startswith(STANDIN_CONFIG.names.special_fund))
    return flatten(found).select("isin", "Cod", "Lib", "Dat", "bench1W")


def unpivot_structs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C13 through ``explode(array(struct))`` instead of ``unpivot``."""
    from perfmart import config as C
    feed = report_stages(standin_inputs(spark, sf_dir), STANDIN_CONFIG, upto="feed")["feed"]
    bench_cols = {src for src, _ in C.BENCH_PERIODS}
    ids = [c for c in feed.columns if c not in bench_cols]
    long = reshape.unpivot_structs(feed, ids, C.BENCH_PERIODS, "periodType", "return")
    return long.withColumns({"periodStartDate": long["Dat"], "date": long["Dat"]})


def collapse_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C23 alone, on the rows with peer names."""
    named = report_stages(standin_inputs(spark, sf_dir), STANDIN_CONFIG, upto="named")["named"]
    return doubles(peers.collapse_sector_label(named))


def _build() -> tuple[dict[str, Query], dict[str, str]]:
    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for key, stage in STAGE_KEYS.items():
        queries[key] = stage_query(stage)
        sql[key] = oracle.stage_sql(_ORACLE_STAGE.get(stage, stage))
    for key, stage in WIDE_KEYS.items():
        queries[key] = stage_query(stage, wide=True)
        sql[key] = oracle.stage_sql(_ORACLE_STAGE.get(stage, stage), wide=True)
    queries["report_mart_wide"] = report_mart_wide
    sql["report_mart_wide"] = oracle.stage_sql("cloned", wide=True)
    queries["propagate_dates_colocated"] = propagate_dates_colocated
    sql["propagate_dates_colocated"] = oracle.stage_sql("periods")
    queries["empty_frame"] = empty_frame
    sql["empty_frame"] = oracle.stage_sql(
        "named", "SELECT * REPLACE (CASE WHEN groupInvestment LIKE '%IA%' AND isin IS NULL "
                 "THEN 'IA SECTOR' ELSE groupInvestment END AS groupInvestment) FROM named")
    queries["unpivot_structs"] = unpivot_structs
    sql["unpivot_structs"] = oracle.stage_sql("bench")
    queries["collapse_label"] = collapse_label
    sql["collapse_label"] = oracle.stage_sql(
        "named", "SELECT * REPLACE (CASE WHEN groupInvestment LIKE '%IA%' AND isin IS NULL "
                 "THEN 'IA SECTOR' ELSE groupInvestment END AS groupInvestment) FROM named")
    queries["report_mart"] = report_mart
    sql["report_mart"] = oracle.stage_sql("cloned")
    queries["report_mart_full"] = report_mart_full
    from perfmart.sources.standins import FULL_SCHEMA
    sql["report_mart_full"] = oracle.stage_sql("cloned", schema=FULL_SCHEMA)
    queries["report_from_files"] = report_from_files
    sql["report_from_files"] = oracle.stage_sql("cloned")
    queries["stored_reference"] = stored_reference
    sql["stored_reference"] = oracle.stage_sql(
        "feed", "SELECT isin, Cod, Lib, Dat, bench1W FROM feed WHERE IsPartPrinc IS NOT NULL")
    queries["publish_report"] = publish_report
    sql["publish_report"] = oracle.stage_sql("cloned")
    queries["staging_snapshot"] = staging_snapshot
    sql["staging_snapshot"] = oracle.stage_sql("staging")
    queries["latest_incremental"] = latest_incremental
    sql["latest_incremental"] = oracle.stage_sql("dated")
    queries["published_rows"] = published_rows
    sql["published_rows"] = oracle.stage_sql(
        "cloned", "SELECT count(*) AS rows, count(DISTINCT date) AS slices FROM cloned")
    for key, fn in primitives.QUERIES.items():
        queries[key] = fn
        if key in primitives.ORACLE:
            sql[key] = primitives.ORACLE[key]
    return queries, sql


QUERIES, ORACLE = _build()
