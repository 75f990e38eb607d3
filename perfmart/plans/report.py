"""The report as a chain of plans: staging -> ... -> published slice, joined at
a few cut points that are computed and written while the plan is built.

``report_stages`` returns every intermediate frame by name, over all dates, so
each step can be queried and checked on its own.  ``current_report`` is the job:
it takes the snapshot date as soon as the final labels are known and carries
only that date through the wide steps after it; label sets (peers with an
average, uncovered peers, sectors) still come from all dates.

Duplicates: the job's contract is a *distinct* published table.  Every step
after the pivot is a filter, projection, join, union, generator or a
duplicate-insensitive pick (newest row, smallest isin), so with
``dedupe_each_step=False`` (used for the full report) one final ``distinct``
replaces the seven intermediate ones, each a full shuffle of wide rows.
Lookups that feed a join stay deduplicated either way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart.config import ReportConfig
from perfmart.operators import benchmark, peers, periods, publish, recode, reshape, snapshot
from perfmart.session import drop_paths, scratch_path
from perfmart.sources import published
from perfmart.sources.envelope import flatten
from perfmart.sources.files import parquet_roundtrip, stage_to_parquet
from perfmart.sources.standins import ReportInputs


class _Done(Exception):
    pass


# Frames written once and read back by their consumers (see report_stages).
CUT_AT = ("feed", "families", "ci_index", "named", "sector", "report")


def report_stages(inputs: ReportInputs, cfg: ReportConfig,
                  dedupe_each_step: bool = True,
                  materialise: Callable[[DataFrame], DataFrame] | None = stage_to_parquet,
                  upto: str | None = None,
                  cut_at: tuple[str, ...] = CUT_AT) -> dict[str, DataFrame]:
    """Intermediate frames by name, built up to and including ``upto``.

    ``materialise`` is applied (at ``cut_at``) where a frame feeds several
    consumers (the reference feed, the pivoted metrics, the frame with index
    rows, peer names, sector rows, the report):
    each is computed once into the shared checkpoint folder and read back,
    instead of every consumer re-running the whole upstream plan (the logical
    plan would otherwise double with every reuse).  The frame returned for
    ``upto`` itself is never materialised.
    """
    names, schema = cfg.names, cfg.schema
    d = dedupe_each_step
    s: dict[str, DataFrame] = {}
    m = materialise or (lambda x: x)

    def put(name: str, df: DataFrame, cut: bool = False) -> DataFrame:
        s[name] = df
        if name == upto:
            raise _Done
        if cut and name in cut_at:
            s[name] = m(df)
        return s[name]

    try:
        # Reference feed, unpivoted benchmarks, special-fund rows.
        # They are independent of the staging branch, and planned when it asks
        # for them (a cut) unless one of them is the frame that is wanted.
        def reference(cut: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
            feed = put("feed", benchmark.load_reference(inputs.main_feed, inputs.share_feed, names.special_fund), cut=cut)
            bench = put("bench", reshape.unpivot_benchmarks(feed))
            return feed, bench, put("special", benchmark.special_rows(bench, names.special_fund, names.special_report))

        if upto in ("feed", "bench", "special"):
            reference(cut=False)
        # Clean, recode, relabel, drop foreign period labels.
        raw = flatten(inputs.staging, "data", ["sourceFileName"])
        staging = put("staging", recode.distinct_staging(raw))
        cleaned = put("cleaned", recode.clean_labels(staging))
        scoped = put("scoped", recode.scoped_recode(cleaned))
        relabelled = put("relabelled", recode.duplicate_relabel(scoped))
        reassigned = put("reassigned", recode.reassign_peer(relabelled))
        normalised = put("normalised", recode.normalise_period(reassigned))
        filtered = put("filtered", recode.drop_foreign_labels(normalised, recode.peer_codes(raw), cut=materialise))
        prepared = put("prepared", recode.copy_period_columns(filtered))
        # Metric names -> columns, metric families.
        pivoted = put("pivoted", reshape.pivot_sum(prepared, schema.pivot_keys, "metricType",
                                                   "metricValue", schema.metrics))
        families = put("families", reshape.coalesce_families(pivoted), cut=True)
        # Report date, newest calculation per key.
        with_date = put("with_date", snapshot.attach_report_date(families, cut=materialise))
        dated = put("dated", snapshot.latest_calculation(with_date, schema.window_keys))
        # The feed has several consumers from here on: one cut.
        feed, bench, special = reference(cut=True)
        # Flag, index rows, ragged append.
        flagged = put("flagged", benchmark.membership_flag(dated, feed, names.flag_col, cut=materialise))
        index = put("index", benchmark.index_rows(flagged, bench, names.flag_col, distinct=d))
        ci_index = put("ci_index", benchmark.append_ragged(flagged, index, special), cut=True)
        # Category averages.
        labelled = put("labelled", peers.category_label(ci_index, names.exempt_report))
        eaa = put("eaa", peers.category_fallback(labelled, names.house_prefix, distinct=d, cut=materialise))
        # Peer names, uncovered peers, sector rows.
        named = put("named", peers.attach_peer_name(eaa, feed, distinct=d, cut=materialise), cut=True)
        uncovered = put("uncovered", peers.uncovered_peers(ci_index))
        peer_sector = put("peer_sector", peers.peer_sectors(named, uncovered, inputs.transco))
        sector = put("sector", peers.sector_rows(named, peer_sector, distinct=d, cut=materialise), cut=True)
        # Period dates of synthetic rows, dealt out by the output columns that
        # the scaling leaves unchanged: the distincts after it need no exchange.
        columns = schema.output_columns(names.flag_col)
        dates = put("periods", periods.propagate_dates(
            sector, distinct=d, cut=materialise, by=[c for c in columns if c not in publish.REWRITTEN]))
        # Output columns, scaling, labels (one distinct covers both).
        projected = put("projected", publish.final_projection(dates, columns, distinct=d))
        report = put("report", publish.scale_and_label(projected, names.special_fund,
                                                       schema.renames), cut=True)
        # The snapshot date's slice and the cloned category averages.
        stored = materialise is not None and "report" in cut_at and upto != "report"
        sliced = put("slice", (snapshot.stored_slice if stored else snapshot.snapshot_slice)(report, names.special_fund))
        put("cloned", publish.clone_rows(sliced, cfg.clones()))
    except _Done:
        pass
    return s


def current_report(inputs: ReportInputs, cfg: ReportConfig,
                   materialise: Callable[[DataFrame], DataFrame] | None = stage_to_parquet) -> DataFrame:
    """The distinct report rows of the snapshot date, with their clones."""
    names, schema = cfg.names, cfg.schema
    m = materialise or (lambda x: x)
    s = report_stages(inputs, cfg, dedupe_each_step=False, materialise=materialise, upto="labelled",
                      cut_at=("feed", "families", "ci_index"))
    eaa = peers.category_fallback(s["labelled"], names.house_prefix, distinct=False, cut=materialise)
    # Later steps change labels only to the sector label, on rows that begin
    # with the sector prefix (their dates count already) or by the collapse.
    # The labels of all dates are kept as one narrow cut: dates and sectors read it.
    labels = m(eaa.select("date", "isin", "groupInvestment", "peersValue").distinct())
    dates = peers.collapse_sector_label(labels.select("date", "isin", "groupInvestment"))
    if labels.inputFiles() and materialise is not None:
        # the date is a value now: it is pushed to the scan of the wide cut
        day = snapshot.latest_counted_date(dates, names.special_fund)
        current = snapshot.on_value(eaa, day)
    else:
        current = snapshot.on_date(eaa, m(snapshot.snapshot_date(dates, names.special_fund)))
    named = m(peers.attach_peer_name(current, s["feed"], distinct=False, cut=materialise))
    uncovered = peers.uncovered_peers(s["ci_index"])
    peer_sector = peers.peer_sectors(labels, uncovered, inputs.transco)
    sector = m(peers.sector_rows(named, peer_sector, distinct=False, cut=materialise))
    dated = periods.propagate_dates(sector, distinct=False, cut=materialise)
    report = publish.scale_and_label(
        publish.final_projection(dated, schema.output_columns(names.flag_col), distinct=False),
        names.special_fund, schema.renames)
    return publish.clone_rows(report, cfg.clones())


def run_report(inputs: ReportInputs, cfg: ReportConfig, target: str) -> published.Published:
    """Build the report of the snapshot date, replace that date in ``target``,
    and remove the run's cut points.  The result counts the rows, as the write
    has seen them."""
    spark, made = inputs.staging.sparkSession, []

    def cut(df: DataFrame) -> DataFrame:
        made.append(scratch_path(spark, "cut"))
        return parquet_roundtrip(df, made[-1])

    try:
        return published.publish(current_report(inputs, cfg, cut), target)
    finally:
        drop_paths(spark, made)


def doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles (for engine-independent comparisons)."""
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
