"""Label cleaning and recoding of the long metric table (steps before the pivot).

Input columns are those of the flattened staging envelope: ``scopeName,
peerGroup, metricPeriodType, currency, morningstarRatingOverall,
calculatedOn, exportedOn, isin, groupInvestment, ...``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.operators.relational import dealt, lookup_join
from perfmart.sources.files import stage_to_parquet
from perfmart.functions import (
    is_own_period,
    map_lookup,
    recode_in_scope,
    replace_all,
    strip_leading_label,
)


def clean_labels(df: DataFrame,
                 currency_renames=C.CURRENCY_RENAMES,
                 peer_prefixes: Sequence[str] = C.PEER_PREFIXES) -> DataFrame:
    """Rating glyphs to stars, currency names to codes, report-level names,
    and the ``Peers ``/``Peer `` marker removed from peer groups."""
    currency = replace_all("currency", currency_renames)
    return df.withColumns({
        "morningstarRating": F.replace(F.col("morningstarRatingOverall"),
                                       F.lit(C.RATING_GLYPH), F.lit(C.RATING_STAR)),
        "currency": currency,
        "calculationDate": F.col("calculatedOn"),
        "exportDate": F.col("exportedOn"),
        "reportName": F.col("scopeName"),
        "reportCurrency": currency,
        "peersValue": strip_leading_label("peerGroup", peer_prefixes),
    })


def scoped_recode(df: DataFrame,
                  scope_pattern: str = C.UK_SCOPE_PATTERN,
                  peer_map=None, period_map=None,
                  guarded=C.GUARDED_PERIOD_RULES) -> DataFrame:
    """Inside reports LIKE ``scope_pattern`` peer codes and period labels take
    their scoped names; elsewhere the guarded rules (report compared by
    equality) may rename a period."""
    if peer_map is None:
        peer_map = [(c, C.UK_PREFIX + c) for c in C.UK_PEER_CODES]
    if period_map is None:
        period_map = [(c, C.UK_PREFIX + c) for c in C.UK_PERIOD_CODES] + list(C.UK_PERIOD_EXTRA)
    in_scope = F.col("reportName").like(scope_pattern)
    period = F.col("metricPeriodType")
    new_period = F.when(in_scope, F.coalesce(map_lookup(period, period_map), period))
    for report, old, new in guarded:
        new_period = new_period.when((F.col("reportName") == report) & (period == old), F.lit(new))
    return df.withColumns({
        "peersValue": recode_in_scope("peersValue", in_scope, peer_map),
        "metricPeriodType": new_period.otherwise(period),
    })


def _rule_match(peer: str, period: str, group_prefix: str, report_prefix: str | None) -> Column:
    cond = ((F.col("peersValue") == peer) & (F.col("metricPeriodType") == period)
            & F.col("groupInvestment").startswith(group_prefix))
    if report_prefix is not None:
        cond = cond & F.col("reportName").startswith(report_prefix)
    return cond


def duplicate_relabel(df: DataFrame, rules=C.DUPLICATE_RULES) -> DataFrame:
    """Add a copy, under a new peer, of rows matching a rule (first rule wins).

    Written as a generator (each row explodes into itself plus its copy), not
    as ``df UNION df.where(rule)``: the input is read once, not twice."""
    if not rules:
        return df
    new_peer = None
    for peer, period, group_prefix, report_prefix, target in rules:
        m = _rule_match(peer, period, group_prefix, report_prefix)
        new_peer = F.when(m, F.lit(target)) if new_peer is None else new_peer.when(m, F.lit(target))
    copies = F.when(new_peer.isNotNull(), F.array(F.col("peersValue"), new_peer)) \
              .otherwise(F.array(F.col("peersValue")))
    return df.withColumn("peersValue", F.explode(copies))


def reassign_peer(df: DataFrame, rules=C.REASSIGN_RULES) -> DataFrame:
    """Rewrite the peer of rows matching a rule in place (first rule wins)."""
    if not rules:
        return df
    expr = None
    for peer, period, group_prefix, target in rules:
        m = _rule_match(peer, period, group_prefix, None)
        expr = F.when(m, F.lit(target)) if expr is None else expr.when(m, F.lit(target))
    return df.withColumn("peersValue", expr.otherwise(F.col("peersValue")))


def normalise_period(df: DataFrame, label: str = C.SINCE_PM,
                     special=C.OWN_PERIOD_SPECIAL) -> DataFrame:
    """A period that names the row's own peer becomes ``label``."""
    own = is_own_period("metricPeriodType", "peersValue", special)
    return df.withColumn("metricPeriodType",
                         F.when(own, F.lit(label)).otherwise(F.col("metricPeriodType")))


def drop_foreign_labels(df: DataFrame, peers: DataFrame,
                        marker: str = C.FOREIGN_PERIOD_MARKER, cut=stage_to_parquet) -> DataFrame:
    """Remove rows whose period equals any peer code of ``peers`` (a one-column
    frame ``peersValue``) or contains ``marker``; a null period is kept.

    The distinct codes are written first (``lookup_join``): while Spark may
    broadcast them, the rows are filtered where they are."""
    codes = (peers.select(F.col("peersValue").alias("metricPeriodType")).where(F.col("metricPeriodType").isNotNull())
                  .distinct().withColumn("__code", F.lit(1)))
    # Left join on the distinct codes + "no match", i.e. an anti join whose
    # condition stays on the computed period column (an anti join would be
    # pushed below the projections, inlining the whole label expression).
    kept = (lookup_join(df, codes, ["metricPeriodType"], "left", cut)
            .where(F.col("__code").isNull()).select(*df.columns))
    return kept.where(F.col("metricPeriodType").isNull()
                      | ~F.col("metricPeriodType").contains(marker))


#: Staging columns that every step up to the pivot leaves as they are and that
#: are pivot keys (three of them under another name).  Numbers are left out:
#: an aggregate normalises them, so they could not serve as its partitioning.
DEAL_BY = ("sourceFileName", "isin", "groupInvestment", "morningstarCategory", "calculatedOn", "startDate", "endDate")


def distinct_staging(raw: DataFrame, by: Sequence[str] = DEAL_BY) -> DataFrame:
    """Distinct staging rows, dealt out once by columns that stay unchanged up
    to the pivot: the distinct and the pivot both accept that partitioning, so
    the wide rows are exchanged a single time.  Rows without an isin are spread
    by their group, category and dates.  The rows are counted first, so that a
    task's share does not grow with them (``dealt``)."""
    return dealt(raw, by, raw.count()).distinct()


def copy_period_columns(df: DataFrame) -> DataFrame:
    """Report-level names of the period and fund columns."""
    return df.withColumns({
        "returnDateDaily": F.col("inceptionDate"),
        "netFlowYTD": F.col("flowYTD"),
        "periodType": F.col("metricPeriodType"),
        "periodStartDate": F.col("startDate"),
        "periodEndDate": F.col("endDate"),
    })


def peer_codes(raw_staging: DataFrame) -> DataFrame:
    """Peer codes after the scoped recode (before relabelled copies are added).
    The recode is row-wise in two columns, so their distinct pairs of the raw
    staging rows are enough; only these two columns are read."""
    pairs = raw_staging.select("peerGroup", "scopeName").distinct()
    peers = pairs.select(F.col("scopeName").alias("reportName"), F.lit(None).cast("string").alias("metricPeriodType"),
                         strip_leading_label("peerGroup", C.PEER_PREFIXES).alias("peersValue"))
    return scoped_recode(peers).select("peersValue").distinct()
