"""Period dates of synthetic rows (index, category average, sector)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.operators.colocated import SPREAD, colocated_join
from perfmart.operators.relational import distinct_rows, lookup_join
from perfmart.sources.files import stage_to_parquet

DATE_KEYS = ["date", "peersValue", "reportName", "reportCurrency", "periodType"]


def is_synthetic(index_suffix: str = C.INDEX_SUFFIX, avg_suffix: str = C.CATEGORY_AVERAGE,
                 sector: str = C.IA_SECTOR) -> Column:
    g = F.col("groupInvestment")
    return g.endswith(index_suffix) | g.endswith(avg_suffix) | (g == sector)


def propagate_stored_dates(cut: DataFrame, distinct: bool = True) -> DataFrame:
    """``propagate_dates`` of a frame stored by ``bucketed_cut(..., DATE_KEYS)``:
    the wide rows are read bucket by bucket and never dealt out again.  Distinct
    dates are found within the buckets first, so only these travel."""
    syn = is_synthetic()
    columns = [c for c in cut.columns if c != SPREAD]
    pair = [F.col("periodStartDate").alias("__start"), F.col("periodEndDate").alias("__end")]
    dates = (cut.where(~syn).select(*DATE_KEYS, SPREAD, *pair).distinct()   # within the buckets
                .select(*DATE_KEYS, "__start", "__end").distinct())
    synthetic = (colocated_join(cut.where(syn).drop("periodStartDate", "periodEndDate"), dates, DATE_KEYS)
                 .withColumnsRenamed({"__start": "periodStartDate", "__end": "periodEndDate"}).select(*columns))
    out = cut.where(syn.isNull() | ~syn).select(*columns).unionByName(synthetic)
    return distinct_rows(out) if distinct else out


def propagate_dates(df: DataFrame, distinct: bool = True, cut=stage_to_parquet,
                    by: Sequence[str] | None = None) -> DataFrame:
    """Synthetic rows take both period dates from the other rows with the same
    (date, peer, report, currency, period): one row per distinct date pair,
    null dates without a match.  Rows whose group is null or not synthetic are
    untouched and never join; the distinct dates are a ``lookup_join``.  ``by``:
    columns that a projection after this keeps (``distinct_rows``)."""
    syn = is_synthetic()
    base = df.where(~syn)
    dates = (base.select(*DATE_KEYS, F.col("periodStartDate").alias("__start"),
                         F.col("periodEndDate").alias("__end")).distinct())
    synthetic = (lookup_join(df.where(syn).drop("periodStartDate", "periodEndDate"), dates, DATE_KEYS, "left", cut)
                   .withColumnsRenamed({"__start": "periodStartDate", "__end": "periodEndDate"})
                   .select(*df.columns))
    untouched = df.where(syn.isNull() | ~syn)
    out = untouched.unionByName(synthetic)
    return distinct_rows(out, by=by) if distinct else out
