"""Report dates, latest row per business key, and the published date slice."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.operators.relational import latest_per_key, lookup_join
from perfmart.sources.files import stage_to_parquet


def attach_report_date(df: DataFrame, week_period: str = C.WEEK_PERIOD,
                       on: Sequence[str] = ("sourceFileName", "reportName"), cut=stage_to_parquet) -> DataFrame:
    """``date`` := end date of the ``week_period`` rows of the same file and
    report.  Rows of a (file, report) without such a row are dropped; several
    end dates fan the rows out.  The date table has one row per (file, report,
    date) and few keys: a ``lookup_join``."""
    dates = (df.where((F.col("periodType") == week_period) & F.col("periodEndDate").isNotNull())
               .select(*on, F.col("periodEndDate").alias("date")).distinct())
    return lookup_join(df, dates, list(on), cut=cut).select(*df.columns, "date")


def latest_calculation(df: DataFrame, keys: Sequence[str],
                       order_col: str = "calculationDate") -> DataFrame:
    """Newest calculation per business key (C10).  The keys are nearly all of a
    row, so each has few rows and they may be dealt out by them."""
    return latest_per_key(df, keys, order_col, rows=df.count())


def snapshot_date(df: DataFrame, exclude_group_prefix: str) -> DataFrame:
    """One-row frame ``snapshot_date``: the latest non-null report date among
    rows whose group does not start with ``exclude_group_prefix`` (a null
    group is not counted)."""
    return df.where(_counted(exclude_group_prefix)).agg(F.max("date").alias("snapshot_date"))


def snapshot_slice(df: DataFrame, exclude_group_prefix: str) -> DataFrame:
    """Rows of the snapshot date.  The date comes from a global aggregate
    (exactly one row), joined back by equality: a broadcast of one row, no
    driver round trip, nothing published when the input is empty."""
    return on_date(df, snapshot_date(df, exclude_group_prefix))


def _counted(exclude_group_prefix: str):
    """Rows that may name the snapshot date."""
    g = F.col("groupInvestment")
    return F.col("date").isNotNull() & g.isNotNull() & ~g.startswith(exclude_group_prefix)


def footer_max(cut: DataFrame, column: str):
    """The largest value of a column of a stored frame, from the statistics in
    its Parquet footers alone: the aggregate is pushed down to the files, no row
    is read.  None without files or values.  Asked in a session of its own, so
    the caller's settings stay as they are."""
    found = footer_max_frame(cut, column)
    return None if found is None else found.first()[0]


def footer_max_frame(cut: DataFrame, column: str) -> DataFrame | None:
    files = cut.inputFiles()
    if not files:
        return None
    own = cut.sparkSession.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(cut.schema).parquet(*files).agg(F.max(column).alias(column))


def latest_counted_date(cut: DataFrame, exclude_group_prefix: str):
    """The snapshot date of a stored frame as a value: the footers' largest date
    if a counted row has it (one lookup with the date pushed to the scan), else
    the largest counted date before it.  None if there is none."""
    try:
        top = footer_max(cut, "date")
    except (PySparkException, Py4JJavaError):  # a file without a single date has no statistics of it
        top = cut.agg(F.max("date")).first()[0]
    ok = _counted(exclude_group_prefix)
    if top is None or not cut.where((F.col("date") == F.lit(top)) & ok).isEmpty():
        return top
    return cut.where((F.col("date") < F.lit(top)) & ok).agg(F.max("date")).first()[0]


def stored_slice(cut: DataFrame, exclude_group_prefix: str) -> DataFrame:
    """``snapshot_slice`` of a stored frame: the date is known when the slice is
    planned, so it reaches the scan as a pushed filter."""
    if not cut.inputFiles():
        return snapshot_slice(cut, exclude_group_prefix)
    return on_value(cut, latest_counted_date(cut, exclude_group_prefix))


def on_value(df: DataFrame, date) -> DataFrame:
    """Rows of one date; none for None."""
    return df.where(F.col("date") == F.lit(date) if date is not None else F.lit(False))


def on_date(df: DataFrame, snap: DataFrame) -> DataFrame:
    """Rows of the date in the one-row frame ``snap``."""
    return (df.join(F.broadcast(snap), F.col("date") == F.col("snapshot_date"))
              .drop("snapshot_date"))
