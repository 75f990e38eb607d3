"""Long <-> wide reshaping: metric pivot, metric-family coalesce, benchmark unpivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart import config as C


def _q(name: str):
    return F.col(f"`{name}`")


def discover_values(df: DataFrame, column: str) -> list[str]:
    """Distinct non-null values of a label column, sorted (what ``pivot``
    without values would find).  One small job returning names, not data, and
    refused beyond the session's ``spark.sql.pivotMaxValues``, as Spark's own
    pivot does; configurations that pass the list skip it."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    rows = (df.select(column).where(F.col(column).isNotNull()).distinct()
              .limit(most + 1).collect())
    if len(rows) > most:
        raise ValueError(f"more than {most} distinct values in {column!r} (spark.sql.pivotMaxValues); "
                         "pass the pivot values explicitly")
    return sorted(r[0] for r in rows)


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, value_col: str,
              values: Sequence[str] | None = None) -> DataFrame:
    """``groupBy(keys).pivot(pivot_col, values).sum(value_col)`` as one
    aggregate of conditional sums: a single exchange with map-side partial
    aggregation (the built-in pivot plans two aggregates).  Null keys form
    groups; a metric absent from a group is null."""
    if values is None:
        values = discover_values(df, pivot_col)
    aggs = [F.sum(F.when(F.col(pivot_col) == F.lit(v), F.col(value_col))).alias(v)
            for v in values]
    return df.groupBy(*[_q(k) for k in keys]).agg(*aggs)


def coalesce_families(df: DataFrame, families=C.METRIC_FAMILIES,
                      skip: Sequence[str] = ()) -> DataFrame:
    """For each (output, prefix) the first non-null column whose name starts
    with ``prefix`` (case-sensitive), in sorted name order; a family with no
    column gives a typed null.  A source column whose name equals an output
    name case-insensitively is replaced by the output."""
    skip_l = {s.lower() for s in skip}
    cols = [c for c in df.columns if c.lower() not in skip_l]
    new = {}
    for out, prefix in families:
        members = sorted(c for c in cols if c.startswith(prefix))
        new[out] = (F.coalesce(*[_q(m) for m in members]) if members
                    else F.lit(None).cast("double"))
    outs = {o.lower() for o in new}
    kept = [_q(c) for c in df.columns if c.lower() not in outs]
    # the percentile is an output column of its own, whether or not the metric occurs
    if C.PERCENTILE_METRIC not in df.columns:
        kept.append(F.lit(None).cast("double").alias(C.PERCENTILE_METRIC))
    return df.select(*kept, *[v.alias(k) for k, v in new.items()])


def unpivot_columns(df: DataFrame, ids: Sequence[str], columns: Sequence[tuple[str, str]],
                    label_col: str, value_col: str) -> DataFrame:
    """Wide -> long through ``DataFrame.unpivot`` (one scan, an Expand node);
    ``columns`` maps source column -> label.  Null values are kept."""
    renamed = df.select(*[_q(i) for i in ids], *[_q(src).alias(lbl) for src, lbl in columns])
    return renamed.unpivot([_q(i) for i in ids], [_q(lbl) for _, lbl in columns],
                           label_col, value_col)


def unpivot_structs(df: DataFrame, ids: Sequence[str], columns: Sequence[tuple[str, str]],
                    label_col: str, value_col: str) -> DataFrame:
    """The same through ``explode(array(struct(label, value)))``."""
    arr = F.array(*[F.struct(F.lit(lbl).alias(label_col), _q(src).alias(value_col))
                    for src, lbl in columns])
    return (df.select(*[_q(i) for i in ids], F.explode(arr).alias("__b"))
              .select(*[_q(i) for i in ids], F.col(f"__b.{label_col}").alias(label_col),
                      F.col(f"__b.{value_col}").alias(value_col)))


def unpivot_benchmarks(feed: DataFrame, periods=C.BENCH_PERIODS) -> DataFrame:
    """Benchmark feed rows -> one row per period with ``periodType``,
    ``return``, ``periodStartDate`` and ``date`` (both the feed's ``Dat``)."""
    bench_cols = {src for src, _ in periods}
    ids = [c for c in feed.columns if c not in bench_cols]
    long = unpivot_columns(feed, ids, periods, "periodType", "return")
    return long.withColumns({"periodStartDate": F.col("Dat"), "date": F.col("Dat")})
