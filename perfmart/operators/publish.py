"""Final projection, value scaling, clones and the published slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.sources import published


#: Output columns that ``scale_and_label`` writes anew.
REWRITTEN = ("return", "reportName")


def final_projection(df: DataFrame, columns: Sequence[str], distinct: bool = True) -> DataFrame:
    out = df.select(*[F.col(f"`{c}`") for c in columns])
    return out.distinct() if distinct else out


def scale_and_label(df: DataFrame, special_fund: str, renames=C.OUTPUT_RENAMES,
                    index_suffix: str = C.INDEX_SUFFIX, factor: int = 100,
                    distinct: bool = True) -> DataFrame:
    """Benchmark returns (index rows and the special fund, by equality) to
    percent, title-cased report names, and the shortened output names."""
    g = F.col("groupInvestment")
    scale = g.endswith(index_suffix) | (g == special_fund)
    out = df.withColumns({
        "return": F.when(scale, F.col("return") * F.lit(factor)).otherwise(F.col("return")),
        "reportName": F.initcap(F.col("reportName")),
    }).withColumnsRenamed({a: b for a, b in renames if a in df.columns})
    return out.distinct() if distinct else out


def clone_rows(df: DataFrame, rules: Sequence[C.CloneRule]) -> DataFrame:
    """Append, for each rule, copies of its rows under a new peer, group and
    (optionally) report.  The rules are a handful of config entries, so the
    rule table is broadcast and all rules take one pass over the rows."""
    if not rules:
        return df
    names = ("__group", "__prefix", "__skip", "__peer", "__ngroup", "__report")
    table = F.array(*[F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(names, (
        x.group, x.report_prefix, x.skip_period, x.new_peer, x.new_group, x.new_report), strict=True)]) for x in rules])
    r = df.sparkSession.range(1).select(F.inline(table))
    cond = ((F.col("groupInvestment") == F.col("__group"))
            & F.col("reportName").startswith(F.col("__prefix"))
            & (F.col("__skip").isNull() | (F.col("periodType") != F.col("__skip"))))
    copies = (df.join(F.broadcast(r), cond, "inner")
                .withColumns({"peersValue": F.col("__peer"),
                              "groupInvestment": F.col("__ngroup"),
                              "reportName": F.coalesce(F.col("__report"), F.col("reportName"))})
                .select(*df.columns))
    return df.unionByName(copies)


def publish_slice(df: DataFrame, path: str, partition_col: str = "date",
                  fmt: str = "parquet") -> str:
    """Replace the partitions present in ``df`` (one report date) and nothing
    else, through ``perfmart.sources.published``: the files are written first and
    a pointer to them is set last, so a crash at any moment leaves the former
    slice.  Repeating it is safe; an empty slice publishes nothing."""
    return published.publish(df, path, partition_col, fmt).path


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                num_partitions: int | None = None) -> None:
    """Append to a JDBC table (executors write in parallel, one connection per
    partition; cap the partitions to what the database accepts)."""
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url, table, mode="append", properties=properties or {})


def read_published(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """The published table; with ``schema``, also one to which nothing has been
    published yet."""
    return published.read(spark, path, fmt, schema)
