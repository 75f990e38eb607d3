"""Reference (benchmark) feed: membership flag, index rows, special-fund rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.operators.relational import (
    broadcast_limit,
    min_per_key,
    planned_bytes,
    session_partitions,
    union_all,
)
from perfmart.sources.files import stage_to_parquet

INDEX_KEYS = ("peersValue", "calculationDate", "exportDate", "reportCurrency",
              "reportName", "date")
SPECIAL_COLUMNS = ("isin", "periodType", "periodStartDate", "return", "date",
                   "groupInvestment", "reportCurrency", "peersValue", "reportName")


def load_reference(main_envelope: DataFrame, share_envelope: DataFrame,
                   special_fund: str) -> DataFrame:
    """Main feed (``IsPartPrinc`` null) plus the share-level rows of the
    special fund.  The ``data.Lib`` predicate reaches the Parquet scan of the
    nested column."""
    share = share_envelope.select("data").where(F.col("data.Lib").startswith(special_fund)).select("data.*")
    main = main_envelope.select("data.*")
    ptype = share.schema["IsPartPrinc"].dataType
    main = main.withColumn("IsPartPrinc", F.lit(None).cast(ptype))
    return main.unionByName(share)


def membership_flag(df: DataFrame, feed: DataFrame, flag_col: str, cut=stage_to_parquet) -> DataFrame:
    """``flag_col`` = 1 when the row's isin occurs in the feed, else 0.  The
    distinct isins are written first; beyond the broadcast threshold rows and
    isins are dealt out, and rows without an isin, which match nothing, are
    spread by a hash of the row."""
    isins = (feed.select(F.col("isin").alias("__key")).where(F.col("__key").isNotNull()).distinct()
                 .withColumn(flag_col, F.lit(1)))
    kept = cut(isins) if cut is not None else isins
    key = F.col("isin")
    if planned_bytes(kept) > broadcast_limit(df):
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(64 * session_partitions(df)))
        key = F.coalesce(key, F.concat(F.lit("\u0000"), spread.cast("string")))
    return df.withColumn("__key", key).join(kept, "__key", "left").drop("__key").na.fill(0, [flag_col])


def special_rows(bench: DataFrame, special_fund: str, special_report: str) -> DataFrame:
    """Benchmark rows of the special fund as report rows (group = fund name,
    currency, peer code, fixed report name)."""
    return (bench.where(F.col("Lib").startswith(special_fund))
                 .withColumns({"groupInvestment": F.col("Lib"),
                               "reportCurrency": F.col("DevCot"),
                               "peersValue": F.col("Cod"),
                               "reportName": F.lit(special_report)})
                 .select(*SPECIAL_COLUMNS))


def index_rows(flagged: DataFrame, bench: DataFrame, flag_col: str,
               suffix: str = C.INDEX_SUFFIX, distinct: bool = True) -> DataFrame:
    """One own fund per (peer, calculation, export, currency, report, date)
    (the smallest isin), its benchmark periods joined on (isin, date); the row
    becomes ``peer + suffix`` with a null isin.  Rows without a benchmark
    return are dropped, so the join is an inner one."""
    picked = min_per_key(flagged.where(F.col(flag_col) == 1), list(INDEX_KEYS), "isin")
    b = (bench.select("isin", "periodType", "periodStartDate", "return", "date")
              .where(F.col("return").isNotNull()))
    group = F.concat(F.col("peersValue"), F.lit(suffix))
    out = (picked.join(b, ["isin", "date"], "inner")
                 .withColumns({"groupInvestment": group,
                               "isin": F.when(group.endswith(suffix), F.lit(None))
                                        .otherwise(F.col("isin"))}))
    return out.distinct() if distinct else out


def append_ragged(base: DataFrame, *extra: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side become nulls."""
    return union_all([base, *extra], allow_missing=True)
