"""Newest row per key, kept up to date batch by batch.

The state is a table bucketed by a hash of the keys.  A batch is reduced to its
newest rows, dealt out into the state's buckets and merged with them bucket by
bucket: only the batch is shuffled, however large the state has grown.  The pick
is the one of ``latest_per_key`` (a total order), so batches may be cut and
repeated at will: any sequence of them gives what one run over all rows gives.

The hash only places rows; keys are compared as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.operators.relational import latest_per_key, session_partitions

BUCKET = "__bucket"


def _placed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(BUCKET, F.xxhash64(*[F.col(f"`{k}`") for k in keys]))


def buckets_of(spark: SparkSession, state: str) -> int:
    """How many buckets a state table has."""
    said = spark.sql(f"DESCRIBE EXTENDED {state}").where("col_name = 'Num Buckets'").select("data_type").first()
    if said is None:
        raise ValueError(f"{state} is not bucketed")
    return int(said[0])


def merged_latest(state: DataFrame, batch: DataFrame, keys: Sequence[str], order_col: str, buckets: int) -> DataFrame:
    """Newest rows of ``state`` (a scan of the bucketed table) and ``batch``."""
    fresh = latest_per_key(_placed(batch, keys), [BUCKET, *keys], order_col).select(*state.columns)
    both = state.unionByName(fresh.repartition(buckets, BUCKET))
    return latest_per_key(both, [BUCKET, *keys], order_col)


def merge_batch(batch: DataFrame, keys: Sequence[str], order_col: str, into: str, path: str,
                state: str | None = None, buckets: int | None = None) -> DataFrame:
    """Merge ``batch`` with the table ``state`` (None: the first batch) and store
    the outcome as the table ``into`` at ``path``; the former state stays as it
    is, so a failed merge is repeated.  ``buckets`` (first batch): by default the
    session's shuffle partitions."""
    spark = batch.sparkSession
    if state is None:
        n = buckets or session_partitions(batch)
        rows = latest_per_key(_placed(batch, keys), [BUCKET, *keys], order_col).repartition(n, BUCKET)
    else:
        n = buckets_of(spark, state)
        rows = merged_latest(spark.table(state), batch, keys, order_col, n)
    rows.write.mode("error").option("path", path).bucketBy(n, BUCKET).sortBy(BUCKET).saveAsTable(into)
    return spark.table(into).drop(BUCKET)
