"""Joins that leave the large side where it is stored.

A frame that several steps join on the same columns is stored once as a table
bucketed by these columns and a spread, a small number from a hash of the row.
A lookup joined to it is repeated for every spread and dealt into the same
buckets; the stored rows are not shuffled again, and a hot key's rows lie in as
many buckets as there are spreads.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart.operators.relational import orderable_columns, session_partitions
from perfmart.session import scratch_path
from perfmart.sources import files

SPREAD = "__spread"
#: Buckets over which the rows of one key lie.
SPREADS = 16


def bucketed_cut(df: DataFrame, by: Sequence[str], spreads: int = SPREADS, buckets: int | None = None) -> DataFrame:
    """``df`` stored under the shared scratch folder, bucketed by ``by`` and the
    spread (a column of the result).  ``buckets``: by default the session's
    shuffle partitions."""
    n = buckets or session_partitions(df)
    name = f"cut_{uuid.uuid4().hex[:12]}"
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in orderable_columns(df)]), F.lit(spreads)).cast("int")
    # the rows of a bucket come from one task each; where they are many, its files hold
    # the rows of a cut's files, so a scan that needs no buckets packs no more into a task
    (df.withColumn(SPREAD, spread).repartition(n, *by, SPREAD)
       .write.option("path", scratch_path(df.sparkSession, name)).option("maxRecordsPerFile", files.ROWS_A_FILE).bucketBy(n, *by, SPREAD).sortBy(*by, SPREAD).saveAsTable(name))
    return df.sparkSession.table(name)


def colocated_join(cut: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", spreads: int = SPREADS) -> DataFrame:
    """``cut`` (bucketed by ``on`` and its spread) joined with ``lookup``: only
    the lookup is dealt out.  ``how``: inner, left, left_semi or left_anti."""
    spread = lookup.withColumn(SPREAD, F.explode(F.sequence(F.lit(0), F.lit(spreads - 1))))
    return cut.join(spread.hint("merge"), [*on, SPREAD], how).drop(SPREAD)
