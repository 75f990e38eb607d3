"""Envelope tables ``{data: struct<...>, <metadata columns>}``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """A path (any file format Spark reads) or a catalog table name."""
    if "/" in path_or_name or ":" in path_or_name:
        return spark.read.format(fmt).load(path_or_name)
    return spark.table(path_or_name)


def flatten(envelope: DataFrame, struct_col: str = "data", keep: Sequence[str] = ()) -> DataFrame:
    """``select(data.*, *keep)``: struct fields become top-level columns."""
    return envelope.select(f"{struct_col}.*", *keep)


def wrap(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), struct_col: str = "data") -> DataFrame:
    """Inverse of ``flatten``: pack ``fields`` into one struct column."""
    return df.select(F.struct(*[F.col(f"`{f}`") for f in fields]).alias(struct_col), *keep)
