"""Versioned snapshots: one folder a version, the latest is what a job reads.

    <path>/<column>=<version>/part-*

Versions are dates, numbers or strings that sort as they were written.  The
latest one is found by partition discovery alone (file names, no file is
opened) and reaches the scan as a partition filter that is evaluated at run
time, so only files of that version are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

VERSION = "version"


def write_version(df: DataFrame, path: str, version: str, column: str = VERSION, fmt: str = "parquet") -> str:
    """Store ``df`` as one version; a version is written once."""
    target = f"{path.rstrip('/')}/{column}={version}"
    df.write.format(fmt).mode("error").save(target)
    return target


def stored_versions(spark: SparkSession, path: str, column: str = VERSION, fmt: str = "parquet") -> DataFrame:
    """The versions that hold files, one row a file, from the listing alone
    (the content column of ``binaryFile`` is never asked for)."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", f"*.{fmt}").option("basePath", path)
                 .load(path).select(column))


def read_latest(spark: SparkSession, path: str, as_of: object = None, column: str = VERSION,
                schema: StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """The rows of the latest version (not later than ``as_of``, if given);
    none if there is no such version.  ``schema``: of the rows, if it is known
    (it saves reading a footer)."""
    versions = stored_versions(spark, path, column, fmt)
    if as_of is not None:
        versions = versions.where(F.col(column) <= F.lit(as_of))
    latest = versions.agg(F.max(column).alias(column))
    reader = spark.read.format(fmt).option("basePath", path)
    if schema is not None:
        kind = versions.schema[column]
        reader = reader.schema(StructType([*schema.fields, kind]))
    rows = reader.load(path)
    return rows.where(F.col(column) == latest.scalar()).drop(column)
