"""File sources and lineage cuts: CSV lookups, Parquet round trips, checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from perfmart.session import ensure_checkpoint_dir, scratch_path


def string_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv_lookup(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """A ``sep``-separated lookup file with a header, every column a string
    (never inferred: no extra pass over the file, no type drift)."""
    return (spark.read.option("header", True).option("sep", sep)
                 .schema(string_schema(columns)).csv(path))


def write_csv_lookup(df: DataFrame, path: str, sep: str = ";") -> str:
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


#: Rows of one file of a cut.  A scan packs files into tasks by their bytes plus
#: ``spark.sql.files.openCostInBytes`` each, so it bounds the rows of a task too,
#: however far they are compressed: 32 files at most by Spark's defaults.
ROWS_A_FILE = 40_000


def parquet_roundtrip(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to Parquet under the shared checkpoint folder and read it
    back: the plan downstream starts from files, so lost executors recompute
    nothing upstream and the data is not computed twice."""
    spark = df.sparkSession
    target = path or scratch_path(spark, "roundtrip")
    schema = df.schema
    df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_A_FILE).parquet(target)
    return spark.read.schema(schema).parquet(target)  # no job to infer what is known


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir`` (shared storage).
    Checkpointed rows come back as an RDD scan: no column pruning and no file
    statistics, so the report prefers ``stage_to_parquet``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stage_to_parquet(df: DataFrame) -> DataFrame:
    """Lineage cut through a Parquet table under the shared checkpoint folder:
    computed once, survives lost executors, and later reads prune columns and
    give AQE real file sizes for its join decisions."""
    return parquet_roundtrip(df)
