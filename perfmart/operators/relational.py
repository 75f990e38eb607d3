"""Generic relational building blocks used by the report operators.

Each one is a plain DataFrame composition.  Joins carry no broadcast hint
unless a side has one row or holds configuration: the planner chooses from
measured bytes.  A lookup on a key with few values goes through ``lookup_join``:
it is written first, so its size is known before the rows that look it up are
dealt out; beyond the session's broadcast threshold these rows are salted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from perfmart.sources.files import stage_to_parquet

_UNORDERABLE = (MapType,)


def orderable_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    skip = {c.lower() for c in exclude}
    out = []
    for f in df.schema.fields:
        if f.name.lower() in skip or isinstance(f.dataType, _UNORDERABLE):
            continue
        if isinstance(f.dataType, (ArrayType, StructType)) and _has_map(f.dataType):
            continue
        out.append(f.name)
    return out


def _has_map(t) -> bool:
    if isinstance(t, MapType):
        return True
    if isinstance(t, ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False


def total_order(df: DataFrame, first: Sequence[Column], keys: Sequence[str]) -> list[Column]:
    """``first`` followed by every other orderable column ascending: a total
    order over distinct rows, so a pick is reproducible run after run."""
    rest = orderable_columns(df, exclude=list(keys))
    return [*first, *[F.col(f"`{c}`").asc_nulls_first() for c in rest]]


def session_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Rows that one task takes of wide rows that are dealt out to be compared.
ROWS_A_TASK = 40_000


def dealt(df: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows dealt out by columns into partitions of
    ``ROWS_A_TASK``, so that what a task holds does not grow with the input.  The
    session's partitions are not asked: they are fixed, or merged up to a number
    of compressed bytes, and wide rows unpack to many times these.  Floating
    numbers are left out where other columns are left: aggregates and windows
    normalise them and would deal the rows out once more."""
    parts = max(-(-rows // ROWS_A_TASK), df.sparkSession.sparkContext.defaultParallelism)
    exact = [c for c in by if df.schema[c].dataType.typeName() not in ("float", "double")]
    return df.repartition(parts, *[F.col(f"`{c}`") for c in exact or by])


def distinct_rows(df: DataFrame, rows: int | None = None, by: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, in tasks of bounded size (``dealt``): they are dealt out
    before any task compares them, so none holds the rows of a whole file split.
    ``rows``: about how many there are; by default they are counted, which reads
    no column that a filter or join of ``df`` does not need.  ``by``: the columns
    to deal by, if a later distinct keeps these alone: it needs no exchange then."""
    return dealt(df, by or df.columns, df.count() if rows is None else rows).distinct()


def salted_join(df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
                salts: int | None = None) -> DataFrame:
    """``df`` joined with a much smaller ``lookup`` on columns that may hold few
    values (or many nulls): each row of ``df`` gets a salt from a hash of the
    whole row, and each row of ``lookup`` is repeated for every salt, so no key
    value is bound to one task.  ``salts``: by default the session's shuffle
    partitions, so that even one value is spread over all of them.  ``how``:
    inner, left, left_semi or left_anti."""
    salts = salts or session_partitions(df)
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in orderable_columns(df)]), F.lit(salts)).cast("int")
    spread = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("__salt", salt).join(spread, [*on, "__salt"], how).drop("__salt")


def planned_bytes(df: DataFrame) -> int:
    """The size that Spark's planner assumes; for a cut, the bytes of its files."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1: never)."""
    spark = df.sparkSession
    said = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(said)) if not said.startswith("-") else -1


#: Tasks for one key value of a lookup that is large itself.
LEAST_SALTS = 16


def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "inner",
                cut: Callable[[DataFrame], DataFrame] | None = stage_to_parquet) -> DataFrame:
    """``df`` joined with a lookup on columns that may hold few values.  The
    lookup is written as a cut first: its files' bytes are known when the join
    is planned.  Up to the session's broadcast threshold the planner broadcasts
    it and the rows of ``df`` stay where they are; beyond, they are salted.
    The salts are the session's partitions while the repeated lookup stays below
    a quarter of the rows' bytes, else fewer, ``LEAST_SALTS`` at least.
    ``cut=None`` takes the planner's estimate of the lookup as it is."""
    kept = cut(lookup) if cut is not None else lookup
    size = planned_bytes(kept)
    if size <= broadcast_limit(df):
        return df.join(kept, list(on), how)
    salts = max(LEAST_SALTS, planned_bytes(df) // (4 * max(size, 1)))
    return salted_join(df, kept, on, how, min(salts, session_partitions(df)))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_col: str,
                   descending: bool = True, rows: int | None = None) -> DataFrame:
    """Keep one row per key: the newest ``order_col`` (nulls last), ties broken
    by every remaining column.  ``row_number() == 1`` lets Spark add a partial
    WindowGroupLimit before the shuffle, so at most one row per key and map task
    crosses the network, even for a hot key.  ``rows``: for keys of few rows each,
    about how many rows there are; where they are many, they are dealt out by key
    first (``dealt``), so that neither side of the limit sorts a share of the
    input that grows with it."""
    if rows is not None and rows > ROWS_A_TASK * df.sparkSession.sparkContext.defaultParallelism:
        df = dealt(df, keys, rows)
    oc = F.col(f"`{order_col}`")
    first = [oc.desc_nulls_last() if descending else oc.asc_nulls_first()]
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(
        *total_order(df, first, [*keys, order_col]))
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))


def dedup_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Deterministic ``dropDuplicates(keys)``: the smallest row per key."""
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*total_order(df, [], keys))
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1).drop("__rn"))


def min_per_key(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """One value per key, deterministically the smallest non-null one
    (replaces ``first``/``head(1)`` picks).  Partial aggregation runs map-side."""
    return df.groupBy(*keys).agg(F.min(value).alias(alias or value))


def anti_join(df: DataFrame, other: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` without a match; a null key never matches, so it stays
    (unlike ``NOT IN`` over a list holding a null, which keeps nothing)."""
    return df.join(other, on=on, how="left_anti")


def semi_join(df: DataFrame, other: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    return df.join(other, on=on, how="left_semi")


def union_all(dfs: Sequence[DataFrame], by_name: bool = True,
              allow_missing: bool = False) -> DataFrame:
    if not by_name:
        return reduce(lambda a, b: a.union(b), dfs)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def except_values(df: DataFrame, other: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of ``cols`` in ``df`` absent from ``other`` (nulls equal)."""
    return df.select(*cols).subtract(other.select(*cols))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


#: Length of the indexed pieces of a text; shorter patterns are looked up whole.
GRAM = 8


def contains_pairs(texts: DataFrame, text_col: str, patterns: DataFrame, pattern_col: str,
                   offset: int = 0, gram: int = GRAM) -> DataFrame:
    """Distinct (text, pattern) pairs where ``substring(text, offset + 1)``
    contains ``pattern`` literally.

    A LIKE '%p%' join has no equality key.  Here each distinct text is indexed
    by its pieces of ``gram`` characters, and each pattern is looked up by the
    one of its own pieces that is rarest among the texts.  Where the piece is
    found, the text holds the pattern if the characters around it are the
    pattern's; no other place is looked at.  A pattern with a piece that no text
    has is dropped at once.  Patterns shorter than ``gram`` are their own piece:
    a text also emits its pieces of those lengths that occur, ``gram - 1`` of
    them at most.  So the index grows with the texts alone, however many lengths
    the patterns have."""
    p = patterns.select(F.col(pattern_col).alias("__p")).where(F.col("__p").isNotNull()).distinct() \
        .withColumn("__size", F.length("__p"))
    # the lengths of pieces: gram and the shorter ones that occur; one row
    sizes = (p.agg(F.sort_array(F.collect_set(F.least(F.col("__size"), F.lit(gram)))).alias("__ns")).withColumn("__one", F.lit(1)))
    t = (texts.select(F.col(text_col).alias("__t")).where(F.col("__t").isNotNull()).distinct()
              .withColumn("__s", F.substring(F.col("__t"), offset + 1, 1 << 30)).withColumn("__one", F.lit(1)))
    sized = (t.join(F.broadcast(sizes), "__one")
              .select("__t", "__s", F.explode("__ns").alias("__n")).where(F.col("__n") <= F.length("__s")))
    last = F.when(F.col("__n") == 0, F.lit(1)).otherwise(F.length("__s") - F.col("__n") + 1)
    index = (sized.select("__t", "__s", "__n", F.explode(F.sequence(F.lit(1), last)).alias("__at"))
                  .select("__t", "__s", "__at", F.substring(F.col("__s"), F.col("__at"), F.col("__n")).alias("__g")))
    own = p.select("__p", "__size", F.posexplode(F.when(F.col("__size") <= gram, F.array("__p")).otherwise(
        F.transform(F.sequence(F.lit(1), F.col("__size") - gram + 1), lambda i: F.substring(F.col("__p"), i, F.lit(gram))))).alias("__k", "__g"))
    found = index.groupBy("__g").agg(F.count(F.lit(1)).alias("__c"))
    counted = own.join(found, "__g", "left").groupBy("__p", "__size").agg(
        F.min(F.struct(F.coalesce("__c", F.lit(0)).alias("c"), F.col("__k").alias("k"), F.col("__g").alias("g"))).alias("__r"))
    rarest = counted.where(F.col("__r.c") > 0).select("__p", "__size", F.col("__r.k").alias("__k"), F.col("__r.g").alias("__g"))
    around = F.substring(F.col("__s"), F.col("__at") - F.col("__k"), F.col("__size"))
    return (index.join(rarest, "__g").where((F.col("__at") > F.col("__k")) & (around == F.col("__p")))
                 .select(F.col("__t").alias(text_col), F.col("__p").alias(pattern_col)).distinct())


def contains_join(left: DataFrame, text_col: str, right: DataFrame, pattern_col: str,
                  offset: int = 0, cut: Callable[[DataFrame], DataFrame] | None = stage_to_parquet) -> DataFrame:
    """``left JOIN right ON substring(text, offset+1) LIKE '%' || pattern || '%'``
    (pattern taken literally), as two equi-joins through ``contains_pairs``."""
    pairs = contains_pairs(left, text_col, right, pattern_col, offset)
    return lookup_join(left, pairs.join(right, pattern_col), [text_col], cut=cut)
