"""URL filters: exact list membership from a cascade of Bloom filters.

A listed key is a host (with all its subdomains) and a path prefix, such as
``example.com/de/``.  The universe is every key that some URL of the corpus
could fit: each suffix of its host at a label boundary, with each prefix of its
path that is as long as some listed path.  Level 1 holds the listed keys; level
2 the keys of the universe that level 1 takes by mistake; level 3 the listed
keys that level 2 takes by mistake; and so on until a level makes no mistake.
A key of the universe is listed if the first level that lacks it is an even
one, or no level lacks it and their number is odd.  So membership is exact over
the universe, and judging a URL needs no join: the levels are literals.

The first level's error rate is set to listed / universe, so the levels grow
with the list (times the logarithm of the universe), not with the corpus, and
so does what the driver holds: the bits.

A null URL, or one without ``://``, has an empty host and path and fits no rule.
Repeated URLs get equal verdicts.  An empty list blocks nothing.  Of listed keys
of one length that fit one URL (``b.net/`` and ``net/ab``) the larger string wins.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.llm.components import saved
from perfmart.llm.text import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The rules of the production filter: key and verdict.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: Verdict of a URL that fits no listed key.
UNLISTED = "allow"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` in a byte string, probed by ``probes`` hashes."""
    bits: bytes
    size: int
    probes: int
    seed: int

    def has(self, key: Column) -> Column:
        return reduce(lambda a, b: a & b, [self._bit(key, j) for j in range(self.probes)])

    def _bit(self, key: Column, j: int) -> Column:
        at = position(key, self.seed, j, self.size)
        byte = F.conv(F.hex(F.substring(F.lit(self.bits), (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10)
        return F.call_function("shiftright", byte.cast("int"), (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def position(key: Column, seed: int, j: int, size: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(j)), F.lit(size).cast("bigint"))


def build_level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """A filter of ``keys`` (column ``key``) with the given error rate: the set
    bits are put together per byte on the executors, then in one byte string."""
    probes = max(1, round(-math.log2(rate)))
    size = max(64, 8 * math.ceil(count * probes / math.log(2) / 8))
    at = F.explode(F.array(*[position(F.col("key"), seed, j, size) for j in range(probes)]))
    words = (keys.select(at.alias("at"))
                 .groupBy(F.floor(F.col("at") / 8).alias("byte"))
                 .agg(F.bit_or(F.call_function("shiftleft", F.lit(1), (F.col("at") % 8).cast("int"))).alias("bits")))
    data = bytearray(size // 8)
    for r in words.toLocalIterator():
        data[r.byte] = r.bits
    return Level(bytes(data), size, probes, seed)


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """The levels for the distinct, non-null ``key`` column of each frame."""
    listed = listed.select("key").where(F.col("key").isNotNull()).distinct()
    n = listed.count()
    if not n:
        return []
    total = universe.agg(F.approx_count_distinct("key").alias("n")).first().n
    level = build_level(listed, n, min(0.5, n / max(1, total)), 0)
    levels = [level]
    inside, outside = listed, universe.select("key").where(level.has(F.col("key"))).distinct().join(listed, "key", "left_anti")
    outside = saved(outside, "unlisted-keys")  # about as many as listed keys
    inside = saved(inside, "listed-keys")
    while (m := outside.count()):
        level = build_level(outside, m, 0.5, len(levels))
        levels.append(level)
        inside, outside = outside, inside.where(level.has(F.col("key")))
    return levels


def is_listed(key: Column, levels: list[Level]) -> Column:
    """Exact for keys of the universe."""
    out = F.lit(len(levels) % 2 == 1)
    for k, level in reversed(list(enumerate(levels))):
        out = F.when(level.has(key), out).otherwise(F.lit(k % 2 == 1))
    return out


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def candidates(host_col: Column, path_col: Column, lengths: list[int]) -> Column:
    """Every key that the URL fits, the longest first: suffixes of its host at
    label boundaries with prefixes of its path of the given lengths."""
    labels = F.split(host_col, r"\.")
    hosts = F.when(host_col == "", F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(labels)),
                    lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    paths = F.filter(F.array(*[F.when(F.length(path_col) >= n, F.substring(path_col, 1, n)) for n in lengths])
                     if lengths else F.array().cast("array<string>"), lambda p: p.isNotNull())
    keys = F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: F.concat(h, p))))
    return F.reverse(F.sort_array(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), k.alias("key")))))


def judge(pages: DataFrame, rules: DataFrame, unlisted: str = UNLISTED) -> DataFrame:
    """``row`` (the page), ``host``, ``path``, the longest fitting ``rule`` and
    the ``verdict``.  ``rules``: host, path and verdict (allow or block); one
    cascade holds all listed keys, another those that are blocked.  Listed paths
    are grouped by their lengths, of which there are few."""
    rules = rules.select(F.concat(F.translate("host", UPPER, LOWER), "path").alias("key"), F.length("path").alias("n"), "verdict")
    lengths = sorted(r.n for r in rules.where(F.col("key").isNotNull()).select("n").distinct().collect())
    packed = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"))
    urls = packed.select("row", host(F.col("row.url")).alias("host"), path(F.col("row.url")).alias("path"))
    keyed = urls.select("*", candidates(F.col("host"), F.col("path"), lengths)["key"].alias("keys"))
    universe = keyed.select(F.explode("keys").alias("key"))
    listed = cascade(rules, universe)
    blocked = cascade(rules.where(F.col("verdict") == "block"), universe)
    rule = F.get(F.filter("keys", lambda k: is_listed(k, listed)), F.lit(0))
    return keyed.select("row", "host", "path", rule.alias("rule")).select(
        "*", F.when(F.col("rule").isNull(), F.lit(unlisted))
              .when(is_listed(F.col("rule"), blocked), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))


def rule_table(spark: SparkSession, rules: dict[str, str] = RULES) -> DataFrame:
    each = [F.struct(F.lit(k[:k.index("/")]).alias("host"), F.lit(k[k.index("/"):]).alias("path"), F.lit(v).alias("verdict"))
            for k, v in rules.items()]
    return spark.range(1).select(F.inline(F.array(*each)))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every URL of ``pages``."""
    found = judge(table(spark, sf_dir, "pages", "page_id", "url"), rule_table(spark))
    return found.select(F.col("row.page_id").alias("page_id"), "host", "path", "rule", "verdict")


ORACLE_OP4 = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
r(host, path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
  SELECT h.page_id, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY h.page_id ORDER BY length(r.host || r.path) DESC) AS k
  FROM h JOIN r ON (h.host = r.host OR h.host LIKE '%.' || r.host) AND starts_with(h.path, r.path))
SELECT h.page_id, coalesce(h.host, '') AS host, coalesce(h.path, '') AS path, fit.rule, coalesce(fit.verdict, 'allow') AS verdict
FROM h LEFT JOIN fit ON h.page_id = fit.page_id AND fit.k = 1
"""
