"""Peer-group rows: category averages, peer names, sector rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perfmart import config as C
from perfmart.functions import category_average
from perfmart.operators.relational import (
    anti_join,
    contains_join,
    distinct_rows,
    except_values,
    lookup_join,
    min_per_key,
)
from perfmart.sources.files import stage_to_parquet

AVG_COL = "categoryLabel"


def category_label(df: DataFrame, exempt_report: str) -> DataFrame:
    """Adds ``categoryLabel``: the peer's category-average label for EAA and
    Japan groups (hedged EAA groups keep their currency tail), else the group."""
    return df.withColumn(AVG_COL, category_average(
        "groupInvestment", "peersValue", "reportName", exempt_report,
        C.EAA_PREFIX, C.HEDGED_SUFFIX, C.HEDGED_TAIL_CHARS, (C.JAPAN_PREFIX,),
        C.CATEGORY_AVERAGE))


def category_fallback(labelled: DataFrame, house_prefix: str, distinct: bool = True, cut=stage_to_parquet) -> DataFrame:
    """Peers with no category-average row but an own-fund row borrow, per
    (report, peer, category), every row whose original group equals that
    category, labelled ``peer Category Average`` (one null-attribute row when
    the category is no group).  Then the label replaces the group."""
    avg_text = C.CATEGORY_AVERAGE.strip()
    with_avg = labelled.where(F.col(AVG_COL).contains(avg_text)).select("peersValue").distinct()
    wanted = anti_join(labelled.where(F.col("groupInvestment").startswith(house_prefix))
                       .select("reportName", "peersValue", "morningstarCategory").distinct(),
                       with_avg, "peersValue")
    donors = labelled.drop("peersValue", "reportName", "morningstarCategory", AVG_COL)
    # Inner join of the donors plus the wanted triples without any donor,
    # instead of a left join that would have to stream the small side.
    wanted = cut(wanted) if cut is not None else wanted
    matched = lookup_join(donors, wanted.withColumn("groupInvestment", F.col("morningstarCategory"))
                          .where(F.col("groupInvestment").isNotNull()), ["groupInvestment"], cut=None)
    found = donors.select(F.col("groupInvestment").alias("__g")).distinct()
    unmatched = anti_join(wanted, found, F.col("morningstarCategory") == F.col("__g"))
    borrowed = (matched.unionByName(unmatched, allowMissingColumns=True)
                      .withColumn(AVG_COL, F.concat(F.col("peersValue"), F.lit(C.CATEGORY_AVERAGE)))
                      .select(*labelled.columns))
    out = (labelled.unionByName(borrowed)
                   .withColumn("groupInvestment", F.col(AVG_COL)).drop(AVG_COL))
    return distinct_rows(out) if distinct else out


def attach_peer_name(df: DataFrame, feed: DataFrame, distinct: bool = True, cut=stage_to_parquet) -> DataFrame:
    """``peersLib`` := feed ``Lib`` of the feed rows whose ``Cod`` is the peer.
    Both sides are made distinct before the join: so are its rows then, and where
    ``df`` is distinct already, the planner drops the second distinct."""
    names = feed.select(F.col("Cod").alias("peersValue"), F.col("Lib").alias("peersLib")).distinct()
    rows = df.distinct() if distinct else df
    return lookup_join(rows, names, ["peersValue"], "left", cut).select(*df.columns, "peersLib")


def sector_of_peer(df: DataFrame, transco: DataFrame, name_col: str = "name",
                   sector_col: str = "IA Sector") -> DataFrame:
    """(peersValue, sector): the smallest non-null sector of the peer's groups
    through the transcoding table.  Only distinct (peer, group) pairs join."""
    pairs = df.select("peersValue", "groupInvestment").distinct()
    t = transco.select(F.col(name_col).alias("groupInvestment"),
                       F.col(f"`{sector_col}`").alias("sector")).where(F.col("sector").isNotNull())
    return min_per_key(pairs.join(t, "groupInvestment"), ["peersValue"], "sector")


def uncovered_peers(df: DataFrame, ia_prefix: str = C.IA_PREFIX) -> DataFrame:
    """Peers having no (null isin, group starting ``ia_prefix``) row."""
    covered = df.where(F.col("isin").isNull() & F.col("groupInvestment").startswith(ia_prefix))
    return except_values(df, covered, ["peersValue"])


def sector_fanout(df: DataFrame, peer_sector: DataFrame, ia_prefix: str = C.IA_PREFIX,
                  label: str = C.IA_SECTOR, distinct: bool = True, cut=stage_to_parquet) -> DataFrame:
    """For each (peer p, sector s) of ``peer_sector``, every row whose group is
    ``ia_prefix`` followed somewhere by s yields two ``label`` rows: one under
    its own peer and one under p.  The LIKE join runs as an exact equi-join."""
    rows = df.where(F.col("groupInvestment").startswith(ia_prefix))
    ps = peer_sector.select(F.col("peersValue").alias("__p"), F.col("sector").alias("__s"))
    matched = contains_join(rows, "groupInvestment", ps, "__s", offset=len(ia_prefix), cut=cut)
    out = (matched.withColumn("peersValue", F.explode(F.array(F.col("peersValue"), F.col("__p"))))
                  .withColumn("groupInvestment", F.lit(label))
                  .select(*df.columns))
    # not dealt by the label: a constant is no key of the distinct
    return distinct_rows(out, by=[c for c in df.columns if c != "groupInvestment"]) if distinct else out


def collapse_sector_label(df: DataFrame, infix: str = C.IA_INFIX, label: str = C.IA_SECTOR) -> DataFrame:
    """Groups containing ``infix`` on rows without an isin become ``label``."""
    return df.withColumn("groupInvestment",
                         F.when(F.col("groupInvestment").contains(infix) & F.col("isin").isNull(),
                                F.lit(label)).otherwise(F.col("groupInvestment")))


def peer_sectors(named: DataFrame, uncovered: DataFrame, transco: DataFrame) -> DataFrame:
    """(peersValue, sector) of the uncovered peers (C20 restricted by C21)."""
    return sector_of_peer(named, transco).join(uncovered.select("peersValue"), "peersValue", "left_semi")


def sector_rows(named: DataFrame, peer_sector: DataFrame, distinct: bool = True, cut=stage_to_parquet) -> DataFrame:
    """Sector fan-out of the uncovered peers' sectors (rows already carry
    ``peersLib``), then the label collapse."""
    fan = sector_fanout(named, peer_sector, distinct=distinct, cut=cut)
    return collapse_sector_label(named.unionByName(fan))
