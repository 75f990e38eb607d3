"""Report inputs derived from the driver's tables (TPC-H-like schema + events).

The report reads three envelope feeds and one CSV lookup.  Here they are
built from whole driver tables, so every query grows with the scale factor:

* staging (long metrics): one row per ``events`` row, the fund being the
  event's customer; peer group from the market segment, report from the
  region, metric from the event type, value from the event value.
* reference feed (wide benchmarks): weekly sums of the events of the
  house's own funds, one column per benchmark period; the share-level feed
  carries the special fund.
* sector transcoding CSV: one line per nation.

Stand-in vocabulary (fixed values of this adapter, not report rules):
segment -> peer code AUTOMOBILE CI, BUILDING CC, FURNITURE CFB,
HOUSEHOLD CCR, MACHINERY CS.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perfmart.config import FOREIGN_PERIOD_MARKER, HouseNames, ReportConfig, ReportSchema
from perfmart.sources.envelope import wrap
from perfmart.sources.files import read_csv_lookup, write_csv_lookup
from perfmart.session import scratch_path

SEGMENT_CODES = (("AUTOMOBILE", "CI"), ("BUILDING", "CC"), ("FURNITURE", "CFB"),
                 ("HOUSEHOLD", "CCR"), ("MACHINERY", "CS"))

STANDIN_NAMES = HouseNames(exempt_report="5 - MIDDLE EAST Digital")
STANDIN_ATTRIBUTES = ("EuSfdrFundType", "GlobalCategory",
                      "PAI_Non_Renewable_%_Energy_Consumption_Average_Value")
STANDIN_METRICS = ("Max Drawdown (1Y)", "Morningstar category percentile", "Return (Ann)",
                   "Return (Cum)", "Sharpe Ratio (1Y)", "Sortino Ratio (1Y)", "Std Dev (1Y)")
STANDIN_SCHEMA = ReportSchema(
    attributes=STANDIN_ATTRIBUTES,
    window_excluded=("PAI_Non_Renewable_%_Energy_Consumption_Average_Value",),
    renames=(),
    metrics=STANDIN_METRICS,
)
STANDIN_CONFIG = ReportConfig(names=STANDIN_NAMES, schema=STANDIN_SCHEMA)
# The production schema (all 36 attributes, 57 output columns, shortened names)
# on the same stand-in data.
FULL_SCHEMA = ReportSchema(metrics=STANDIN_METRICS)
FULL_CONFIG = ReportConfig(names=STANDIN_NAMES, schema=FULL_SCHEMA)

STAGING_FIELDS = ("morningstarRatingOverall", "currency", "calculatedOn", "exportedOn",
                  "scopeName", "isin", "groupInvestment", "peerGroup", "metricPeriodType",
                  "startDate", "endDate", "inceptionDate", "flowYTD", "fundSize",
                  "morningstarCategory", "metricType", "metricValue", *STANDIN_ATTRIBUTES)
FEED_FIELDS = ("isin", "Cod", "Lib", "DevCot", "Dat", "bench1W", "bench3M", "benchYtd",
               "bench1Y", "bench3Y", "bench5Y", "benchPm")


_READS: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the (immutable) DataFrame is reused within a session so
    file listing and footer reads happen once."""
    path = f"{sf_dir}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def _case(c: Column, pairs, default: Column) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(default)


def fund_frame(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Customers with their nation and region: one row per fund.  ``wide``: only
    two segments have funds without an isin, so several peers have no sector row
    and take over sectors that lie in one another's names."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    f = (c.join(n, c.c_nationkey == n.n_nationkey)
          .join(r, n.n_regionkey == r.r_regionkey))
    code = _case(F.col("c_mktsegment"), SEGMENT_CODES, F.col("c_mktsegment"))
    kind = F.col("c_custkey") % 4
    without = (F.col("r_regionkey") == 1) & (kind == 3)
    if wide:
        without = without & F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    isin = F.when(without, F.lit(None).cast("string")) \
            .otherwise(F.concat(F.lit("LU"), F.lpad(F.col("c_custkey").cast("string"), 10, "0")))
    group = (F.when(kind == 0, F.concat(F.lit("House "), F.col("c_name")))
              .when(F.col("r_regionkey") == 1, F.concat(F.lit("IA "), F.col("n_name"), F.lit(" Sector")))
              .when(kind == 1, F.concat(F.lit("EAA Fund "), F.col("n_name")))
              .when(kind == 2, F.concat(F.lit("EAA Fund "), F.col("n_name"), F.lit(" EUR Hedged")))
              .otherwise(F.concat(F.lit("Japan Fund "), F.col("n_name"))))
    category = F.when(F.col("r_regionkey") == 1,
                      F.concat(F.lit("IA "), F.col("n_name"), F.lit(" Sector"))) \
                .otherwise(F.concat(F.lit("EAA Fund "), F.col("n_name")))
    cur = F.col("n_nationkey") % 3
    return f.select(
        "c_custkey", "c_name", "n_nationkey", "n_name", "r_regionkey", "r_name", "c_acctbal",
        code.alias("code"), kind.alias("kind"), isin.alias("isin"),
        group.alias("groupInvestment"), category.alias("morningstarCategory"),
        _case(cur, ((0, "Euro"), (1, "Pound Sterling")), F.lit("USD")).alias("currency"),
        _case(cur, ((0, "EUR"), (1, "GBP")), F.lit("USD")).alias("DevCot"),
    )


def staging_envelope(spark: SparkSession, sf_dir: str,
                     attributes: tuple[str, ...] = STANDIN_ATTRIBUTES, wide: bool = False) -> DataFrame:
    """``wide``: as in ``fund_frame``; every twentieth event carries the marker
    of foreign periods.  ``attributes`` beyond the three stand-in ones (e.g. the full production
    list) are filled with nation-level labels, so they never split a group."""
    e = table(spark, sf_dir, "events")
    f = fund_frame(spark, sf_dir, wide)
    d = e.join(f, e.user_id == f.c_custkey)
    code = F.col("code")
    m = F.col("event_id") % 10
    marked = F.lit(wide) & (F.col("event_id") % 20 == 19)
    odd = (F.col("event_id") % 2) == 1
    period = (F.when(m <= 1, F.lit("1 week")).when(m == 2, F.lit("3 months"))
               .when(m == 3, F.lit("YTD")).when(m == 4, F.lit("1 year"))
               .when(m == 5, code).when(m == 6, F.lit("CI"))
               .when(m == 7, F.lit("UK Funds W-1"))
               .when(m == 8, _case(code, (("CI", "CGC & CFG"), ("CFB", "CCR & CEMD"), ("CCR", "CFB")),
                                   F.concat(code, F.lit(" EUR"))))
               .otherwise(F.concat(F.when(marked, F.lit("W-1 " + FOREIGN_PERIOD_MARKER + " ")).otherwise(F.lit("Top ")), code, F.lit(" Funds"))))
    metric = (F.when(F.col("event_type") == "purchase",
                     F.when(odd, F.lit("Return (Ann)")).otherwise(F.lit("Return (Cum)")))
               .when(F.col("event_type") == "view",
                     F.when(odd, F.lit("Sortino Ratio (1Y)")).otherwise(F.lit("Sharpe Ratio (1Y)")))
               .when(F.col("event_type") == "click", F.lit("Std Dev (1Y)"))
               .when(F.col("event_type") == "error", F.lit("Max Drawdown (1Y)"))
               .otherwise(F.lit("Morningstar category percentile")))
    peer_kind = F.col("c_custkey") % 3
    week = F.to_date(F.date_trunc("week", F.col("ts")))
    cols = {
        "morningstarRatingOverall": F.expr("repeat('Ù', cast(c_custkey % 5 + 1 as int))"),
        "currency": F.col("currency"),
        "calculatedOn": F.to_date("ts"),
        "exportedOn": F.date_add(F.to_date("ts"), 1),
        "scopeName": F.concat((F.col("r_regionkey") + 1).cast("string"), F.lit(" - "),
                              F.col("r_name"), F.lit(" Digital")),
        "isin": F.col("isin"),
        "groupInvestment": F.col("groupInvestment"),
        "peerGroup": F.when(peer_kind == 0, F.concat(F.lit("Peers "), code))
                      .when(peer_kind == 1, F.concat(F.lit("Peer "), code)).otherwise(code),
        "metricPeriodType": period,
        "startDate": week,
        "endDate": F.date_add(week, 6),
        "inceptionDate": F.date_add(F.lit("2015-01-01").cast("date"), F.col("c_custkey").cast("int")),
        "flowYTD": F.col("c_acctbal") / 4,
        "fundSize": F.col("c_acctbal"),
        "morningstarCategory": F.col("morningstarCategory"),
        "metricType": metric,
        "metricValue": F.col("value").cast("decimal(18,2)"),
        "EuSfdrFundType": F.concat(F.lit("Article "), (F.col("n_nationkey") % 3 + 6).cast("string")),
        "GlobalCategory": F.col("r_name"),
        "PAI_Non_Renewable_%_Energy_Consumption_Average_Value": (F.col("c_custkey") % 7).cast("string"),
    }
    for i, name in enumerate(a for a in attributes if a not in cols):
        cols[name] = F.concat(F.lit("v"), ((F.col("n_nationkey") + i) % 5).cast("string"))
    flat = d.select(*[v.alias(k) for k, v in cols.items()],
                    F.concat(F.lit("feed_"), week.cast("string")).alias("sourceFileName"))
    fields = [*STAGING_FIELDS, *[a for a in attributes if a not in STAGING_FIELDS]]
    return wrap(flat, fields, ["sourceFileName"])


def _weekly_house(spark: SparkSession, sf_dir: str, wide: bool = False) -> DataFrame:
    """Weekly benchmark sums per own fund (kind 0)."""
    e = table(spark, sf_dir, "events")
    f = fund_frame(spark, sf_dir, wide).where(F.col("kind") == 0)
    d = e.join(f, e.user_id == f.c_custkey)
    dec = F.col("value").cast("decimal(18,2)")

    def s(cond):
        return (F.sum(F.when(cond, dec)).cast("double") / 100)

    et = F.col("event_type")
    week_end = F.date_add(F.to_date(F.date_trunc("week", F.col("ts"))), 6)
    return (d.groupBy("isin", "code", "c_name", "DevCot", week_end.alias("Dat"))
             .agg(s(et == "click").alias("bench1W"), s(et == "view").alias("bench3M"),
                  s(et == "purchase").alias("benchYtd"), s(et == "signup").alias("bench1Y"),
                  s(et == "error").alias("bench3Y"),
                  s((et == "purchase") & (F.col("value") > 50)).alias("bench5Y"),
                  s(F.lit(True)).alias("benchPm")))


def main_feed_envelope(spark: SparkSession, sf_dir: str, weekly: DataFrame | None = None) -> DataFrame:
    w = weekly if weekly is not None else _weekly_house(spark, sf_dir)
    flat = w.select("isin", F.col("code").alias("Cod"),
                    F.concat(F.lit("House "), F.col("code"), F.lit(" Fund")).alias("Lib"),
                    "DevCot", "Dat", "bench1W", "bench3M", "benchYtd", "bench1Y", "bench3Y",
                    "bench5Y", "benchPm")
    return wrap(flat, FEED_FIELDS)


def share_feed_envelope(spark: SparkSession, sf_dir: str,
                        names: HouseNames = STANDIN_NAMES, weekly: DataFrame | None = None) -> DataFrame:
    w = weekly if weekly is not None else _weekly_house(spark, sf_dir)
    lib = (F.when((F.col("code") == "CS") & (F.col("DevCot") == "EUR"), F.lit(names.special_fund))
            .when(F.col("code") == "CS", F.concat(F.lit(names.special_fund + " "), F.col("DevCot")))
            .otherwise(F.concat(F.lit("House Share "), F.col("c_name"))))
    flat = w.select("isin", F.col("code").alias("Cod"), lib.alias("Lib"), "DevCot", "Dat",
                    "bench1W", "bench3M", "benchYtd", "bench1Y", "bench3Y", "bench5Y", "benchPm",
                    (F.col("isin").substr(-1, 1).cast("int") % 2).alias("IsPartPrinc"))
    return wrap(flat, [*FEED_FIELDS, "IsPartPrinc"])


def transco_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.concat(F.lit("IA "), F.col("n_name"), F.lit(" Sector")).alias("name"),
                    F.col("n_name").alias("IA Sector"))


def transco_csv(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """The transcoding lookup written as a ';' CSV with a header under the
    shared scratch folder, then read back as all-string columns."""
    target = path or scratch_path(spark, "transco")
    write_csv_lookup(transco_frame(spark, sf_dir), target)
    return read_csv_lookup(spark, target, ["name", "IA Sector"])


@dataclass
class ReportInputs:
    staging: DataFrame       # envelope {data, sourceFileName}
    main_feed: DataFrame     # envelope {data}
    share_feed: DataFrame    # envelope {data} with IsPartPrinc
    transco: DataFrame       # (name, IA Sector) strings


def standin_inputs(spark: SparkSession, sf_dir: str, csv: bool = False,
                   attributes: tuple[str, ...] = STANDIN_ATTRIBUTES, wide: bool = False) -> ReportInputs:
    weekly = _weekly_house(spark, sf_dir, wide)
    return ReportInputs(
        staging=staging_envelope(spark, sf_dir, attributes, wide),
        main_feed=main_feed_envelope(spark, sf_dir, weekly),
        share_feed=share_feed_envelope(spark, sf_dir, weekly=weekly),
        transco=transco_csv(spark, sf_dir) if csv else transco_frame(spark, sf_dir),
    )
