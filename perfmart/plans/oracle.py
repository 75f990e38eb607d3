"""Independent SQL (DuckDB dialect) for every report step on the stand-in inputs.

Each step is one CTE written from the report's rules, not from the Spark code;
``stage_sql(name)`` returns ``WITH <all steps> SELECT ... FROM <name>`` (DuckDB
only evaluates the CTEs a query needs).  Sums are exact decimals cast to
double, as on the Spark side, so values compare bit for bit.
"""

from __future__ import annotations

from perfmart import config as C
from perfmart.sources.standins import STANDIN_CONFIG, STANDIN_METRICS

N = STANDIN_CONFIG.names
SCHEMA = STANDIN_CONFIG.schema


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def s(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(s(v) for v in values) + ")"


def _cols(cols) -> str:
    return ", ".join(q(c) for c in cols)


_WEEK = "cast(date_trunc('week', e.ts) AS DATE)"

def _standin_ctes(extra_attributes=(), wide: bool = False) -> str:
    extra = "".join(
        f",\n    'v' || cast((f.n_nationkey + {i}) % 5 AS VARCHAR) AS {q(a)}"
        for i, a in enumerate(extra_attributes))
    sql = STANDIN_CTES.replace("/*EXTRA*/", extra)
    if wide:
        sql = sql.replace("/*WIDE1*/", " AND c.c_mktsegment IN ('AUTOMOBILE', 'BUILDING')").replace(
            "/*WIDE2*/", "      WHEN e.event_id % 20 = 19 THEN 'W-1 CEL UKCE UKCED UKCP UKCGB ' || f.code || ' Funds'\n")
    return sql


STANDIN_CTES = f"""
fund AS (
  SELECT c.c_custkey, c.c_name, n.n_nationkey, n.n_name, r.r_regionkey, r.r_name, c.c_acctbal,
    CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'CI' WHEN 'BUILDING' THEN 'CC'
      WHEN 'FURNITURE' THEN 'CFB' WHEN 'HOUSEHOLD' THEN 'CCR' WHEN 'MACHINERY' THEN 'CS'
      ELSE c.c_mktsegment END AS code,
    c.c_custkey % 4 AS kind,
    CASE WHEN r.r_regionkey = 1 AND c.c_custkey % 4 = 3/*WIDE1*/ THEN NULL
      ELSE 'LU' || lpad(cast(c.c_custkey AS VARCHAR), 10, '0') END AS isin,
    CASE WHEN c.c_custkey % 4 = 0 THEN 'House ' || c.c_name
      WHEN r.r_regionkey = 1 THEN 'IA ' || n.n_name || ' Sector'
      WHEN c.c_custkey % 4 = 1 THEN 'EAA Fund ' || n.n_name
      WHEN c.c_custkey % 4 = 2 THEN 'EAA Fund ' || n.n_name || ' EUR Hedged'
      ELSE 'Japan Fund ' || n.n_name END AS groupInvestment,
    CASE WHEN r.r_regionkey = 1 THEN 'IA ' || n.n_name || ' Sector'
      ELSE 'EAA Fund ' || n.n_name END AS morningstarCategory,
    CASE n.n_nationkey % 3 WHEN 0 THEN 'Euro' WHEN 1 THEN 'Pound Sterling' ELSE 'USD' END AS currency,
    CASE n.n_nationkey % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'GBP' ELSE 'USD' END AS DevCot
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey),
staging AS (
  SELECT DISTINCT
    repeat('Ù', cast(f.c_custkey % 5 + 1 AS INTEGER)) AS morningstarRatingOverall,
    f.currency,
    cast(e.ts AS DATE) AS calculatedOn,
    cast(e.ts AS DATE) + 1 AS exportedOn,
    cast(f.r_regionkey + 1 AS VARCHAR) || ' - ' || f.r_name || ' Digital' AS scopeName,
    f.isin, f.groupInvestment,
    CASE f.c_custkey % 3 WHEN 0 THEN 'Peers ' || f.code WHEN 1 THEN 'Peer ' || f.code
      ELSE f.code END AS peerGroup,
    CASE WHEN e.event_id % 10 <= 1 THEN '1 week' WHEN e.event_id % 10 = 2 THEN '3 months'
      WHEN e.event_id % 10 = 3 THEN 'YTD' WHEN e.event_id % 10 = 4 THEN '1 year'
      WHEN e.event_id % 10 = 5 THEN f.code WHEN e.event_id % 10 = 6 THEN 'CI'
      WHEN e.event_id % 10 = 7 THEN 'UK Funds W-1'
      WHEN e.event_id % 10 = 8 THEN CASE f.code WHEN 'CI' THEN 'CGC & CFG'
        WHEN 'CFB' THEN 'CCR & CEMD' WHEN 'CCR' THEN 'CFB' ELSE f.code || ' EUR' END
/*WIDE2*/      ELSE 'Top ' || f.code || ' Funds' END AS metricPeriodType,
    {_WEEK} AS startDate,
    {_WEEK} + 6 AS endDate,
    DATE '2015-01-01' + cast(f.c_custkey AS INTEGER) AS inceptionDate,
    f.c_acctbal / 4 AS flowYTD,
    f.c_acctbal AS fundSize,
    f.morningstarCategory,
    CASE WHEN e.event_type = 'purchase' THEN
        CASE WHEN e.event_id % 2 = 1 THEN 'Return (Ann)' ELSE 'Return (Cum)' END
      WHEN e.event_type = 'view' THEN
        CASE WHEN e.event_id % 2 = 1 THEN 'Sortino Ratio (1Y)' ELSE 'Sharpe Ratio (1Y)' END
      WHEN e.event_type = 'click' THEN 'Std Dev (1Y)'
      WHEN e.event_type = 'error' THEN 'Max Drawdown (1Y)'
      ELSE 'Morningstar category percentile' END AS metricType,
    cast(e.value AS DECIMAL(18,2)) AS metricValue,
    'Article ' || cast(f.n_nationkey % 3 + 6 AS VARCHAR) AS EuSfdrFundType,
    f.r_name AS GlobalCategory,
    cast(f.c_custkey % 7 AS VARCHAR) AS "PAI_Non_Renewable_%_Energy_Consumption_Average_Value"/*EXTRA*/,
    'feed_' || cast({_WEEK} AS VARCHAR) AS sourceFileName
  FROM events e JOIN fund f ON e.user_id = f.c_custkey),
weekly AS (
  SELECT f.isin, f.code, f.c_name, f.DevCot, {_WEEK} + 6 AS Dat,
    cast(sum(CASE WHEN e.event_type = 'click' THEN cast(e.value AS DECIMAL(18,2)) END) AS DOUBLE) / 100 AS bench1W,
    cast(sum(CASE WHEN e.event_type = 'view' THEN cast(e.value AS DECIMAL(18,2)) END) AS DOUBLE) / 100 AS bench3M,
    cast(sum(CASE WHEN e.event_type = 'purchase' THEN cast(e.value AS DECIMAL(18,2)) END) AS DOUBLE) / 100 AS benchYtd,
    cast(sum(CASE WHEN e.event_type = 'signup' THEN cast(e.value AS DECIMAL(18,2)) END) AS DOUBLE) / 100 AS bench1Y,
    cast(sum(CASE WHEN e.event_type = 'error' THEN cast(e.value AS DECIMAL(18,2)) END) AS DOUBLE) / 100 AS bench3Y,
    cast(sum(CASE WHEN e.event_type = 'purchase' AND e.value > 50 THEN cast(e.value AS DECIMAL(18,2)) END) AS DOUBLE) / 100 AS bench5Y,
    cast(sum(cast(e.value AS DECIMAL(18,2))) AS DOUBLE) / 100 AS benchPm
  FROM events e JOIN fund f ON e.user_id = f.c_custkey
  WHERE f.kind = 0
  GROUP BY f.isin, f.code, f.c_name, f.DevCot, {_WEEK} + 6),
main_feed AS (
  SELECT isin, code AS Cod, 'House ' || code || ' Fund' AS Lib, DevCot, Dat,
    bench1W, bench3M, benchYtd, bench1Y, bench3Y, bench5Y, benchPm
  FROM weekly),
share_feed AS (
  SELECT isin, code AS Cod,
    CASE WHEN code = 'CS' AND DevCot = 'EUR' THEN {s(N.special_fund)}
      WHEN code = 'CS' THEN {s(N.special_fund + ' ')} || DevCot
      ELSE 'House Share ' || c_name END AS Lib,
    DevCot, Dat, bench1W, bench3M, benchYtd, bench1Y, bench3Y, bench5Y, benchPm,
    cast(right(isin, 1) AS INTEGER) % 2 AS IsPartPrinc
  FROM weekly),
transco AS (
  SELECT 'IA ' || n_name || ' Sector' AS name, n_name AS "IA Sector" FROM nation)"""


def _peer_map_case(col: str, codes, extra=()) -> str:
    whens = [f"WHEN {col} IN {_in(codes)} THEN {s(C.UK_PREFIX)} || {col}"]
    whens += [f"WHEN {col} = {s(a)} THEN {s(b)}" for a, b in extra]
    return "CASE " + " ".join(whens) + f" ELSE {col} END"


def _metric_cols() -> list[str]:
    return list(STANDIN_METRICS)


def _family(prefix: str) -> str:
    members = sorted(m for m in STANDIN_METRICS if m.startswith(prefix))
    if not members:
        return "CAST(NULL AS DOUBLE)"
    return "coalesce(" + ", ".join(q(m) for m in members) + ")"


def _with_date_order(schema) -> list[str]:
    keys = schema.pivot_keys
    order = ["sourceFileName", "reportName"] + [k for k in keys if k not in ("sourceFileName", "reportName")]
    order += _metric_cols() + [o for o, _ in C.METRIC_FAMILIES] + ["date"]
    return order


def _tiebreak(schema) -> str:
    wk = set(schema.window_keys)
    cols = [c for c in _with_date_order(schema) if c not in wk and c != "calculationDate"]
    return ", ".join(f"{q(c)} ASC NULLS FIRST" for c in cols)


SYN = ("(ends_with(groupInvestment, {idx}) OR ends_with(groupInvestment, {avg}) "
       "OR groupInvestment = {sec})").format(idx=s(C.INDEX_SUFFIX), avg=s(C.CATEGORY_AVERAGE),
                                              sec=s(C.IA_SECTOR))
OWN = ("(ends_with(metricPeriodType, ' ' || peersValue) OR metricPeriodType = peersValue "
       "OR (metricPeriodType = 'CS' AND starts_with(peersValue, 'CS')) "
       "OR starts_with(metricPeriodType, peersValue || ' ') "
       "OR contains(metricPeriodType, ' ' || peersValue || ' '))")


def _clone_branches() -> str:
    out = []
    for r in STANDIN_CONFIG.clones():
        repl = [f"{s(r.new_peer)} AS peersValue", f"{s(r.new_group)} AS groupInvestment"]
        if r.new_report is not None:
            repl.append(f"{s(r.new_report)} AS reportName")
        skip = f" AND periodType <> {s(r.skip_period)}" if r.skip_period else ""
        out.append(f"SELECT * REPLACE ({', '.join(repl)}) FROM slice "
                   f"WHERE groupInvestment = {s(r.group)} AND starts_with(reportName, {s(r.report_prefix)}){skip}")
    return "\n  UNION ALL ".join(["SELECT * FROM slice", *out])


def _initcap(col: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({col}), ' '), "
            f"lambda w: upper(w[1]) || w[2:]), ' ')")


def _stage_ctes(schema) -> str:
    pivot_keys = _cols(schema.pivot_keys)
    sums = ",\n    ".join(
        f"cast(sum(CASE WHEN metricType = {s(m)} THEN metricValue END) AS DOUBLE) AS {q(m)}"
        for m in STANDIN_METRICS)
    families = ",\n    ".join(f"{_family(p)} AS {q(o)}" for o, p in C.METRIC_FAMILIES)
    window = _cols(schema.window_keys)
    out_cols = _cols(schema.output_columns(N.flag_col))
    renames = ", ".join(f"{q(a)} AS {q(b)}" for a, b in schema.renames)
    rename = f" RENAME ({renames})" if renames else ""
    bench = "\n  UNION ALL ".join(
        f"SELECT isin, Cod, Lib, DevCot, Dat, IsPartPrinc, {s(lbl)} AS periodType, {src} AS \"return\", "
        f"Dat AS periodStartDate, Dat AS date FROM feed" for src, lbl in C.BENCH_PERIODS)
    return f"""
cleaned AS (
  SELECT * REPLACE (replace(replace(currency, 'Euro', 'EUR'), 'Pound Sterling', 'GBP') AS currency),
    replace(morningstarRatingOverall, {s(C.RATING_GLYPH)}, '*') AS morningstarRating,
    calculatedOn AS calculationDate, exportedOn AS exportDate, scopeName AS reportName,
    replace(replace(currency, 'Euro', 'EUR'), 'Pound Sterling', 'GBP') AS reportCurrency,
    CASE WHEN starts_with(peerGroup, 'Peers ') THEN replace(peerGroup, 'Peers ', '')
      WHEN starts_with(peerGroup, 'Peer ') THEN replace(peerGroup, 'Peer ', '')
      ELSE peerGroup END AS peersValue
  FROM staging),
scoped AS (
  SELECT * REPLACE (
    CASE WHEN reportName LIKE {s(C.UK_SCOPE_PATTERN)} THEN {_peer_map_case('peersValue', C.UK_PEER_CODES)}
      ELSE peersValue END AS peersValue,
    CASE WHEN reportName LIKE {s(C.UK_SCOPE_PATTERN)}
        THEN {_peer_map_case('metricPeriodType', C.UK_PERIOD_CODES, C.UK_PERIOD_EXTRA)}
      WHEN reportName = '6%' AND metricPeriodType = 'CSEM EUR' THEN 'Ret since launch'
      WHEN reportName = '6%' AND metricPeriodType = 'CSEM EUR W-1' THEN 'Ret since launch W-1'
      ELSE metricPeriodType END AS metricPeriodType)
  FROM cleaned),
relabelled AS (
  SELECT * FROM scoped
  UNION ALL
  SELECT * REPLACE (CASE WHEN peersValue = 'CI' THEN 'CGC' ELSE 'CFB' END AS peersValue)
  FROM scoped
  WHERE (peersValue = 'CI' AND metricPeriodType = 'CGC & CFG' AND groupInvestment LIKE 'EAA Fund%')
     OR (peersValue = 'CCR' AND metricPeriodType = 'CFB' AND groupInvestment LIKE 'EAA Fund%'
         AND reportName LIKE '3%')),
reassigned AS (
  SELECT * REPLACE (
    CASE WHEN peersValue = 'CFB' AND metricPeriodType = 'CCR & CEMD' AND groupInvestment LIKE 'EAA Fund%' THEN 'CCR'
      WHEN peersValue = 'CI' AND metricPeriodType = 'CGC & CFG' AND groupInvestment LIKE 'EAA Fund%' THEN 'CFG'
      WHEN peersValue = 'CI' AND metricPeriodType = 'CHX' AND groupInvestment LIKE 'EAA Fund%' THEN 'CHX'
      ELSE peersValue END AS peersValue)
  FROM relabelled),
normalised AS (
  SELECT * REPLACE (CASE WHEN {OWN} THEN {s(C.SINCE_PM)} ELSE metricPeriodType END AS metricPeriodType)
  FROM reassigned),
filtered AS (
  SELECT * FROM normalised n
  WHERE NOT EXISTS (SELECT 1 FROM scoped p WHERE p.peersValue = n.metricPeriodType)
    AND (metricPeriodType IS NULL OR NOT contains(metricPeriodType, {s(C.FOREIGN_PERIOD_MARKER)}))),
prepared AS (
  SELECT *, inceptionDate AS returnDateDaily, flowYTD AS netFlowYTD, metricPeriodType AS periodType,
    startDate AS periodStartDate, endDate AS periodEndDate
  FROM filtered),
pivoted AS (
  SELECT {pivot_keys},
    {sums}
  FROM prepared GROUP BY {pivot_keys}),
families AS (
  SELECT *,
    {families}
  FROM pivoted),
report_dates AS (
  SELECT DISTINCT sourceFileName, reportName, periodEndDate AS date
  FROM families WHERE periodType = {s(C.WEEK_PERIOD)} AND periodEndDate IS NOT NULL),
with_date AS (
  SELECT f.*, d.date FROM families f
  JOIN report_dates d ON f.sourceFileName = d.sourceFileName AND f.reportName = d.reportName),
dated AS (
  SELECT * FROM with_date
  QUALIFY row_number() OVER (PARTITION BY {window}
    ORDER BY calculationDate DESC NULLS LAST, {_tiebreak(schema)}) = 1),
feed AS (
  SELECT *, CAST(NULL AS INTEGER) AS IsPartPrinc FROM main_feed
  UNION ALL BY NAME
  SELECT * FROM share_feed WHERE Lib LIKE {s(N.special_fund + '%')}),
house_isins AS (SELECT DISTINCT isin FROM feed WHERE isin IS NOT NULL),
flagged AS (
  SELECT d.*, CASE WHEN h.isin IS NULL THEN 0 ELSE 1 END AS {q(N.flag_col)}
  FROM dated d LEFT JOIN house_isins h ON d.isin = h.isin),
bench AS (
  {bench}),
special AS (
  SELECT isin, periodType, periodStartDate, "return", date, Lib AS groupInvestment,
    DevCot AS reportCurrency, Cod AS peersValue, {s(N.special_report)} AS reportName
  FROM bench WHERE Lib LIKE {s(N.special_fund + '%')}),
picked AS (
  SELECT peersValue, calculationDate, exportDate, reportCurrency, reportName, date, min(isin) AS isin
  FROM flagged WHERE {q(N.flag_col)} = 1
  GROUP BY peersValue, calculationDate, exportDate, reportCurrency, reportName, date),
index_rows AS (
  SELECT DISTINCT p.peersValue, p.calculationDate, p.exportDate, p.reportCurrency, p.reportName, p.date,
    CASE WHEN (p.peersValue || {s(C.INDEX_SUFFIX)}) LIKE {s('%' + C.INDEX_SUFFIX)} THEN NULL ELSE p.isin END AS isin,
    b.periodType, b.periodStartDate, b."return", p.peersValue || {s(C.INDEX_SUFFIX)} AS groupInvestment
  FROM picked p LEFT JOIN bench b ON p.isin = b.isin AND p.date = b.date
  WHERE b."return" IS NOT NULL),
ci_index AS (
  SELECT * FROM flagged
  UNION ALL BY NAME SELECT * FROM index_rows
  UNION ALL BY NAME SELECT * FROM special),
labelled AS (
  SELECT *,
    CASE WHEN reportName <> {s(N.exempt_report)} THEN
      CASE WHEN groupInvestment LIKE 'EAA%' THEN
          CASE WHEN groupInvestment LIKE '%Hedged' THEN peersValue || ' Category Average ' || right(groupInvestment, 10)
            ELSE peersValue || ' Category Average' END
        WHEN groupInvestment LIKE 'Japan Fund%' THEN peersValue || ' Category Average'
        ELSE groupInvestment END
      ELSE groupInvestment END AS categoryLabel
  FROM ci_index),
with_average AS (SELECT DISTINCT peersValue FROM labelled WHERE categoryLabel LIKE '%Category Average%'),
wanted AS (
  SELECT DISTINCT reportName, peersValue, morningstarCategory FROM labelled l
  WHERE NOT EXISTS (SELECT 1 FROM with_average w WHERE w.peersValue = l.peersValue)
    AND groupInvestment LIKE {s(N.house_prefix + '%')}),
borrowed AS (
  SELECT d.* EXCLUDE (peersValue, reportName, morningstarCategory, categoryLabel),
    w.reportName, w.peersValue, w.morningstarCategory, w.peersValue || ' Category Average' AS categoryLabel
  FROM wanted w LEFT JOIN labelled d ON w.morningstarCategory = d.groupInvestment),
eaa AS (
  SELECT DISTINCT * EXCLUDE (categoryLabel) REPLACE (categoryLabel AS groupInvestment)
  FROM (SELECT * FROM labelled UNION ALL BY NAME SELECT * FROM borrowed)),
peer_names AS (SELECT DISTINCT Cod, Lib AS peersLib FROM feed),
named AS (
  SELECT DISTINCT e.*, n.peersLib FROM eaa e LEFT JOIN peer_names n ON e.peersValue = n.Cod),
uncovered AS (
  SELECT peersValue FROM ci_index
  EXCEPT
  SELECT peersValue FROM ci_index WHERE isin IS NULL AND groupInvestment LIKE 'IA%'),
peer_sector AS (
  SELECT g.peersValue, min(t."IA Sector") AS sector
  FROM (SELECT DISTINCT peersValue, groupInvestment FROM named) g
  JOIN transco t ON g.groupInvestment = t.name
  WHERE t."IA Sector" IS NOT NULL AND g.peersValue IN (SELECT peersValue FROM uncovered)
  GROUP BY g.peersValue),
fan_source AS (
  SELECT r.*, p.peersValue AS uncovered_peer
  FROM named r JOIN peer_sector p
    ON r.groupInvestment LIKE 'IA%' AND contains(substr(r.groupInvestment, 3), p.sector)),
fan AS (
  SELECT * EXCLUDE (uncovered_peer) REPLACE ('IA SECTOR' AS groupInvestment) FROM fan_source
  UNION
  SELECT * EXCLUDE (uncovered_peer) REPLACE (uncovered_peer AS peersValue, 'IA SECTOR' AS groupInvestment)
  FROM fan_source),
sector AS (
  SELECT * REPLACE (CASE WHEN groupInvestment LIKE '%IA%' AND isin IS NULL THEN 'IA SECTOR'
    ELSE groupInvestment END AS groupInvestment)
  FROM (SELECT * FROM named UNION ALL BY NAME SELECT * FROM fan)),
base_dates AS (
  SELECT DISTINCT date, peersValue, reportName, reportCurrency, periodType,
    periodStartDate AS new_start, periodEndDate AS new_end
  FROM sector WHERE NOT {SYN}),
periods AS (
  SELECT DISTINCT * EXCLUDE (new_start, new_end) REPLACE (
    CASE WHEN {SYN} THEN new_start ELSE periodStartDate END AS periodStartDate,
    CASE WHEN {SYN} THEN new_end ELSE periodEndDate END AS periodEndDate)
  FROM sector LEFT JOIN base_dates USING (date, peersValue, reportName, reportCurrency, periodType)),
projected AS (SELECT DISTINCT {out_cols} FROM periods),
report AS (
  SELECT DISTINCT * REPLACE (
    CASE WHEN groupInvestment LIKE {s('%' + C.INDEX_SUFFIX)} OR groupInvestment = {s(N.special_fund)}
      THEN "return" * 100 ELSE "return" END AS "return",
    {_initcap('reportName')} AS reportName){rename}
  FROM projected),
snap AS (
  SELECT max(date) AS d FROM report
  WHERE date IS NOT NULL AND groupInvestment NOT LIKE {s(N.special_fund + '%')}),
slice AS (SELECT r.* FROM report r JOIN snap ON r.date = snap.d),
cloned AS (
  {_clone_branches()})"""


# Decimal columns before the pivot are compared as doubles.
_AS_DOUBLE = {"staging", "cleaned", "scoped", "relabelled", "reassigned", "normalised",
              "filtered", "prepared"}


def stage_sql(stage: str, select: str | None = None, schema=SCHEMA, wide: bool = False) -> str:
    """SQL of one step; ``wide``: on the stand-in with several uncovered peers; ``schema`` other than the stand-in one (e.g. the full
    production attribute list) adds nation-level attribute columns."""
    body = select or (f"SELECT * REPLACE (cast(metricValue AS DOUBLE) AS metricValue) FROM {stage}"
                      if stage in _AS_DOUBLE else f"SELECT * FROM {stage}")
    extra = [a for a in schema.attributes if a not in SCHEMA.attributes]
    return f"WITH {_standin_ctes(extra, wide)},{_stage_ctes(schema)}\n{body}"
