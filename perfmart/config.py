"""Business rules and schema of the performance report, as data.

Every operator takes its rules as arguments; the objects below are the
defaults a deployment starts from.  Names that identify one fund house
(its own fund-name prefix, its special fund, its report titles) are
deployment parameters with neutral placeholders here: set them in
``HouseNames`` for a real run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reporting rules for identical results;
# they are listed plainly, in the order the rules apply them.
# ---------------------------------------------------------------------------

# Label cleaning.
RATING_GLYPH = "Ù"
RATING_STAR = "*"
CURRENCY_RENAMES = (("Euro", "EUR"), ("Pound Sterling", "GBP"))
PEER_PREFIXES = ("Peers ", "Peer ")

# Scoped recode of peer codes and period labels for reports LIKE '2%'.
UK_SCOPE_PATTERN = "2%"
UK_PREFIX = "UK"
UK_PEER_CODES = ("CI", "CC", "CLSEE", "CS", "CGC", "CCNE", "CE", "CEL", "CP",
                 "CGEC", "CGB", "CED", "CEMP")
UK_PERIOD_CODES = ("CE", "CI", "CC", "CLSEE", "CEL", "CS", "CGC", "CCNE", "CP",
                   "CGEC", "CGB", "CED", "CEMP")
UK_PERIOD_EXTRA = (("UK Funds W-1", "Since UK Funds W-1"),)
# (report name compared by equality, period, new period)
GUARDED_PERIOD_RULES = (("6%", "CSEM EUR", "Ret since launch"),
                        ("6%", "CSEM EUR W-1", "Ret since launch W-1"))

# Added relabelled copies: (peer, period, group prefix, report prefix or None, new peer)
DUPLICATE_RULES = (("CI", "CGC & CFG", "EAA Fund", None, "CGC"),
                   ("CCR", "CFB", "EAA Fund", "3", "CFB"))
# In-place peer rewrites, first match wins: (peer, period, group prefix, new peer)
REASSIGN_RULES = (("CFB", "CCR & CEMD", "EAA Fund", "CCR"),
                  ("CI", "CGC & CFG", "EAA Fund", "CFG"),
                  ("CI", "CHX", "EAA Fund", "CHX"))
SINCE_PM = "Since PM*"
# (period, peer prefix) pair that also counts as the peer's own period
OWN_PERIOD_SPECIAL = ("CS", "CS")
FOREIGN_PERIOD_MARKER = "CEL UKCE UKCED UKCP UKCGB"

# Metric families: (output column, pivot-column name prefix)
METRIC_FAMILIES = (("sharpeRatio", "Sharpe Ratio"),
                   ("sortinoRatio", "Sortino Ratio"),
                   ("return", "Return"),
                   ("stdDev", "Std Dev"),
                   ("maxDrawdown", "Max Drawdown"))
PERCENTILE_METRIC = "Morningstar category percentile"
WEEK_PERIOD = "1 week"

# Benchmark columns of the reference feed and the period each one reports.
BENCH_PERIODS = (("bench1W", "1 week"), ("bench3M", "3 months"),
                 ("benchYtd", "YTD"), ("bench1Y", "1 year"),
                 ("bench3Y", "3 years"), ("bench5Y", "5 years"),
                 ("benchPm", "Since PM*"))
INDEX_SUFFIX = " Index"

# Category-average labels.
CATEGORY_AVERAGE = " Category Average"
EAA_PREFIX = "EAA"
HEDGED_SUFFIX = "Hedged"
HEDGED_TAIL_CHARS = 10
JAPAN_PREFIX = "Japan Fund"

# Sector rows.
IA_PREFIX = "IA"
IA_INFIX = "IA"
IA_SECTOR = "IA SECTOR"

# The 36 ESG / PAI attributes carried through the report.
ESG_ATTRIBUTES = (
    "EuSfdrFundType",
    "EU_Sustainable_Finance_Disclosure_Regulation_Minimum_Or_Planned_Investments_Sustainable_Investments_Taxonomy_Aligned",
    "Minimum_Percentage_Investments_Aligned_EU_Taxonomy_Including_Sovereign_Bonds",
    "Principle_Adverse_Impact_Consideration",
    "ISR_EMT",
    "Towards_Sustainability_EMT",
    "GlobalCategory",
    "SustainableInvestmentOverall",
    "PAI_Scope_1_GHG_EmissionsTonnes",
    "PAI_Scope_1_2_3_GHG_EmissionsTonnes",
    "PAI_Carbon_Footprint_Scope_1_2_Tonnes_Per_EURm",
    "PAI_Carbon_Footprint_Scope_1_2_3_Tonnes_Per_EURm",
    "PAI_GHG_Intensity_Scope_1_2_Average_Value",
    "PAI_GHG_Intensity_Scope_1_2_3_Average_Value",
    "PAI_Fossil_Fuel_%_of_Covered_Portfolio_Involved",
    "PAI_Fossil_Fuel_%_of_Portfolio_Involved",
    "PAI_Fossil_Fuel_%_of_Eligible_Portfolio_Involved",
    "PAI_Non_Renewable_%_Energy_Consumption_Average_Value",
    "PAI_Non_Renewable_of_Energy_Production_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_A_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_B_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_C_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_D_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_E_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_F_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_G_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_H_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_L_Average_Value",
    "PAI_Negative_Affect_On_Biodiversity_%_Portfolio_Involved",
    "PAI_Emissions_Water_Tonnes_Per_EURm",
    "PAI_Hazardous_Waste_Tonnes_Per_EURm",
    "PAI_Ungc_Lack_Compliance_Mechanisms_%_Portfolio_Involved",
    "PAI_Controversial_Weapons_%_Eligible_Portfolio_Involved",
    "PAI_Ungc_Principles_OECD_Guidelines_Violations_%_Portfolio_Involved",
    "PAI_Gender_Pay_Gap_Average_Value",
    "PAI_Percentage_Female_Board_Members_Average_Value",
)
# Pivot keys that are not latest-row keys.
ESG_NOT_IN_WINDOW = (
    "PAI_Non_Renewable_%_Energy_Consumption_Average_Value",
    "PAI_Non_Renewable_of_Energy_Production_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_A_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_B_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_C_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_D_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_E_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_F_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_G_Average_Value",
    "PAI_Energy_Consumption_Intensity_NACE_H_Average_Value",
)
# Output names longer than a PostgreSQL identifier, cut to 63 characters.
OUTPUT_RENAMES = (
    ("EU_Sustainable_Finance_Disclosure_Regulation_Minimum_Or_Planned_Investments_Sustainable_Investments_Taxonomy_Aligned",
     "EU_Sustainable_Finance_Disclosure_Regulation_Minimum_Or_Planned"),
    ("Minimum_Percentage_Investments_Aligned_EU_Taxonomy_Including_Sovereign_Bonds",
     "Minimum_Percentage_Investments_Aligned_EU_Taxonomy_Including_So"),
    ("PAI_Ungc_Principles_OECD_Guidelines_Violations_%_Portfolio_Involved",
     "PAI_Ungc_Principles_OECD_Guidelines_Violations_%_Portfolio_Invo"),
)

# Columns in front of the attributes in the published table, in order.
OUTPUT_HEAD = ("date", "reportName", "reportCurrency", "isin", "groupInvestment",
               "peersValue", "fundSize", "returnDateDaily", "netFlowYTD",
               "periodType", "periodStartDate", "periodEndDate", "return",
               PERCENTILE_METRIC, "sharpeRatio", "sortinoRatio", "maxDrawdown",
               "stdDev", "morningstarRating", "peersLib")

# Report-level columns of the pivot key, after the attributes.
PIVOT_TAIL = ("calculationDate", "exportDate", "reportName", "reportCurrency",
              "isin", "groupInvestment", "peersValue", "morningstarRating",
              "currency", "morningstarCategory", "fundSize", "returnDateDaily",
              "netFlowYTD", "periodType", "periodStartDate", "periodEndDate")
WINDOW_TAIL = ("reportCurrency", "isin", "groupInvestment", "peersValue",
               "morningstarRating", "currency", "morningstarCategory", "fundSize",
               "returnDateDaily", "netFlowYTD", "periodType", "periodStartDate",
               "periodEndDate", "sharpeRatio", "sortinoRatio", "stdDev", "maxDrawdown")


@dataclass(frozen=True)
class HouseNames:
    """Names that belong to one fund house; supply the real ones per deployment."""
    house_prefix: str = "House"                         # own funds: group LIKE '<prefix>%'
    special_fund: str = "House Global Market Neutral"   # share-level feed fund
    special_report: str = "7 - Lab Digital"             # report of the special fund rows
    exempt_report: str = "5 - DCP Digital"              # report without category averages
    clone_report: str = "3 - Latam Digital"             # report of one clone rule
    flag_col: str = "isHouseSC"                         # 1 when the isin is in the feed


@dataclass(frozen=True)
class CloneRule:
    group: str                 # exact group label after the final relabel
    report_prefix: str         # reportName LIKE '<prefix>%'
    new_peer: str
    new_group: str
    new_report: str | None = None
    skip_period: str | None = SINCE_PM   # rows with this period are not cloned


def default_clone_rules(names: HouseNames) -> tuple[CloneRule, ...]:
    return (
        CloneRule("CI Category Average", "1", "CHX", "CHX Category Average"),
        CloneRule("CI Category Average", "1", "CGC", "CGC Category Average"),
        CloneRule("CI Category Average", "1", "CFG", "CFG Category Average"),
        CloneRule("CFB Category Average", "1", "CCR", "CCR Category Average"),
        CloneRule("CCR Category Average", "3", "CFB", "CFB Category Average",
                  names.clone_report),
    )


@dataclass(frozen=True)
class ReportSchema:
    """Column lists of one report run (production: the full attribute list)."""
    attributes: tuple[str, ...] = ESG_ATTRIBUTES
    window_excluded: tuple[str, ...] = ESG_NOT_IN_WINDOW
    renames: tuple[tuple[str, str], ...] = OUTPUT_RENAMES
    metrics: tuple[str, ...] | None = None   # explicit pivot values; None = discover

    @property
    def pivot_keys(self) -> list[str]:
        return ["sourceFileName", *self.attributes, *PIVOT_TAIL]

    @property
    def window_keys(self) -> list[str]:
        attrs = [a for a in self.attributes if a not in self.window_excluded]
        return ["date", "reportName", *attrs, *WINDOW_TAIL]

    def output_columns(self, flag_col: str) -> list[str]:
        return [*OUTPUT_HEAD, flag_col, *self.attributes]


@dataclass(frozen=True)
class ReportConfig:
    names: HouseNames = field(default_factory=HouseNames)
    schema: ReportSchema = field(default_factory=ReportSchema)
    clone_rules: tuple[CloneRule, ...] | None = None

    def clones(self) -> tuple[CloneRule, ...]:
        return self.clone_rules if self.clone_rules is not None else default_clone_rules(self.names)
