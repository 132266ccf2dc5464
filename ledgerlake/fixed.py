"""Fixed values.

These values must equal the ones the original filings job uses for the
results to agree: the reporting-tag dictionary, the metric lists, the word
lists of the transcript measures, the price-change classes, the URL format
and the calendar range.  They are written out as data, in their natural
order; nothing here is computed.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: canonical metric -> reporting tags that roll up into it.
# ---------------------------------------------------------------------------
TAG_HIERARCHY: dict[str, list[str]] = {
    "Assets": [
        "Assets",
        "AssetsCurrent",
        "AssetsNoncurrent",
        "AssetsHeldForSale",
    ],
    "CashAndCashEquivalents": [
        "CashAndCashEquivalentsAtCarryingValue",
        "CashCashEquivalentsRestrictedCashAndRestrictedCashEquivalents",
        "CashAndCashEquivalents",
    ],
    "EarningsPerShareBasic": [
        "EarningsPerShareBasic",
        "BasicEarningsLossPerShare",
    ],
    "GrossProfit": [
        "GrossProfit",
        "GrossProfitLoss",
    ],
    "Liabilities": [
        "Liabilities",
        "LiabilitiesCurrent",
        "LiabilitiesNoncurrent",
        "LiabilitiesHeldForSale",
    ],
    "NetIncomeLoss": [
        "NetIncomeLoss",
        "ProfitLoss",
        "NetIncomeLossAvailableToCommonStockholdersBasic",
    ],
    "OperatingCashFlow": [
        "NetCashProvidedByUsedInOperatingActivities",
        "NetCashProvidedByUsedInOperatingActivitiesIndirect",
        "NetCashProvidedByUsedInOperatingActivitiesContinuing",
    ],
    "Revenues": [
        "Revenues",
        "SalesRevenueNet",
        "SalesRevenueServicesNet",
        "SalesRevenueGoodsNet",
        "RevenueFromContractWithCustomerExcludingAssessedTax",
    ],
    "SharesOutstanding": [
        "SharesOutstanding",
        "CommonStockSharesOutstanding",
    ],
    "StockholdersEquity": [
        "StockholdersEquity",
        "StockholdersEquityIncludingPortionAttributableToNoncontrollingInterest",
        "StockholdersEquityIncludingPortionAttributableToParent",
    ],
    "EBITDA": [
        "EarningsBeforeInterestTaxesDepreciationAndAmortization",
        "EBITDA",
        "OperatingIncomeLossBeforeDepreciationAndAmortization",
        "OperatingIncomeLossBeforeDepreciationAmortizationAndImpairment",
        "OperatingProfitLossBeforeDepreciationAndAmortization",
    ],
}

# FIXED VALUES: metrics whose nulls are counted by the sparse-row filter
# (EBITDA is pivoted but not counted) and the threshold: keep when nulls < 4.
COUNTED_METRICS: list[str] = [
    "Assets",
    "CashAndCashEquivalents",
    "EarningsPerShareBasic",
    "GrossProfit",
    "Liabilities",
    "NetIncomeLoss",
    "OperatingCashFlow",
    "Revenues",
    "SharesOutstanding",
    "StockholdersEquity",
]
MAX_NULLS_EXCLUSIVE = 4

# FIXED VALUES: flow metrics turned from year-to-date into quarter values.
FLOW_METRICS: list[str] = ["GrossProfit", "NetIncomeLoss", "OperatingCashFlow", "Revenues"]

# FIXED VALUES: period codes of the year-to-date rule.
CUMULATIVE_PERIODS: list[str] = ["Q2", "Q3", "FY"]  # the current row reports one of these
PRIOR_PERIODS: list[str] = ["Q1", "Q2", "Q3"]  # and the next row one of these
FULL_YEAR = "FY"
FOURTH_QUARTER = "Q4"
MISSING_PERIOD = "NotAvailable"

# FIXED VALUES: transcript word lists.
POSITIVE_WORDS: list[str] = ["growth", "profit", "strong", "increase", "record", "improvement", "innovation"]
NEGATIVE_WORDS: list[str] = ["decline", "loss", "weak", "decrease", "problem", "challenge", "risk"]

# FIXED VALUES: price-change classes (percent bounds, inclusive side as stated).
#   pct < -5          -> 1   large negative
#   -5 <= pct < -2    -> 2   medium negative
#   -2 <= pct < 0     -> 3   small negative
#   pct == 0          -> 4   no change
#   0 < pct <= 2      -> 5   small positive
#   2 < pct <= 5      -> 6   medium positive
#   pct > 5           -> 7   large positive
CLASS_LARGE = 5.0
CLASS_MEDIUM = 2.0
ALLOWED_CLASSES: list[int] = [0, 1, 2, 3, 4, 5, 6, 7]
PRICE_WINDOW_MONTHS = 3

# FIXED VALUES: output column order of the fact table before the transcript join.
FACT_COLUMNS: list[str] = [
    "accessionNumber", "ticker", "reportDate", "filingDate", "endDate", "form",
    "financialPeriod", "stockPriceChange",
    "Assets", "CashAndCashEquivalents", "EarningsPerShareBasic",
    "GrossProfit", "Liabilities", "NetIncomeLoss", "OperatingCashFlow",
    "Revenues", "SharesOutstanding", "StockholdersEquity", "fileURL",
]
TRANSCRIPT_MEASURES: list[str] = [
    "TransLength", "TotalTokens", "PositiveWordCount", "NegativeWordCount", "SentimentScore",
]

# FIXED VALUES: data-quality rules.
REQUIRED_COLUMNS: list[str] = ["ticker", "reportDate", "filingDate", "financialPeriod", "stockPriceChange"]
DUPLICATE_KEY: list[str] = ["ticker", "financialPeriod", "reportDate"]
VALIDATION_KEYS: list[str] = ["ticker", "reportDate", "filingDate", "accessionNumber"]
VALIDATION_FLAGS: list[str] = [
    "stockPriceChange", "Assets", "CashAndCashEquivalents",
    "EarningsPerShareBasic", "GrossProfit", "Liabilities",
    "NetIncomeLoss", "OperatingCashFlow", "Revenues",
    "SharesOutstanding", "StockholdersEquity",
]

# FIXED VALUES: company-description keys kept for the company dimension.
COMPANY_KEYS: list[str] = [
    "cik", "entityType", "sicDescription", "ownerOrg", "name", "tickers", "exchanges",
    "description", "website", "investorWebsite", "category", "fiscalYearEnd",
    "stateOfIncorporation",
]

# FIXED VALUES: filing document URL prefix, CIK width, calendar range.
FILING_URL_BASE = "https://www.sec.gov/Archives/edgar/data/"
CIK_WIDTH = 10
CALENDAR_START = "2010-01-01"
CALENDAR_END = "2030-12-31"
