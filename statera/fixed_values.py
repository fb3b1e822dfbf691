"""Values that results depend on."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

# Cells that mean "no value" in a raw file.
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "Null",
    "n/a",
    "nan",
    "null",
)

# Replaced ticker symbols.
SYMBOL_ALIASES = {"AGTL": "ATGL"}

# Sector and sub-sector by symbol; other symbols get DEFAULT_SECTOR.
DEFAULT_SECTOR = ("Other", "Other")
SECTORS = {
    "TCS": ("IT", "IT Services"),
    "INFY": ("IT", "IT Services"),
    "WIPRO": ("IT", "IT Services"),
    "HCLTECH": ("IT", "IT Services"),
    "TECHM": ("IT", "IT Services"),
    "HDFCBANK": ("Banking", "Private Bank"),
    "ICICIBANK": ("Banking", "Private Bank"),
    "SBIN": ("Banking", "PSU Bank"),
    "AXISBANK": ("Banking", "Private Bank"),
    "KOTAKBANK": ("Banking", "Private Bank"),
    "BANKBARODA": ("Banking", "PSU Bank"),
    "INDUSINDBK": ("Banking", "Private Bank"),
    "BAJFINANCE": ("NBFC", "Consumer Finance"),
    "BAJAJFINSV": ("NBFC", "Financial Services"),
    "SBILIFE": ("Insurance", "Life Insurance"),
    "HDFCLIFE": ("Insurance", "Life Insurance"),
    "ICICIPRULI": ("Insurance", "Life Insurance"),
    "RELIANCE": ("Energy", "Integrated Energy"),
    "ONGC": ("Energy", "Oil & Gas"),
    "BPCL": ("Energy", "Oil Marketing"),
    "IOC": ("Energy", "Oil Marketing"),
    "ADANIGREEN": ("Power", "Renewable Power"),
    "ADANIPOWER": ("Power", "Thermal Power"),
    "ATGL": ("Energy", "Gas Distribution"),
    "NTPC": ("Power", "Power Generation"),
    "POWERGRID": ("Power", "Transmission"),
    "COALINDIA": ("Energy", "Mining"),
    "BHARTIARTL": ("Telecom", "Telecom Services"),
    "ASIANPAINT": ("Paint", "Decorative Paints"),
    "BERGEPAINT": ("Paint", "Decorative Paints"),
    "ULTRACEMCO": ("Cement", "Cement"),
    "AMBUJACEM": ("Cement", "Cement"),
    "SHREECEM": ("Cement", "Cement"),
    "SUNPHARMA": ("Healthcare", "Pharma"),
    "CIPLA": ("Healthcare", "Pharma"),
    "DRREDDY": ("Healthcare", "Pharma"),
    "DIVISLAB": ("Healthcare", "Pharma"),
    "APOLLOHOSP": ("Healthcare", "Hospitals"),
    "TITAN": ("Consumer Goods", "Lifestyle"),
    "NESTLEIND": ("Consumer Goods", "FMCG"),
    "HINDUNILVR": ("Consumer Goods", "FMCG"),
    "ITC": ("Consumer Goods", "FMCG"),
    "DABUR": ("Consumer Goods", "FMCG"),
    "BRITANNIA": ("Consumer Goods", "FMCG"),
    "MARUTI": ("Auto", "Passenger Vehicles"),
    "M&M": ("Auto", "Diversified Auto"),
    "TATAMOTORS": ("Auto", "Auto OEM"),
    "BAJAJ-AUTO": ("Auto", "Two Wheelers"),
    "HEROMOTOCO": ("Auto", "Two Wheelers"),
    "EICHERMOT": ("Auto", "Two Wheelers"),
    "LT": ("Infrastructure", "Engineering"),
    "ADANIPORTS": ("Ports", "Ports & Logistics"),
    "PIDILITIND": ("Consumer Goods", "Specialty Chemicals"),
}

# Quarter and place within the fiscal year by month of the label.
MONTH_QUARTER = {"Mar": "Q4", "Jun": "Q1", "Sep": "Q2", "Dec": "Q3"}
MONTH_ORDER = {"Jun": 1, "Sep": 2, "Dec": 3, "Mar": 4}
OTHER_MONTH_ORDER = 9
TTM_SORT_ORDER = 999999

# Health bands as (name, lower bound, upper bound, colour).
HEALTH_BANDS = (
    ("POOR", 0, 20, "#B91C1C"),
    ("WEAK", 20, 40, "#EA580C"),
    ("AVERAGE", 40, 60, "#CA8A04"),
    ("GOOD", 60, 80, "#15803D"),
    ("EXCELLENT", 80, 100, "#166534"),
)

# Patterns of numbers, remarks and period labels.
SIGNED = r"([-+]?\d+(?:\.\d+)?)"
BUCKET_YEARS = r"(?i)(10|5|3)\s*years?"
SLUG_BREAK = "[^A-Z0-9]+"
LINE_BREAK = r"[\r\n]+"
ITEM_BREAK = r"\r?\n|;|[|]"
MONTH_YEAR = r"^[A-Za-z]{3}[-\s]?\d{2,4}"
BARE_YEAR = r"^\d{4}(\.5)?$"

# Accepted headers of raw columns.
SYMBOL_NAMES = ("company_id", "symbol", "ticker")
COMPANY_HEADERS = {
    "symbol": ["company_id", "symbol", "ticker", "id"],
    "company_name": ["company_name", "name"],
    "company_logo": ["company_logo", "logo", "company_logo_url"],
    "nse_url": ["nse_url", "nse_profile", "nse_link"],
    "bse_url": ["bse_url", "bse_profile", "bse_link"],
    "about_company": ["about_company", "about"],
    "roce": ["roce", "roce_pct", "roce_percentage"],
    "roe": ["roe", "roe_pct", "roe_percentage"],
}
BALANCE_SHEET_HEADERS = {
    "symbol": SYMBOL_NAMES,
    "other_assets": ["other_assets", "other_asset"],
}
PROFIT_LOSS_HEADERS = {
    "symbol": SYMBOL_NAMES,
    "opm_pct": ["opm_pct", "opm_percentage"],
    "tax_pct": ["tax_pct", "tax_percentage"],
    "dividend_payout_pct": ["dividend_payout_pct", "dividend_payout"],
}
DOCUMENT_HEADERS = {
    "symbol": SYMBOL_NAMES,
    "document_url": ["document_url", "annual_report_url", "annual_report", "url"],
}

# Scores as (metric, is higher better).
SCORES = {
    "profitability_score": ("net_profit_margin_pct", True),
    "growth_score": ("asset_turnover", True),
    "leverage_score": ("debt_to_equity", False),
    "cashflow_score": ("free_cash_flow", True),
    "dividend_score": ("dividend_payout_pct", True),
    "trend_score": ("return_on_assets", True),
}


class Listing(NamedTuple):
    """What a list may be filtered and ordered by."""

    filters: Sequence[str]
    orderings: Sequence[str]
    default: Sequence[str]
    unique: Sequence[str]


# Fields, filters and orderings of the served lists.
COMPANY_FIELDS = (
    "symbol",
    "company_name",
    "sector",
    "sub_sector",
    "website",
    "company_logo",
    "face_value",
    "book_value",
    "roce",
    "roe",
)
SEARCH_FIELDS = ("symbol", "company_name", "sector", "sub_sector")
COMPANIES = Listing(
    (), ("symbol", "company_name", "sector", "roce", "roe", "book_value"), ("symbol",), ("symbol",)
)
BY_PERIOD = ("symbol", "sort_order")
PROFIT_LOSS = Listing(
    ("symbol", "year_id"),
    ("sort_order", "sales", "net_profit", "eps", "net_profit_margin_pct"),
    BY_PERIOD,
    ("symbol", "year_id"),
)
BALANCE_SHEET = Listing(
    ("symbol", "year_id"),
    ("sort_order", "total_assets", "borrowings", "debt_to_equity"),
    BY_PERIOD,
    ("symbol", "year_id"),
)
CASH_FLOW = Listing(
    ("symbol", "year_id"),
    ("sort_order", "operating_activity", "free_cash_flow", "cash_conversion_ratio"),
    BY_PERIOD,
    ("symbol", "year_id"),
)
ANALYSIS = Listing(
    ("symbol", "period_label"),
    ("period_label", "compounded_sales_growth_pct", "compounded_profit_growth_pct"),
    ("symbol", "period_label"),
    ("symbol", "period_label"),
)
SCORE_LIST = Listing(
    ("symbol", "health_label_id"),
    ("computed_at", "overall_score", "profitability_score", "growth_score"),
    ("-computed_at",),
    ("symbol", "computed_at"),
)

# Other names under which a request may filter.
FILTER_NAMES = {"year": "year_id", "health_label": "health_label_id"}

DOCUMENT_FIELDS = ("year_label", "document_url")
REMARK_FIELDS = ("is_pro", "category", "text", "source", "confidence", "generated_at")
