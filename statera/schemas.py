"""Warehouse tables: column types, required columns, keys, references and load columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Table:
    """A warehouse table.

    ``columns`` maps a name to a Spark type or ``varchar(n)``; ``load_columns`` are those an
    incoming batch may set, ``conflict`` the key it is merged on.
    """

    columns: dict[str, str]
    required: Sequence[str] = ()
    conflict: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign_keys: Sequence[ForeignKey] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    generated: Sequence[str] = ()

    @property
    def load_columns(self) -> list[str]:
        return [name for name in self.columns if name not in self.generated]

    def struct(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(name, T.StringType() if length_of(kind) else _type(kind))
                for name, kind in self.columns.items()
            ]
        )


def length_of(kind: str) -> int | None:
    """The length limit of a ``varchar(n)``."""
    return int(kind[8:-1]) if kind.startswith("varchar(") else None


def _type(kind: str) -> T.DataType:
    return T.DataType.fromDDL(kind)


MONEY, PERCENT, AMOUNT = "decimal(18,2)", "decimal(8,2)", "decimal(12,2)"
RATIO, WIDE_RATIO, SCORE = "decimal(10,4)", "decimal(12,4)", "decimal(6,2)"
GROWTH = "decimal(10,2)"

TO_COMPANY = ForeignKey("symbol", "dim_company", "symbol")
TO_YEAR = ForeignKey("year_id", "dim_year", "year_id")

# Columns, types, keys and references of the warehouse.
# In load order: a table comes after those it refers to.
TABLES: dict[str, Table] = {
    "dim_sector": Table(
        columns={
            "sector_id": "int",
            "sector_name": "varchar(100)",
            "sector_code": "varchar(20)",
            "description": "string",
        },
        required=("sector_id", "sector_name", "sector_code"),
        conflict=("sector_code",),
        unique=(("sector_id",), ("sector_name",), ("sector_code",)),
        generated=("sector_id",),
    ),
    "dim_company": Table(
        columns={
            "symbol": "varchar(20)",
            "company_name": "varchar(255)",
            "sector": "varchar(100)",
            "sub_sector": "varchar(100)",
            "company_logo": "string",
            "website": "string",
            "nse_url": "string",
            "bse_url": "string",
            "face_value": AMOUNT,
            "book_value": AMOUNT,
            "about_company": "string",
            "roce": PERCENT,
            "roe": PERCENT,
        },
        required=("symbol", "company_name"),
        conflict=("symbol",),
        unique=(("symbol",),),
    ),
    "dim_year": Table(
        columns={
            "year_id": "int",
            "year_label": "varchar(20)",
            "fiscal_year": "int",
            "quarter": "varchar(4)",
            "is_ttm": "boolean",
            "is_half_year": "boolean",
            "sort_order": "int",
        },
        required=("year_id", "year_label", "is_ttm", "is_half_year", "sort_order"),
        # Ids are positions and differ between batches; the label is what a period is known by.
        conflict=("year_label",),
        unique=(("year_id",), ("year_label",)),
        defaults={"is_ttm": False, "is_half_year": False},
    ),
    "dim_health_label": Table(
        columns={
            "label_id": "int",
            "label_name": "varchar(20)",
            "min_score": SCORE,
            "max_score": SCORE,
            "color_hex": "varchar(7)",
        },
        required=("label_id", "label_name", "min_score", "max_score", "color_hex"),
        conflict=("label_name",),
        unique=(("label_id",), ("label_name",)),
    ),
    "fact_balance_sheet": Table(
        columns={
            "symbol": "varchar(20)",
            "year_id": "int",
            "equity_capital": MONEY,
            "reserves": MONEY,
            "borrowings": MONEY,
            "other_liabilities": MONEY,
            "total_liabilities": MONEY,
            "fixed_assets": MONEY,
            "cwip": MONEY,
            "investments": MONEY,
            "other_assets": MONEY,
            "total_assets": MONEY,
            "debt_to_equity": WIDE_RATIO,
            "equity_ratio": WIDE_RATIO,
            "book_value_per_share": WIDE_RATIO,
        },
        required=("symbol", "year_id"),
        conflict=("symbol", "year_id"),
        unique=(("symbol", "year_id"),),
        foreign_keys=(TO_COMPANY, TO_YEAR),
    ),
    "fact_profit_loss": Table(
        columns={
            "symbol": "varchar(20)",
            "year_id": "int",
            "sales": MONEY,
            "expenses": MONEY,
            "operating_profit": MONEY,
            "opm_pct": PERCENT,
            "other_income": MONEY,
            "interest": MONEY,
            "depreciation": MONEY,
            "profit_before_tax": MONEY,
            "tax_pct": PERCENT,
            "net_profit": MONEY,
            "eps": AMOUNT,
            "dividend_payout_pct": PERCENT,
            "net_profit_margin_pct": RATIO,
            "expense_ratio_pct": RATIO,
            "interest_coverage": WIDE_RATIO,
            "asset_turnover": WIDE_RATIO,
            "return_on_assets": RATIO,
        },
        required=("symbol", "year_id"),
        conflict=("symbol", "year_id"),
        unique=(("symbol", "year_id"),),
        foreign_keys=(TO_COMPANY, TO_YEAR),
    ),
    "fact_cash_flow": Table(
        columns={
            "symbol": "varchar(20)",
            "year_id": "int",
            "operating_activity": MONEY,
            "investing_activity": MONEY,
            "financing_activity": MONEY,
            "net_cash_flow": MONEY,
            "free_cash_flow": MONEY,
            "cash_conversion_ratio": WIDE_RATIO,
        },
        required=("symbol", "year_id"),
        conflict=("symbol", "year_id"),
        unique=(("symbol", "year_id"),),
        foreign_keys=(TO_COMPANY, TO_YEAR),
    ),
    "fact_analysis": Table(
        columns={
            "symbol": "varchar(20)",
            "period_label": "varchar(10)",
            "compounded_sales_growth_pct": GROWTH,
            "compounded_profit_growth_pct": GROWTH,
            "stock_price_cagr_pct": GROWTH,
            "roe_pct": GROWTH,
        },
        required=("symbol", "period_label"),
        conflict=("symbol", "period_label"),
        unique=(("symbol", "period_label"),),
        foreign_keys=(TO_COMPANY,),
    ),
    "fact_pros_cons": Table(
        columns={
            "symbol": "varchar(20)",
            "is_pro": "boolean",
            "category": "varchar(100)",
            "text": "string",
            "source": "varchar(20)",
            "confidence": SCORE,
            "generated_at": "timestamp",
        },
        required=("symbol", "is_pro", "text", "source"),
        conflict=("symbol", "is_pro", "text"),
        unique=(("symbol", "is_pro", "text"),),
        foreign_keys=(TO_COMPANY,),
        defaults={"source": "MANUAL"},
    ),
    "documents": Table(
        columns={"symbol": "varchar(20)", "year_label": "varchar(20)", "document_url": "string"},
        required=("symbol", "document_url"),
        conflict=("symbol", "year_label", "document_url"),
        unique=(("symbol", "year_label", "document_url"),),
        foreign_keys=(TO_COMPANY,),
    ),
    "fact_ml_scores": Table(
        columns={
            "symbol": "varchar(20)",
            "computed_at": "timestamp",
            "overall_score": SCORE,
            "profitability_score": SCORE,
            "growth_score": SCORE,
            "leverage_score": SCORE,
            "cashflow_score": SCORE,
            "dividend_score": SCORE,
            "trend_score": SCORE,
            "health_label_id": "int",
        },
        required=("symbol", "computed_at", "overall_score"),
        conflict=("symbol", "computed_at"),
        unique=(("symbol", "computed_at"),),
        foreign_keys=(TO_COMPANY, ForeignKey("health_label_id", "dim_health_label", "label_id")),
    ),
}
