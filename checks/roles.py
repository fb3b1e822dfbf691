"""The given tables in the roles of a financial warehouse.

Companies are customers, sectors market segments, sub-sectors nations. Balance sheets are orders
by customer and month, profit-and-loss statements are line items by customer and order month, cash
flows line items by customer and ship month. All raw tables are text, as files would deliver them.
Money is added up in whole cents, so totals do not depend on the order of rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statera.plans import conform
from statera.session import run_dir, stored
from statera.sources import ORDINAL


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def cents(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def symbol_text(key: str) -> Column:
    """An identifier as a careless source writes it."""
    return F.concat(F.lit(" c"), F.col(key).cast("string"), F.lit(" "))


def month_of(date: str) -> Column:
    return F.trunc(F.to_date(date), "MM")


def period_text(date: str) -> Column:
    """A month's label; March as the bare year and September as a half year.

    Applied to months after they are grouped, since formatting a date costs more than grouping it.
    """
    month = F.month(date)
    year = F.year(date).cast("string")
    return (
        F.when(month == 3, year)
        .when(month == 9, F.concat(year, F.lit(".5")))
        .otherwise(F.date_format(date, "MMM yyyy"))
    )


def money_text(total: Column, places: int) -> Column:
    """Text with thousands commas from a whole number of units of 10 to the -places."""
    return F.format_number(total / 10**places, places)


def reading_place() -> Column:
    """Where a statement's row stands in its file: files are in order of company and month."""
    months = F.year("month") * 12 + F.month("month")
    return (F.col("o_custkey") * 100_000 + months).alias(ORDINAL)


def raw_companies(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        symbol_text("c_custkey").alias("id"),
        F.concat(F.lit("  "), "c_name", F.lit("\r\n"), "c_mktsegment").alias("company_name"),
        F.concat((F.col("c_custkey") % 3).cast("string"), F.lit(".00")).alias("face_value"),
        money_text(cents("c_acctbal"), 2).alias("book_value"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("%")).alias("roce_percentage"),
    )


def sectors(spark: SparkSession, sf: str) -> DataFrame:
    """Sectors of the companies outside the last region; the others are not listed."""
    nations = table(spark, sf, "nation").filter(F.col("n_regionkey") < 4)
    return (
        table(spark, sf, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("symbol"),
            F.col("c_mktsegment").alias("sector"),
            F.col("n_name").alias("sub_sector"),
        )
    )


def companies(spark: SparkSession, sf: str) -> DataFrame:
    return conform.normalize_companies(raw_companies(spark, sf), sectors(spark, sf))[0]


def raw_balance_sheet(spark: SparkSession, sf: str) -> DataFrame:
    p = cents("o_totalprice")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return (
        table(spark, sf, "orders")
        .groupBy("o_custkey", month_of("o_orderdate").alias("month"))
        .agg(
            F.sum(F.when(status == "O", p)).alias("equity_capital"),
            F.sum(F.when(status == "P", p).when(status == "F", -p)).alias("reserves"),
            F.sum(F.when(priority.isin("1-URGENT", "2-HIGH"), p)).alias("borrowings"),
            F.sum(F.when(priority == "5-LOW", p)).alias("other_asset"),
            F.sum(p).alias("total_assets"),
        )
        .select(
            symbol_text("o_custkey").alias("company_id"),
            period_text("month").alias("year"),
            reading_place(),
            *[
                money_text(F.col(name), 2).alias(name)
                for name in (
                    "equity_capital",
                    "reserves",
                    "borrowings",
                    "other_asset",
                    "total_assets",
                )
            ],
        )
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their company and the months of order and shipment."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        month_of("l_shipdate").alias("ship_month"),
        "l_returnflag",
        cents("l_extendedprice").alias("p"),
        cents("l_discount").alias("d"),
        cents("l_tax").alias("t"),
    )
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", month_of("o_orderdate").alias("order_month")
    )
    # A few bytes per order, each key once: looked up in a table per task, the lines go unsorted.
    joined = lines.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.drop("l_orderkey", "o_orderkey")


def raw_profit_loss(
    spark: SparkSession, sf: str, lines: DataFrame | None = None
) -> DataFrame:
    """Profit and loss by company and month of order; ``lines`` are stored ``order_lines``."""
    p, d, t, flag = F.col("p"), F.col("d"), F.col("t"), F.col("l_returnflag")
    lines = lines if lines is not None else order_lines(spark, sf)
    sums = (
        lines.groupBy("o_custkey", F.col("order_month").alias("month"))
        .agg(
            F.sum(F.when(flag == "R", 0).otherwise(p) * 100).alias("sales"),
            F.sum(p * (t + 60)).alias("expenses"),
            F.sum(p * d).alias("interest"),
            F.sum(d).alias("payout"),
            F.count("*").alias("lines"),
        )
    )
    operating = F.col("sales") - F.col("expenses")
    return sums.select(
        symbol_text("o_custkey").alias("company_id"),
        period_text("month").alias("year"),
        reading_place(),
        money_text(F.col("sales"), 4).alias("sales"),
        money_text(F.col("expenses"), 4).alias("expenses"),
        money_text(operating, 4).alias("operating_profit"),
        F.concat(F.col("lines").cast("string"), F.lit("%")).alias("opm_percentage"),
        money_text(F.col("interest"), 4).alias("interest"),
        money_text(operating - F.col("interest"), 4).alias("net_profit"),
        F.col("lines").cast("string").alias("eps"),
        F.concat(F.col("payout").cast("string"), F.lit(" %")).alias("dividend_payout"),
    )


def raw_cash_flow(
    spark: SparkSession, sf: str, sums_by_task: bool = True, lines: DataFrame | None = None
) -> DataFrame:
    """Cash flows by company and month of shipment.

    A company has hardly two lines a month, so sums per map task save no row of the whole table and
    their hash table fills the task; without ``sums_by_task`` lines are summed after the shuffle
    only. Whoever asks for a few columns, months or companies say, is better off with them.
    ``lines`` are stored ``order_lines``.
    """
    p, d, t, flag = F.col("p"), F.col("d"), F.col("t"), F.col("l_returnflag")
    lines = lines if lines is not None else order_lines(spark, sf)
    lines = lines.drop("order_month").withColumnRenamed("ship_month", "month")
    if not sums_by_task:
        lines = lines.repartition("o_custkey", "month")
    sums = (
        lines.groupBy("o_custkey", "month")
        .agg(
            F.sum(F.when(flag != "R", p)).alias("operating"),
            F.sum(F.when(flag == "A", -p * t)).alias("investing"),
            F.sum(p * d).alias("financing"),
        )
    )
    return sums.select(
        symbol_text("o_custkey").alias("company_id"),
        period_text("month").alias("year"),
        reading_place(),
        money_text(F.col("operating"), 2).alias("operating_activity"),
        money_text(F.col("investing"), 4).alias("investing_activity"),
        money_text(F.col("financing"), 4).alias("financing_activity"),
    )


def labels(spark: SparkSession, sf: str) -> DataFrame:
    """Raw period labels; the months alone are read, not the statements built on them.

    A month's place is its least key. It also keeps the months distinct before they are formatted:
    Spark drops a distinct below an aggregate that does not mind repeats.
    """
    frames = []
    for name, date, key in (
        ("orders", "o_orderdate", "o_orderkey"),
        ("lineitem", "l_shipdate", "l_orderkey"),
    ):
        months = table(spark, sf, name).groupBy(month_of(date).alias("month"))
        months = months.agg(F.min(key).cast("bigint").alias(ORDINAL))
        frames.append(months.select(period_text("month").alias("year"), ORDINAL))
    return conform.parsed_labels(frames)


class Warehouse:
    """Clean dimensions and facts of the given tables; a fact is made when it is first asked for.

    ``keep`` stores the facts, for queries that read several of them. Without it they are plans, so
    that a query for one company or period reads what it needs.
    """

    def __init__(self, spark: SparkSession, sf: str, keep: bool = False):
        self.spark, self.sf, self.keep = spark, sf, keep
        # One small table that every fact is joined with.
        self.periods = stored(conform.numbered_labels(labels(spark, sf)), "labels")
        self.years = conform.year_dimension_of(self.periods)
        self.companies = companies(spark, sf)

    @cached_property
    def lines(self) -> DataFrame | None:
        """Two statements are made of the order lines: where facts are stored, so are these."""
        return stored(order_lines(self.spark, self.sf), "lines") if self.keep else None

    def _fact(self, df: DataFrame) -> DataFrame:
        df = df.drop(ORDINAL)
        return stored(df) if self.keep else df

    @cached_property
    def balance_sheet(self) -> DataFrame:
        raw = raw_balance_sheet(self.spark, self.sf)
        return self._fact(
            conform.normalize_balance_sheet(raw, self.years, self.companies, self.periods)
        )

    @cached_property
    def profit_loss(self) -> DataFrame:
        raw = raw_profit_loss(self.spark, self.sf, self.lines)
        return self._fact(
            conform.normalize_profit_loss(raw, self.years, self.balance_sheet, self.periods)
        )

    @cached_property
    def cash_flow(self) -> DataFrame:
        raw = raw_cash_flow(self.spark, self.sf, sums_by_task=False, lines=self.lines)
        return self._fact(
            conform.normalize_cash_flow(raw, self.years, self.profit_loss, self.periods)
        )


_houses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, sf: str) -> Warehouse:
    """The clean warehouse of a folder, built once for as long as the session keeps its tables."""
    own = (run_dir(spark), sf)
    if own not in _houses:
        _houses[own] = Warehouse(spark, sf, keep=True)
    return _houses[own]


def raw_analysis(spark: SparkSession, sf: str, ordinal: bool = False) -> DataFrame:
    """Growth remarks of several shapes, by order; in order of the keys, if asked for."""
    key = F.col("o_orderkey")
    number = (key % 40 - 10).cast("string")

    def remark(kinds: list[str]) -> Column:
        text = F.when(F.lit(False), F.lit(""))
        for kind, words in enumerate(kinds):
            text = text.when(
                key % len(kinds) == kind, F.concat(F.lit(words), number, F.lit("%  "))
            )
        return text

    return table(spark, sf, "orders").select(
        symbol_text("o_custkey").alias("company_id"),
        remark(["10 Years:   ", "5 Years ", "ttm: ", "1 Year: ", "3 years:"]).alias(
            "compounded_sales_growth"
        ),
        remark(["10 Years: ", "Last Year: "]).alias("compounded_profit_growth"),
        F.when(key % 3 > 0, remark(["TTM "])).alias("stock_price_cagr"),
        F.lit("n.a.").alias("roe"),
        *([F.col("o_orderkey").alias(ORDINAL)] if ordinal else []),
    )


def mixed_period(key: str, date: str) -> Column:
    """Period labels of every shape the parser knows, by a key."""
    kind = F.col(key) % 11
    return (
        F.when(kind == 0, F.date_format(date, "MMM-yy"))
        .when(kind == 1, F.concat(F.lit("Sep "), F.year(date), F.lit(" half")))
        .when(kind == 2, F.year(date).cast("string"))
        .when(kind == 3, F.concat(F.year(date), F.lit(".5")))
        .when(kind == 4, F.lit(" ttm "))
        .when(kind == 5, F.concat(F.lit("FY"), F.year(date)))
        .when(kind == 6, F.lit("  "))
        .when(kind == 7, F.lower(F.date_format(date, "MMMyyyy")))
        .when(kind == 8, F.concat(F.lit("Sep "), F.year(date)))
        .when(kind == 9, F.date_format(date, "MMM yyyy"))
    )
