"""The SQL that each query is checked against.

Written from the tables alone: none of it goes through the text forms that the queries parse.
"""

from __future__ import annotations

SPACES = "' ' || chr(9) || chr(10) || chr(13)"


def fiscal_place(date: str) -> str:
    """Sort order of a month's label."""
    return (
        f"year({date}) * 10 + CASE month({date}) WHEN 6 THEN 1 WHEN 9 THEN 2 "
        f"WHEN 12 THEN 3 WHEN 3 THEN 4 ELSE 9 END"
    )


def quarter(date: str) -> str:
    return (
        f"CASE month({date}) WHEN 3 THEN 'Q4' WHEN 6 THEN 'Q1' WHEN 9 THEN 'Q2' "
        f"WHEN 12 THEN 'Q3' END"
    )


def cents(name: str) -> str:
    return f"CAST(round({name} * 100) AS BIGINT)"


def ratio(numerator: str, denominator: str, scale: str = "", guard: str = "> 0") -> str:
    return f"CASE WHEN {denominator} {guard} THEN {numerator} / {denominator}{scale} END"


def r4(expression: str) -> str:
    return f"round_even(({expression}) * 10000, 0) / 10000"


def r2(expression: str) -> str:
    return f"round_even(({expression}) * 100, 0) / 100"


YEARS = f"""
months AS (
    SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem
),
labels AS (
    SELECT DISTINCT strftime(d, '%b %Y') AS year_label, year(d) AS fiscal_year,
        {quarter('d')} AS quarter, {fiscal_place('d')} AS sort_order
    FROM months
),
years AS (
    SELECT row_number() OVER (ORDER BY sort_order, year_label) AS year_id, year_label,
        fiscal_year, quarter, sort_order
    FROM labels
)"""

COMPANIES = """
company AS (
    SELECT 'C' || c_custkey AS symbol, c_custkey, c_name || ' ' || c_mktsegment AS company_name,
        CASE WHEN n_regionkey < 4 THEN c_mktsegment ELSE 'Other' END AS sector,
        CASE WHEN n_regionkey < 4 THEN n_name ELSE 'Other' END AS sub_sector,
        CAST(c_custkey % 3 AS DOUBLE) AS face_value,
        c_acctbal AS book_value, CAST(c_nationkey AS DOUBLE) AS roce
    FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

FACTS = f"""
bs_sums AS (
    SELECT o_custkey, strftime(o_orderdate, '%b %Y') AS year_label,
        sum({cents('o_totalprice')}) FILTER (o_orderstatus = 'O') / 100.0 AS equity_capital,
        sum(CASE o_orderstatus WHEN 'P' THEN {cents('o_totalprice')}
            WHEN 'F' THEN -{cents('o_totalprice')} END) / 100.0 AS reserves,
        sum({cents('o_totalprice')}) FILTER (o_orderpriority IN ('1-URGENT', '2-HIGH'))
            / 100.0 AS borrowings,
        sum({cents('o_totalprice')}) FILTER (o_orderpriority = '5-LOW') / 100.0 AS other_assets,
        sum({cents('o_totalprice')}) / 100.0 AS total_assets
    FROM orders GROUP BY ALL
),
bs_worth AS (
    SELECT 'C' || o_custkey AS symbol, y.year_id, y.year_label, y.sort_order,
        CAST(equity_capital AS DOUBLE) AS equity_capital, CAST(reserves AS DOUBLE) AS reserves,
        CAST(borrowings AS DOUBLE) AS borrowings, CAST(other_assets AS DOUBLE) AS other_assets,
        CAST(total_assets AS DOUBLE) AS total_assets,
        CAST(coalesce(equity_capital, 0) AS DOUBLE) + CAST(coalesce(reserves, 0) AS DOUBLE)
            AS net_worth,
        CASE WHEN o_custkey % 3 > 0 THEN CAST(equity_capital AS DOUBLE) / (o_custkey % 3) END
            AS shares
    FROM bs_sums JOIN years y USING (year_label)
),
bs AS (
    SELECT symbol, year_id, year_label, sort_order, equity_capital, reserves, borrowings,
        other_assets, total_assets,
        {ratio('borrowings', 'net_worth')} AS debt_to_equity,
        {ratio('net_worth', 'total_assets')} AS equity_ratio,
        {ratio('net_worth', 'shares')} AS book_value_per_share
    FROM bs_worth
),
lines AS (
    SELECT o_custkey, o_orderdate, l_shipdate, l_returnflag, {cents('l_extendedprice')} AS p,
        {cents('l_discount')} AS d, {cents('l_tax')} AS t
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
pl_sums AS (
    SELECT o_custkey, strftime(o_orderdate, '%b %Y') AS year_label,
        sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE p * 100 END) AS s,
        sum(p * (t + 60)) AS e, sum(p * d) AS i, sum(d) AS payout, count(*) AS n
    FROM lines GROUP BY ALL
),
pl_values AS (
    SELECT 'C' || o_custkey AS symbol, y.year_id, y.year_label, y.sort_order,
        CAST(s AS DOUBLE) / 10000 AS sales, CAST(e AS DOUBLE) / 10000 AS expenses,
        CAST(s - e AS DOUBLE) / 10000 AS operating_profit, CAST(n AS DOUBLE) AS opm_pct,
        CAST(i AS DOUBLE) / 10000 AS interest, CAST(s - e - i AS DOUBLE) / 10000 AS net_profit,
        CAST(n AS DOUBLE) AS eps, CAST(payout AS DOUBLE) AS dividend_payout_pct
    FROM pl_sums JOIN years y USING (year_label)
),
pl AS (
    SELECT v.*,
        {ratio('net_profit', 'sales', ' * 100')} AS net_profit_margin_pct,
        {ratio('expenses', 'sales', ' * 100')} AS expense_ratio_pct,
        {ratio('operating_profit', 'interest')} AS interest_coverage,
        {ratio('sales', 'b.total_assets')} AS asset_turnover,
        {ratio('net_profit', 'b.total_assets', ' * 100')} AS return_on_assets
    FROM pl_values v LEFT JOIN bs b ON v.symbol = b.symbol AND v.year_id = b.year_id
),
cf_sums AS (
    SELECT o_custkey, strftime(l_shipdate, '%b %Y') AS year_label,
        CAST(sum(p) FILTER (l_returnflag <> 'R') AS DOUBLE) / 100 AS operating_activity,
        CAST(sum(-p * t) FILTER (l_returnflag = 'A') AS DOUBLE) / 10000 AS investing_activity,
        CAST(sum(p * d) AS DOUBLE) / 10000 AS financing_activity
    FROM lines GROUP BY ALL
),
cf AS (
    SELECT 'C' || o_custkey AS symbol, y.year_id, y.year_label, y.sort_order,
        operating_activity, investing_activity, financing_activity,
        coalesce(operating_activity, 0) + coalesce(investing_activity, 0) AS free_cash_flow,
        {ratio('operating_activity', 'v.net_profit', guard='<> 0')} AS cash_conversion_ratio
    FROM cf_sums JOIN years y USING (year_label)
    LEFT JOIN pl_values v ON v.symbol = 'C' || o_custkey AND v.year_id = y.year_id
)"""

WAREHOUSE = f"WITH {YEARS.strip()}, {COMPANIES.strip()}, {FACTS.strip()}"

WIDE = """
wide AS (
    SELECT c.symbol, c.company_name, c.sector, c.sub_sector, y.year_id, y.year_label,
        y.fiscal_year, y.quarter, CASE WHEN y.year_id IS NOT NULL THEN FALSE END AS is_ttm,
        p.sales, p.net_profit, p.net_profit_margin_pct, p.opm_pct, p.eps,
        p.dividend_payout_pct, p.interest_coverage, b.total_assets, b.borrowings,
        b.debt_to_equity, b.equity_ratio, f.operating_activity, f.investing_activity,
        f.free_cash_flow, f.cash_conversion_ratio
    FROM company c
    LEFT JOIN pl p ON c.symbol = p.symbol
    LEFT JOIN years y ON p.year_id = y.year_id
    LEFT JOIN bs b ON p.symbol = b.symbol AND p.year_id = b.year_id
    LEFT JOIN cf f ON p.symbol = f.symbol AND p.year_id = f.year_id
),
newest AS (
    SELECT *, coalesce(year_id, 0) AS sort_year,
        row_number() OVER (PARTITION BY symbol ORDER BY coalesce(year_id, 0) DESC) AS rn
    FROM wide QUALIFY rn = 1
)"""

WIDE_COLUMNS = f"""symbol, company_name, sector, sub_sector, year_id, year_label, fiscal_year,
    quarter, is_ttm, sales, net_profit, {r4('net_profit_margin_pct')} AS net_profit_margin_pct,
    opm_pct, eps, dividend_payout_pct, {r4('interest_coverage')} AS interest_coverage,
    total_assets, borrowings, {r4('debt_to_equity')} AS debt_to_equity,
    {r4('equity_ratio')} AS equity_ratio, operating_activity, investing_activity,
    {r4('free_cash_flow')} AS free_cash_flow,
    {r4('cash_conversion_ratio')} AS cash_conversion_ratio"""


def measures(by: str) -> str:
    keys = f"{by}," if by else ""
    group = f"GROUP BY {by}" if by else ""
    columns = [c.strip() for c in by.split(",") if c.strip()]
    same = " AND ".join(f"t.{c} IS NOT DISTINCT FROM n.{c}" for c in columns) or "TRUE"
    return f"""{WAREHOUSE}, {WIDE.strip()},
total AS (
    SELECT {keys} CAST(sum(CAST(sales AS DECIMAL(24, 4))) AS DOUBLE) AS total_sales,
        CAST(sum(CAST(net_profit AS DECIMAL(24, 4))) AS DOUBLE) AS total_net_profit,
        {r4('avg(net_profit_margin_pct)')} AS average_margin_pct,
        {r4('avg(debt_to_equity)')} AS average_debt_to_equity,
        CAST(sum(CAST(free_cash_flow AS DECIMAL(24, 4))) AS DOUBLE) AS free_cash_flow
    FROM wide {group}
),
top AS (SELECT {keys} max(eps) AS latest_eps FROM newest {group})
SELECT t.*, n.latest_eps FROM total t LEFT JOIN top n ON {same}"""


def bounded(metric: str, inverted: bool = False) -> str:
    """A score over all rows of the input."""
    low = f"quantile_cont({metric}, 0.05) OVER ()"
    high = f"quantile_cont({metric}, 0.95) OVER ()"
    scaled = f"(least(greatest({metric}, {low}), {high}) - {low}) / ({high} - {low}) * 100"
    if inverted:
        scaled = f"100 - {scaled}"
    return f"""CASE WHEN count({metric}) OVER () = 0 THEN NULL
        WHEN {low} = {high} THEN 50.0 WHEN {metric} IS NULL THEN NULL ELSE {scaled} END"""


def label_ladder(score: str) -> str:
    return f"""CASE WHEN {score} IS NULL THEN NULL WHEN {score} >= 80 THEN 'EXCELLENT'
        WHEN {score} >= 60 THEN 'GOOD' WHEN {score} >= 40 THEN 'AVERAGE'
        WHEN {score} >= 20 THEN 'WEAK' ELSE 'POOR' END"""


SCORES = (
    "profitability_score",
    "growth_score",
    "leverage_score",
    "cashflow_score",
    "dividend_score",
    "trend_score",
)


def health(aligned: bool) -> str:
    period_b = " AND p.year_id = b.year_id" if aligned else ""
    period_f = " AND p.year_id = f.year_id" if aligned else ""
    total = " + ".join(f"coalesce({s}, 0)" for s in SCORES)
    present = " + ".join(f"CAST({s} IS NOT NULL AS INT)" for s in SCORES)

    def newest(name: str) -> str:
        return f"""SELECT * FROM {name} QUALIFY row_number() OVER (
            PARTITION BY symbol ORDER BY sort_order DESC, year_id DESC) = 1"""

    rounded = ", ".join(f"{r4(s)} AS {s}" for s in SCORES)
    return f"""{WAREHOUSE},
pl_new AS ({newest('pl')}), bs_new AS ({newest('bs')}), cf_new AS ({newest('cf')}),
merged AS (
    SELECT p.symbol, p.net_profit_margin_pct AS m1, p.asset_turnover AS m2,
        b.debt_to_equity AS m3, f.free_cash_flow AS m4, p.dividend_payout_pct AS m5,
        p.return_on_assets AS m6
    FROM pl_new p LEFT JOIN bs_new b ON p.symbol = b.symbol{period_b}
    LEFT JOIN cf_new f ON p.symbol = f.symbol{period_f}
),
scored AS (
    SELECT symbol, {bounded('m1')} AS profitability_score, {bounded('m2')} AS growth_score,
        {bounded('m3', True)} AS leverage_score, {bounded('m4')} AS cashflow_score,
        {bounded('m5')} AS dividend_score, {bounded('m6')} AS trend_score
    FROM merged
),
overall AS (
    SELECT *, CASE WHEN {present} > 0 THEN {r2(f'({total}) / ({present})')} END AS overall_score
    FROM scored
)
SELECT symbol, DATE '2024-01-31' AS computed_on, overall_score, {rounded},
    {label_ladder('overall_score')} AS health_label
FROM overall"""


def mixed(key: str, date: str) -> dict[str, str]:
    """Parsed fields of the mixed period labels, straight from key and date."""
    kind, y = f"({key} % 11)", f"year({date})"
    month = f"strftime({date}, '%b')"
    century = f"(2000 + {y} % 100)"
    place = f"({fiscal_place(date)} - {y} * 10)"
    return {
        "year_label": f"""CASE {kind} WHEN 0 THEN {month} || ' ' || {century}
            WHEN 1 THEN 'Sep ' || {y} WHEN 2 THEN 'Mar ' || {y} WHEN 3 THEN 'Sep ' || {y}
            WHEN 4 THEN 'TTM' WHEN 5 THEN 'FY' || {y} WHEN 7 THEN {month} || ' ' || {y}
            WHEN 8 THEN 'Sep ' || {y} WHEN 9 THEN {month} || ' ' || {y} END""",
        "fiscal_year": f"""CASE WHEN {kind} = 0 THEN {century}
            WHEN {kind} IN (1, 2, 3, 7, 8, 9) THEN {y} END""",
        "quarter": f"""CASE WHEN {kind} = 4 THEN 'TTM' WHEN {kind} IN (1, 3, 8) THEN 'Q2'
            WHEN {kind} = 2 THEN 'Q4' WHEN {kind} IN (0, 7, 9) THEN {quarter(date)} END""",
        "is_ttm": f"coalesce({kind} = 4, FALSE)",
        "is_half_year": f"coalesce({kind} = 1, FALSE)",
        "sort_order": f"""CASE WHEN {kind} = 4 THEN 999999 WHEN {kind} = 0
            THEN {century} * 10 + {place} WHEN {kind} IN (1, 3, 8) THEN {y} * 10 + 2
            WHEN {kind} = 2 THEN {y} * 10 + 4 WHEN {kind} IN (7, 9) THEN {y} * 10 + {place} END""",
    }


def mixed_columns(key: str, date: str) -> str:
    return ", ".join(f"{value} AS {name}" for name, value in mixed(key, date).items())


MIXED = f"""WITH all_rows AS (
    SELECT 0 AS t, o_orderkey AS k, o_orderkey, {mixed_columns('o_orderkey', 'o_orderdate')}
    FROM orders
    UNION ALL
    SELECT 1, l_orderkey, NULL, {mixed_columns('l_orderkey', 'l_shipdate')} FROM lineitem
),
seen AS (
    SELECT year_label, min_by(is_half_year, t * 1000000000000 + k) AS is_half_year,
        any_value(fiscal_year) AS fiscal_year, any_value(quarter) AS quarter,
        any_value(is_ttm) AS is_ttm, any_value(sort_order) AS sort_order
    FROM all_rows WHERE year_label IS NOT NULL GROUP BY year_label
),
dim AS (
    SELECT row_number() OVER (ORDER BY sort_order NULLS LAST, year_label) AS year_id, *
    FROM seen
)"""


def growth(value: str) -> str:
    """Growth figures; ``value`` picks between the period's number and the percentage."""

    def pick(first: str, percent: str) -> str:
        return first if value == "first" else percent

    n = "(o_orderkey % 40 - 10)"
    number = f"CAST({n} AS DOUBLE)"
    return f"""
    SELECT DISTINCT 'C' || o_custkey AS symbol,
        CASE o_orderkey % 5 WHEN 0 THEN '10Y' WHEN 1 THEN '5Y' WHEN 2 THEN 'TTM'
            WHEN 4 THEN '3Y' END AS period_label,
        {pick(f"CASE o_orderkey % 5 WHEN 0 THEN 10.0 WHEN 1 THEN 5.0 WHEN 2 THEN {number} "
              f"WHEN 3 THEN 1.0 ELSE 3.0 END", number)} AS compounded_sales_growth_pct,
        {pick(f"CASE WHEN o_orderkey % 2 = 0 THEN 10.0 ELSE {number} END", number)}
            AS compounded_profit_growth_pct,
        CASE WHEN o_orderkey % 3 > 0 THEN {number} END AS stock_price_cagr_pct,
        CAST(NULL AS DOUBLE) AS roe_pct
    FROM orders WHERE o_orderkey % 5 <> 3"""


GROWTH_BY_SYMBOL = f"""growth AS (
    SELECT symbol, period_label, max(compounded_sales_growth_pct) AS compounded_sales_growth_pct,
        max(compounded_profit_growth_pct) AS compounded_profit_growth_pct,
        max(stock_price_cagr_pct) AS stock_price_cagr_pct, max(roe_pct) AS roe_pct
    FROM ({growth('percent')}) GROUP BY ALL
)"""

SCORE_ROWS = f"""runs AS (
    SELECT 'C' || c_custkey AS symbol, DATE '2024-01-31' AS computed_on, c_acctbal / 100 AS score
    FROM customer
    UNION ALL
    SELECT 'C' || c_custkey, DATE '2024-02-29', c_acctbal / 200 FROM customer
),
score_rows AS (
    SELECT *, CASE WHEN score >= 0 THEN {label_ladder('score')} END AS label FROM runs
)"""

LABEL_ID = """CASE label WHEN 'POOR' THEN 1 WHEN 'WEAK' THEN 2 WHEN 'AVERAGE' THEN 3
    WHEN 'GOOD' THEN 4 WHEN 'EXCELLENT' THEN 5 END"""


def search_condition(term: str) -> str:
    fields = ("symbol", "company_name", "sector", "sub_sector")
    return "(" + " OR ".join(f"contains(lower({f}), '{term}')" for f in fields) + ")"


SEARCHABLE = f"""WITH c AS (
    SELECT 'C' || c_custkey AS symbol, c_name AS company_name, c_mktsegment AS sector,
        n_name AS sub_sector, CAST(NULL AS VARCHAR) AS website,
        CAST(NULL AS VARCHAR) AS company_logo, CAST(NULL AS DOUBLE) AS face_value,
        CASE WHEN c_acctbal > 0 THEN c_acctbal END AS book_value,
        CAST(c_nationkey AS DOUBLE) AS roce, CAST(NULL AS DOUBLE) AS roe
    FROM customer JOIN nation ON c_nationkey = n_nationkey
),
found AS (
    SELECT * FROM c WHERE {' AND '.join(search_condition(t) for t in ('build', 'nation_1', '00'))}
)"""

ORDER_STORE = """WITH stored AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders WHERE year(o_orderdate) <= 1998
),
batch AS (
    SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderstatus <> 'P' THEN lower(o_orderstatus) END AS o_orderstatus,
        o_totalprice * 2 AS o_totalprice
    FROM orders WHERE year(o_orderdate) >= 1998
)"""

UPSERTED = f"""{ORDER_STORE}
SELECT coalesce(b.o_orderkey, s.o_orderkey) AS o_orderkey,
    coalesce(b.o_custkey, s.o_custkey) AS o_custkey,
    CASE WHEN b.o_orderkey IS NOT NULL THEN b.o_orderstatus ELSE s.o_orderstatus END
        AS o_orderstatus,
    coalesce(b.o_totalprice, s.o_totalprice) AS o_totalprice, s.o_orderpriority
FROM stored s FULL JOIN batch b ON s.o_orderkey = b.o_orderkey"""


def list_parts(rows: int, growth: bool = False) -> str:
    """Documents, remarks and growth figures of each company in parts of so many rows."""
    figures = (
        "compounded_sales_growth_pct, compounded_profit_growth_pct, stock_price_cagr_pct, roe_pct"
    )
    more = f"""UNION ALL
    SELECT symbol, 'analysis', concat_ws('~', period_label, {figures}, company_name),
        row_number() OVER (PARTITION BY symbol ORDER BY period_label)
    FROM growth JOIN company USING (symbol)"""
    return f"""entries AS (
    SELECT 'C' || o_custkey AS symbol, 'documents' AS list,
        strftime(o_orderdate, '%b %Y') || '~/o/' || o_orderkey AS item,
        row_number() OVER (PARTITION BY o_custkey
            ORDER BY strftime(o_orderdate, '%b %Y'), '/o/' || o_orderkey) AS n
    FROM orders
    UNION ALL
    SELECT 'C' || user_id, 'pros_cons', (event_type <> 'error') || '~' || event_type || '~'
        || props || ' ' || event_id || '~MANUAL~100.0',
        row_number() OVER (PARTITION BY user_id
            ORDER BY event_type <> 'error', event_type, props || ' ' || event_id)
    FROM events
    {more if growth else ""}
),
parts AS (
    SELECT symbol, list, (n - 1) // {rows} AS part, count(*) AS entries,
        string_agg(item, '|' ORDER BY n) AS items
    FROM entries JOIN (SELECT symbol FROM company) USING (symbol) GROUP BY ALL
)"""


def newest_of(name: str) -> str:
    return f"""(SELECT * FROM {name} QUALIFY row_number() OVER (
        PARTITION BY symbol ORDER BY sort_order DESC, year_id DESC) = 1)"""


def struct_columns(alias: str, name: str, columns: str) -> str:
    return ", ".join(f"{alias}.{c.strip()} AS {name}_{c.strip()}" for c in columns.split(","))


SNAPSHOT = f"""{WAREHOUSE}, {SCORE_ROWS}
SELECT d.symbol,
    {struct_columns("d", "company",
                    "company_name, sector, sub_sector, face_value, book_value, roce")},
    {struct_columns("p", "profit_loss", "year_label, sales, expenses, operating_profit, interest,"
                    " net_profit, eps")},
    CASE WHEN p.symbol IS NOT NULL THEN d.company_name END AS profit_loss_company_name,
    {struct_columns("b", "balance_sheet", "year_label, equity_capital, reserves, borrowings,"
                    " other_assets, total_assets")},
    {struct_columns("f", "cash_flow", "year_label, operating_activity, investing_activity,"
                    " financing_activity")},
    CAST({LABEL_ID} AS BIGINT) AS ml_score_health_label_id, s.label AS ml_score_health_label_name,
    s.score AS ml_score_profitability_score
FROM company d
LEFT JOIN {newest_of('pl')} p ON d.symbol = p.symbol
LEFT JOIN {newest_of('bs')} b ON d.symbol = b.symbol
LEFT JOIN {newest_of('cf')} f ON d.symbol = f.symbol
LEFT JOIN (SELECT * FROM score_rows WHERE computed_on = DATE '2024-02-29') s
    ON d.symbol = s.symbol"""


def json_of(**fields: str) -> str:
    """A JSON object of texts that are JSON already."""
    inner = " || ',' || ".join(f"""'"{name}":' || {value}""" for name, value in fields.items())
    return f"'{{' || {inner} || '}}'"


def json_text(value: str) -> str:
    return f"""coalesce('"' || {value} || '"', 'null')"""


def json_statement(name: str, **money: str) -> str:
    """The newest row of each company of a fact, with exact figures."""
    exact = {c: json_text(f"CAST(CAST({c} AS {kind}) AS VARCHAR)") for c, kind in money.items()}
    return json_of(
        year_id="year_id",
        symbol=json_text("symbol"),
        **exact,
        year_label=json_text("year_label"),
        company_name=json_text("company_name"),
    ) + f" AS j FROM {newest_of(name)} JOIN company USING (symbol)"


FOUR = "DECIMAL(18, 4)"
COMPANY_JSON = f"""{WAREHOUSE}, {GROWTH_BY_SYMBOL}, {SCORE_ROWS},
pl_json AS (SELECT symbol, {json_statement("pl", sales=FOUR, net_profit=FOUR)}),
bs_json AS (SELECT symbol, {json_statement("bs", total_assets="DECIMAL(18, 2)")}),
cf_json AS (SELECT symbol,
    {json_statement("cf", operating_activity="DECIMAL(18, 2)", investing_activity=FOUR)}),
score_json AS (SELECT symbol, {json_of(
    health_label_id=f"coalesce(CAST({LABEL_ID} AS VARCHAR), 'null')",
    symbol=json_text("symbol"),
    computed_at="""'"2024-02-29T00:00:00.000Z"'""",
    score=json_text("CAST(CAST(score AS DECIMAL(6, 2)) AS VARCHAR)"),
    company_name=json_text("company_name"),
    health_label_name=json_text("label"),
)} AS j FROM score_rows JOIN company USING (symbol) WHERE computed_on = DATE '2024-02-29'),
entries AS (
    SELECT 'C' || o_custkey AS symbol, 'documents' AS list, {json_of(
        year_label=json_text("strftime(o_orderdate, '%b %Y')"),
        document_url=json_text("'/o/' || o_orderkey"),
    )} AS item,
        row_number() OVER (PARTITION BY o_custkey
            ORDER BY strftime(o_orderdate, '%b %Y'), '/o/' || o_orderkey) AS n
    FROM orders
    UNION ALL
    SELECT 'C' || user_id, 'pros_cons', {json_of(
        is_pro="CAST(event_type <> 'error' AS VARCHAR)",
        category=json_text("event_type"),
        text=json_text("""replace(props || ' ' || event_id, '"', '\\"')"""),
        source="""'"MANUAL"'""",
        confidence="'100.0'",
        generated_at="'null'",
    )}, row_number() OVER (PARTITION BY user_id
        ORDER BY event_type <> 'error', event_type, props || ' ' || event_id)
    FROM events
    UNION ALL
    SELECT symbol, 'analysis', {json_of(
        period_label=json_text("period_label"),
        compounded_sales_growth_pct=json_text(
            "CAST(CAST(compounded_sales_growth_pct AS DECIMAL(6, 2)) AS VARCHAR)"),
        company_name=json_text("company_name"),
    )}, row_number() OVER (PARTITION BY symbol ORDER BY period_label)
    FROM growth JOIN company USING (symbol)
)
SELECT symbol, NULL AS list, NULL::BIGINT AS part, {json_of(
    symbol=json_text("c.symbol"),
    company=json_of(
        symbol=json_text("c.symbol"),
        company_name=json_text("c.company_name"),
        book_value=json_text("CAST(CAST(c.book_value AS DECIMAL(12, 2)) AS VARCHAR)"),
    ),
    latest_profit_loss="coalesce(p.j, 'null')",
    latest_balance_sheet="coalesce(b.j, 'null')",
    latest_cash_flow="coalesce(f.j, 'null')",
    latest_ml_score="coalesce(s.j, 'null')",
)} AS document
FROM company c LEFT JOIN pl_json p USING (symbol) LEFT JOIN bs_json b USING (symbol)
LEFT JOIN cf_json f USING (symbol) LEFT JOIN score_json s USING (symbol)
UNION ALL
SELECT symbol, list, (n - 1) // 1000, '[' || string_agg(item, ',' ORDER BY n) || ']'
FROM entries JOIN (SELECT symbol FROM company) USING (symbol)
GROUP BY symbol, list, (n - 1) // 1000"""

REMARK_ROWS = """remark_rows AS (
    SELECT user_id, event_type AS text FROM events WHERE event_type <> 'error' UNION ALL
    SELECT user_id, 'seen ' || event_id FROM events WHERE event_type <> 'error' UNION ALL
    SELECT user_id, 'failed ' || event_id FROM events WHERE event_type = 'error'
)"""

LAST_GROWTH = f"""last_growth AS (
    SELECT * EXCLUDE k FROM (
        SELECT * EXCLUDE k, min(k) AS k
        FROM ({growth('first').replace("SELECT DISTINCT", "SELECT o_orderkey AS k,")}) GROUP BY ALL
    ) QUALIFY row_number() OVER (PARTITION BY symbol, period_label ORDER BY k DESC) = 1
)"""

WITH_STUBS = """(SELECT symbol, face_value, book_value, roce FROM company UNION ALL
    SELECT DISTINCT 'C' || user_id, NULL, NULL, NULL FROM events
    WHERE 'C' || user_id NOT IN (SELECT symbol FROM company))"""

BS_FIGURES = ["equity_capital", "reserves", "borrowings", "other_assets", "total_assets"]
PL_FIGURES = ["sales", "expenses", "operating_profit", "interest", "net_profit", "eps"]
CF_FIGURES = ["operating_activity", "investing_activity", "financing_activity"]
GROWTH_FIGURES = [
    "compounded_sales_growth_pct",
    "compounded_profit_growth_pct",
    "stock_price_cagr_pct",
]


def totals(tables: dict[str, tuple]) -> str:
    """Rows and sums of tables; a third entry is the digits that figures are stored with."""
    parts = []
    for name, (source, figures, *digits) in tables.items():
        parts.append(f"SELECT '{name}.rows' AS item, CAST(count(*) AS DOUBLE) AS total FROM {source}")
        for figure in figures:
            value = f"CAST(CAST({figure} AS VARCHAR) AS DECIMAL(24, {(digits or [4])[0]}))"
            parts.append(
                f"SELECT '{name}.{figure}', CAST(sum(CAST({value} AS DECIMAL(38, 4))) AS DOUBLE)"
                f" FROM {source}"
            )
    return " UNION ALL ".join(parts)


PARTS = """SELECT p_partkey, CASE WHEN p_size > 3 THEN p_name || ', it''s (a); "b"' END AS p_name,
    p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, {price} AS p_retailprice FROM part"""
PART_PRICE = "CAST(CAST(p_retailprice AS DECIMAL(18, 2)) AS DOUBLE)"
BROKEN_PARTS = f"""SELECT * REPLACE (p_name || E';\\n\\n"VALUES (1);\\r\\nend' AS p_name)
    FROM ({PARTS.format(price=PART_PRICE)})"""

STUBS = f"""WITH {COMPANIES.strip()},
known AS (SELECT c.* FROM company c JOIN customer u USING (c_custkey) WHERE c_acctbal >= 0),
found AS (
    SELECT 'C' || o_custkey AS symbol FROM orders UNION SELECT 'U' || user_id FROM events
)
SELECT symbol, company_name, sector, sub_sector, face_value, book_value, roce FROM known
UNION ALL
SELECT f.symbol, f.symbol, coalesce(c.sector, 'Other'), coalesce(c.sub_sector, 'Other'),
    NULL, NULL, NULL
FROM found f LEFT JOIN company c ON f.symbol = c.symbol
WHERE f.symbol NOT IN (SELECT symbol FROM known)"""

ITEMS = """regexp_split_to_array({text}, '\\r?\\n|;|[|]')"""


def items(text: str, flag: str) -> str:
    return f"""SELECT 'D' || doc_id AS symbol, {flag} AS is_pro,
        unnest({ITEMS.format(text=text)}) AS item FROM documents"""


WIDE_VIEW = f"{WAREHOUSE}, {WIDE.strip()} SELECT {WIDE_COLUMNS} FROM wide"

SECTOR_YEAR = measures("sub_sector, fiscal_year")

LOADED = f"""{WAREHOUSE}, {LAST_GROWTH}, {REMARK_ROWS},
        sector_names AS (SELECT DISTINCT sector FROM company)
        {totals({
            "dim_sector": ("(SELECT sector FROM sector_names UNION SELECT 'Other')", []),
            "dim_company": (WITH_STUBS, ["face_value", "book_value", "roce"], 2),
            "dim_year": ("years", ["fiscal_year", "sort_order"]),
            "dim_health_label": ("range(5)", []),
            "fact_balance_sheet": ("bs", BS_FIGURES, 2),
            "fact_profit_loss": ("pl", PL_FIGURES, 2),
            "fact_cash_flow": ("cf", CF_FIGURES, 2),
            "fact_analysis": ("last_growth", GROWTH_FIGURES, 2),
            "fact_pros_cons": ("(SELECT DISTINCT * FROM remark_rows)", []),
            "documents": ("orders", []),
            "fact_ml_scores": ("customer", []),
        })}
        UNION ALL SELECT 'fact_ml_scores.trend_score', 50.0 * count(*) FROM customer
        UNION ALL SELECT unnest(['orphan_profit_loss', 'orphan_balance_sheet',
            'orphan_cash_flow', 'missing_year_dim']), 0"""

LATER_PERIODS = f"""WITH months AS (
            SELECT DISTINCT strftime(o_orderdate, '%b %Y') AS year_label,
                {fiscal_place('o_orderdate')} AS sort_order FROM orders),
        ids AS (SELECT year_label, row_number() OVER (ORDER BY sort_order, year_label) AS year_id
            FROM months)
        SELECT 'C' || o_custkey AS symbol, year_id, year_label,
            CAST(sum({cents('o_totalprice')}) AS DOUBLE) / 100 AS total_assets
        FROM (SELECT *, strftime(o_orderdate, '%b %Y') AS year_label FROM orders)
        JOIN ids USING (year_label) GROUP BY ALL"""

DEEP_PAGE = """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
        ORDER BY o_orderpriority DESC NULLS FIRST, o_orderkey LIMIT 100 OFFSET 8900"""

ORACLES: dict[str, str] = {
    "rename_project": """SELECT p_partkey, p_name AS title, p_brand,
        CAST(p_size AS BIGINT) AS p_size FROM part""",
    "to_number": """SELECT o_orderkey, CASE o_orderkey % 6
        WHEN 0 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE)
        WHEN 1 THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE)
        WHEN 2 THEN -CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) END AS number
        FROM orders""",
    "symbol_normalize": """SELECT c_custkey, CASE WHEN c_nationkey = 0 THEN NULL
        WHEN c_custkey = 1 THEN 'FIRST' WHEN c_custkey = 7 THEN 'SEVENTH'
        ELSE upper(c_name) END AS symbol, c_name || ' ' || c_mktsegment AS company_name
        FROM customer""",
    "lookup_default": """SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        coalesce(r_name, 'Other') AS sector,
        coalesce(CASE WHEN r_name IS NOT NULL THEN n_name END, '-') AS sub_sector
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey AND n_regionkey < 3""",
    "normalize_companies": f"""WITH {COMPANIES.strip()}
        SELECT symbol, company_name, sector, sub_sector, face_value, book_value, roce
        FROM company""",
    "profit_ratios": f"""{WAREHOUSE} SELECT symbol, year_id, year_label, sort_order, sales,
        expenses, operating_profit, opm_pct, interest, net_profit, eps, dividend_payout_pct,
        {r4('net_profit_margin_pct')} AS net_profit_margin_pct,
        {r4('expense_ratio_pct')} AS expense_ratio_pct,
        {r4('interest_coverage')} AS interest_coverage,
        {r4('asset_turnover')} AS asset_turnover,
        {r4('return_on_assets')} AS return_on_assets FROM pl""",
    "balance_ratios": f"""{WAREHOUSE} SELECT symbol, year_id, year_label, sort_order,
        equity_capital, reserves, borrowings, other_assets, total_assets,
        {r4('debt_to_equity')} AS debt_to_equity, {r4('equity_ratio')} AS equity_ratio,
        {r4('book_value_per_share')} AS book_value_per_share FROM bs""",
    "cash_conversion": f"""{WAREHOUSE} SELECT symbol, year_id, year_label, sort_order,
        operating_activity, investing_activity, financing_activity,
        {r4('free_cash_flow')} AS free_cash_flow,
        {r4('cash_conversion_ratio')} AS cash_conversion_ratio FROM cf""",
    "period_parse": f"SELECT o_orderkey, {mixed_columns('o_orderkey', 'o_orderdate')} FROM orders",
    "year_dimension": f"""{MIXED} SELECT year_id, year_label, fiscal_year, quarter, is_ttm,
        is_half_year, sort_order FROM dim""",
    "attach_period": f"""{MIXED} SELECT a.o_orderkey, d.year_id, a.year_label,
        coalesce(d.fiscal_year, a.fiscal_year) AS fiscal_year,
        coalesce(d.quarter, a.quarter) AS quarter, coalesce(d.is_ttm, a.is_ttm) AS is_ttm,
        coalesce(d.is_half_year, a.is_half_year) AS is_half_year,
        coalesce(d.sort_order, a.sort_order) AS sort_order
        FROM all_rows a LEFT JOIN dim d ON a.year_label = d.year_label WHERE a.t = 0""",
    "sector_dimension": """WITH s AS (
            SELECT DISTINCT c_mktsegment, n_name FROM customer
            JOIN nation ON c_nationkey = n_nationkey
        ), named AS (
            SELECT c_mktsegment[1] || lower(c_mktsegment[2:]) || ' & (' || n_name || ')' AS sector_name,
                c_mktsegment || '_' || n_name AS sector_code FROM s
        )
        SELECT row_number() OVER (ORDER BY sector_name) AS sector_id, sector_name, sector_code,
            sector_name || ' sector' AS description FROM named""",
    "growth_extract": growth("first"),
    "growth_extract_percent": growth("percent"),
    "split_to_rows": f"""WITH items AS ({items('text', 'TRUE')} UNION ALL
            {items("source || ' ; - ' || lang || ' -| - '", 'FALSE')})
        SELECT symbol, is_pro, CAST(NULL AS VARCHAR) AS category, trim(item, ' -') AS text,
            'MANUAL' AS source, 100.0::DOUBLE AS confidence
        FROM items WHERE trim(item, {SPACES}) <> ''""",
    "documents_by_period": """SELECT DISTINCT upper(source) AS symbol,
        'Sep ' || (n_chars % 30 + 1990) AS year_label, '/' || lang AS document_url
        FROM documents WHERE lang <> 'de' AND n_chars > 300""",
    "latest_per_entity": """WITH o AS (
            SELECT *, CASE WHEN o_orderpriority <> '5-LOW'
                THEN year(o_orderdate) * 10 + quarter(o_orderdate) END AS sort_order FROM orders
        )
        SELECT o_custkey, sort_order, o_orderkey, o_totalprice FROM o QUALIFY row_number() OVER (
            PARTITION BY o_custkey ORDER BY sort_order DESC NULLS FIRST, o_orderkey DESC) = 1""",
    "latest_coalesced": f"""{WAREHOUSE}, {WIDE.strip()}
        SELECT {WIDE_COLUMNS}, sort_year, rn FROM newest""",
    "dedupe_keep_first": """SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate,
            CAST(l_linenumber AS BIGINT) AS l_linenumber)
        FROM (SELECT * FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1)""",
    "stub_completion": STUBS,
    "bounded_score": f"""WITH c AS (SELECT c_custkey,
            CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS balance FROM customer),
        s AS (SELECT *, {bounded('balance')} AS score, {bounded('balance', True)} AS inverted_score
            FROM c)
        SELECT c_custkey, balance, {r4('score')} AS score, {r4('inverted_score')} AS inverted_score
        FROM s""",
    "bounded_score_constant": """SELECT c_custkey,
        CASE WHEN c_nationkey = 3 THEN 7.5::DOUBLE END AS same, CAST(NULL AS DOUBLE) AS none,
        50.0::DOUBLE AS same_score, CAST(NULL AS DOUBLE) AS none_score FROM customer""",
    "health_scores": health(aligned=True),
    "health_scores_unaligned": f"SELECT * EXCLUDE computed_on FROM ({health(aligned=False)})",
    "health_label_band": f"""SELECT c_custkey, {label_ladder('c_acctbal / 100')} AS label,
        CASE WHEN c_acctbal >= 0 AND c_acctbal <= 10000
            THEN {label_ladder('c_acctbal / 100')} END AS band FROM customer""",
    "label_lookup": """SELECT c_custkey, 'NATION_' || (c_custkey % 30) AS health_label,
        CASE WHEN c_custkey % 30 < 25 THEN c_custkey % 30 END AS health_label_id FROM customer""",
    "wide_financials": WIDE_VIEW,
    "wide_colocated": WIDE_VIEW,
    "measures_total": measures(""),
    "measures_by_sector": measures("sector"),
    "measures_by_sector_year": SECTOR_YEAR,
    "measures_merged": SECTOR_YEAR,
    "price_stats": f"""WITH r AS (
            SELECT user_id, value, length(props) AS volume, value / nullif(lag(value) OVER (
                PARTITION BY user_id ORDER BY ts, event_id), 0) - 1 AS change FROM events
        )
        SELECT user_id, count(*) AS records_count,
            {r2('CAST(sum(CAST(value AS DECIMAL(18, 4))) AS DOUBLE) / count(value)')} AS avg_price,
            {r2('max(value)')} AS max_price, {r2('min(value)')} AS min_price,
            {r2('max(value) - min(value)')} AS price_range,
            round_even(CAST(sum(volume) AS DOUBLE) / count(volume), 0) AS avg_volume,
            {r2('stddev_samp(value)')} AS volatility,
            {r4('avg(change)')} AS avg_daily_return, {r4('max(change)')} AS max_daily_return,
            {r4('min(change)')} AS min_daily_return
        FROM r GROUP BY user_id""",
    "upsert_update": UPSERTED,
    "upsert_large_batch": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        CASE WHEN l_returnflag <> 'R' THEN l_partkey END AS l_partkey,
        l_quantity + 1 AS l_quantity, CASE WHEN l_returnflag <> 'R' THEN l_returnflag END
            AS l_returnflag
        FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_quantity, l_returnflag) = 1""",
    "upsert_last_wins": """SELECT c_custkey, c_name, coalesce(o.status, '-') AS status
        FROM customer LEFT JOIN (SELECT o_custkey, max_by(o_orderstatus, o_orderkey) AS status
            FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey""",
    "upsert_null_key": """WITH c AS (SELECT c_mktsegment,
            CAST(CASE WHEN c_nationkey > 5 THEN c_nationkey END AS BIGINT) AS nation, c_acctbal
            FROM customer)
        SELECT c_mktsegment, nation, min(c_acctbal) AS best FROM c GROUP BY ALL
        UNION ALL
        SELECT c_mktsegment, nation, max(c_acctbal) FROM c WHERE nation IS NULL GROUP BY ALL""",
    "insert_if_absent": """WITH d AS (SELECT source, CASE WHEN lang <> 'en' THEN lang END
            AS year_label, n_chars FROM documents),
        stored AS (SELECT DISTINCT source, year_label FROM d WHERE n_chars < 2000)
        SELECT * FROM stored
        UNION ALL SELECT source, year_label FROM d WHERE year_label IS NULL
        UNION ALL (SELECT source, year_label FROM d WHERE year_label IS NOT NULL
            EXCEPT SELECT * FROM stored)""",
    "fk_audit": """SELECT 'orders_customer' AS "check", count(*) AS violations FROM orders
            ANTI JOIN (SELECT c_custkey AS o_custkey FROM customer WHERE c_acctbal >= 0) c
            USING (o_custkey)
        UNION ALL SELECT 'lineitem_orders', count(*) FROM lineitem
            WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'lineitem_part', count(*) FROM lineitem
            WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)""",
    "orphan_rows": """SELECT o_orderkey, o_totalprice FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "unique_audit": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "not_null_audit": """SELECT 'o_orderkey' AS "column", 0::BIGINT AS nulls
        UNION ALL SELECT 'price', count(*) FROM orders WHERE o_orderpriority = '5-LOW'
        UNION ALL SELECT 'status', count(*) FROM orders WHERE o_orderstatus <> 'F'""",
    "warehouse_audit": f"""WITH {SCORE_ROWS},
        rich AS (SELECT * FROM customer WHERE c_acctbal >= 0),
        doubled AS (SELECT * FROM score_rows UNION ALL
            SELECT * FROM score_rows WHERE score > 50)
        SELECT 'dim_company' AS table_name, 'unique(symbol)' AS rule, 0::BIGINT AS violations
        UNION ALL SELECT 'dim_company', 'not_null(symbol)', 0
        UNION ALL SELECT 'dim_company', 'not_null(company_name)', count(*) FROM rich
            WHERE c_nationkey = 0
        UNION ALL SELECT 'fact_ml_scores', 'unique(symbol, computed_at)', count(*)
            FROM score_rows WHERE score > 50
        UNION ALL SELECT 'fact_ml_scores', 'not_null(' || c || ')', 0
            FROM (VALUES ('symbol'), ('computed_at'), ('overall_score')) v(c)
        UNION ALL SELECT 'fact_ml_scores', 'reference(symbol)', count(*) FROM doubled
            WHERE symbol NOT IN (SELECT 'C' || c_custkey FROM rich)
        UNION ALL SELECT 'fact_ml_scores', 'reference(health_label_id)', count(*) FROM doubled
            WHERE label = 'EXCELLENT'
        UNION ALL SELECT 'dim_health_label', r, 0 FROM (VALUES ('unique(label_id)'),
            ('unique(label_name)'), ('not_null(label_id)'), ('not_null(label_name)'),
            ('not_null(min_score)'), ('not_null(max_score)'), ('not_null(color_hex)')) v(r)""",
    "company_json": COMPANY_JSON,
    "company_search": f"""{SEARCHABLE} SELECT * FROM found
        ORDER BY book_value DESC NULLS FIRST, symbol LIMIT 100""",
    "company_search_count": f'{SEARCHABLE} SELECT count(*) AS "count" FROM found',
    "ordered_page": """SELECT o_orderkey,
        CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price, o_orderpriority
        FROM orders ORDER BY price DESC NULLS FIRST, o_orderkey LIMIT 100 OFFSET 3900""",
    "deep_page": DEEP_PAGE,
    "deep_page_by_position": DEEP_PAGE,
    "ordered_position": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
        l_partkey, count(*) AS lines,
        row_number() OVER (ORDER BY l_partkey, l_orderkey, l_linenumber) - 1 AS position
        FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey""",
    "position_in_group": f"""SELECT o_orderstatus, o_orderkey, CAST(p AS DOUBLE) / 100 AS p,
        CAST(coalesce(sum(coalesce(p, 0)) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) / 100 AS before
        FROM (SELECT o_orderstatus, o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN
            CASE WHEN o_orderkey % 2 = 0 THEN {cents('o_totalprice')}
            ELSE -{cents('o_totalprice')} END END AS p FROM orders)""",
    "profit_loss_list": f"""{WAREHOUSE} SELECT symbol, company_name, year_label, sales, net_profit
        FROM pl JOIN company USING (symbol) WHERE symbol = 'C7'
        ORDER BY sort_order DESC, year_id LIMIT 100""",
    "legacy_metrics": f"""{WAREHOUSE} SELECT symbol, company_name, year_label, sales, net_profit
        FROM pl JOIN company USING (symbol) ORDER BY sales NULLS LAST, symbol, year_id LIMIT 100""",
    "balance_sheet_list": f"""{WAREHOUSE} SELECT symbol, company_name, year_label, borrowings
        FROM bs JOIN company USING (symbol)
        ORDER BY borrowings DESC NULLS FIRST, symbol, year_id LIMIT 100 OFFSET 100""",
    "cash_flow_list": f"""{WAREHOUSE} SELECT symbol, company_name, year_label, operating_activity
        FROM cf JOIN company USING (symbol) ORDER BY symbol, sort_order, year_id LIMIT 500""",
    "analysis_list": f"""WITH {COMPANIES.strip()}, {GROWTH_BY_SYMBOL}
        SELECT symbol, period_label, compounded_sales_growth_pct, compounded_profit_growth_pct,
            stock_price_cagr_pct, roe_pct, company_name
        FROM growth JOIN company USING (symbol) WHERE period_label = 'TTM'
        ORDER BY compounded_sales_growth_pct DESC NULLS FIRST, symbol LIMIT 100""",
    "score_list": f"""WITH {COMPANIES.strip()}, {SCORE_ROWS}
        SELECT symbol, company_name, computed_on, {r4('score')} AS overall_score,
            CAST({LABEL_ID} AS BIGINT) AS health_label_id, label AS health_label_name
        FROM score_rows JOIN company USING (symbol)
        ORDER BY score DESC, symbol, computed_on LIMIT 1000""",
    "company_detail": f"""WITH {COMPANIES.strip()}, {list_parts(1000)}
        SELECT symbol, list, part, entries, items FROM parts
        UNION ALL SELECT symbol, 'company', 0, 1, company_name FROM company""",
    "company_detail_parts": f"""WITH {COMPANIES.strip()}, {list_parts(8)}
        SELECT symbol, list, part, entries, items FROM parts""",
    "snapshot": SNAPSHOT,
    "snapshot_lists": f"""WITH {COMPANIES.strip()}, {GROWTH_BY_SYMBOL}, {list_parts(1000, True)}
        SELECT symbol, list, part, entries, items FROM parts""",
    "snapshot_of_one": f"{SNAPSHOT} WHERE d.symbol = 'C7'",
    "dump_ingest": BROKEN_PARTS,
    "banner_read": f"""{PARTS.format(price=PART_PRICE)} UNION ALL
        SELECT NULL, ' P_NAME ', ' P_BRAND ', ' P_TYPE ', NULL, NULL
        FROM (SELECT DISTINCT p_partkey // 1000 FROM part)""",
    "raw_csv_scan": PARTS.format(price=PART_PRICE),
    "raw_csv_breaks": BROKEN_PARTS,
    "clean_csv_scan": "SELECT * REPLACE (p_partkey + 9007199254740993 AS p_partkey) FROM ("
    + PARTS.format(price=f"CASE WHEN p_size <> 7 THEN {PART_PRICE} END")
    + ")",
    "conform_write": f"""WITH {COMPANIES.strip()}, {SCORE_ROWS} SELECT symbol, computed_on,
        CAST(CAST(score AS DECIMAL(6, 2)) AS DOUBLE) AS overall_score,
        CAST(NULL AS DOUBLE) AS trend_score, CAST({LABEL_ID} AS BIGINT) AS health_label_id,
        company_name, CAST(CAST(book_value AS DECIMAL(12, 2)) AS DOUBLE) AS book_value
        FROM score_rows JOIN company USING (symbol)""",
    "write_report": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS rows, count(*) AS reported FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    ),
    "conform_run": f"""{WAREHOUSE}, growth AS ({growth('first')}), {REMARK_ROWS},
        sector_names AS (SELECT DISTINCT sector FROM company)
        {totals({
            "dim_year": ("years", ["fiscal_year", "sort_order"]),
            "dim_company": (WITH_STUBS, ["face_value", "book_value", "roce"]),
            "sector_mapping": (WITH_STUBS, []),
            "dim_sector": ("(SELECT sector FROM sector_names UNION SELECT 'Other')", []),
            "fact_balance_sheet": ("bs", BS_FIGURES),
            "fact_profit_loss": ("pl", PL_FIGURES),
            "fact_cash_flow": ("cf", CF_FIGURES),
            "fact_analysis": ("growth", GROWTH_FIGURES),
            "fact_pros_cons": ("remark_rows", []),
            "documents": ("orders", []),
        })}""",
    "load_warehouse": LOADED,
    "load_versions": LOADED,
    "load_repeated_keys": f"""WITH {COMPANIES.strip()}, last AS (
            SELECT 'C' || o_custkey AS symbol, min(o_orderkey) AS k,
                arg_min(o_totalprice, o_orderkey) AS price FROM orders GROUP BY o_custkey)
        SELECT symbol, coalesce('order ' || k, company_name) AS company_name,
            CAST(CAST(price AS DECIMAL(12, 2)) AS DOUBLE) AS book_value
        FROM company LEFT JOIN last USING (symbol)""",
    "load_later_periods": LATER_PERIODS,
    "load_versions_later_periods": LATER_PERIODS,
    "load_versions_touched": """SELECT fiscal_year, rows, rows AS counted, fiscal_year = 1995 AS rewritten
        FROM (SELECT year(o_orderdate) AS fiscal_year,
                count(DISTINCT (o_custkey, month(o_orderdate))) AS rows FROM orders GROUP BY 1)""",
    "score_job": f"""SELECT symbol, DATE '2024-01-31' AS computed_on, overall_score,
        CAST({LABEL_ID.replace("CASE label", "CASE health_label")} AS BIGINT) AS health_label_id
        FROM ({health(True)}) WHERE overall_score IS NOT NULL""",
}
