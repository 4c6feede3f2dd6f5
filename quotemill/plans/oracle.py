"""Reference SQL for the registered queries, written independently of the DataFrame code.

Prices are whole cents and ratios whole millionths here, so rounding is exact arithmetic.
"""

from __future__ import annotations

from quotemill.operators.fundamentals import BALANCE_COLUMNS, CASH_FLOW_COLUMNS
from quotemill.plans.registry import MONTH, MONTHS, RUN_DATE
from quotemill.sources.adapters import NEWS_DATES, SNAPSHOT_DATES

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (list(needs), sql)


def select(sql: str, *needs: str) -> str:
    """A statement with the common tables it needs, in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][0]:
            visit(need)
        if name not in order:
            order.append(name)

    for need in needs:
        visit(need)
    tables = ",\n".join(f"{name} AS ({CTES[name][1]})" for name in order)
    return f"WITH {tables}\n{sql}" if order else sql


def micros(top: str, bottom: str) -> str:
    """Ratio in millionths, rounded half away from zero; NULL unless ``bottom`` is positive."""
    top, bottom = f"CAST({top} AS HUGEINT)", f"CAST({bottom} AS HUGEINT)"
    size = f"(2 * abs({top}) * 1000000 + {bottom}) // (2 * {bottom})"
    return f"CASE WHEN {bottom} > 0 THEN CAST(sign({top}) AS HUGEINT) * ({size}) END"


def steps(*pairs: tuple[str, int], otherwise: int) -> str:
    whens = " ".join(f"WHEN {condition} THEN {points}" for condition, points in pairs)
    return f"CASE {whens} ELSE {otherwise} END"


# -- prices ------------------------------------------------------------------

cte(
    "trades",
    """SELECT CAST(l_suppkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS date,
        CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, CAST(l_quantity AS BIGINT) AS shares,
        CAST(round(l_discount * 100) AS BIGINT) AS discount, CAST(round(l_tax * 100) AS BIGINT) AS tax,
        l_linenumber AS line, l_returnflag AS flag
    FROM lineitem""",
)
cte(
    "bars",
    """SELECT ticker, date,
        min((2 * cents + shares) // (2 * shares)) AS low_cents,
        max((2 * cents + shares) // (2 * shares)) AS high_cents,
        CAST((2 * sum(cents) + sum(shares)) // (2 * sum(shares)) AS BIGINT) AS close_cents,
        close_cents / 1e2 AS close, CAST(sum(shares) AS BIGINT) AS volume, count(*) AS transactions
    FROM trades GROUP BY ticker, date""",
    "trades",
)
BAR_COLUMNS = """ticker, low_cents / 1e2 AS open, high_cents / 1e2 AS high, low_cents / 1e2 AS low,
    close, volume, close AS vwap, transactions"""
cte(
    "steps",
    """SELECT ticker, date, close, close / nullif(lag(close) OVER w, 0) - 1 AS daily_return,
        close / nullif(first_value(close) OVER w, 0) - 1 AS cumulative_return,
        close / nullif(lag(close, 30) OVER w, 0) - 1 AS rolling_30d_return,
        close / nullif(lag(close, 90) OVER w, 0) - 1 AS rolling_90d_return,
        close / nullif(lag(close, 252) OVER w, 0) - 1 AS rolling_1y_return,
        max(close) OVER w AS running_max_price
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
    "bars",
)
cte(
    "returns",
    """SELECT *, stddev_samp(daily_return) OVER (
            PARTITION BY ticker ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW
        ) AS rolling_30d_volatility,
        close / nullif(running_max_price, 0) - 1 AS drawdown_pct
    FROM steps""",
    "steps",
)
RETURN_COLUMNS = """ticker, date, close, daily_return, cumulative_return, rolling_30d_return,
    rolling_90d_return, rolling_1y_return, round(rolling_30d_volatility, 6) AS rolling_30d_volatility,
    running_max_price, drawdown_pct"""


def average(rows: int) -> str:
    frame = f"OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return (
        f"(2 * sum(close_cents) {frame} + count(*) {frame}) // (2 * count(*) {frame}) / 1e2 AS sma_{rows}"
    )


cte(
    "averages",
    f"SELECT ticker, date, close, {average(20)}, {average(50)}, {average(200)}, {average(30)} FROM bars",
    "bars",
)
cte(
    "points",
    """SELECT ticker, date, CASE WHEN volume % 13 <> 0 THEN CAST((volume * 7) % 101 AS DOUBLE) END AS rsi_value,
        (volume % 21 - 10) / 1e1 AS macd_value, (volume % 17 - 8) / 1e1 AS macd_signal
    FROM bars""",
    "bars",
)
cte(
    "technical",
    """SELECT a.ticker, a.date, a.close, a.sma_20, a.sma_50, a.sma_200, p.rsi_value, p.macd_value,
        p.macd_signal, round(p.macd_value - p.macd_signal, 4) AS macd_histogram
    FROM averages a JOIN points p ON a.ticker = p.ticker AND a.date = p.date""",
    "averages",
    "points",
)
cte(
    "parts",
    f"""SELECT ticker, date,
        {steps(("close > sma_20 AND close > sma_50 AND close > sma_200", 40),
               ("close > sma_20 AND close > sma_50", 30), ("close > sma_20", 20),
               ("close > sma_50", 10), otherwise=5)} AS trend_score,
        {steps(("rsi_value BETWEEN 50 AND 70", 30), ("rsi_value BETWEEN 40 AND 80", 20),
               ("rsi_value > 70", 15), ("rsi_value BETWEEN 30 AND 40", 10), ("rsi_value < 30", 5),
               otherwise=15)} AS momentum_score,
        {steps(("macd_value > macd_signal AND macd_value > 0", 10), ("macd_value > macd_signal", 7),
               ("macd_value < macd_signal AND macd_value < 0", 3), otherwise=5)} AS macd_score,
        (close - lag(close, 20) OVER w) / nullif(lag(close, 20) OVER w, 0) * 100 AS change
    FROM technical WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
    "technical",
)
cte(
    "technical_scores",
    f"""SELECT ticker, date, trend_score, momentum_score, macd_score,
        {steps(("change > 10", 20), ("change > 5", 15), ("change > 0", 10), ("change > -5", 5), otherwise=0)}
            AS price_action_score,
        trend_score + momentum_score + macd_score + price_action_score AS technical_score
    FROM parts""",
    "parts",
)

# -- recursive averages ------------------------------------------------------

cte(
    "numbered",
    """SELECT ticker, date, close, row_number() OVER w AS n, close - lag(close) OVER w AS change
    FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
    "bars",
)



MACD_SQL = select("", "numbered").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + """,
walk(ticker, n, short, long, signal) AS (
    SELECT ticker, n, close, close, CAST(0 AS DOUBLE) FROM numbered WHERE n = 1
    UNION ALL
    SELECT x.ticker, x.n, w.short + (x.close - w.short) * (2 / 13e0),
        w.long + (x.close - w.long) * (2 / 27e0),
        w.signal + ((w.short + (x.close - w.short) * (2 / 13e0))
            - (w.long + (x.close - w.long) * (2 / 27e0)) - w.signal) * (2 / 10e0)
    FROM walk w JOIN numbered x ON x.ticker = w.ticker AND x.n = w.n + 1
)
SELECT x.ticker, x.date, round(w.short - w.long, 6) AS macd_value, round(w.signal, 6) AS signal_value,
    round(w.short - w.long - w.signal, 6) AS histogram_value
FROM walk w JOIN numbered x ON x.ticker = w.ticker AND x.n = w.n"""

STRENGTH = """CASE WHEN n > 14 THEN CASE WHEN loss = 0 AND gain = 0 THEN 50 WHEN loss = 0 THEN 100
    ELSE round(100 - 100 / (1 + gain / loss), 9) END END AS rsi_value"""

RSI_SQL = select("", "numbered").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
seed AS (
    SELECT ticker, avg(greatest(change, 0)) AS gain, avg(greatest(-change, 0)) AS loss
    FROM numbered WHERE n BETWEEN 2 AND 15 GROUP BY ticker HAVING count(*) = 14
),
walk(ticker, n, gain, loss) AS (
    SELECT ticker, CAST(15 AS BIGINT), gain, loss FROM seed
    UNION ALL
    SELECT x.ticker, x.n, (w.gain * 13 + greatest(x.change, 0)) / 14, (w.loss * 13 + greatest(-x.change, 0)) / 14
    FROM walk w JOIN numbered x ON x.ticker = w.ticker AND x.n = w.n + 1
),
joined AS (
    SELECT x.ticker, x.date, x.n, w.gain, w.loss
    FROM numbered x LEFT JOIN walk w ON x.ticker = w.ticker AND x.n = w.n
)
SELECT ticker, date, {STRENGTH} FROM joined"""

cte(
    "simple_strength",
    """SELECT ticker, date, n, avg(greatest(change, 0)) OVER w AS gain, avg(greatest(-change, 0)) OVER w AS loss
    FROM numbered WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)""",
    "numbered",
)

# -- statements --------------------------------------------------------------


def part(condition: str) -> str:
    return f"CAST(coalesce(sum(cents) FILTER (WHERE {condition}), 0) AS BIGINT)"


cte(
    "years",
    f"""SELECT ticker, make_date(year(date), 12, 31) AS date, CAST(year(date) AS VARCHAR) AS fiscal_year,
        'FY' AS period, CAST(sum(cents) AS BIGINT) AS revenue, count(*) AS shares,
        {part("flag <> 'R'")} AS gross_profit, {part("flag = 'A'")} AS operating_income,
        {part("flag = 'A' AND discount <= 5")} - {part("flag = 'R' AND tax = 8")} AS net_income,
        {part("line <= 3")} AS total_current_assets, {part("line >= 5")} AS total_current_liabilities,
        5 * ({part("discount < 5")} - 2 * {part("tax = 0")}) AS total_stockholders_equity,
        3 * {part("tax >= 6")} AS total_debt, {part("line = 1")} AS cash_and_short_term_investments,
        {part("line = 2")} AS net_receivables, {part("line = 7")} AS investment,
        {part("flag = 'N' AND line <= 4")} - {part("flag = 'R' AND line = 1")} AS free_cash_flow
    FROM trades GROUP BY ticker, year(date)""",
    "trades",
)
cte(
    "statements",
    """SELECT ticker, date, fiscal_year, period, revenue, revenue - gross_profit AS cost_of_revenue,
        gross_profit, operating_income, net_income, net_income / shares AS eps_diluted,
        CAST(NULL AS BIGINT) AS ebitda, shares AS weighted_average_shares_out_diluted,
        3 * revenue AS total_assets, total_current_assets, cash_and_short_term_investments,
        net_receivables, 3 * revenue - total_stockholders_equity AS total_liabilities,
        total_current_liabilities, total_stockholders_equity, total_debt,
        total_debt - cash_and_short_term_investments AS net_debt,
        free_cash_flow + investment AS operating_cash_flow, free_cash_flow, -investment AS capital_expenditure
    FROM years""",
    "years",
)
RATIO_PARTS = {
    "gross_margin": ("gross_profit", "revenue"),
    "operating_margin": ("operating_income", "revenue"),
    "net_margin": ("net_income", "revenue"),
    "return_on_equity": ("net_income", "total_stockholders_equity"),
    "return_on_assets": ("net_income", "total_assets"),
    "current_ratio": ("total_current_assets", "total_current_liabilities"),
    "quick_ratio": ("(cash_and_short_term_investments + net_receivables)", "total_current_liabilities"),
    "debt_to_equity": ("total_debt", "total_stockholders_equity"),
    "debt_to_assets": ("total_debt", "total_assets"),
    "fcf_margin": ("free_cash_flow", "revenue"),
    "fcf_to_net_income": ("free_cash_flow", "net_income"),
    "revenue_per_share": ("revenue", "weighted_average_shares_out_diluted"),
    "fcf_per_share": ("free_cash_flow", "weighted_average_shares_out_diluted"),
    "book_value_per_share": ("total_stockholders_equity", "weighted_average_shares_out_diluted"),
}
cte(
    "ratios",
    "SELECT *, " + ", ".join(f"{micros(*p)} AS {n}" for n, p in RATIO_PARTS.items()) + " FROM statements",
    "statements",
)
cte(
    "before",
    """SELECT *, lag(revenue) OVER w AS revenue_0, lag(net_income) OVER w AS income_0,
        lag(eps_diluted) OVER w AS eps_0, lag(free_cash_flow) OVER w AS fcf_0,
        lag(operating_cash_flow) OVER w AS ocf_0
    FROM ratios WINDOW w AS (PARTITION BY ticker ORDER BY date)""",
    "ratios",
)
cte(
    "growth",
    f"""SELECT *, {micros("(revenue - revenue_0)", "revenue_0")} AS revenue_growth_yoy,
        {micros("(net_income - income_0)", "income_0")} AS net_income_growth_yoy,
        CASE WHEN eps_0 > 0 THEN (eps_diluted - eps_0) / eps_0 END AS eps_growth_yoy,
        {micros("(free_cash_flow - fcf_0)", "fcf_0")} AS fcf_growth_yoy,
        {micros("(operating_cash_flow - ocf_0)", "ocf_0")} AS operating_cash_flow_growth_yoy
    FROM before""",
    "before",
)


def over(column: str, *pairs: tuple[int, int], otherwise: int, sign: str = ">") -> str:
    return steps(*[(f"{column} {sign} {limit}", points) for limit, points in pairs], otherwise=otherwise)


RATE = ((200000, 10), (150000, 8), (100000, 6), (50000, 4), (0, 2))
EPS_RATE = ((0.25, 10), (0.15, 8), (0.10, 6), (0.05, 4), (0, 2))
MARGINS = steps(
    ("gross_margin > 500000 AND operating_margin > 250000 AND net_margin > 200000", 15),
    ("gross_margin > 400000 AND operating_margin > 200000 AND net_margin > 150000", 12),
    ("gross_margin > 300000 AND operating_margin > 150000 AND net_margin > 100000", 9),
    ("gross_margin > 200000 AND operating_margin > 100000", 6),
    ("gross_margin > 0 AND net_margin > 0", 3),
    otherwise=0,
)
cte(
    "fundamental_scores",
    f"""SELECT *,
        {MARGINS} + {over("return_on_equity", (200000, 10), (150000, 7), (100000, 5), (0, 2), otherwise=0)}
            AS profitability_score,
        {over("revenue_growth_yoy", *RATE, otherwise=0)} + {over("eps_growth_yoy", *EPS_RATE, otherwise=0)}
            + {over("fcf_growth_yoy", *RATE, otherwise=0)} AS growth_score,
        {over("current_ratio", (2000000, 10), (1500000, 8), (1000000, 6), (750000, 4), otherwise=2)}
            + {over("debt_to_equity", (300000, 10), (500000, 8), (1000000, 6), (2000000, 4), otherwise=2, sign="<")}
            + {over("fcf_margin", (250000, 5), (200000, 4), (150000, 3), (100000, 2), otherwise=1)}
            AS financial_health_score,
        {over("fcf_to_net_income", (1200000, 15), (1000000, 12), (800000, 9), (500000, 6), otherwise=3)}
            + {over("fcf_margin", (200000, 5), (150000, 4), (100000, 3), otherwise=2)} AS cash_quality_score,
        profitability_score + growth_score + financial_health_score + cash_quality_score AS fundamentals_score
    FROM growth""",
    "growth",
)
SCALED = """gross_margin operating_margin net_margin return_on_equity current_ratio debt_to_equity
    fcf_margin revenue_growth_yoy fcf_growth_yoy""".split()


def scaled(*columns: str) -> str:
    return ", ".join(f"{c} / 1e6 AS {c}" for c in columns)


# -- companies and composite scores ------------------------------------------

cte(
    "lookup",
    f"""SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS company_name, r_name AS sector, n_name AS industry,
        n_name || ', ' || r_name AS location, DATE '1990-01-01' + CAST(floor(s_acctbal) AS INTEGER) AS date_added,
        lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, CAST(1900 + s_nationkey AS VARCHAR) AS founded_year,
        as_of_date
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    JOIN (VALUES (DATE '{SNAPSHOT_DATES[0]}'), (DATE '{SNAPSHOT_DATES[1]}')) d(as_of_date)
        ON as_of_date = DATE '{SNAPSHOT_DATES[0]}' OR s_acctbal >= 0""",
)
COMPANY_COLUMNS = """as_of_date, ticker, company_name, sector, industry, location, date_added, cik, founded_year,
    CAST(year(date_added) AS INTEGER) AS date_added_year"""
cte("companies", "SELECT * FROM lookup WHERE as_of_date = (SELECT max(as_of_date) FROM lookup)", "lookup")
cte(
    "periods",
    """SELECT ticker, fiscal_year, lag(date) OVER (PARTITION BY ticker ORDER BY fiscal_year)
            AS fiscal_year_start_date, date AS fiscal_year_end_date, fundamentals_score, profitability_score,
        growth_score, financial_health_score, cash_quality_score,
        lead(date) OVER (PARTITION BY ticker ORDER BY date) AS next_end
    FROM fundamental_scores""",
    "fundamental_scores",
)


def composite_sql(match: str) -> str:
    return f"""SELECT t.ticker, t.date AS technical_date, t.technical_score, f.fiscal_year,
        f.fiscal_year_start_date, f.fiscal_year_end_date, f.fundamentals_score, t.trend_score,
        t.momentum_score, t.macd_score, t.price_action_score, f.profitability_score, f.growth_score,
        f.financial_health_score, f.cash_quality_score,
        (5 * t.technical_score + 5 * f.fundamentals_score) / 1e1 AS composite_score_equal,
        (6 * t.technical_score + 4 * f.fundamentals_score) / 1e1 AS composite_score_technical_bias,
        (4 * t.technical_score + 6 * f.fundamentals_score) / 1e1 AS composite_score_fundamental_bias
    FROM technical_scores t LEFT JOIN periods f ON t.ticker = f.ticker AND {match}"""


INCLUSIVE = "t.date >= f.fiscal_year_start_date AND t.date <= f.fiscal_year_end_date"
HALF_OPEN = "t.date > f.fiscal_year_start_date AND t.date <= f.fiscal_year_end_date"
ASOF = "t.date >= f.fiscal_year_end_date AND (f.next_end IS NULL OR t.date < f.next_end)"
cte("composite", composite_sql(INCLUSIVE), "technical_scores", "periods")
cte(
    "industry",
    """SELECT s.ticker, c.company_name, c.sector, c.industry, composite_score_equal,
        composite_score_technical_bias, composite_score_fundamental_bias, technical_score,
        fundamentals_score, technical_date, fiscal_year, fiscal_year_start_date, fiscal_year_end_date
    FROM composite s LEFT JOIN companies c ON s.ticker = c.ticker""",
    "composite",
    "companies",
)
cte(
    "performance",
    """SELECT r.*, c.company_name, c.sector, c.industry
    FROM returns r LEFT JOIN companies c ON r.ticker = c.ticker""",
    "returns",
    "companies",
)

# -- semantic queries --------------------------------------------------------


def score_measures(name: str, column: str) -> str:
    """Mean as an exact whole-number sum of tenths over the count."""
    return f"""{tenths(name, column)}, max({column}) AS max_{name}, min({column}) AS min_{name},
        round(stddev_samp({column}), 6) AS std_{name}"""


def tenths(name: str, column: str) -> str:
    total = f"sum(CAST(round({column} * 10) AS BIGINT)) / 1e1"
    return f"round({total} / nullif(count({column}), 0), 6) AS avg_{name}"


def means(*columns: str) -> str:
    return ", ".join(f"round(avg({c}), 6) AS avg_{c}" for c in columns)


TECHNICAL = f"""{score_measures("technical_score", "technical_score")},
    {means("trend_score", "momentum_score", "price_action_score", "macd_score")},
    count(DISTINCT ticker) AS ticker_count, count(*) AS observation_count"""
COMPOSITE = f"""{score_measures("composite_equal", "composite_score_equal")},
    {tenths("composite_technical_bias", "composite_score_technical_bias")},
    {tenths("composite_fundamental_bias", "composite_score_fundamental_bias")},
    {means("technical_score", "fundamentals_score")}, count(DISTINCT ticker) AS ticker_count"""
MICRO_MEANS = ", ".join(
    f"round(sum({c}) / 1e6 / nullif(count({c}), 0), 6) AS avg_{c}"
    for c in SCALED
    if c not in ("fcf_margin", "fcf_growth_yoy")
)
FUNDAMENTAL = f"""{score_measures("fundamentals_score", "fundamentals_score")},
    {means("profitability_score", "growth_score", "financial_health_score", "cash_quality_score")},
    {MICRO_MEANS}, count(DISTINCT ticker) AS ticker_count"""
PRICE = f"""{means("daily_return", "cumulative_return", "rolling_30d_return", "rolling_90d_return",
                   "rolling_1y_return")},
    max(cumulative_return) AS latest_cumulative_return,
    round(avg(rolling_30d_volatility), 6) AS avg_volatility_30d,
    round(avg(CASE WHEN daily_return > 0 THEN 1 WHEN daily_return <= 0 THEN 0 END), 6) AS positive_return_rate,
    round(avg(rolling_1y_return / nullif(rolling_30d_volatility, 0)), 6) AS avg_risk_adjusted_return,
    round(avg(drawdown_pct), 6) AS avg_drawdown, min(drawdown_pct) AS max_drawdown,
    round(avg(rolling_1y_return / nullif(abs(drawdown_pct), 0)), 6) AS avg_return_to_drawdown,
    max(close) AS latest_close, count(DISTINCT ticker) AS ticker_count, count(*) AS observation_count"""


def latest(table: str, column: str) -> str:
    return f"{column} = (SELECT max({column}) FROM {table})"


# -- feeds -------------------------------------------------------------------

END_OF_RUN = f"date <= DATE '{RUN_DATE}'"
cte(
    "stories",
    f"""SELECT CAST(doc_id % 10 AS VARCHAR) AS ticker, 'doc/' || doc_id AS article_id, source AS publisher_name,
        'http://' || source AS publisher_homepage_url, 'Document ' || doc_id AS title,
        CASE WHEN lang = 'en' THEN DATE '{NEWS_DATES[0]}' ELSE DATE '{NEWS_DATES[1]}' END AS date,
        date + to_hours(doc_id % 24) + to_minutes(doc_id % 60) AS published_utc,
        '["' || (doc_id % 10) || '"]' AS tickers, text AS description,
        '["' || lang || '","' || source || '"]' AS keywords, lang
    FROM documents""",
)
STORY_COLUMNS = """ticker, article_id, publisher_name, publisher_homepage_url, title, published_utc, tickers,
    description, keywords, date"""


def newest(columns: str, table: str, order: str, k: int, where: str = "true") -> str:
    return f"""SELECT {columns} FROM (
        SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY {order}) AS place FROM {table} WHERE {where}
    ) WHERE place <= {k}"""


CONSTITUENT_COLUMNS = f"""ticker, company_name AS security_name, sector AS gics_sector,
    industry AS gics_sub_industry, location AS headquarters_location, date_added, cik, founded_year,
    DATE '{RUN_DATE}' AS date"""

cte(
    "monthly",
    """SELECT ticker, CAST(date_trunc('month', date) AS DATE) AS date, CAST(sum(volume) AS BIGINT) AS volume
    FROM bars GROUP BY 1, 2""",
    "bars",
)


def _queries() -> dict[str, str]:
    bars = lambda sql: select(sql, "bars")
    returns = f"SELECT {RETURN_COLUMNS} FROM returns"
    technical = """SELECT ticker, date, trend_score, momentum_score, macd_score, price_action_score,
        technical_score FROM technical_scores"""
    volatility = "round(rolling_30d_volatility, 6) AS rolling_30d_volatility"
    return {
        "staged_prices": bars(f"SELECT {BAR_COLUMNS}, date FROM bars"),
        "daily_price_changes": bars(
            """SELECT ticker, date, close, lag(close) OVER w AS previous_day_close,
                (close_cents - lag(close_cents) OVER w) / 1e2 AS price_change
            FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)"""
        ),
        "price_returns": select(returns, "returns"),
        "price_returns_split": select(returns, "returns"),
        "incremental_price_returns": select(returns, "returns"),
        "state_price_returns": bars(
            """SELECT ticker, min(date) AS first_date, arg_min(close, date) AS first_close, max(close) AS peak,
                count(*) AS "rows", max(date) AS last_date FROM bars GROUP BY ticker"""
        ),
        "incremental_daily_changes": bars(
            """SELECT ticker, date, close, lag(close) OVER w AS previous_day_close,
                (close_cents - lag(close_cents) OVER w) / 1e2 AS price_change
            FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date)"""
        ),
        "incremental_indicators": select(
            """SELECT *, 14 AS rsi_window_size, 'day' AS rsi_timespan, 'close' AS rsi_series_type
            FROM technical""",
            "technical",
        ),
        "incremental_composite": select("SELECT * FROM composite", "composite"),
        "incremental_industry": select("SELECT * FROM industry", "industry"),
        "incremental_performance": select(
            f"SELECT {RETURN_COLUMNS}, company_name, sector, industry FROM performance", "performance"
        ),
        "table_replace_day": select(
            f"""SELECT ticker, date, volume, CASE WHEN date = DATE '{MONTH}' THEN 2 ELSE 1 END AS version
            FROM monthly WHERE volume >= 60 OR date <> DATE '{MONTH}'""",
            "monthly",
        ),
        "table_replace_range": select(
            f"""SELECT ticker, date, volume, CASE WHEN date = DATE '{MONTHS[1]}' THEN 2 ELSE 1 END AS version
            FROM monthly WHERE date < DATE '{MONTHS[0]}' OR date >= DATE '{MONTHS[1]}'""",
            "monthly",
        ),
        "job_news_backfill": f"""SELECT CAST(doc_id % 10 AS VARCHAR) AS ticker, 'doc/' || doc_id AS article_id,
                CASE WHEN lang = 'en' THEN DATE '{NEWS_DATES[0]}' ELSE DATE '{NEWS_DATES[1]}' END AS date, lang
            FROM documents WHERE doc_id % 10 IN (SELECT s_suppkey FROM supplier)""",
        "staged_views": bars("SELECT ticker, date, close, volume FROM bars WHERE volume >= 60"),
        "exposed_marts": select(
            """SELECT 'technical_scores' AS name, count(*) AS "rows" FROM technical_scores
            UNION ALL SELECT 'fundamental_scores', count(*) FROM fundamental_scores
            UNION ALL SELECT unnest(['composite_scores', 'industry_scores', 'price_performance']), NULL""",
            "technical_scores", "fundamental_scores",
        ),
        "table_range_atomic": select(
            f"""SELECT ticker, date, volume, 1 AS version, 'before' AS seen FROM monthly
            UNION ALL
            SELECT ticker, date, volume, CASE WHEN date = DATE '{MONTHS[1]}' THEN 2 ELSE 1 END, 'after'
            FROM monthly WHERE date < DATE '{MONTHS[0]}' OR date >= DATE '{MONTHS[1]}'""",
            "monthly",
        ),
        "table_as_of": select(
            f"""SELECT ticker, date, volume, 1 AS version,
                date BETWEEN DATE '{MONTHS[0]}' AND DATE '{MONTHS[1]}' AS changed FROM monthly""",
            "monthly",
        ),
        "checked_write": select(
            """SELECT count(*) AS "rows", count(*) - count(ticker) AS nulls, min(volume) < 60 AS refused,
                CASE WHEN min(volume) < 60 THEN 1 ELSE 2 END AS version FROM monthly""",
            "monthly",
        ),
        "table_delete_insert": select(
            "SELECT ticker, date, volume, CASE WHEN volume >= 60 THEN 2 ELSE 1 END AS version FROM monthly", "monthly"
        ),
        "table_full_refresh": select("SELECT ticker, date, volume, 2 AS version FROM monthly", "monthly"),
        "table_variants": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
        "rolling_volatility": select(f"SELECT ticker, date, {volatility} FROM returns", "returns"),
        "running_drawdown": select("SELECT ticker, date, running_max_price, drawdown_pct FROM returns", "returns"),
        "sma_indicators": select("SELECT * FROM averages", "averages"),
        "sma_split": select("SELECT ticker, date, close, sma_20, sma_50, sma_200 FROM averages", "averages"),
        "rsi": RSI_SQL,
        "rsi_split": RSI_SQL,
        "rsi_simple": select(f"SELECT ticker, date, {STRENGTH} FROM simple_strength", "simple_strength"),
        "macd": MACD_SQL,
        "macd_split": MACD_SQL,
        "technical_indicators_join": select(
            """SELECT *, 14 AS rsi_window_size, 'day' AS rsi_timespan, 'close' AS rsi_series_type
            FROM technical""",
            "technical",
        ),
        "technical_scores": select(technical, "technical_scores"),
        "incremental_technical_scores": select(technical, "technical_scores"),
        "fundamentals_join": select("SELECT * FROM statements", "statements"),
        "ratios": select(f"SELECT ticker, date, {scaled(*RATIO_PARTS)} FROM ratios", "ratios"),
        "yoy_growth": select(
            f"""SELECT ticker, date, eps_growth_yoy, {scaled("revenue_growth_yoy", "net_income_growth_yoy",
                "fcf_growth_yoy", "operating_cash_flow_growth_yoy")} FROM growth""",
            "growth",
        ),
        "fundamental_scores": select(
            f"""SELECT ticker, date, fiscal_year, profitability_score, growth_score, financial_health_score,
                cash_quality_score, fundamentals_score, eps_growth_yoy, {scaled(*SCALED)}
            FROM fundamental_scores""",
            "fundamental_scores",
        ),
        "companies_snapshot": select(f"SELECT {COMPANY_COLUMNS} FROM lookup", "lookup"),
        "companies_current": select(f"SELECT {COMPANY_COLUMNS} FROM companies", "companies"),
        "universe_distinct": select("SELECT DISTINCT ticker FROM companies", "companies"),
        "universe_semi_join": select(
            """SELECT ticker, date, close, volume FROM bars
            WHERE ticker IN (SELECT ticker FROM companies)""",
            "bars",
            "companies",
        ),
        "fiscal_periods": select("SELECT * EXCLUDE (next_end) FROM periods", "periods"),
        "composite_scores": select("SELECT * FROM composite", "composite"),
        "composite_half_open": select(composite_sql(HALF_OPEN), "technical_scores", "periods"),
        "composite_asof": select(composite_sql(ASOF), "technical_scores", "periods"),
        "industry_scores": select("SELECT * FROM industry", "industry"),
        "price_performance": select(
            f"SELECT {RETURN_COLUMNS}, company_name, sector, industry FROM performance", "performance"
        ),
        "latest_k_points": """SELECT ticker, timestamp, event_id, value FROM (
                SELECT CAST(user_id AS VARCHAR) AS ticker, ts AS timestamp, event_id, value,
                    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
                FROM events WHERE ts < TIMESTAMP '2024-01-21 00:00:00'
            ) WHERE place <= 5""",
        "latest_k_articles": select(
            newest("ticker, article_id, published_utc, lang", "stories", "published_utc DESC, article_id", 10),
            "stories",
        ),
        "feed_news": select(
            newest(STORY_COLUMNS, "stories", "published_utc DESC, article_id", 10, f"date = DATE '{NEWS_DATES[0]}'"),
            "stories",
        ),
        "feed_news_range": select(
            f"SELECT {STORY_COLUMNS} FROM stories", "stories"
        ),
        "news_ticker_explode": select(
            f"""SELECT m.ticker, 'Document ' || doc_id AS title, DATE '{NEWS_DATES[0]}' AS date, text AS content,
                'NYSE:' || (doc_id % 10) || ', NASDAQ:' || (doc_id * 3) % 10 AS article_tickers,
                'doc/' || doc_id AS article_url, source AS site
            FROM (
                SELECT *, CAST(doc_id % 10 AS VARCHAR) AS ticker FROM documents
                UNION ALL SELECT *, CAST((doc_id * 3) % 10 AS VARCHAR) AS ticker FROM documents
            ) m WHERE lang = 'en' AND ticker IN (SELECT ticker FROM companies)""",
            "companies",
        ),
        "json_variant": "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
        "feed_prices": bars(f"SELECT {BAR_COLUMNS}, DATE '{RUN_DATE}' AS date FROM bars"),
        "feed_prices_range": bars(f"SELECT {BAR_COLUMNS}, date FROM bars"),
        "feed_indicator": select(
            newest(
                f"""ticker, CAST(date AS TIMESTAMP) AS timestamp, rsi_value, 14 AS window_size, 'day' AS timespan,
                'close' AS series_type, DATE '{RUN_DATE}' AS date""",
                "points",
                "date DESC",
                120,
                END_OF_RUN,
            ),
            "points",
        ),
        "feed_indicator_range": select(
            """SELECT ticker, CAST(date AS TIMESTAMP) AS timestamp, close AS sma_value, 30 AS window_size,
                'day' AS timespan, 'close' AS series_type, date FROM bars""",
            "bars",
        ),
        "feed_macd": select(
            newest(
                f"""ticker, CAST(date AS TIMESTAMP) AS timestamp, macd_value, macd_signal AS signal_value,
                macd_value - macd_signal AS histogram_value, 12 AS short_window, 26 AS long_window,
                9 AS signal_window, 'day' AS timespan, 'close' AS series_type, DATE '{RUN_DATE}' AS date""",
                "points",
                "date DESC",
                1,
                END_OF_RUN,
            ),
            "points",
        ),
        "feed_income": select(
            """SELECT ticker, date, CAST(date AS TIMESTAMP) + INTERVAL '16 hours 30 minutes' AS accepted_date,
                fiscal_year, period, revenue, gross_profit, operating_income, net_income,
                weighted_average_shares_out_diluted, eps_diluted FROM statements""",
            "statements",
        ),
        "feed_balance": select(
            f"SELECT ticker, date, fiscal_year, period, {', '.join(BALANCE_COLUMNS)} FROM statements", "statements"
        ),
        "feed_cash_flow": select(
            f"SELECT ticker, date, fiscal_year, period, {', '.join(CASH_FLOW_COLUMNS)} FROM statements", "statements"
        ),
        "feed_constituents": select(
            f"SELECT {CONSTITUENT_COLUMNS} FROM lookup WHERE as_of_date = DATE '{SNAPSHOT_DATES[0]}'", "lookup"
        ),
        "feed_rejects": """SELECT ['status', 'empty', 'broken'][1 + s_suppkey % 7] AS reason, count(*) AS "lines"
            FROM supplier WHERE s_suppkey % 7 < 3 GROUP BY 1""",
        "ingest_rejects": """SELECT job, CASE s_suppkey % 7 WHEN 0 THEN 'broken' WHEN 1 THEN damage ELSE 'stored' END AS reason,
                count(*) AS "lines"
            FROM supplier, (VALUES ('prices_backfill', 'status'), ('rsi_backfill', 'status'), ('income_statements', 'empty'))
                AS jobs(job, damage)
            GROUP BY ALL""",
        "feed_reference": "SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name, true AS active FROM supplier",
        "delete_insert_merge": bars(
            """SELECT ticker, date, close, CASE WHEN date >= DATE '2000-12-01' THEN 2 ELSE 1 END AS version
            FROM bars"""
        ),
        "overwrite_date_range": bars(
            """SELECT ticker, date, close,
                CASE WHEN date BETWEEN DATE '2000-01-01' AND DATE '2000-06-30' THEN 2 ELSE 1 END AS version
            FROM bars WHERE volume >= 40 OR date NOT BETWEEN DATE '2000-01-01' AND DATE '2000-06-30'"""
        ),
        "overwrite_partition": bars(
            """SELECT ticker, date, close, CASE WHEN date = DATE '2000-06-15' THEN 2 ELSE 1 END AS version
            FROM bars WHERE volume >= 40 OR date <> DATE '2000-06-15'"""
        ),
        "sem_technical": select(
            f"SELECT ticker, {TECHNICAL} FROM technical_scores GROUP BY ticker", "technical_scores"
        ),
        "sem_technical_monthly": select(
            f"SELECT month AS date, {TECHNICAL} FROM (SELECT *, CAST(date_trunc('month', date) AS DATE) AS month "
            "FROM technical_scores) GROUP BY month",
            "technical_scores",
        ),
        "rollup_technical": select(
            " UNION ALL ".join(
                f"""SELECT date, {TECHNICAL}, '{grain}' AS grain FROM (
                    SELECT * REPLACE (CAST(date_trunc('{grain}', date) AS DATE) AS date) FROM technical_scores) GROUP BY date"""
                for grain in ("month", "quarter", "year")
            ),
            "technical_scores",
        ),
        "rollup_price": select(
            """SELECT sector, CAST(NULL AS VARCHAR) AS ticker, CAST(NULL AS DATE) AS date, max(close) AS latest_close,
                min(drawdown_pct) AS max_drawdown, count(DISTINCT ticker) AS ticker_count, count(*) AS observation_count,
                round(avg(CASE WHEN daily_return > 0 THEN 1 WHEN daily_return <= 0 THEN 0 END), 6) AS positive_return_rate
            FROM performance GROUP BY sector
            UNION ALL
            SELECT NULL, ticker, CAST(date_trunc('year', date) AS DATE), max(close), min(drawdown_pct), count(DISTINCT ticker),
                count(*), round(avg(CASE WHEN daily_return > 0 THEN 1 WHEN daily_return <= 0 THEN 0 END), 6)
            FROM performance GROUP BY ALL""",
            "performance",
        ),
        "sem_fundamental": select(
            f"SELECT fiscal_year, {FUNDAMENTAL} FROM fundamental_scores GROUP BY fiscal_year", "fundamental_scores"
        ),
        "sem_composite": select(
            f"SELECT fiscal_year, {COMPOSITE}, count(*) AS observation_count FROM composite GROUP BY fiscal_year",
            "composite",
        ),
        "sem_industry": select(
            f"""SELECT sector, industry, {COMPOSITE}, count(DISTINCT sector) AS sector_count
            FROM industry GROUP BY sector, industry""",
            "industry",
        ),
        "sem_price": select(f"SELECT sector, {PRICE} FROM performance GROUP BY sector", "performance"),
        "sem_dimensions_only": select("SELECT DISTINCT sector, fiscal_year FROM industry", "industry"),
        "g1_strong_now": select(
            """SELECT ticker, company_name, sector, technical_date, fiscal_year, composite_score_equal FROM industry
            WHERE technical_date = (SELECT max(technical_date) FROM industry)
            ORDER BY composite_score_equal DESC NULLS LAST, ticker, fiscal_year LIMIT 20""",
            "industry",
        ),
        "g2_ticker_performance": select(
            """SELECT ticker, date, close, daily_return, cumulative_return, rolling_1y_return, drawdown_pct
            FROM performance WHERE ticker = '7'""",
            "performance",
        ),
        "g3_best_in_sector": select(
            f"""SELECT ticker, company_name, industry, technical_date, fiscal_year, composite_score_equal
            FROM industry WHERE {latest("industry", "technical_date")} AND sector = 'ASIA'
            ORDER BY composite_score_equal DESC NULLS LAST, ticker, fiscal_year LIMIT 10""",
            "industry",
        ),
        "g4_strong_fundamentals": select(
            """SELECT ticker, date, fiscal_year, fundamentals_score, profitability_score, growth_score
            FROM fundamental_scores ORDER BY fundamentals_score DESC, ticker, fiscal_year LIMIT 20""",
            "fundamental_scores",
        ),
        "g5_momentum_leaders": select(
            f"""SELECT ticker, date, momentum_score, technical_score FROM technical_scores
            WHERE {latest("technical_scores", "date")}
            ORDER BY momentum_score DESC, technical_score DESC, ticker LIMIT 20""",
            "technical_scores",
        ),
        "g6_risk_adjusted": select(
            """SELECT ticker, sector,
                round(avg(rolling_1y_return / nullif(rolling_30d_volatility, 0)), 6) AS avg_risk_adjusted_return,
                round(avg(rolling_1y_return / nullif(abs(drawdown_pct), 0)), 6) AS avg_return_to_drawdown,
                round(avg(rolling_30d_volatility), 6) AS avg_volatility_30d, count(*) AS observation_count
            FROM performance GROUP BY ticker, sector
            ORDER BY avg(rolling_1y_return / nullif(rolling_30d_volatility, 0)) DESC NULLS LAST, ticker LIMIT 20""",
            "performance",
        ),
        "g7_sector_rotation": select(
            """SELECT sector, technical_date, round(mean, 6) AS avg_composite_equal, ticker_count,
                round(mean - lag(mean) OVER (PARTITION BY sector ORDER BY technical_date), 6) AS change
            FROM (SELECT sector, CAST(date_trunc('month', technical_date) AS DATE) AS technical_date,
                    sum(CAST(round(composite_score_equal * 10) AS BIGINT)) / 1e1
                        / nullif(count(composite_score_equal), 0) AS mean,
                    count(DISTINCT ticker) AS ticker_count
                FROM industry GROUP BY 1, 2)""",
            "industry",
        ),
        "g8_rank_by_composite": select(
            f"""SELECT ticker, technical_date, fiscal_year, composite_score_technical_bias FROM composite
            WHERE {latest("composite", "technical_date")}
            ORDER BY composite_score_technical_bias DESC NULLS LAST, ticker, fiscal_year LIMIT 20""",
            "composite",
        ),
        "g9_near_high": select(
            f"""SELECT ticker, company_name, sector, date, close, drawdown_pct FROM performance
            WHERE {latest("performance", "date")} AND drawdown_pct >= -0.9""",
            "performance",
        ),
        "g10_most_volatile": select(
            """SELECT ticker, round(avg(rolling_30d_volatility), 6) AS avg_volatility_30d,
                min(drawdown_pct) AS max_drawdown
            FROM performance GROUP BY ticker ORDER BY avg(rolling_30d_volatility) DESC NULLS LAST, ticker LIMIT 20""",
            "performance",
        ),
        "g11_momentum": select(
            """SELECT ticker, date, rolling_30d_return, rolling_90d_return FROM returns
            WHERE rolling_30d_return > 0.1e0 AND rolling_90d_return > 0.1e0""",
            "returns",
        ),
        "g12_mean_reversion": select(
            """SELECT ticker, date, rolling_30d_return, rolling_1y_return FROM returns
            WHERE rolling_30d_return < -0.1e0 AND rolling_1y_return > 0.1e0""",
            "returns",
        ),
        "g13_regime_shift": select(
            """SELECT ticker, date, rolling_30d_return, rolling_1y_return FROM returns
            WHERE (rolling_30d_return > 0 AND rolling_1y_return < 0)
                OR (rolling_30d_return < 0 AND rolling_1y_return > 0)""",
            "returns",
        ),
        "g14_risk_off": select(
            f"""SELECT ticker, date, {volatility}, drawdown_pct FROM returns
            WHERE returns.rolling_30d_volatility > 0.5e0 AND drawdown_pct < -0.3e0""",
            "returns",
        ),
        "top_technical": select(
            """SELECT ticker, date, trend_score, momentum_score, macd_score, price_action_score, technical_score
            FROM technical_scores WHERE date = (SELECT max(date) FROM technical_scores)
            ORDER BY technical_score DESC, ticker LIMIT 20""",
            "technical_scores",
        ),
        "q_not_null": select("SELECT ticker, date FROM points WHERE rsi_value IS NULL", "points"),
        "q_unique": select('SELECT ticker, count(*) AS "rows" FROM lookup GROUP BY ticker HAVING count(*) > 1', "lookup"),
        "q_composite_grain": select(
            """SELECT ticker, technical_date, count(*) AS "rows" FROM composite
            GROUP BY ticker, technical_date HAVING count(*) > 1""",
            "composite",
        ),
        "q_score_range": select(
            """SELECT ticker, date, technical_score FROM technical_scores
            WHERE technical_score NOT BETWEEN 0 AND 60""",
            "technical_scores",
        ),
        "q_fundamentals_range": select(
            """SELECT ticker, date, fundamentals_score FROM fundamental_scores
            WHERE fundamentals_score IS NULL OR fundamentals_score NOT BETWEEN 30 AND 60""",
            "fundamental_scores",
        ),
    }


ORACLE_SQL = _queries()
