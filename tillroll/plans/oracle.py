"""The same answers in plain SQL, written from the definitions rather than from the
Spark plans: joins to lists of existing keys, windows over lines, subset joins."""

from __future__ import annotations

import re

from tillroll.plans.catalog import (
    LONG_MIN_SUPPORT,
    MIN_LIFT,
    MIN_SUPPORT,
    PRODUCT_MIN_SUPPORT,
    RISK_EDGES,
    SEGMENT,
)
from tillroll.schema import CATEGORY_COLUMNS, ORDER_COLUMNS

LINES = """
lines AS (
  SELECT o_orderpriority AS order_priority,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
         CAST(l_tax * 100 AS DECIMAL(10,2)) AS shipping_cost,
         o_custkey AS customer_id, c_name AS customer_name, l_returnflag AS ship_mode,
         c_mktsegment AS customer_segment, p_type AS product_category,
         p_brand AS product_sub_category, CAST(p_size AS VARCHAR) AS product_container,
         l_partkey AS product_name, r_name AS region, n_name AS state_or_province,
         CAST(NULL AS VARCHAR) AS city, CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_shipdate AS DATE) AS ship_date, CAST(l_quantity AS INTEGER) AS quantity,
         l_orderkey AS order_id, l_linestatus AS line_status,
         CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER) AS sales_amount,
         CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS INTEGER)
           + CAST(l_tax * 100 AS DECIMAL(10,2)) AS sales_amount_with_shipping,
         CAST(year(o_orderdate) AS BIGINT) AS y
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""


def _raw_column(c: str) -> str:
    if c in ("order_date", "ship_date"):
        text = (
            f"CASE WHEN line_status = 'O' THEN strftime({c}, '%-m/%-d/%Y')"
            f" ELSE strftime({c}, '%d/%m/%Y') END"
        )
    elif c == "unit_price":
        text = "CASE WHEN product_container = '7' THEN 'n/a' ELSE CAST(unit_price AS VARCHAR) END"
    elif c == "quantity":
        text = (
            "CASE WHEN quantity <> 13 THEN CAST(quantity AS VARCHAR)"
            " || CASE WHEN product_container = '11' THEN '.00001' ELSE '' END END"
        )
    else:
        text = f"CAST({c} AS VARCHAR)"
    return f"{text} AS {c}"


RAW = (
    LINES
    + f""",
once AS (SELECT {', '.join(_raw_column(c) for c in ORDER_COLUMNS)} FROM lines),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE ship_mode = 'R')"""
)


def _month_first(c: str) -> str:
    return (
        f"CAST(coalesce(try_strptime({c}, '%m/%d/%Y'), try_strptime({c}, '%d/%m/%Y')) AS DATE)"
    )


def _text(date: str) -> str:
    return f"strftime({date}, '%Y-%m-%d')"


ALL_TEXT = ", ".join(ORDER_COLUMNS)
# A whole number as it is written, with nothing but zeros behind the point.
WHOLE = r"CASE WHEN regexp_full_match(quantity, '[0-9]+([.]0*)?') THEN TRY_CAST(quantity AS INTEGER) END"
_PARSED_COLUMNS = ", ".join(
    f"{_month_first(c)} AS {c}" if c.endswith("_date") else c for c in ORDER_COLUMNS
)
CLEAN = (
    RAW
    + f""",
dated AS (SELECT {_PARSED_COLUMNS} FROM raw),
deduped AS (SELECT DISTINCT * FROM dated),
typed AS (
  SELECT * REPLACE (TRY_CAST(unit_price AS DECIMAL(10,2)) AS unit_price,
                    TRY_CAST(shipping_cost AS DECIMAL(10,2)) AS shipping_cost,
                    {WHOLE} AS quantity)
  FROM deduped),
clean AS (
  SELECT *, unit_price * quantity AS sales_amount,
         unit_price * quantity + shipping_cost AS sales_amount_with_shipping
  FROM typed)"""
)


def _with(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"


# --- ingest and cleaning ---------------------------------------------------------------


def _ingest() -> dict[str, str]:
    o: dict[str, str] = {}
    o["load_orders"] = _with(RAW, f"SELECT {ALL_TEXT} FROM raw")
    broken = """customer_name || chr(10) || '"' || city || '",' || chr(10) || chr(10) || customer_id"""
    o["load_orders_quoted_breaks"] = _with(RAW, f"SELECT * REPLACE ({broken} AS customer_name) FROM (SELECT {ALL_TEXT} FROM raw)")
    o["normalize_columns"] = o["load_orders"]
    def parsed(source: str, order: str, ship: str) -> str:
        return _with(
            RAW,
            f"""
SELECT order_id, product_name, order_date AS order_date_text, ship_date AS ship_date_text,
       {_text(order)} AS order_date, {_text(ship)} AS ship_date
FROM {source}""",
        )

    o["parse_order_dates_month_first_fallback"] = parsed(
        "raw", _month_first("order_date"), _month_first("ship_date")
    )
    o["parse_order_dates_day_first"] = parsed(
        "raw", "try_strptime(order_date, '%d/%m/%Y')", "try_strptime(ship_date, '%d/%m/%Y')"
    )
    o["parse_order_dates_year_first"] = parsed(
        f"(SELECT * REPLACE ({_text(_month_first('order_date'))} AS order_date) FROM raw)",
        "try_strptime(order_date, '%Y-%m-%d')",
        "try_strptime(ship_date, '%m/%d/%Y')",
    )
    number = "CAST(datediff('day', DATE '1970-01-01', {}) * CAST(86400000 AS BIGINT) AS VARCHAR)"
    shipped = number.format(_month_first("ship_date"))
    millis = (
        f"{number.format(_month_first('order_date'))} AS order_date,"
        f" CASE WHEN CAST(order_id AS BIGINT) % 97 = 0 THEN '{'9' * 20}' ELSE {shipped} END AS ship_date"
    )
    o["parse_order_dates_epoch_ms"] = parsed(
        f"(SELECT * REPLACE ({millis}) FROM raw)",
        "make_timestamp(CAST(order_date AS BIGINT) * 1000)",
        "make_timestamp(TRY_CAST(ship_date AS BIGINT) * 1000)",
    )
    dated = ", ".join(f"{_text(c)} AS {c}" if c.endswith("_date") else c for c in ORDER_COLUMNS)
    o["dedupe_orders"] = _with(CLEAN, f"SELECT {dated} FROM deduped")
    o["coerce_numerics"] = _with(
        RAW,
        """
SELECT order_id, product_name, CAST(TRY_CAST(unit_price AS DECIMAL(10,2)) AS DOUBLE) AS unit_price,
       CAST(TRY_CAST(shipping_cost AS DECIMAL(10,2)) AS DOUBLE) AS shipping_cost,
       CAST(_WHOLE_ AS BIGINT) AS quantity
FROM raw""".replace("_WHOLE_", WHOLE),
    )
    o["add_sales_amounts"] = _with(
        LINES,
        """
SELECT order_id, product_name, CAST(sales_amount AS DOUBLE) AS sales_amount,
       CAST(sales_amount_with_shipping AS DOUBLE) AS sales_amount_with_shipping
FROM lines""",
    )
    o["add_calendar"] = _with(
        LINES,
        f"""
SELECT order_id, product_name, {_text('order_date')} AS order_date, y AS order_year,
       monthname(order_date) AS order_month_name
FROM lines""",
    )
    domains = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, dense_rank() OVER (ORDER BY {c}) - 1 AS code,"
        f" count(*) AS n FROM lines WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in CATEGORY_COLUMNS
    )
    o["category_codes"] = _with(LINES, domains)
    numbers = {
        "unit_price": "CAST(unit_price AS DOUBLE)",
        "shipping_cost": "CAST(shipping_cost AS DOUBLE)",
        "quantity": "CAST(quantity AS BIGINT)",
        "sales_amount": "CAST(sales_amount AS DOUBLE)",
        "sales_amount_with_shipping": "CAST(sales_amount_with_shipping AS DOUBLE)",
    }
    clean_columns = ", ".join(
        f"{_text(c)} AS {c}" if c.endswith("_date") else f"{numbers.get(c, c)} AS {c}"
        for c in (*ORDER_COLUMNS, "sales_amount", "sales_amount_with_shipping")
    )
    o["clean_orders"] = _with(CLEAN, f"SELECT {clean_columns} FROM clean")

    checks = [
        "SELECT 'rows_in' AS metric, CAST(NULL AS VARCHAR) AS \"column\", (SELECT count(*) FROM raw) AS value",
        "SELECT 'rows_out', NULL, (SELECT count(*) FROM clean)",
        "SELECT 'duplicate_rows', NULL, (SELECT count(*) FROM dated) - (SELECT count(*) FROM deduped)",
        "SELECT 'columns', NULL, 20",
    ]
    readings = [("unparsed_dates", c, _month_first(c)) for c in ("order_date", "ship_date")]
    readings += [
        ("failed_numbers", "unit_price", "TRY_CAST(unit_price AS DECIMAL(10,2))"),
        ("failed_numbers", "shipping_cost", "TRY_CAST(shipping_cost AS DECIMAL(10,2))"),
        ("failed_numbers", "quantity", WHOLE),
    ]
    checks += [
        f"SELECT '{metric}', '{c}', (SELECT count(*) FROM raw WHERE {c} <> '' AND {read} IS NULL)"
        for metric, c, read in readings
    ]
    named = ", ".join(f"CASE WHEN {c} <> '' AND {read} IS NULL THEN '{c}' END" for _, c, read in readings)
    o["rejected_rows"] = _with(
        CLEAN,
        f"""
SELECT * FROM (SELECT order_id, product_name, concat_ws(',', {named}) AS rejected_for FROM raw)
WHERE rejected_for <> ''""",
    )
    checks += [
        f"SELECT 'non_null', '{c}', (SELECT count({c}) FROM clean)"
        for c in (*ORDER_COLUMNS, "sales_amount", "sales_amount_with_shipping")
    ]
    o["quality_report"] = _with(CLEAN, "\nUNION ALL\n".join(checks))
    o["profile_numeric"] = _with(
        LINES,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,"
            f" round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,"
            + ",".join(
                f" round(quantile_cont(CAST({c} AS DOUBLE), {p}), 6) AS {name}"
                for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))
            )
            + f", CAST(max({c}) AS DOUBLE) AS max FROM lines"
            for c in ("unit_price", "shipping_cost", "quantity")
        ),
    )
    o["profile_text"] = _with(
        RAW,
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS \"column\", CAST(coalesce(sum(n), 0) AS BIGINT) AS count, count(*) AS \"unique\","
            f" first(value ORDER BY n DESC, value) AS top, max(n) AS freq"
            f" FROM (SELECT {c} AS value, count(*) AS n FROM raw WHERE {c} IS NOT NULL GROUP BY {c})"
            for c in ORDER_COLUMNS
        ),
    )
    return o


# --- growth ----------------------------------------------------------------------------

YEARLY = (
    LINES
    + """,
yearly AS (SELECT y AS year, CAST(sum(sales_amount) AS DOUBLE) AS total_sales FROM lines GROUP BY y),
growth AS (
  SELECT year, total_sales, lag(total_sales) OVER (ORDER BY year) AS lagged_sales,
         (total_sales / nullif(lag(total_sales) OVER (ORDER BY year), 0) - 1) * 100 AS yoy_pct
  FROM yearly),
ends AS (
  SELECT (SELECT total_sales FROM yearly WHERE year = (SELECT min(year) FROM yearly)) AS first_year_sales,
         (SELECT total_sales FROM yearly WHERE year = (SELECT max(year) FROM yearly)) AS last_year_sales,
         (SELECT max(year) - min(year) FROM yearly) AS number_of_years),
trend AS (
  SELECT *, pow(last_year_sales / nullif(first_year_sales, 0),
                CAST(1 AS DOUBLE) / nullif(number_of_years, 0)) - 1 AS cagr
  FROM ends)"""
)


def _since(year: int | None) -> str:
    """Each line with the first year of its product and of its customer, and the year asked for."""
    at = "max(y) OVER ()" if year is None else f"CAST({year} AS BIGINT)"
    return (
        LINES
        + f""",
since AS (
  SELECT *, {at} AS asked, min(y) OVER (PARTITION BY product_name) AS product_since,
         min(y) OVER (PARTITION BY customer_id) AS customer_since
  FROM lines)"""
    )


def _growth() -> dict[str, str]:
    o: dict[str, str] = {}
    o["yearly_sales_growth"] = _with(
        YEARLY,
        """
SELECT year, round(total_sales, 6) AS total_sales, round(lagged_sales, 6) AS lagged_sales,
       round(yoy_pct, 6) AS yoy_pct
FROM growth""",
    )
    o["sales_cagr"] = _with(
        YEARLY,
        """
SELECT round(first_year_sales, 6) AS first_year_sales, round(last_year_sales, 6) AS last_year_sales,
       number_of_years, round(cagr, 6) AS cagr
FROM trend""",
    )
    o["growth_signal"] = _with(
        YEARLY,
        """
SELECT year, round(yoy_pct, 6) AS yoy_pct, round(prev_yoy_pct, 6) AS prev_yoy_pct,
       round(cagr * 100, 6) AS cagr_pct,
       CASE WHEN yoy_pct IS NULL THEN NULL
            WHEN yoy_pct <= cagr * 100 THEN 'below_trend'
            WHEN yoy_pct < prev_yoy_pct THEN 'slowing_above_trend'
            ELSE 'accelerating' END AS signal
FROM (SELECT *, lag(yoy_pct) OVER (ORDER BY year) AS prev_yoy_pct FROM growth), trend""",
    )
    for suffix, year in (("", None), ("_1996", 1996), ("_2001", 2001)):
        base = _since(year)
        for what in ("product", "customer"):
            sales = f"CAST(sum(sales_amount) FILTER (WHERE {what}_since < asked AND y = {{}}) AS DOUBLE)"
            o[f"existing_{what}_growth{suffix}"] = _with(
                base + f", sums AS (SELECT {sales.format('asked')} AS now, {sales.format('asked - 1')} AS before FROM since)",
                f"""
SELECT round(now, 6) AS total_sales_excluding_new_{what}s,
       round((now / nullif(before, 0) - 1) * 100, 6) AS yoy_pct
FROM sums""",
            )

        def quantity(*conditions: str) -> str:
            return f"CAST(coalesce(sum(quantity) FILTER (WHERE {' AND '.join(conditions)}), 0) AS BIGINT)"

        o[f"customer_demand{suffix}"] = _with(
            base,
            f"""
SELECT customer_id, y AS order_year, CAST(sum(quantity) AS BIGINT) AS total_quantity,
       {quantity('product_since < asked')} AS old_product_quantity,
       {quantity('product_since >= asked')} AS new_product_quantity
FROM since WHERE customer_since < asked GROUP BY customer_id, y""",
        )
        both_years = base + f""",
spent AS (
  SELECT customer_id, any_value(asked) AS asked,
         {quantity('y = asked - 1')} AS all_before, {quantity('y = asked')} AS all_now,
         {quantity('y = asked - 1', 'product_since < asked')} AS old_before,
         {quantity('y = asked', 'product_since < asked')} AS old_now
  FROM since GROUP BY customer_id
  HAVING bool_or(y = asked - 1) AND bool_or(y = asked))"""

        def demand_growth(growth: str) -> str:
            return _with(
                both_years,
                f"""
SELECT customer_id, asked - 1 AS last_year, all_before AS last_year_quantity,
       asked AS this_year, all_now AS this_year_quantity,
       {growth.format('CAST(all_now - all_before AS DOUBLE) / nullif(all_before, 0)')} AS total_quantity_growth,
       old_before AS quantity_old_products_last_year, old_now AS quantity_old_products_this_year,
       {growth.format('CAST(old_now - old_before AS DOUBLE) / nullif(old_before, 0)')} AS old_product_growth
FROM spent""",
            )

        o[f"customer_demand_growth{suffix}"] = demand_growth("round({} * 100, 6)")
        if year == 1996:
            o["customer_demand_growth_integer_1996"] = demand_growth("CAST(trunc({}) AS BIGINT) * 100")
        o[f"existing_customer_sales_growth{suffix}"] = _with(
            base
            + """,
spent AS (
  SELECT customer_id, CAST(sum(sales_amount) FILTER (WHERE y = asked - 1) AS DOUBLE) AS before,
         CAST(sum(sales_amount) FILTER (WHERE y = asked) AS DOUBLE) AS now
  FROM since GROUP BY customer_id
  HAVING bool_or(y = asked - 1) AND bool_or(y = asked))""",
            """
SELECT customer_id, round(before, 6) AS last_year_sales, round(now, 6) AS this_year_sales,
       round((now - before) / nullif(before, 0) * 100, 6) AS sales_growth
FROM spent""",
        )
        o[f"revenue_by_cohort{suffix}"] = _with(
            base
            + """,
marked AS (
  SELECT CASE WHEN customer_since < asked THEN 'existing' ELSE 'new' END AS cc,
         CASE WHEN product_since < asked THEN 'old' ELSE 'new' END AS pc,
         CASE WHEN y = asked - 1 THEN sales_amount ELSE 0 END AS before,
         CASE WHEN y = asked THEN sales_amount ELSE 0 END AS now
  FROM since WHERE y IN (asked - 1, asked)),
cells AS (
  SELECT coalesce(cc, 'all') AS customer_cohort, coalesce(pc, 'all') AS product_cohort,
         sum(before) AS before, sum(now) AS now
  FROM marked GROUP BY GROUPING SETS ((cc, pc), (cc), (pc), ()))""",
            """
SELECT customer_cohort, product_cohort, CAST(before AS DOUBLE) AS last_year_sales,
       CAST(now AS DOUBLE) AS this_year_sales, CAST(now - before AS DOUBLE) AS change,
       round(CAST(now - before AS DOUBLE) / nullif((SELECT CAST(sum(now) - sum(before) AS DOUBLE) FROM marked), 0) * 100, 6)
         AS share_of_change_pct
FROM cells""",
        )
    return o


# --- customers -------------------------------------------------------------------------

CUSTOMERS = (
    LINES
    + """,
placed AS (
  SELECT *, row_number() OVER w AS place,
         order_date - lag(order_date) OVER w AS gap
  FROM lines
  WINDOW w AS (PARTITION BY customer_id ORDER BY order_date, order_id, product_name, quantity, unit_price)),
per AS (
  SELECT customer_id, min(order_date) AS first_date, max(order_date) AS last_date,
         count(*) AS frequency, CAST(sum(sales_amount_with_shipping) AS DOUBLE) AS monetary,
         CAST(sum(quantity) AS BIGINT) AS total_quantity,
         CAST(max(CASE WHEN place = 1 THEN sales_amount END) AS DOUBLE) AS first_order_revenue,
         CASE WHEN count(*) = 1 THEN 0 ELSE CAST(floor(avg(gap)) AS BIGINT) END AS avg_days_between_orders,
         CAST(arg_min(quantity, place) FILTER (WHERE quantity IS NOT NULL) AS BIGINT) AS first_order_quantity
  FROM placed GROUP BY customer_id),
tops AS (SELECT max(last_date) AS top_date, max(frequency) AS top_frequency FROM per),
metrics AS (
  SELECT customer_id, first_date, last_date,
         CAST(trunc((last_date - first_date) / CAST(365 AS DOUBLE)) AS BIGINT) AS customer_tenure,
         CAST(top_date - last_date AS BIGINT) AS recency, frequency, monetary, total_quantity,
         first_order_revenue, avg_days_between_orders, first_order_quantity,
         monetary / frequency AS average_order_value,
         monetary * CAST(trunc((last_date - first_date) / CAST(365 AS DOUBLE)) AS BIGINT) AS customer_lifetime_value,
         CASE WHEN frequency > 1 THEN CAST(1 AS BIGINT) ELSE 0 END AS repeat_purchase_customer,
         CAST(frequency AS DOUBLE) / top_frequency AS relative_repeat_rate,
         (top_date - last_date) / CAST(365 AS DOUBLE) AS churn_likelihood,
         CAST(total_quantity AS DOUBLE) / frequency AS average_basket_size
  FROM per, tops),
global_metrics AS (
  SELECT customer_id, first_date, last_date,
         CAST(trunc((top_date - first_date) / CAST(365 AS DOUBLE)) AS BIGINT) AS customer_tenure,
         CAST(top_date - last_date AS BIGINT) AS recency, frequency, monetary,
         monetary / frequency AS average_purchase_value,
         monetary * CAST(trunc((top_date - first_date) / CAST(365 AS DOUBLE)) AS BIGINT) AS customer_lifetime_value
  FROM per, tops)"""
)


def _segment(table: str) -> str:
    def at(p: float) -> str:
        return f"(SELECT quantile_cont(customer_lifetime_value, {p}) FROM {table})"

    return (
        f"CASE WHEN customer_lifetime_value <= {at(0.25)} THEN 'Low Value'"
        f" WHEN customer_lifetime_value <= {at(0.75)} THEN 'Medium Value' ELSE 'High Value' END"
    )


_METRIC_COLUMNS = f"""customer_id, {_text('first_date')} AS first_date, {_text('last_date')} AS last_date,
       customer_tenure, recency, frequency, round(monetary, 6) AS monetary, total_quantity,
       round(first_order_revenue, 6) AS first_order_revenue, avg_days_between_orders, first_order_quantity,
       round(average_order_value, 6) AS average_order_value,
       round(customer_lifetime_value, 6) AS customer_lifetime_value, repeat_purchase_customer,
       round(relative_repeat_rate, 6) AS relative_repeat_rate, round(churn_likelihood, 6) AS churn_likelihood,
       round(average_basket_size, 6) AS average_basket_size"""
_GLOBAL_COLUMNS = f"""customer_id, {_text('first_date')} AS first_date, {_text('last_date')} AS last_date,
       customer_tenure, recency, frequency, round(monetary, 6) AS monetary,
       round(average_purchase_value, 6) AS average_purchase_value,
       round(customer_lifetime_value, 6) AS customer_lifetime_value"""


def _risk(table: str, value: str, year: int | None) -> str:
    at = "(SELECT max(year(last_date)) FROM per)" if year is None else str(year)
    low, mid, high = RISK_EDGES[:3]
    return (
        CUSTOMERS
        + f""",
flags AS (
  SELECT customer_id, {value} AS v, year(first_date) < {at} AS past, year(first_date) = {at} AS fresh,
         year(first_date) < {at} AND year(last_date) = {at} AS retained
  FROM {table}),
binned AS (
  SELECT *, CASE WHEN fresh THEN 'New' WHEN NOT past OR v <= {low} THEN NULL
                 WHEN v <= {mid} THEN 'Low' WHEN v <= {high} THEN 'Med' ELSE 'High' END AS risk_level
  FROM flags),
final AS (SELECT * FROM binned WHERE (fresh OR retained) AND risk_level IS NOT NULL),
counts AS (
  SELECT risk_level, count(DISTINCT customer_id) AS n, avg(v) AS aov FROM final GROUP BY risk_level),
kept AS (SELECT risk_level, count(DISTINCT customer_id) AS n FROM binned WHERE retained GROUP BY risk_level),
pasts AS (SELECT risk_level, count(DISTINCT customer_id) AS n FROM binned WHERE past GROUP BY risk_level),
rates AS (
  SELECT c.risk_level, c.n, c.aov, coalesce(CAST(k.n AS DOUBLE) / pasts.n, 0) * 100 AS retention_pct
  FROM counts c LEFT JOIN kept k ON c.risk_level = k.risk_level
  LEFT JOIN pasts ON c.risk_level = pasts.risk_level),
budget AS (
  SELECT risk_level, n AS number_of_customers, aov, retention_pct, n * (retention_pct / 100) * aov AS at_risk,
         coalesce(n * (retention_pct / 100) * aov
                  / nullif((SELECT sum(n * (retention_pct / 100) * aov) FROM rates), 0), 0) * 100 AS risk_allocation_pct
  FROM rates)"""
    )


_BUDGET_COLUMNS = """risk_level, number_of_customers, round(aov, 6) AS aov,
       round(retention_pct, 6) AS retention_pct, round(at_risk, 6) AS at_risk,
       round(risk_allocation_pct, 6) AS risk_allocation_pct"""


_REPORT_COLUMNS = """risk_level, number_of_customers, format('${:,.2f}', aov) AS aov,
       format('{:.2f}%', retention_pct) AS retention_pct, format('${:,.2f}', at_risk) AS at_risk,
       format('{:.2f}%', risk_allocation_pct) AS risk_allocation_pct"""


def _customers() -> dict[str, str]:
    o: dict[str, str] = {}
    o["customer_metrics"] = _with(CUSTOMERS, f"SELECT {_METRIC_COLUMNS}\nFROM metrics")
    o["customer_metrics_by_order_key"] = _with(
        CUSTOMERS.replace("ORDER BY order_date, order_id,", "ORDER BY -order_id,"), f"SELECT {_METRIC_COLUMNS}\nFROM metrics"
    )
    o["clv_segments"] = _with(
        CUSTOMERS, f"SELECT {_METRIC_COLUMNS},\n       {_segment('metrics')} AS clv_segment\nFROM metrics"
    )
    o["customer_metrics_global_tenure"] = _with(
        CUSTOMERS, f"SELECT {_GLOBAL_COLUMNS}\nFROM global_metrics"
    )
    o["clv_segments_global_tenure"] = _with(
        CUSTOMERS,
        f"SELECT {_GLOBAL_COLUMNS},\n       {_segment('global_metrics')} AS clv_segment\nFROM global_metrics",
    )
    for fmt in ("parquet", "csv"):
        o[f"write_output_{fmt}"] = _with(
            CUSTOMERS,
            f"SELECT customer_id, frequency, monetary, {_segment('metrics')} AS clv_segment\nFROM metrics",
        )
    for year in (1996, 2001):
        base = _risk("metrics", "average_order_value", year)
        flags = "customer_id, CAST(past AS BIGINT) AS is_past, CAST(fresh AS BIGINT) AS is_new, CAST(retained AS BIGINT) AS is_retained"
        o[f"customer_lifecycle_{year}"] = _with(base, f"SELECT {flags} FROM flags")
        o[f"risk_levels_{year}"] = _with(base, f"SELECT {flags}, risk_level FROM binned")
        o[f"risk_allocation_{year}"] = _with(base, f"SELECT {_BUDGET_COLUMNS} FROM budget")
    o["risk_allocation"] = _with(
        _risk("metrics", "average_order_value", None), f"SELECT {_BUDGET_COLUMNS} FROM budget"
    )
    o["risk_allocation_global_tenure"] = _with(
        _risk("global_metrics", "average_purchase_value", 2001),
        f"SELECT {_BUDGET_COLUMNS} FROM budget",
    )
    o["risk_allocation_report"] = _with(
        _risk("metrics", "average_order_value", 2001),
        f"SELECT {_REPORT_COLUMNS}\nFROM budget",
    )
    return o


# --- products --------------------------------------------------------------------------

PRODUCTS = (
    LINES
    + """,
by_year AS (
  SELECT product_name AS product, y AS year, coalesce(sum(sales_amount_with_shipping), 0) AS sales
  FROM lines GROUP BY product_name, y),
spans AS (SELECT product, min(year) AS first_year, max(year) AS last_year FROM by_year GROUP BY product),
growth AS (
  SELECT s.product, first_year, last_year, CAST(a.sales AS DOUBLE) AS starting_value,
         CAST(b.sales AS DOUBLE) AS ending_value,
         CASE WHEN first_year = last_year OR a.sales = 0 THEN 0
              ELSE pow(CAST(b.sales AS DOUBLE) / nullif(CAST(a.sales AS DOUBLE), 0),
                       CAST(1 AS DOUBLE) / nullif(last_year - first_year, 0)) - 1 END AS cagr
  FROM spans s JOIN by_year a ON s.product = a.product AND s.first_year = a.year
  JOIN by_year b ON s.product = b.product AND s.last_year = b.year),
totals AS (SELECT product, CAST(sum(sales) AS DOUBLE) AS sales FROM by_year GROUP BY product),
shares AS (
  SELECT product, sales, sales / (SELECT CAST(sum(sales) AS DOUBLE) FROM by_year) * 100 AS market_share
  FROM totals),
relative AS (
  SELECT *, market_share / (SELECT max(market_share) FROM shares) AS relative_market_share FROM shares),
matrix AS (
  SELECT r.*, g.cagr, (SELECT (min(cagr) + max(cagr)) / 2 FROM growth) AS mid
  FROM relative r JOIN growth g ON r.product = g.product),
classed AS (
  SELECT *, CASE WHEN relative_market_share > 0.5 AND cagr > mid THEN 'Star'
                 WHEN relative_market_share > 0.5 AND cagr <= mid THEN 'Cash Cow'
                 WHEN relative_market_share <= 0.5 AND cagr > mid THEN 'Question Mark'
                 ELSE 'Dog' END AS category
  FROM matrix)"""
)
_SHARE_COLUMNS = """product, round(sales, 6) AS sales, round(market_share, 6) AS market_share,
       round(relative_market_share, 6) AS relative_market_share"""


def _products() -> dict[str, str]:
    return {
        "product_yearly_sales": _with(
            PRODUCTS, "SELECT product, year, CAST(sales AS DOUBLE) AS sales FROM by_year"
        ),
        "product_cagr": _with(
            PRODUCTS,
            "SELECT product, first_year, last_year, starting_value, ending_value, round(cagr, 6) AS cagr FROM growth",
        ),
        "product_market_share": _with(PRODUCTS, f"SELECT {_SHARE_COLUMNS}\nFROM relative"),
        "boston_matrix": _with(
            PRODUCTS, f"SELECT {_SHARE_COLUMNS}, round(cagr, 6) AS cagr, category\nFROM classed"
        ),
        "boston_matrix_quadrants": _with(
            PRODUCTS
            + ",\nexact AS (SELECT product_name AS product, sum(sales_amount_with_shipping) AS sales FROM lines GROUP BY product_name)",
            """
SELECT category, count(*) AS n_products, CAST(sum(e.sales) AS DOUBLE) AS sales, CAST(0.5 AS DOUBLE) AS share_threshold,
       round(max(mid), 6) AS cagr_mid, round((SELECT min(cagr) FROM growth), 6) AS cagr_min,
       round((SELECT max(cagr) FROM growth), 6) AS cagr_max
FROM classed JOIN exact e ON classed.product = e.product GROUP BY category""",
        ),
    }


# --- baskets ---------------------------------------------------------------------------


def _baskets_cte(min_support: float, max_len: int, item: str = "product_sub_category") -> str:
    sets = [
        "set1 AS (SELECT [item] AS items, count(*) AS n FROM baskets GROUP BY item"
        f" HAVING count(*) / CAST((SELECT total FROM size) AS DOUBLE) >= {min_support})"
    ]
    for k in range(2, max_len + 1):
        tables = ", ".join(f"baskets b{i}" for i in range(k))
        ordered = " AND ".join(
            f"b{i}.order_id = b{i + 1}.order_id AND b{i}.item < b{i + 1}.item" for i in range(k - 1)
        )
        items = ", ".join(f"b{i}.item" for i in range(k))
        sets.append(
            f"set{k} AS (SELECT [{items}] AS items, count(*) AS n FROM {tables} WHERE {ordered}"
            f" GROUP BY {items} HAVING count(*) / CAST((SELECT total FROM size) AS DOUBLE) >= {min_support})"
        )
    union = " UNION ALL ".join(f"SELECT * FROM set{k}" for k in range(1, max_len + 1))
    return (
        LINES
        + f""",
pairs AS (
  SELECT DISTINCT order_id, {item} AS item FROM lines WHERE {SEGMENT[0]} = '{SEGMENT[1]}'),
baskets AS (
  SELECT * FROM pairs
  WHERE order_id IN (SELECT order_id FROM pairs GROUP BY order_id HAVING count(*) > 1)),
size AS (SELECT count(DISTINCT order_id) AS total FROM baskets),
{', '.join(sets)},
itemsets AS (
  SELECT items, n, n / CAST((SELECT total FROM size) AS DOUBLE) AS support FROM ({union}))"""
    )


def _rules_cte(min_support: float, max_len: int, metric: str, threshold: float) -> str:
    return _baskets_cte(min_support, max_len) + _RULES.format(metric=metric, threshold=threshold)


def _any_length_cte() -> str:
    return (
        _baskets_cte(LONG_MIN_SUPPORT, 1).replace("itemsets AS (", "single_sets AS (")
        + """,
subsets AS (
  SELECT order_id, item AS last, [item] AS items FROM baskets
  UNION ALL
  SELECT s.order_id, b.item, list_append(s.items, b.item)
  FROM subsets s JOIN baskets b ON s.order_id = b.order_id AND b.item > s.last),
counted AS (
  SELECT items, count(*) AS n, count(*) / CAST((SELECT total FROM size) AS DOUBLE) AS support
  FROM subsets GROUP BY items)"""
    )


_RULES = """,
splits AS (
  SELECT i.items, i.support, a.items AS ants, a.support AS sa, c.items AS cons, c.support AS sc
  FROM itemsets i
  JOIN (SELECT items, unnest(items) AS probe, support FROM itemsets) a
    ON list_contains(i.items, a.probe) AND a.probe = a.items[1]
   AND len(a.items) < len(i.items) AND list_has_all(i.items, a.items)
  JOIN itemsets c ON c.items = list_filter(i.items, lambda x: NOT list_contains(a.items, x))),
measured AS (
  SELECT ants, cons, sa, sc, support, support / sa AS confidence, support / sa / sc AS lift,
         support - sa * sc AS leverage,
         CASE WHEN support / sa >= 1 THEN CAST('Infinity' AS DOUBLE)
              ELSE (1 - sc) / (1 - support / sa) END AS conviction
  FROM splits),
rules AS (SELECT * FROM measured WHERE {metric} >= {threshold}),
placed AS (
  SELECT ants[1] AS source, cons[1] AS target, lift,
         row_number() OVER (ORDER BY lift DESC, ants, cons) AS place
  FROM rules),
undirected AS (
  SELECT * FROM placed
  QUALIFY row_number() OVER (PARTITION BY least(source, target), greatest(source, target) ORDER BY place) = 1)"""


_ITEMSET_COLUMNS = "array_to_string(items, ',') AS items, n, round(support, 6) AS support"
_RULE_COLUMNS = """array_to_string(ants, ',') AS antecedents, array_to_string(cons, ',') AS consequents,
       round(sa, 6) AS antecedent_support, round(sc, 6) AS consequent_support, round(support, 6) AS support,
       round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(leverage, 6) AS leverage,
       round(conviction, 6) AS conviction"""


def _baskets() -> dict[str, str]:
    pairs = _rules_cte(MIN_SUPPORT, 2, "lift", MIN_LIFT)
    o = {
        "order_baskets": _with(_baskets_cte(MIN_SUPPORT, 1), "SELECT order_id, item FROM baskets"),
        "basket_arrays": _with(
            _baskets_cte(MIN_SUPPORT, 1),
            "SELECT order_id, string_agg(item, ',' ORDER BY item) AS items FROM baskets GROUP BY order_id",
        ),
        "frequent_itemsets": _with(
            _baskets_cte(MIN_SUPPORT, 2), f"SELECT {_ITEMSET_COLUMNS} FROM itemsets"
        ),
        "frequent_itemsets_max_len_3": _with(
            _baskets_cte(LONG_MIN_SUPPORT, 3), f"SELECT {_ITEMSET_COLUMNS} FROM itemsets"
        ),
        "frequent_itemsets_any_length": _with(
            "RECURSIVE" + _any_length_cte(),
            f"SELECT {_ITEMSET_COLUMNS} FROM counted WHERE support >= {LONG_MIN_SUPPORT}",
        ),
        "frequent_itemsets_products": _with(
            _baskets_cte(PRODUCT_MIN_SUPPORT, 2, "product_name"), f"SELECT {_ITEMSET_COLUMNS} FROM itemsets"
        ),
        "association_rules_any_length": _with(
            "RECURSIVE"
            + _any_length_cte()
            + f""",
itemsets AS (SELECT items, n, support FROM counted WHERE support >= {MIN_SUPPORT})"""
            + _RULES.format(metric="confidence", threshold=0.2),
            f"SELECT {_RULE_COLUMNS}\nFROM rules",
        ),
        "association_rules": _with(pairs, f"SELECT {_RULE_COLUMNS}\nFROM rules"),
        "association_rules_max_len_3": _with(
            _rules_cte(LONG_MIN_SUPPORT, 3, "confidence", 0.2), f"SELECT {_RULE_COLUMNS}\nFROM rules"
        ),
    }
    for suffix, edges in (("", "undirected"), ("_undirected", "undirected"), ("_directed", "placed")):
        o[f"association_edges{suffix}"] = _with(
            pairs,
            f"SELECT source, target, round(lift, 6) AS lift, format('Lift: {{:.2f}}', lift) AS title FROM {edges}",
        )
        o[f"association_nodes{suffix}"] = _with(
            pairs
            + f""",
ends AS (
  SELECT source AS item, place * 2 AS at, 'blue' AS color FROM placed
  UNION ALL SELECT target, place * 2 + 1, 'red' FROM placed),
touched AS (
  SELECT item, count(*) AS degree
  FROM (SELECT source AS item FROM {edges} UNION ALL SELECT target FROM {edges}) GROUP BY item)""",
            """
SELECT e.item, arg_min(e.color, e.at) AS color, max(t.degree) AS degree
FROM ends e JOIN touched t ON e.item = t.item GROUP BY e.item""",
        )
    return o


# --- job -------------------------------------------------------------------------------


def _daily_job() -> str:
    """The rows each output holds, counted from the cleaned lines."""
    low = RISK_EDGES[0]
    mid, high = RISK_EDGES[1:3]
    return _with(
        CLEAN
        + f""",
per AS (
  SELECT customer_id, year(min(order_date)) AS first_y, year(max(order_date)) AS last_y,
         CAST(coalesce(sum(sales_amount_with_shipping), 0) AS DOUBLE) / count(*) AS aov
  FROM clean GROUP BY customer_id),
levels AS (
  SELECT DISTINCT CASE WHEN first_y = top THEN 'New' WHEN aov <= {low} THEN NULL WHEN aov <= {mid} THEN 'Low'
                       WHEN aov <= {high} THEN 'Med' ELSE 'High' END AS risk_level
  FROM per, (SELECT max(last_y) AS top FROM per) WHERE last_y = top)""",
        """
SELECT 'cleaned_data' AS output, (SELECT count(*) FROM clean) AS rows
UNION ALL SELECT 'quality_report', 29
UNION ALL SELECT 'customer_metrics', (SELECT count(*) FROM per)
UNION ALL SELECT 'risk_budget', (SELECT count(*) FROM levels WHERE risk_level IS NOT NULL)
UNION ALL SELECT 'boston_matrix', (SELECT count(DISTINCT product_name) FROM clean WHERE order_date IS NOT NULL)""",
    )


def _daily_outputs() -> dict[str, str]:
    """The job's tables, from the cleaned lines instead of the lines."""
    cleaned = re.sub(r"\blines\b", "source_lines", CLEAN) + """,
lines AS (SELECT *, CAST(year(order_date) AS BIGINT) AS y FROM clean)"""

    def over_cleaned(ctes: str, query: str) -> str:
        assert LINES in ctes
        return _with(ctes.replace(LINES, cleaned), query)

    return {
        "daily_job_customer_metrics": over_cleaned(
            CUSTOMERS, f"SELECT {_METRIC_COLUMNS},\n       {_segment('metrics')} AS clv_segment\nFROM metrics"
        ),
        "daily_job_risk_budget": over_cleaned(
            _risk("metrics", "average_order_value", None), f"SELECT {_REPORT_COLUMNS}\nFROM budget"
        ),
        "daily_job_boston_matrix": over_cleaned(
            PRODUCTS.replace("FROM lines GROUP BY", "FROM lines WHERE y IS NOT NULL GROUP BY"),
            f"SELECT {_SHARE_COLUMNS}, round(cagr, 6) AS cagr, category\nFROM classed",
        ),
    }


def all_oracles() -> dict[str, str]:
    return {
        **_ingest(),
        **_growth(),
        **_customers(),
        **_products(),
        **_baskets(),
        "daily_job": _daily_job(),
        **_daily_outputs(),
    }
