"""Revenue growth and where it comes from. Amounts are without shipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.expressions import (
    as_double,
    change_pct,
    compound_rate,
    growth_pct,
    ratio,
    year_start,
)
from tillroll.functions.sharing import share


def _yearly(orders: DataFrame) -> DataFrame:
    return (
        orders.where(F.col("order_date").isNotNull())
        .groupBy(F.year("order_date").cast("bigint").alias("year"))
        .agg(as_double(F.sum("sales_amount")).alias("total_sales"))
    )


def yearly_sales_growth(orders: DataFrame) -> DataFrame:
    """``year, total_sales, lagged_sales, yoy_pct``; the lag is the previous year
    that has sales, which need not be ``year - 1``."""
    # The window sees one row per calendar year.
    lagged = F.lag("total_sales").over(Window.orderBy("year"))
    return (
        _yearly(orders)
        .withColumn("lagged_sales", lagged)
        .withColumn("yoy_pct", growth_pct(F.col("total_sales"), F.col("lagged_sales")))
    )


def sales_cagr(orders: DataFrame) -> DataFrame:
    """One row: ``first_year_sales, last_year_sales, number_of_years, cagr``."""
    return (
        _yearly(orders)
        .agg(
            F.min_by("total_sales", "year").alias("first_year_sales"),
            F.max_by("total_sales", "year").alias("last_year_sales"),
            (F.max("year") - F.min("year")).alias("number_of_years"),
        )
        .withColumn(
            "cagr",
            compound_rate(
                F.col("first_year_sales"), F.col("last_year_sales"), F.col("number_of_years")
            ),
        )
    )


def growth_signal(orders: DataFrame) -> DataFrame:
    """``year, yoy_pct, prev_yoy_pct, cagr_pct, signal``: is growth above its long-run
    rate, and is it speeding up?"""
    every_year = Window.orderBy("year").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    yoy, prev, trend = F.col("yoy_pct"), F.col("prev_yoy_pct"), F.col("cagr_pct")
    return (
        yearly_sales_growth(orders)
        .withColumn("prev_yoy_pct", F.lag("yoy_pct").over(Window.orderBy("year")))
        .withColumn(
            "cagr_pct",
            100
            * compound_rate(
                F.first("total_sales").over(every_year),
                F.last("total_sales").over(every_year),
                F.last("year").over(every_year) - F.first("year").over(every_year),
            ),
        )
        .select(
            "year",
            "yoy_pct",
            "prev_yoy_pct",
            "cagr_pct",
            F.when(yoy.isNull(), F.lit(None).cast("string"))
            .when((yoy > trend) & (yoy < prev), "slowing_above_trend")
            .when(yoy > trend, "accelerating")
            .otherwise("below_trend")
            .alias("signal"),
        )
    )


def _by_key_and_year(orders: DataFrame, key: str) -> DataFrame:
    """Sales and lines per key and calendar year, also of lines without the key."""
    return share(
        orders.where(F.col("order_date").isNotNull())
        .groupBy(key, F.year("order_date").alias("year"))
        .agg(F.sum("sales_amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    )


def _last_year(grouped: DataFrame, column: str = "year") -> Column:
    """The last year with orders, from rows already grouped: no further pass over the lines."""
    return grouped.agg(F.max(column).alias("as_of_year")).scalar()


def _growth_of_existing(
    orders: DataFrame, key: str, as_of_year: int | None, total_name: str
) -> DataFrame:
    """Revenue in the year from keys first seen earlier, against the year before.

    One aggregate per key holds the first sale and both years' sums, so no join back
    to the lines is needed and a hot key merges map-side. Without a given year, sums per
    key and year come first and tell the last year too.
    """
    if as_of_year is None:
        grouped = _by_key_and_year(orders, key)
        year, at, amount = _last_year(grouped), F.col("year"), F.col("amount")
        lines, now, before = grouped.where(F.col(key).isNotNull()), at == year, at == year - 1
        is_old = F.col("first_sale") < year
    else:
        this_year, next_year = year_start(as_of_year), year_start(as_of_year + 1)
        at, amount = F.col("order_date"), F.col("sales_amount")
        lines, now = orders.where(F.col(key).isNotNull() & (at < next_year)), at >= this_year
        before = (at >= year_start(as_of_year - 1)) & (at < this_year)
        is_old = F.col("first_sale") < this_year
    return (
        lines.groupBy(key)
        .agg(
            F.min(at).alias("first_sale"),
            F.sum(F.when(now, amount)).alias("this_year"),
            F.sum(F.when(before, amount)).alias("last_year"),
        )
        .where(is_old)
        .agg(F.sum("this_year").alias("this_year"), F.sum("last_year").alias("last_year"))
        .select(
            as_double(F.col("this_year")).alias(total_name),
            growth_pct(F.col("this_year"), F.col("last_year")).alias("yoy_pct"),
        )
    )


def existing_product_growth(orders: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """``total_sales_excluding_new_products, yoy_pct``."""
    return _growth_of_existing(
        orders, "product_name", as_of_year, "total_sales_excluding_new_products"
    )


def existing_customer_growth(orders: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """``total_sales_excluding_new_customers, yoy_pct``."""
    return _growth_of_existing(
        orders, "customer_id", as_of_year, "total_sales_excluding_new_customers"
    )


def _first_sales(orders: DataFrame, key: str) -> DataFrame:
    """First and last date per key, also of lines without the key."""
    return share(
        orders.where(F.col("order_date").isNotNull())
        .groupBy(key)
        .agg(F.min("order_date").alias("first_date"), F.max("order_date").alias("last_date"))
    )


def _year_of(as_of_year: int | None, first_sales: DataFrame) -> Column:
    if as_of_year is not None:
        return F.lit(as_of_year)
    return first_sales.agg(F.year(F.max("last_date")).alias("as_of_year")).scalar()


def _start(year: Column, as_of_year: int | None, offset: int = 0) -> Column:
    """1 January of ``year + offset``; a literal if the year is given, so it reaches the scan."""
    if as_of_year is not None:
        return year_start(as_of_year + offset)
    return F.make_date(year + offset, F.lit(1), F.lit(1))


def _with_newcomer_flags(lines: DataFrame, this_year: Column, **first_sales: DataFrame) -> DataFrame:
    """Adds ``new_<key>`` for each key: first seen in the analysis year or later.

    A key seen on a line before that year is no newcomer, so only the later lines are
    joined, and with the list of newcomers, which is shorter than the list of the
    others. A line without the key matches no existing one, so it counts as new.
    ``lines`` are dated.
    """
    date = F.col("order_date")
    before, since = lines.where(date < this_year), lines.where(date >= this_year)
    for key, dates in first_sales.items():
        newcomers = dates.where(F.col(key).isNotNull() & (F.col("first_date") >= this_year)).select(
            key, F.lit(True).alias("listed")
        )
        before = before.withColumn(f"new_{key}", F.col(key).isNull())
        since = (
            since.join(newcomers, key, "left")
            .withColumn(f"new_{key}", F.coalesce("listed", F.col(key).isNull()))
            .drop("listed")
        )
    return before.unionByName(since)


def customer_demand(orders: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """``customer_id, order_year, total_quantity, old_product_quantity,
    new_product_quantity`` of customers who bought before the analysis year."""
    products = _first_sales(orders, "product_name")
    year = _year_of(as_of_year, products)
    lines = orders.where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull()).select(
        "customer_id", "product_name", "order_date", "quantity"
    )
    flagged = _with_newcomer_flags(lines, _start(year, as_of_year), product_name=products)
    quantity, is_new = F.col("quantity").cast("bigint"), F.col("new_product_name")
    per_year = flagged.groupBy(
        "customer_id", F.year("order_date").cast("bigint").alias("order_year")
    ).agg(
        F.sum(quantity).alias("total_quantity"),
        F.sum(F.when(~is_new, quantity).otherwise(0)).alias("old_product_quantity"),
        F.sum(F.when(is_new, quantity).otherwise(0)).alias("new_product_quantity"),
    )
    # A customer's rows are one per calendar year by now, so the window is small and
    # tells the first year without another pass over the lines.
    first_year = F.min("order_year").over(Window.partitionBy("customer_id"))
    return (
        per_year.withColumn("first_year", first_year)
        .where(F.col("first_year") < year)
        .drop("first_year")
    )


def customer_demand_growth(
    orders: DataFrame, as_of_year: int | None = None, integer_division: bool = False
) -> DataFrame:
    """Quantities of the year and the year before, per customer who bought in both.

    Such a customer is an existing one by definition, so lines outside the two years
    are read only to date the products.
    """
    products = _first_sales(orders, "product_name")
    year = _year_of(as_of_year, products)
    this_year = _start(year, as_of_year)
    date = F.col("order_date")
    lines = orders.where(
        F.col("customer_id").isNotNull()
        & (date >= _start(year, as_of_year, -1))
        & (date < _start(year, as_of_year, 1))
    ).select("customer_id", "product_name", "order_date", "quantity")
    flagged = _with_newcomer_flags(lines, this_year, product_name=products)

    is_now = date >= this_year
    quantity = F.col("quantity").cast("bigint")
    old_quantity = F.when(~F.col("new_product_name"), quantity).otherwise(0)
    return (
        flagged.groupBy("customer_id")
        .agg(
            F.count_if(~is_now).alias("n_before"),
            F.count_if(is_now).alias("n_now"),
            F.sum(F.when(~is_now, quantity)).alias("last_year_quantity"),
            F.sum(F.when(is_now, quantity)).alias("this_year_quantity"),
            F.sum(F.when(~is_now, old_quantity)).alias("quantity_old_products_last_year"),
            F.sum(F.when(is_now, old_quantity)).alias("quantity_old_products_this_year"),
        )
        .where((F.col("n_before") > 0) & (F.col("n_now") > 0))
        .select(
            "customer_id",
            (year - 1).cast("bigint").alias("last_year"),
            "last_year_quantity",
            year.cast("bigint").alias("this_year"),
            "this_year_quantity",
            change_pct(
                F.col("this_year_quantity"), F.col("last_year_quantity"), integer_division
            ).alias("total_quantity_growth"),
            "quantity_old_products_last_year",
            "quantity_old_products_this_year",
            change_pct(
                F.col("quantity_old_products_this_year"),
                F.col("quantity_old_products_last_year"),
                integer_division,
            ).alias("old_product_growth"),
        )
    )


def existing_customer_sales_growth(
    orders: DataFrame, as_of_year: int | None = None
) -> DataFrame:
    """``customer_id, last_year_sales, this_year_sales, sales_growth`` of customers who
    bought in both years. Reads those two years only if the year is given; else sums per
    customer and year tell the last year."""
    if as_of_year is None:
        grouped = _by_key_and_year(orders, "customer_id")
        year, at, amount, n = _last_year(grouped), F.col("year"), F.col("amount"), F.col("n")
        two_years, is_now = grouped.where((at == year) | (at == year - 1)), at == year
    else:
        at, amount, n = F.col("order_date"), F.col("sales_amount"), F.lit(1)
        two_years = orders.where((at >= year_start(as_of_year - 1)) & (at < year_start(as_of_year + 1)))
        is_now = at >= year_start(as_of_year)
    return (
        two_years.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.sum(F.when(~is_now, n).otherwise(0)).alias("n_before"),
            F.sum(F.when(is_now, n).otherwise(0)).alias("n_now"),
            F.sum(F.when(~is_now, amount)).alias("before"),
            F.sum(F.when(is_now, amount)).alias("now"),
        )
        .where((F.col("n_before") > 0) & (F.col("n_now") > 0))
        .select(
            "customer_id",
            as_double(F.col("before")).alias("last_year_sales"),
            as_double(F.col("now")).alias("this_year_sales"),
            change_pct(F.col("now"), F.col("before")).alias("sales_growth"),
        )
    )


def revenue_by_cohort(orders: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Revenue of both years by customer cohort (new, existing) and product cohort
    (new, old), with ``all`` rows as totals, and each cell's share of the change."""
    products, customers = _first_sales(orders, "product_name"), _first_sales(orders, "customer_id")
    year = _year_of(as_of_year, products)
    this_year = _start(year, as_of_year)
    date = F.col("order_date")
    lines = orders.where((date >= _start(year, as_of_year, -1)) & (date < _start(year, as_of_year, 1))).select(
        "customer_id", "product_name", "order_date", "sales_amount"
    )
    flagged = _with_newcomer_flags(lines, this_year, product_name=products, customer_id=customers)
    is_now = date >= this_year
    cells = flagged.groupBy(
        F.when(F.col("new_customer_id"), "new").otherwise("existing").alias("customer_cohort"),
        F.when(F.col("new_product_name"), "new").otherwise("old").alias("product_cohort"),
    ).agg(
        F.sum(F.when(~is_now, F.col("sales_amount"))).alias("before"),
        F.sum(F.when(is_now, F.col("sales_amount"))).alias("now"),
    )
    # From here on there are at most four cells and five totals.
    totals = cells.cube("customer_cohort", "product_cohort").agg(
        F.coalesce(F.sum("before"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("now"), F.lit(0)).alias("now"),
    )
    change = F.col("now") - F.col("before")
    whole = F.max(
        F.when(F.col("customer_cohort").isNull() & F.col("product_cohort").isNull(), change)
    ).over(Window.partitionBy())
    return totals.select(
        F.coalesce("customer_cohort", F.lit("all")).alias("customer_cohort"),
        F.coalesce("product_cohort", F.lit("all")).alias("product_cohort"),
        as_double(F.col("before")).alias("last_year_sales"),
        as_double(F.col("now")).alias("this_year_sales"),
        as_double(change).alias("change"),
        (ratio(change, whole) * 100).alias("share_of_change_pct"),
    )
