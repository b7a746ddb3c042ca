"""Customer value, segments and the retention-risk budget. Amounts include shipping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.expressions import (
    as_double,
    money_text,
    percent_text,
    ratio,
    resolve_year,
    right_closed,
)
from tillroll.functions.quantiles import exact_quantiles
from tillroll.functions.sharing import share

# The default average-order-value bins and their labels.
RISK_EDGES = (-1, 110, 900, float("inf"))
RISK_LABELS = ("Low", "Med", "High")
CLV_LABELS = ("Low Value", "Medium Value", "High Value")


def _whole_years(days: Column) -> Column:
    return (days / 365).cast("bigint")


def _totals(orders: DataFrame, *extra: Column) -> DataFrame:
    """One row per customer from one partially aggregated pass over the lines."""
    return (
        orders.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_date"),
            F.max("order_date").alias("last_date"),
            F.count(F.lit(1)).alias("frequency"),
            as_double(F.coalesce(F.sum("sales_amount_with_shipping"), F.lit(0))).alias("monetary"),
            *extra,
        )
    )


def customer_totals(orders: DataFrame, order_key: str | None = None) -> DataFrame:
    """What ``customer_measures`` takes of each customer's lines. Lines may be taken in parts,
    if no customer is in two of them.

    "First" and the day gaps follow ``order_key`` if one is given, such as the
    ``file_order`` of ``load_orders``. Otherwise lines are ordered by date, order,
    product, quantity and price, undated lines last.
    """
    date = F.col("order_date")
    if order_key is None:
        key = F.struct(
            date.isNull().alias("undated"),
            date,
            F.col("order_id"),
            F.col("product_name"),
            F.col("quantity"),
            F.col("unit_price"),
        )
        from_date, to_date = F.min(date), F.max(date)
    else:
        key = F.col(order_key)
        dated_key = F.when(date.isNotNull(), key)
        from_date, to_date = F.min_by(date, dated_key), F.max_by(date, dated_key)
    dated = F.count(date)
    quantity = F.col("quantity")
    return _totals(
        orders,
        F.coalesce(F.sum(quantity.cast("bigint")), F.lit(0).cast("bigint")).alias("total_quantity"),
        as_double(F.min_by(F.col("unit_price") * quantity, key)).alias("first_order_revenue"),
        # Consecutive differences add up to last minus first.
        F.when(dated == 1, F.lit(0).cast("bigint"))
        .when(dated > 1, F.floor(F.date_diff(to_date, from_date) / (dated - 1)))
        .alias("avg_days_between_orders"),
        F.min_by(quantity, F.when(quantity.isNotNull(), key)).cast("bigint").alias("first_order_quantity"),
    )


def customer_metrics(orders: DataFrame, order_key: str | None = None) -> DataFrame:
    """The 16 measures of each customer; ``order_key`` as in ``customer_totals``.

    The totals are shared, because the maxima over all customers are read from them as well.
    """
    return customer_measures(share(customer_totals(orders, order_key)))


def customer_measures(per: DataFrame) -> DataFrame:
    """The 16 measures from the totals of all customers."""
    top = per.agg(
        F.struct(
            F.max("last_date").alias("last_date"), F.max("frequency").alias("frequency")
        ).alias("top")
    ).scalar()

    tenure = _whole_years(F.date_diff("last_date", "first_date"))
    recency = F.date_diff(top["last_date"], F.col("last_date")).cast("bigint")
    return per.select(
        "customer_id",
        "first_date",
        "last_date",
        tenure.alias("customer_tenure"),
        recency.alias("recency"),
        "frequency",
        "monetary",
        "total_quantity",
        "first_order_revenue",
        "avg_days_between_orders",
        "first_order_quantity",
        ratio(F.col("monetary"), F.col("frequency")).alias("average_order_value"),
        (F.col("monetary") * tenure).alias("customer_lifetime_value"),
        (F.col("frequency") > 1).cast("bigint").alias("repeat_purchase_customer"),
        ratio(F.col("frequency"), top["frequency"]).alias("relative_repeat_rate"),
        (recency / F.lit(365.0)).alias("churn_likelihood"),
        ratio(F.col("total_quantity"), F.col("frequency")).alias("average_basket_size"),
    )


def customer_metrics_global_tenure(orders: DataFrame) -> DataFrame:
    """The variant whose tenure runs from the first order to the last date of all
    customers, so a customer who left keeps ageing."""
    per = share(_totals(orders))
    last = per.agg(F.max("last_date").alias("last_date")).scalar()
    tenure = _whole_years(F.date_diff(last, F.col("first_date")))
    return per.select(
        "customer_id",
        "first_date",
        "last_date",
        tenure.alias("customer_tenure"),
        F.date_diff(last, F.col("last_date")).cast("bigint").alias("recency"),
        "frequency",
        "monetary",
        ratio(F.col("monetary"), F.col("frequency")).alias("average_purchase_value"),
        (F.col("monetary") * tenure).alias("customer_lifetime_value"),
    )


def clv_segments(
    customers: DataFrame, value_col: str = "customer_lifetime_value"
) -> DataFrame:
    """Adds ``clv_segment``: up to the lower quartile Low Value, up to the upper one
    Medium Value, above it High Value. Equal quartiles leave Medium Value empty."""
    values = customers.select(
        F.lit(value_col).alias("column"), F.col(value_col).cast("double").alias("value")
    )
    at = F.col("prob")
    quartiles = (
        exact_quantiles(values, [0.25, 0.75])
        .agg(
            F.struct(
                F.max(F.when(at == 0.25, F.col("quantile"))).alias("low"),
                F.max(F.when(at == 0.75, F.col("quantile"))).alias("high"),
            ).alias("quartiles")
        )
        .scalar()
    )
    edges = [float("-inf"), quartiles["low"], quartiles["high"], float("inf")]
    return customers.withColumn("clv_segment", right_closed(F.col(value_col), edges, CLV_LABELS))


def customer_lifecycle(customers: DataFrame, as_of_year: int | None = None) -> DataFrame:
    """Adds ``is_past, is_new, is_retained`` for the analysis year (default: the year
    of the last order). First order later than that: none of the three."""
    year = resolve_year(customers, as_of_year, "last_date")
    first, last = F.year("first_date"), F.year("last_date")
    return customers.withColumns(
        {
            "is_past": F.coalesce(first < year, F.lit(False)),
            "is_new": F.coalesce(first == year, F.lit(False)),
            "is_retained": F.coalesce((first < year) & (last == year), F.lit(False)),
        }
    )


def risk_levels(
    customers: DataFrame,
    as_of_year: int | None = None,
    edges: Sequence[float] = RISK_EDGES,
    labels: Sequence[str] = RISK_LABELS,
    value_col: str = "average_order_value",
) -> DataFrame:
    """Adds the lifecycle flags and ``risk_level``: New, or the bin of the average
    order value of a past customer."""
    level = F.when(F.col("is_new"), F.lit("New")).when(
        F.col("is_past"), right_closed(F.col(value_col), edges, labels)
    )
    return customer_lifecycle(customers, as_of_year).withColumn("risk_level", level)


def risk_allocation(
    customers: DataFrame,
    as_of_year: int | None = None,
    edges: Sequence[float] = RISK_EDGES,
    labels: Sequence[str] = RISK_LABELS,
    value_col: str = "average_order_value",
) -> DataFrame:
    """``risk_level, number_of_customers, aov, retention_pct, at_risk,
    risk_allocation_pct`` over the new and the retained customers."""
    current = F.col("is_new") | F.col("is_retained")
    levels = (
        risk_levels(customers, as_of_year, edges, labels, value_col)
        .where(F.col("risk_level").isNotNull())
        .groupBy("risk_level")
        .agg(
            F.count_if(current).alias("number_of_customers"),
            F.coalesce(F.avg(F.when(current, F.col(value_col))), F.lit(0.0)).alias("aov"),
            F.coalesce(
                ratio(F.count_if("is_retained"), F.count_if("is_past")) * 100, F.lit(0.0)
            ).alias("retention_pct"),
        )
        .where(F.col("number_of_customers") > 0)
        .withColumn(
            "at_risk",
            F.col("number_of_customers") * (F.col("retention_pct") / 100) * F.col("aov"),
        )
    )
    # One row per level is left, so the total needs no further shuffle to speak of.
    total = F.sum("at_risk").over(Window.partitionBy())
    return levels.withColumn(
        "risk_allocation_pct", F.coalesce(ratio(F.col("at_risk"), total), F.lit(0.0)) * 100
    )


def risk_allocation_report(allocation: DataFrame) -> DataFrame:
    """The allocation with money and percentages as text."""
    return allocation.select(
        "risk_level",
        "number_of_customers",
        money_text(F.col("aov")).alias("aov"),
        percent_text(F.col("retention_pct")).alias("retention_pct"),
        money_text(F.col("at_risk")).alias("at_risk"),
        percent_text(F.col("risk_allocation_pct")).alias("risk_allocation_pct"),
    )
