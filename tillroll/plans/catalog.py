"""Every operator as a named query over the star-schema tables.

Results are made comparable across engines: doubles rounded to six places, decimals
as doubles, integers as bigint, dates as ISO text, arrays as comma-separated text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.sharing import scratch_path, stage_writes
from tillroll.operators import baskets, cleaning, customers, growth, products, profiling
from tillroll.plans.daily import run_daily
from tillroll.sources.orders_files import load_orders, slices_for, write_output
from tillroll.sources.published import read_published
from tillroll.sources.star_tables import raw_order_text, sales_lines

Query = Callable[[SparkSession, str], DataFrame]

# Average order values in the test tables lie between the first two edges.
RISK_EDGES = (-1, 23_000, 26_000, float("inf"))
SEGMENT = ("customer_segment", "BUILDING")
MIN_SUPPORT = 0.02
MIN_LIFT = 1.1
LONG_MIN_SUPPORT = 0.002
PRODUCT_MIN_SUPPORT = 0.0015
RAW_PARTS = 4  # of the orders, in which the daily job's raw file is written


def comparable(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DecimalType):
            column = column.cast("double")
        if isinstance(kind, (T.DecimalType, T.DoubleType)):
            column = F.round(column, 6)
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(kind, T.BooleanType):
            column = column.cast("bigint")
        return column.alias(field.name)

    return df.select(*[shown(f) for f in df.schema])


# --- order lines as each group of operators needs them -------------------------------


def _revenue_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir, "order_date", "sales_amount")


def _growth_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(
        spark, sf_dir, "customer_id", "product_name", "order_date", "quantity", "sales_amount"
    )


def _product_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir, "product_name", "order_date", "sales_amount")


def _customer_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir, "customer_id", "order_date", "sales_amount")


def _demand_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir, "customer_id", "product_name", "order_date", "quantity")


def _product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(spark, sf_dir, "product_name", "order_date", "sales_amount_with_shipping")


def _customer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_lines(
        spark,
        sf_dir,
        "customer_id",
        "order_id",
        "product_name",
        "order_date",
        "quantity",
        "unit_price",
        "sales_amount_with_shipping",
    )


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.customer_metrics(_customer_lines(spark, sf_dir))


def _customers_by_order_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As if the file began with the highest order number."""
    lines = _customer_lines(spark, sf_dir)
    place = F.struct((-F.col("order_id")).alias("order"), "product_name", "quantity", "unit_price")
    return customers.customer_metrics(lines.withColumn("place", place), "place")


def _customers_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers.customer_metrics_global_tenure(
        sales_lines(spark, sf_dir, "customer_id", "order_date", "sales_amount_with_shipping")
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_columns(raw_order_text(spark, sf_dir))


def _baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baskets of brands; the catalogue itself has too few repeated pairs."""
    lines = sales_lines(spark, sf_dir, "order_id", SEGMENT[0], "product_sub_category")
    return baskets.order_baskets(lines, *SEGMENT, item_col="product_sub_category")


def _pair_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sales_lines(spark, sf_dir, "order_id", SEGMENT[0], "product_sub_category")
    return baskets.segment_rules(
        lines, *SEGMENT, MIN_SUPPORT, "lift", MIN_LIFT, max_len=2, item_col="product_sub_category"
    )


# --- ingest and cleaning ---------------------------------------------------------------


def _load_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_output(raw_order_text(spark, sf_dir), scratch_path(spark, "raw-csv"), "csv")
    return load_orders(spark, path)


def _load_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with a line break and quotes, read in splits."""
    name = F.concat("customer_name", F.lit('\n"'), "city", F.lit('",\n\n'), "customer_id")
    path = write_output(_raw(spark, sf_dir).withColumn("customer_name", name), scratch_path(spark, "quoted-csv"), "csv")
    return load_orders(spark, path, quoted_breaks=True)


def _parsed(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = _raw(spark, sf_dir)
        if mode == "year_first":
            raw = raw.withColumn(
                "order_date", F.date_format(cleaning.order_date_expr("order_date"), "yyyy-MM-dd")
            )
        if mode == "epoch_ms":
            for c in ("order_date", "ship_date"):
                days = F.unix_date(cleaning.order_date_expr(c)).cast("bigint")
                millis = (days * 86_400_000).cast("string")
                if c == "ship_date":  # a number that no date reaches
                    millis = F.when(F.col("order_id").cast("bigint") % 97 == 0, "9" * 20).otherwise(millis)
                raw = raw.withColumn(c, millis)
        parsed = raw.select(
            "order_id",
            "product_name",
            F.col("order_date").alias("order_date_text"),
            F.col("ship_date").alias("ship_date_text"),
            "order_date",
            "ship_date",
        )
        return cleaning.parse_order_dates(parsed, mode=mode)

    return run


def _write_output(fmt: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        metrics = customers.clv_segments(_customers(spark, sf_dir)).select(
            "customer_id", "frequency", "monetary", "clv_segment"
        )
        path = write_output(metrics, scratch_path(spark, f"metrics-{fmt}"), fmt)
        if fmt == "parquet":
            return spark.read.parquet(path)
        return spark.read.schema(metrics.schema).option("header", True).csv(path)

    return run


def _daily_job(spark: SparkSession, sf_dir: str, output: str | None = None) -> DataFrame:
    """The job's summary, or one of its outputs read back."""
    raw = scratch_path(spark, "raw-csv")
    parts = slices_for(spark, f"{sf_dir}/lineitem.parquet", RAW_PARTS)
    for i in range(parts):
        with stage_writes(spark):
            write_output(raw_order_text(spark, sf_dir, i, parts), raw, "csv", compression="gzip", mode="append")
    folder = scratch_path(spark, "daily")
    summary = run_daily(spark, raw, folder, risk_edges=RISK_EDGES, drop_input=True)
    return summary if output is None else read_published(spark, folder, output)


def _basket_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baskets.order_baskets(sales_lines(spark, sf_dir, "order_id", SEGMENT[0], "product_name"), *SEGMENT)


# --- rest ------------------------------------------------------------------------------


def _risk(edges_from: Query, year: int | None, value_col: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return customers.risk_allocation(
            edges_from(spark, sf_dir), year, RISK_EDGES, value_col=value_col
        )

    return run


def _by_year(name: str, lines: Query, operator: Callable[..., DataFrame]) -> dict[str, Query]:
    """The default year, the year with many newcomers and the last one."""
    out: dict[str, Query] = {name: lambda s, d: operator(lines(s, d))}
    for year in (1996, 2001):
        out[f"{name}_{year}"] = lambda s, d, y=year: operator(lines(s, d), y)
    return out


def _queries() -> dict[str, Query]:
    q: dict[str, Query] = {}

    q["load_orders"] = _load_orders
    q["load_orders_quoted_breaks"] = _load_quoted_breaks
    q["normalize_columns"] = _raw
    for mode in cleaning.DATE_MODES:
        q[f"parse_order_dates_{mode}"] = _parsed(mode)
    q["dedupe_orders"] = lambda s, d: cleaning.dedupe_orders(
        cleaning.parse_order_dates(_raw(s, d))
    )
    q["coerce_numerics"] = lambda s, d: cleaning.coerce_numerics(
        _raw(s, d).select("order_id", "product_name", "unit_price", "shipping_cost", "quantity")
    )
    q["add_sales_amounts"] = lambda s, d: sales_lines(
        s, d, "order_id", "product_name", "sales_amount", "sales_amount_with_shipping"
    )
    q["add_calendar"] = lambda s, d: cleaning.add_calendar(
        sales_lines(s, d, "order_id", "product_name", "order_date")
    )
    q["category_codes"] = lambda s, d: cleaning.category_codes(
        sales_lines(s, d, *cleaning.CATEGORY_COLUMNS)
    )
    q["clean_orders"] = lambda s, d: cleaning.clean_orders(raw_order_text(s, d))
    q["quality_report"] = lambda s, d: cleaning.quality_report(
        raw_order_text(s, d), cleaning.clean_orders(raw_order_text(s, d))
    )
    q["rejected_rows"] = lambda s, d: cleaning.rejected_rows(raw_order_text(s, d)).select(
        "order_id", "product_name", "rejected_for"
    )
    q["profile_numeric"] = lambda s, d: profiling.profile_numeric(
        sales_lines(s, d, "unit_price", "shipping_cost", "quantity")
    )
    q["profile_text"] = lambda s, d: profiling.profile_text(_raw(s, d))
    q["write_output_parquet"] = _write_output("parquet")
    q["write_output_csv"] = _write_output("csv")

    q["yearly_sales_growth"] = lambda s, d: growth.yearly_sales_growth(_revenue_lines(s, d))
    q["sales_cagr"] = lambda s, d: growth.sales_cagr(_revenue_lines(s, d))
    q["growth_signal"] = lambda s, d: growth.growth_signal(_revenue_lines(s, d))
    q |= _by_year("existing_product_growth", _product_revenue, growth.existing_product_growth)
    q |= _by_year("existing_customer_growth", _customer_revenue, growth.existing_customer_growth)
    q |= _by_year("customer_demand", _demand_lines, growth.customer_demand)
    q |= _by_year("customer_demand_growth", _demand_lines, growth.customer_demand_growth)
    q["customer_demand_growth_integer_1996"] = lambda s, d: growth.customer_demand_growth(
        _demand_lines(s, d), 1996, integer_division=True
    )
    q |= _by_year(
        "existing_customer_sales_growth", _customer_revenue, growth.existing_customer_sales_growth
    )
    q |= _by_year("revenue_by_cohort", _growth_lines, growth.revenue_by_cohort)

    q["customer_metrics"] = _customers
    q["customer_metrics_by_order_key"] = _customers_by_order_key
    q["clv_segments"] = lambda s, d: customers.clv_segments(_customers(s, d))
    q["customer_metrics_global_tenure"] = _customers_global
    q["clv_segments_global_tenure"] = lambda s, d: customers.clv_segments(_customers_global(s, d))
    for year in (1996, 2001):
        q[f"customer_lifecycle_{year}"] = lambda s, d, y=year: customers.customer_lifecycle(
            _customers(s, d), y
        ).select("customer_id", "is_past", "is_new", "is_retained")
        q[f"risk_levels_{year}"] = lambda s, d, y=year: customers.risk_levels(
            _customers(s, d), y, RISK_EDGES
        ).select("customer_id", "is_past", "is_new", "is_retained", "risk_level")
        q[f"risk_allocation_{year}"] = _risk(_customers, year, "average_order_value")
    q["risk_allocation"] = _risk(_customers, None, "average_order_value")
    q["risk_allocation_global_tenure"] = _risk(_customers_global, 2001, "average_purchase_value")
    q["risk_allocation_report"] = lambda s, d: customers.risk_allocation_report(
        _risk(_customers, 2001, "average_order_value")(s, d)
    )

    q["product_yearly_sales"] = lambda s, d: products.product_yearly_sales(_product_lines(s, d))
    q["product_cagr"] = lambda s, d: products.product_cagr(_product_lines(s, d))
    q["product_market_share"] = lambda s, d: products.product_market_share(_product_lines(s, d))
    q["boston_matrix"] = lambda s, d: products.boston_matrix(_product_lines(s, d))
    q["boston_matrix_quadrants"] = lambda s, d: products.boston_matrix_quadrants(
        _product_lines(s, d)
    )

    q["order_baskets"] = _baskets
    q["basket_arrays"] = lambda s, d: baskets.basket_arrays(_baskets(s, d))
    q["frequent_itemsets"] = lambda s, d: baskets.frequent_itemsets(_baskets(s, d), MIN_SUPPORT, 2)
    q["frequent_itemsets_max_len_3"] = lambda s, d: baskets.frequent_itemsets(
        _baskets(s, d), LONG_MIN_SUPPORT, 3
    )
    q["frequent_itemsets_any_length"] = lambda s, d: baskets.frequent_itemsets(
        _baskets(s, d), LONG_MIN_SUPPORT
    )
    q["association_rules"] = _pair_rules
    q["association_rules_max_len_3"] = lambda s, d: baskets.association_rules(
        baskets.frequent_itemsets(_baskets(s, d), LONG_MIN_SUPPORT, 3), "confidence", 0.2
    )
    q["association_edges"] = lambda s, d: baskets.association_edges(_pair_rules(s, d))
    q["association_edges_undirected"] = lambda s, d: baskets.association_edges(
        _pair_rules(s, d), directed=False
    )
    q["association_edges_directed"] = lambda s, d: baskets.association_edges(
        _pair_rules(s, d), directed=True
    )
    q["association_nodes_directed"] = lambda s, d: baskets.association_nodes(
        _pair_rules(s, d), directed=True
    )
    q["association_nodes"] = lambda s, d: baskets.association_nodes(_pair_rules(s, d))
    q["association_nodes_undirected"] = lambda s, d: baskets.association_nodes(
        _pair_rules(s, d), directed=False
    )

    q["frequent_itemsets_products"] = lambda s, d: baskets.frequent_itemsets(
        _basket_products(s, d), PRODUCT_MIN_SUPPORT, 2
    )
    q["association_rules_any_length"] = lambda s, d: baskets.association_rules(
        baskets.frequent_itemsets(_baskets(s, d), MIN_SUPPORT), "confidence", 0.2
    )
    q["daily_job"] = _daily_job
    for output in ("risk_budget", "boston_matrix", "customer_metrics"):
        q[f"daily_job_{output}"] = lambda s, d, o=output: _daily_job(s, d, o)
    return q


def all_queries() -> dict[str, Query]:
    def wrap(run: Query) -> Query:
        return lambda spark, sf_dir: comparable(run(spark, sf_dir))

    return {name: wrap(run) for name, run in _queries().items()}
