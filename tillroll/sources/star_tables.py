"""The order-lines model over star-schema tables (lineitem, orders, customer, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.cleaning import add_sales_amounts
from tillroll.schema import ORDER_COLUMNS, RAW_HEADERS

# Column -> (table that holds it, expression). The part key is the product key.
_LINE = {
    "order_id": ("lineitem", "l_orderkey"),
    "product_name": ("lineitem", "l_partkey"),
    "ship_mode": ("lineitem", "l_returnflag"),
    "quantity": ("lineitem", "cast(l_quantity as int)"),
    "shipping_cost": ("lineitem", "cast(l_tax * 100 as decimal(10,2))"),
    "ship_date": ("lineitem", "cast(l_shipdate as date)"),
    "line_status": ("lineitem", "l_linestatus"),
    "customer_id": ("orders", "o_custkey"),
    "order_date": ("orders", "cast(o_orderdate as date)"),
    "order_priority": ("orders", "o_orderpriority"),
    "customer_name": ("customer", "c_name"),
    "customer_segment": ("customer", "c_mktsegment"),
    "product_category": ("part", "p_type"),
    "product_sub_category": ("part", "p_brand"),
    "product_container": ("part", "cast(p_size as string)"),
    "unit_price": ("part", "cast(p_retailprice as decimal(10,2))"),
    "state_or_province": ("nation", "n_name"),
    "region": ("region", "r_name"),
    "city": ("lineitem", "cast(null as string)"),
}
# Tables reached through an order, each with its join to the ones before it.
_ORDER_SIDE = (
    ("customer", "o_custkey", "c_custkey"),
    ("nation", "c_nationkey", "n_nationkey"),
    ("region", "n_regionkey", "r_regionkey"),
)
_AMOUNTS = ("sales_amount", "sales_amount_with_shipping")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The named order-line columns, joining only the tables that hold them.

    Catalyst cannot drop an inner join it does not need, so the choice is made here.
    Join strategies are left to the optimizer and AQE, which measure the sides.
    """
    wanted = list(columns) or [*ORDER_COLUMNS, *_AMOUNTS]
    base = [c for c in wanted if c not in _AMOUNTS]
    if set(wanted) & set(_AMOUNTS):
        base += [c for c in ("unit_price", "quantity", "shipping_cost") if c not in base]

    needed = {_LINE[c][0] for c in base}
    lines = table(spark, sf_dir, "lineitem")
    if "part" in needed:
        part = table(spark, sf_dir, "part")
        lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    if needed - {"lineitem", "part"}:
        # Customers and places join the orders, of which there are several times fewer
        # than lines; the lines then move once for all of them.
        order_side = table(spark, sf_dir, "orders")
        depth = max((i + 1 for i, t in enumerate(_ORDER_SIDE) if t[0] in needed), default=0)
        for name, left, right in _ORDER_SIDE[:depth]:
            other = table(spark, sf_dir, name)
            order_side = order_side.join(other, F.col(left) == F.col(right))
        lines = lines.join(order_side, F.col("l_orderkey") == F.col("o_orderkey"))
    lines = lines.select(*[F.expr(_LINE[c][1]).alias(c) for c in base])
    if set(wanted) & set(_AMOUNTS):
        lines = add_sales_amounts(lines)
    return lines.select(*wanted)


def _raw_date(c: str) -> Column:
    """As the raw file has them: month first on open lines, day first on the others."""
    return F.when(F.col("line_status") == "O", F.date_format(c, "M/d/yyyy")).otherwise(
        F.date_format(c, "dd/MM/yyyy")
    )


def raw_order_text(spark: SparkSession, sf_dir: str, part: int = 0, parts: int = 1) -> DataFrame:
    """All lines as an uncleaned file would hold them: text under the raw headers,
    two date styles, some unreadable numbers, and every returned line twice. With ``parts``
    the lines of one part of the orders, by hash; each line is in one part."""
    lines = sales_lines(spark, sf_dir, *ORDER_COLUMNS, "line_status")
    if parts > 1:
        # On the key of the join, so it reaches the scans of lines and of orders.
        lines = lines.where(F.pmod(F.xxhash64("order_id"), F.lit(parts)) == part)
    text = {c: F.col(c).cast("string") for c in ORDER_COLUMNS}
    text["order_date"] = _raw_date("order_date")
    text["ship_date"] = _raw_date("ship_date")
    text["unit_price"] = F.when(F.col("product_container") == "7", F.lit("n/a")).otherwise(text["unit_price"])
    odd = F.when(F.col("product_container") == "11", F.concat(text["quantity"], F.lit(".00001"))).otherwise(text["quantity"])
    text["quantity"] = F.when(F.col("quantity") != 13, odd)
    headers = ["Quantity " if h == "Quantity" else h for h in RAW_HEADERS]
    copies = F.when(F.col("ship_mode") == "R", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.select(
        *[text[c].alias(h) for c, h in zip(ORDER_COLUMNS, headers)], F.explode(copies).alias("copy")
    ).drop("copy")
