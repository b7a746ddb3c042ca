"""What the plans must and must not hold, whatever the size of the data."""

import datetime as dt
import os

import pytest

from helpers import LINE_SCHEMA
from tillroll.operators import baskets, customers, growth, products
from tillroll.operators.cleaning import add_sales_amounts
from tillroll.plans.catalog import all_queries

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


@pytest.fixture(autouse=True)
def _whole_plan_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


@pytest.fixture
def stored(spark, tmp_path):
    """Order lines as a parquet table, so that scans show in plans."""
    rows = [
        (f"c{i % 5}", f"o{i // 2}", f"p{i % 3}", "Corporate", dt.date(2011 + i % 3, 1, 1), 1, None, None, i)
        for i in range(30)
    ]
    df = add_sales_amounts(spark.createDataFrame(rows, LINE_SCHEMA).fillna(1, ["unit_price", "shipping_cost"]))
    df.write.parquet(str(tmp_path / "lines"))
    return spark.read.parquet(str(tmp_path / "lines"))


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize(
    "name", [n for n in all_queries() if not n.startswith(("load_", "write_", "daily_"))]
)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(all_queries()[name](spark, SF_DIR))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "MapInArrow"):
        assert word not in text


@pytest.mark.parametrize(
    "operator", [growth.existing_customer_sales_growth, growth.customer_demand_growth, growth.revenue_by_cohort]
)
def test_two_years_reach_the_scan(stored, operator):
    text = plan(operator(stored, 2013))
    assert "GreaterThanOrEqual(order_date,2012-01-01)" in text and "LessThan(order_date,2014-01-01)" in text


def test_only_needed_columns_are_read(stored):
    text = plan(growth.yearly_sales_growth(stored))
    assert "ReadSchema: struct<order_date:date,sales_amount:" in text and "quantity" not in text
    text = plan(products.boston_matrix(stored))
    assert "customer" not in text


@pytest.mark.parametrize(
    "operator, shuffles",
    [
        # By key, then the single total.
        (lambda df: growth.existing_product_growth(df, 2013), 2),
        (lambda df: growth.existing_customer_sales_growth(df, 2013), 1),
        (products.product_yearly_sales, 1),
        (products.product_cagr, 2),
    ],
)
def test_number_of_shuffles(stored, operator, shuffles):
    text = plan(operator(stored))
    assert text.count("Exchange ") == shuffles and "Join" not in text


def test_sums_are_partial_before_the_shuffle(stored):
    assert "partial_sum" in plan(growth.yearly_sales_growth(stored))
    customers_plan = plan(customers.customer_metrics(stored))
    assert "partial_min_by" in customers_plan and customers_plan.count("FileScan") == customers_plan.count("InMemoryRelation")


def test_matrix_scans_the_lines_once(stored):
    df = products.boston_matrix(stored)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_baskets_read_the_lines_once(stored):
    text = plan(baskets.order_baskets(stored, "customer_segment", "Corporate"))
    assert "Join" not in text and text.count("FileScan") == 1


def test_pair_counts_are_partial_before_the_shuffle(stored):
    sets = baskets.frequent_itemsets(
        baskets.order_baskets(stored, "customer_segment", "Corporate"), 0.1, 2
    )
    # Upwards from the join of an order's items: a projection at most, then the map-side count.
    lines = plan(sets).splitlines()
    at = next(i for i, line in enumerate(lines) if "Join [order_id" in line and "last" in line)
    assert any("partial_count" in line for line in lines[at - 2 : at])


@pytest.mark.parametrize(
    "operator, passes",
    [
        (growth.existing_product_growth, 1),
        (growth.existing_customer_growth, 1),
        (growth.existing_customer_sales_growth, 1),
        # One to date the products (and customers), one each over older and newer lines.
        (growth.customer_demand, 3),
        (growth.customer_demand_growth, 3),
        (growth.revenue_by_cohort, 4),
    ],
)
def test_the_default_year_costs_no_pass(spark, stored, operator, passes):
    """Counts how often the lines are read, with the year given and without."""
    for year in (2013, None):
        read = spark.sparkContext.accumulator(0)

        def seen(batches, read=read):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        operator(stored.mapInArrow(seen, stored.schema), year).collect()
        assert 0 < read.value <= passes * stored.count()
