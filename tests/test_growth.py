import pytest

from helpers import by, one
from tillroll.operators import growth as g


def yearly(lines, **sales):
    return lines(*[{"order_date": f"{y[1:]}-06-01", "unit_price": str(v)} for y, v in sales.items()])


def test_one_year_only(lines):
    df = yearly(lines, y2013=5)
    assert one(g.yearly_sales_growth(df))["yoy_pct"] is None
    row = one(g.sales_cagr(df))
    assert (row["number_of_years"], row["cagr"]) == (0, None)
    assert one(g.growth_signal(df))["signal"] is None


def test_lag_is_the_previous_year_with_sales(lines):
    rows = by(g.yearly_sales_growth(yearly(lines, y2010=100, y2012=150)), "year")
    assert rows[2012]["lagged_sales"] == 100.0 and rows[2012]["yoy_pct"] == 50.0
    row = one(g.sales_cagr(yearly(lines, y2010=100, y2012=144)))
    assert row["number_of_years"] == 2 and row["cagr"] == pytest.approx(0.2)


def test_undated_lines_do_not_make_a_year(lines):
    df = lines({"order_date": None, "unit_price": "9"}, {"unit_price": "1"})
    assert one(g.yearly_sales_growth(df))["total_sales"] == 1.0


def test_zero_sales_before(lines):
    df = yearly(lines, y2012=0, y2013=5)
    assert by(g.yearly_sales_growth(df), "year")[2013]["yoy_pct"] is None
    for operator in (g.existing_product_growth, g.existing_customer_growth):
        row = one(operator(df))
        assert row["yoy_pct"] is None and list(row.values())[0] == 5.0
    assert one(g.existing_customer_sales_growth(df))["sales_growth"] is None


def test_growth_signal(lines):
    # Growth 50, 20, 30 and -10 percent; the compound rate is about 20.4 percent.
    df = yearly(lines, y2009=100, y2010=150, y2011=180, y2012=234, y2013="210.6")
    rows = by(g.growth_signal(df), "year")
    assert [rows[y]["signal"] for y in range(2009, 2014)] == [
        None, "accelerating", "below_trend", "accelerating", "below_trend",
    ]
    df = yearly(lines, y2009=100, y2010=200, y2011=300, y2012=300)
    assert by(g.growth_signal(df), "year")[2011]["signal"] == "slowing_above_trend"


def history(lines):
    """Customer a and product x are old; b and y appear in 2013."""
    return lines(
        {"customer_id": "a", "product_name": "x", "order_date": "2011-03-01", "quantity": 7},
        {"customer_id": "a", "product_name": "x", "order_date": "2012-03-01", "quantity": 2, "unit_price": "10"},
        {"customer_id": "a", "product_name": "x", "order_date": "2013-03-01", "quantity": 3, "unit_price": "10"},
        {"customer_id": "a", "product_name": "y", "order_date": "2013-04-01", "quantity": 5},
        {"customer_id": "b", "product_name": "x", "order_date": "2013-05-01", "quantity": 1, "unit_price": "8"},
        {"customer_id": "b", "product_name": "y", "order_date": "2013-05-01", "quantity": 4},
        {"customer_id": "c", "product_name": "x", "order_date": "2012-05-01", "quantity": 6},
        {"customer_id": None, "product_name": "x", "order_date": "2013-05-01", "quantity": 1, "unit_price": "100"},
        {"customer_id": "a", "product_name": None, "order_date": "2013-05-01", "quantity": 9},
    )


def test_existing_products_and_customers(lines):
    df = history(lines)
    row = one(g.existing_product_growth(df, 2013))
    assert row["total_sales_excluding_new_products"] == 30 + 8 + 100
    assert row["yoy_pct"] == pytest.approx((138 / 26 - 1) * 100)
    row = one(g.existing_customer_growth(df))
    assert row["total_sales_excluding_new_customers"] == 30 + 5 + 9
    assert row["yoy_pct"] == pytest.approx((44 / 26 - 1) * 100)


def test_demand(lines):
    rows = by(g.customer_demand(history(lines), 2013), "customer_id", "order_year")
    assert set(rows) == {("a", 2011), ("a", 2012), ("a", 2013), ("c", 2012)}
    now = rows["a", 2013]
    # The line without a product matches no old product.
    assert (now["total_quantity"], now["old_product_quantity"], now["new_product_quantity"]) == (17, 3, 14)
    assert rows["a", 2011]["old_product_quantity"] == 7


def test_demand_growth_needs_both_years(lines):
    row = one(g.customer_demand_growth(history(lines)))
    assert row["customer_id"] == "a" and (row["last_year"], row["this_year"]) == (2012, 2013)
    assert (row["last_year_quantity"], row["this_year_quantity"]) == (2, 17)
    assert row["total_quantity_growth"] == 750.0 and row["old_product_growth"] == 50.0
    whole = one(g.customer_demand_growth(history(lines), 2013, integer_division=True))
    assert whole["total_quantity_growth"] == 700 and whole["old_product_growth"] == 0


def test_demand_growth_from_nothing(lines):
    df = lines({"order_date": "2012-01-01", "quantity": 0}, {"order_date": "2013-01-01", "quantity": 3})
    row = one(g.customer_demand_growth(df))
    assert row["total_quantity_growth"] is None and row["old_product_growth"] is None


def test_a_gap_year_has_nobody_in_both_years(lines):
    df = yearly(lines, y2010=1, y2012=1)
    assert g.existing_customer_sales_growth(df).count() == 0
    assert g.customer_demand_growth(df).count() == 0


def test_sales_growth(lines):
    row = one(g.existing_customer_sales_growth(history(lines), 2013))
    assert row == {
        "customer_id": "a",
        "last_year_sales": 20.0,
        "this_year_sales": 44.0,
        "sales_growth": pytest.approx(120.0),
    }


def test_cohorts_add_up(lines):
    rows = by(g.revenue_by_cohort(history(lines), 2013), "customer_cohort", "product_cohort")
    assert rows["new", "new"]["this_year_sales"] == 4.0
    assert rows["new", "old"]["this_year_sales"] == 8.0 + 100.0
    assert rows["existing", "old"]["last_year_sales"] == 26.0
    assert rows["existing", "new"]["this_year_sales"] == 5.0 + 9.0
    cells = [r for k, r in rows.items() if "all" not in k]
    for column in ("last_year_sales", "this_year_sales", "change"):
        assert sum(r[column] for r in cells) == rows["all", "all"][column]
    assert sum(r["share_of_change_pct"] for r in cells) == pytest.approx(100)


def test_years_after_the_analysis_year_do_not_count(lines):
    df = lines(
        {"order_date": "2011-01-01", "unit_price": "4"},
        {"order_date": "2012-01-01", "unit_price": "5"},
        {"order_date": "2013-01-01", "unit_price": "100", "product_name": "later", "customer_id": "later"},
    )
    assert one(g.existing_product_growth(df, 2012))["yoy_pct"] == 25.0
    assert one(g.existing_customer_growth(df, 2012))["yoy_pct"] == 25.0
    rows = by(g.revenue_by_cohort(df, 2012), "customer_cohort", "product_cohort")
    assert rows["all", "all"]["this_year_sales"] == 5.0
