import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import by, one
from tillroll.functions.expressions import money_text, percent_text
from tillroll.operators import customers as c


def test_null_customer_is_left_out(lines):
    assert [r.customer_id for r in c.customer_metrics(lines({"customer_id": None}, {})).collect()] == ["c"]


def test_one_line(lines):
    row = one(c.customer_metrics(lines({"unit_price": "5", "shipping_cost": "1.5"})))
    assert row["customer_tenure"] == row["avg_days_between_orders"] == 0
    assert row["repeat_purchase_customer"] == 0 and row["customer_lifetime_value"] == 0
    assert row["monetary"] == row["average_order_value"] == 6.5
    assert row["relative_repeat_rate"] == 1.0 and row["churn_likelihood"] == 0.0


def test_frequency_counts_lines(lines):
    df = lines({}, {}, {"customer_id": "d", "order_date": "2012-01-02"})
    rows = by(c.customer_metrics(df), "customer_id")
    assert rows["c"]["frequency"] == 2 and rows["d"]["relative_repeat_rate"] == 0.5
    assert rows["d"]["recency"] == 365 and rows["d"]["churn_likelihood"] == 1.0


@pytest.mark.parametrize("days, tenure", [(364, 0), (365, 1), (729, 1), (730, 2)])
def test_tenure(lines, days, tenure):
    last = (dt.date(2013, 1, 1) + dt.timedelta(days)).isoformat()
    assert one(c.customer_metrics(lines({}, {"order_date": last})))["customer_tenure"] == tenure


def test_mean_gap_is_floored(lines):
    df = lines({}, {"order_date": "2013-01-02"}, {"order_date": "2013-01-04"})
    assert one(c.customer_metrics(df))["avg_days_between_orders"] == 1


def test_gap_in_file_order_may_be_negative(lines):
    df = lines({"order_date": "2013-01-08"}, {"order_date": "2013-01-10"}, {"order_date": "2013-01-01"})
    assert one(c.customer_metrics(df))["avg_days_between_orders"] == 4
    assert one(c.customer_metrics(df, order_key="place"))["avg_days_between_orders"] == -4


def test_first_line(lines):
    df = lines(
        {"order_date": "2013-02-01", "quantity": 9, "unit_price": "2"},
        {"order_date": "2013-01-01", "quantity": None, "unit_price": "2"},
        {"order_date": "2013-01-02", "quantity": 4, "unit_price": "2"},
    )
    row = one(c.customer_metrics(df))
    assert row["first_order_revenue"] is None and row["first_order_quantity"] == 4
    row = one(c.customer_metrics(df, order_key="place"))
    assert row["first_order_revenue"] == 18.0 and row["first_order_quantity"] == 9


def test_undated_lines(lines):
    df = lines({"order_date": None, "quantity": 2}, {"quantity": 3})
    row = one(c.customer_metrics(df))
    assert row["avg_days_between_orders"] == 0 and row["first_order_quantity"] == 3
    row = one(c.customer_metrics(lines({"order_date": None, "unit_price": None})))
    assert row["avg_days_between_orders"] is None and row["monetary"] == 0.0


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from("abc"),
            st.integers(0, 900),
            st.one_of(st.none(), st.integers(0, 9)),
            st.integers(0, 500),
        ),
        min_size=1,
        max_size=12,
    )
)
def test_metrics_in_file_order_match_pandas(lines, rows):
    start = dt.date(2011, 1, 1)
    got = by(
        c.customer_metrics(
            lines(
                *[
                    {
                        "customer_id": k,
                        "order_date": (start + dt.timedelta(d)).isoformat(),
                        "quantity": q,
                        "unit_price": str(p),
                        "shipping_cost": "1",
                    }
                    for k, d, q, p in rows
                ]
            ),
            order_key="place",
        ),
        "customer_id",
    )
    pdf = pd.DataFrame(rows, columns=["k", "d", "q", "p"]).astype({"q": float})
    pdf["revenue"] = pdf.q * pdf.p
    for k, group in pdf.groupby("k"):
        row = got[k]
        assert row["frequency"] == len(group)
        assert row["monetary"] == pytest.approx((group.revenue + 1).sum())
        assert row["total_quantity"] == group.q.sum()
        assert row["customer_tenure"] == (group.d.max() - group.d.min()) // 365
        assert row["recency"] == pdf.d.max() - group.d.max()
        want = 0 if len(group) == 1 else pd.to_timedelta(group.d, "D").diff().mean().days
        assert row["avg_days_between_orders"] == want
        first = group.revenue.iloc[0]
        assert row["first_order_revenue"] == (None if pd.isna(first) else first)
        known = group.q.dropna()
        assert row["first_order_quantity"] == (known.iloc[0] if len(known) else None)


def test_global_tenure(lines):
    df = lines({"customer_id": "a", "order_date": "2010-01-01"}, {"customer_id": "b", "order_date": "2013-01-02"})
    rows = by(c.customer_metrics_global_tenure(df), "customer_id")
    assert rows["a"]["customer_tenure"] == 3 and rows["b"]["customer_tenure"] == 0
    assert rows["a"]["customer_lifetime_value"] == 3.0
    assert by(c.customer_metrics(df), "customer_id")["a"]["customer_tenure"] == 0


def test_segments(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 10.0, 100.0)], "customer_lifetime_value double")
    rows = by(c.clv_segments(df), "customer_lifetime_value")
    assert [rows[v]["clv_segment"] for v in (0, 1, 10, 100)] == [
        "Low Value", "Medium Value", "Medium Value", "High Value",
    ]


def test_segments_with_equal_quartiles(spark):
    df = spark.createDataFrame([(v,) for v in (5.0, 5.0, 5.0, 5.0, 9.0, None)], "customer_lifetime_value double")
    segments = [(r.customer_lifetime_value, r.clv_segment) for r in c.clv_segments(df).distinct().collect()]
    assert set(segments) == {(5.0, "Low Value"), (9.0, "High Value"), (None, None)}


# --- risk --------------------------------------------------------------------------------

CUSTOMERS = "customer_id string, first_date date, last_date date, average_order_value double"


def people(spark, *rows):
    return spark.createDataFrame(
        [(str(i), dt.date(first, 1, 1), dt.date(last, 1, 1), v) for i, (first, last, v) in enumerate(rows)],
        CUSTOMERS,
    )


def test_bins_are_right_closed(spark):
    values = [-2.0, -1.0, 0.0, 110.0, 110.01, 900.0, 901.0, None, float("nan")]
    df = people(spark, *[(2012, 2013, v) for v in values])
    levels = [r.risk_level for r in c.risk_levels(df, 2013).orderBy("customer_id").collect()]
    assert levels == [None, None, "Low", "Low", "Med", "Med", "High", None, None]


def test_lifecycle(spark):
    df = people(spark, (2012, 2013, 1.0), (2013, 2013, 1.0), (2012, 2012, 1.0), (2014, 2014, 1.0), (2012, 2014, 1.0))
    rows = c.customer_lifecycle(df, 2013).orderBy("customer_id").collect()
    assert [(r.is_past, r.is_new, r.is_retained) for r in rows] == [
        (True, False, True),
        (False, True, False),
        (True, False, False),
        (False, False, False),
        (True, False, False),
    ]
    assert [r.is_new for r in c.customer_lifecycle(df).orderBy("customer_id").collect()][3]


def test_nobody_retained(spark):
    rows = by(c.risk_allocation(people(spark, (2013, 2013, 50.0), (2012, 2012, 50.0)), 2013), "risk_level")
    assert set(rows) == {"New"}
    assert rows["New"]["at_risk"] == 0 and rows["New"]["risk_allocation_pct"] == 0


def test_published_budget(spark):
    """Counts and average order values as published for 2013."""
    groups = {"High": (637, 393, 2053.63), "Low": (403, 92, 73.01), "Med": (1266, 707, 445.11)}
    rows = [(2013, 2013, 833.35)] * 397
    for past, retained, value in groups.values():
        rows += [(2012, 2013, value)] * retained + [(2012, 2012, value)] * (past - retained)
    budget = c.risk_allocation(people(spark, *rows), 2013)
    text = by(c.risk_allocation_report(budget), "risk_level")
    assert {k: r["number_of_customers"] for k, r in text.items()} == {
        "High": 393, "Low": 92, "Med": 707, "New": 397,
    }
    assert {k: r["retention_pct"] for k, r in text.items()} == {
        "High": "61.70%", "Low": "22.83%", "Med": "55.85%", "New": "0.00%",
    }
    assert text["High"]["aov"] == "$2,053.63" and text["New"]["at_risk"] == "$0.00"
    # The published amounts come from averages before rounding to cents.
    levels = by(budget, "risk_level")
    for level, published in {"High": 497929.13, "Low": 1533.39, "Med": 175742.42}.items():
        row = levels[level]
        slack = row["number_of_customers"] * row["retention_pct"] / 100 * 0.005
        assert abs(row["at_risk"] - published) <= slack
    shares = {k: r["risk_allocation_pct"] for k, r in levels.items()}
    assert shares == pytest.approx({"High": 73.74, "Low": 0.23, "Med": 26.03, "New": 0}, abs=0.006)


def test_text(spark):
    df = spark.createDataFrame([(1234.5,), (0.125,), (2.675,)], "v double")
    rows = df.select(money_text(F.col("v")).alias("m"), percent_text(F.col("v")).alias("p")).collect()
    assert [r.m for r in rows] == ["$1,234.50", "$0.12", "$2.67"]
    assert rows[0].p == "1234.50%"
