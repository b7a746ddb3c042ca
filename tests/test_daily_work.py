"""What the daily job does once and not for each row or reader."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillroll.operators import cleaning, products


@pytest.mark.parametrize(
    "style, text",
    [
        (cleaning.MONTH_DAY_YEAR, "31/12/2013"), (cleaning.MONTH_DAY_YEAR, "0/1/2013"), (cleaning.MONTH_DAY_YEAR, "1/32/2013"),
        (cleaning.DAY_MONTH_YEAR, "12/31/2013"), (cleaning.YEAR_MONTH_DAY, "2013-13-1"), (cleaning.YEAR_MONTH_DAY, "2013-1-00"),
    ],
)
def test_no_cast_throws_over_a_month_or_day_out_of_range(spark, style, text):
    assert spark.range(1).select(F.regexp_replace(F.lit(text), *style)).first()[0] == "--"


def test_dates_read_as_before(spark):
    """As by patterns that take any two digits and leave the rest to the cast."""
    slashed = r"(?s)^(?:([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})|.*)$"
    dashed = r"(?s)^(?:([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})|.*)$"
    old = {
        "month_first_fallback": [(slashed, "$3-$1-$2"), (slashed, "$3-$2-$1")],
        "day_first": [(slashed, "$3-$2-$1")],
        "year_first": [(dashed, "$1-$2-$3"), (slashed, "$3-$1-$2")],
    }
    parts = ["", "0", "00", "1", "01", "9", "10", "12", "13", "19", "20", "28", "29", "30", "31", "32", "99", "001", "1 ", " 1", "x"]
    ends = ["", "\n", "\r\n", " ", "T", " "]
    texts = [f"{a}/{b}/{y}{e}" for a in parts for b in parts for y in ("2012", "2013", "0000", "213") for e in ends]
    texts += [f"{y}{s}{a}{s}{b}{e}" for a in parts for b in parts for y in ("2012", "2013") for s in "-/" for e in ends]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    for mode, styles in old.items():
        want = F.coalesce(*[F.regexp_replace("t", text, iso).try_cast("date") for text, iso in styles])
        rows = df.select(want.cast("string").alias("want"), cleaning.order_date_expr("t", mode).cast("string").alias("got"), "t").collect()
        assert [r for r in rows if r.want != r.got] == [] and any(r.got for r in rows)


def test_both_readers_of_the_products_share_their_aggregate(spark, tmp_path):
    rows = [(f"p{i % 3}", dt.date(2011 + i % 2, 1, 1), i) for i in range(9)]
    spark.createDataFrame(rows, "product_name string, order_date date, sales_amount_with_shipping int").write.parquet(str(tmp_path / "lines"))
    df = products.boston_matrix(spark.read.parquet(str(tmp_path / "lines")))
    df.collect()
    reused = [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "ReusedExchange" in x]
    assert reused and all("[product#" in x for x in reused)
