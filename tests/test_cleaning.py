import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from helpers import by, one
from tillroll.operators import cleaning as c
from tillroll.operators import profiling
from tillroll.schema import ORDER_COLUMNS, RAW_HEADERS, snake_name
from tillroll.sources.orders_files import load_orders, write_output
from tillroll.sources.star_tables import table

D = dt.date


def parsed(spark, texts, mode):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, d string")
    return [r.d for r in c.parse_order_dates(df, ["d"], mode).orderBy("i").collect()]


DATES = ["1/2/2013", "01/02/2013", "13/02/2013", "02/30/2013", "1/2/13", "", None, "2013-01-02", "1/2/2013x"]


def test_dates_month_first(spark):
    assert parsed(spark, DATES, "month_first_fallback") == [
        D(2013, 1, 2), D(2013, 1, 2), D(2013, 2, 13), None, None, None, None, None, None,
    ]


def test_dates_day_first(spark):
    assert parsed(spark, DATES, "day_first") == [
        D(2013, 2, 1), D(2013, 2, 1), D(2013, 2, 13), None, None, None, None, None, None,
    ]


def test_dates_year_first(spark):
    texts = ["2013-1-2", "2013/01/02", "1/2/2013", "2013-02-30", "13/02/2013", "2013-01-02 junk"]
    assert parsed(spark, texts, "year_first") == [
        D(2013, 1, 2), D(2013, 1, 2), D(2013, 1, 2), None, None, None,
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_dates_epoch_ms_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = ["1357084800000", "-1", "x", None]
        assert parsed(spark, texts, "epoch_ms") == [D(2013, 1, 2), D(1969, 12, 31), None, None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unknown_date_mode(spark):
    with pytest.raises(ValueError, match="unknown date mode"):
        parsed(spark, ["1/2/2013"], "guess")


def test_parsed_dates_stay(spark):
    df = spark.createDataFrame([(D(2013, 1, 2),)], "d date")
    assert one(c.parse_order_dates(df, ["d"]))["d"] == D(2013, 1, 2)


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Quantity ", " Order ID", "ProductSubCategory"])
    assert c.normalize_columns(df).columns == ["quantity", "order_id", "product_sub_category"]
    assert snake_name("State or Province") == "state_or_province"


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "b", 3)], "x string, y string, k int")
    assert c.dedupe_orders(df.drop("k")).count() == 2
    assert by(c.dedupe_orders(df, "k"), "y")[None]["k"] == 1


def test_numbers_and_amounts(spark):
    df = spark.createDataFrame(
        [(1, "abc", "1.5", "2"), (2, "2.00", "0.25", None), (3, "2.00", "0.25", "3.0"), (4, "1.00", "0", "2.5")],
        "i int, unit_price string, shipping_cost string, quantity string",
    )
    rows = by(c.add_sales_amounts(c.coerce_numerics(df)), "i")
    assert rows[1]["unit_price"] is None and rows[1]["sales_amount"] is None
    assert rows[2]["quantity"] is None and rows[2]["sales_amount_with_shipping"] is None
    assert float(rows[3]["sales_amount"]) == 6.0
    assert float(rows[3]["sales_amount_with_shipping"]) == 6.25
    assert rows[4]["quantity"] is None


def test_amounts_twice(lines):
    df = lines({"quantity": 3, "unit_price": "2.50"})
    assert c.add_sales_amounts(df).columns == df.columns
    assert float(one(c.add_sales_amounts(df))["sales_amount"]) == 7.5


def test_calendar(lines):
    row = one(c.add_calendar(lines({"order_date": "2013-05-09"})))
    assert (row["order_year"], row["order_month_name"]) == (2013, "May")


def test_category_codes(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y")], "s string, t string")
    rows = by(c.category_codes(df, ["s", "t"]), "column", "value")
    assert {k: (r["code"], r["n"]) for k, r in rows.items()} == {
        ("s", "a"): (0, 1), ("s", "b"): (1, 2), ("t", "x"): (0, 1), ("t", "y"): (1, 1),
    }


@pytest.mark.parametrize("ranges", [1, 40, 100_000])
def test_codes_of_a_large_domain(spark, monkeypatch, ranges):
    monkeypatch.setattr(c, "CODE_RANGES", ranges)
    wide = spark.range(9_000).selectExpr("concat('v', id * 7919 % 4000) as s", "if(id % 3 = 0, null, 'é') as t")
    rows = by(c.category_codes(wide, ["s", "t"]), "column", "value")
    domain = sorted({f"v{i}" for i in range(4_000)})
    assert {v: r["code"] for (column, v), r in rows.items() if column == "s"} == {v: i for i, v in enumerate(domain)}
    assert (rows["t", "é"]["code"], rows["t", "é"]["n"]) == (0, 6_000)
    sizes = c.value_ranges(spark.createDataFrame([("s", v) for v in domain], "column string, value string")).groupBy("range").count()
    if ranges == 40:  # no task ranks more than a small part of the domain
        assert sizes.agg(F.max("count")).first()[0] < 1_000
    assert c.category_codes(wide.limit(0), ["s", "t"]).collect() == []


# --- files -------------------------------------------------------------------------------

HEADERS = ["Quantity " if h == "Quantity" else h for h in RAW_HEADERS]


def order_row(**values):
    row = {name: f"{name} text" for name in ORDER_COLUMNS}
    row |= {
        "unit_price": "2.50", "shipping_cost": "1.00", "quantity": "2",
        "order_date": "1/2/2013", "ship_date": "13/02/2013",
    }
    return {**row, **values}


def csv_line(values):
    return ",".join('"' + v.replace('"', '""') + '"' if any(ch in v for ch in ',"\n') else v for v in values)


def write_csv(path, *rows, headers=HEADERS):
    text = [csv_line(headers)]
    text += [csv_line([r[snake_name(h)] for h in headers]) for r in rows]
    path.write_text("\n".join(text) + "\n")
    return str(path)


def test_load_csv_quotes_and_blank_header(spark, tmp_path):
    path = write_csv(tmp_path / "o.csv", order_row(product_name='Pen, "blue"', city=""))
    row = one(load_orders(spark, path))
    assert list(row) == list(ORDER_COLUMNS)
    assert row["product_name"] == 'Pen, "blue"'
    assert row["quantity"] == "2" and row["city"] is None


def test_load_csv_by_header_not_by_place(spark, tmp_path):
    path = write_csv(tmp_path / "o.csv", order_row(), headers=HEADERS[::-1])
    assert one(load_orders(spark, path))["ship_mode"] == "ship_mode text"


def test_load_csv_line_break_in_a_field(spark, tmp_path):
    path = write_csv(tmp_path / "o.csv", order_row(product_name="two\nlines"), order_row())
    assert load_orders(spark, path, multiline=True).where("product_name = 'two\nlines'").count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        load_orders(spark, path).collect()


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_breaks_in_splits_as_in_whole_files(spark, tmp_path, small_splits):
    # Records within a split, over an edge, and over several whole splits.
    names = ["plain", "two\nlines", 'a "q"\n\n,b', "\n", "x" * 3000, "l\n" * 9000, "", '"']
    rows = [order_row(order_id=str(i), product_name=names[i * i % len(names)], city=names[i % 3]) for i in range(200)]
    path = write_csv(tmp_path / "o.csv", *rows)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    found = load_orders(spark, path, quoted_breaks=True, file_order=True).orderBy("file_order").drop("file_order")
    assert found.collect() == load_orders(spark, path, multiline=True).collect()


def test_quoted_breaks_in_runs_of_few_lines(spark, tmp_path, small_splits, monkeypatch):
    # A run is much smaller than a split: records within it, over an edge, over several runs.
    monkeypatch.setattr("tillroll.sources.quoted_breaks._RUN_BITS", 2)
    names = ["plain", "two\nlines", "l\n" * 50, "\n", '"']
    rows = [order_row(order_id=str(i), product_name=names[i * i % len(names)]) for i in range(200)]
    folder = tmp_path / "in"
    folder.mkdir()
    for name, part in (("a.csv", rows[:150]), ("b.csv", rows[150:152]), ("c.csv", rows[152:])):
        text = open(write_csv(tmp_path / name, *part)).read()
        # Blank lines of more than a split before the header of one file.
        (folder / name).write_text("\n" * 20_000 + text if name == "c.csv" else text)
    found = load_orders(spark, str(folder), quoted_breaks=True, file_order=True).orderBy("file_order").drop("file_order")
    assert found.collect() == load_orders(spark, str(folder), multiline=True, file_order=True).orderBy("file_order").drop("file_order").collect()


def test_quoted_breaks_of_several_files_line_ends_and_blank_lines(spark, tmp_path):
    text = open(write_csv(tmp_path / "o.csv", order_row(product_name="two\nlines"), order_row())).read()
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text(text)
    (folder / "b.csv").write_bytes(text.replace("\n", "\r\n").encode())
    (folder / "c.csv").write_text("\n" + text.rstrip("\n"))
    (folder / "d.csv").write_text(text.split("\n")[0] + "\n\n")
    found = load_orders(spark, str(folder), quoted_breaks=True)
    assert found.count() == 6 and found.where("product_name = 'two\nlines'").count() == 3


@pytest.mark.parametrize(
    "spoil",
    [
        lambda text: text + "a,b,c\n",
        lambda text: text + ",".join("a" * 19) + "\n",
        lambda text: text + '"a,b\n',
        lambda text: text.replace("ship_mode text", '5" pipe'),
        lambda text: text.replace("ship_mode text", 'a "b" c'),
    ],
)
def test_quoted_breaks_refuse_what_is_no_record(spark, tmp_path, spoil):
    path = tmp_path / "o.csv"
    write_csv(path, order_row(product_name="two\nlines"), order_row())
    path.write_text(spoil(path.read_text()))
    with pytest.raises(Exception, match="malformed"):
        load_orders(spark, str(path), quoted_breaks=True).collect()


def test_load_reports_what_is_missing(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        load_orders(spark, str(tmp_path / "none.csv"))
    path = write_csv(tmp_path / "o.csv", order_row(), headers=HEADERS[:-1])
    with pytest.raises(ValueError, match="order_id"):
        load_orders(spark, path)


def test_file_order_across_splits(spark, tmp_path):
    rows = [order_row(order_id=str(i)) for i in range(400)]
    path = write_csv(tmp_path / "o.csv", *rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = load_orders(spark, path, file_order=True)
        assert df.rdd.getNumPartitions() > 2
        assert [r.order_id for r in df.orderBy("file_order").collect()] == [str(i) for i in range(400)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_clean_orders_and_report(spark, tmp_path):
    path = write_csv(
        tmp_path / "o.csv",
        order_row(), order_row(),
        order_row(order_id="2", unit_price="abc"),
        order_row(order_id="3", quantity="", order_date="never"),
    )
    raw = load_orders(spark, path, file_order=True)
    clean = c.clean_orders(raw, order_key="file_order")
    rows = by(clean, "order_id")
    assert len(rows) == 3
    good = rows["order_id text"]
    assert (good["order_date"], good["ship_date"]) == (D(2013, 1, 2), D(2013, 2, 13))
    assert float(good["sales_amount_with_shipping"]) == 6.0
    report = {k: r["value"] for k, r in by(c.quality_report(raw, clean), "metric", "column").items()}
    assert report[("rows_in", None)] == 4 and report[("rows_out", None)] == 3
    assert report[("duplicate_rows", None)] == 1
    assert report[("unparsed_dates", "order_date")] == 1 and report[("unparsed_dates", "ship_date")] == 0
    assert report[("failed_numbers", "unit_price")] == 1 and report[("failed_numbers", "quantity")] == 0
    assert report[("non_null", "sales_amount")] == 1
    assert report[("columns", None)] == len(clean.columns)


def test_rejected_rows_keep_their_text(spark, tmp_path):
    path = write_csv(
        tmp_path / "o.csv",
        order_row(), order_row(order_id="2", unit_price="abc", ship_date="soon"), order_row(order_id="2", unit_price="abc", ship_date="soon"),
        order_row(order_id="3", quantity="", order_date=" "), order_row(order_id="4", quantity="2.5"),
    )
    raw = load_orders(spark, path)
    got = sorted((r.order_id, r.unit_price, r.rejected_for) for r in c.rejected_rows(raw).collect())
    assert got == [("2", "abc", "ship_date,unit_price")] * 2 + [("4", "2.50", "quantity")]
    plan = c.rejected_rows(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_write_output_formats(spark, tmp_path):
    df = spark.createDataFrame([("a,b", 1.5), ('say "x"', None)], "t string, v double")
    for fmt in ("parquet", "csv"):
        path = write_output(df, str(tmp_path / fmt), fmt)
        back = spark.read.parquet(path) if fmt == "parquet" else spark.read.schema(df.schema).csv(
            path, header=True, escape='"'
        )
        assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(ValueError, match="format"):
        write_output(df, str(tmp_path / "x"), "xls")
    write_output(df, str(tmp_path / "parts"), partition_by=["t"])
    assert spark.read.parquet(str(tmp_path / "parts")).where(F.col("t") == "a,b").count() == 1


# --- profiles ----------------------------------------------------------------------------


def test_profile_numeric_matches_pandas(spark):
    pdf = spark.range(101).select((F.col("id") * 1.5).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("y"))
    want = pdf.toPandas().describe().T
    for name, row in by(profiling.profile_numeric(pdf, ["x", "y"]), "column").items():
        got = [row[k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(list(want.loc[name]))


def test_profile_text(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y"), ("a", None)], "s string, t string")
    rows = by(profiling.profile_text(df), "column")
    assert rows["s"] == {"column": "s", "count": 4, "unique": 2, "top": "a", "freq": 2}
    assert rows["t"] == {"column": "t", "count": 2, "unique": 2, "top": "x", "freq": 1}


def test_a_row_with_too_few_or_too_many_fields_raises_whatever_is_read(spark, tmp_path):
    for extra in (-8, 2):
        path = write_csv(tmp_path / f"orders{extra}.csv", order_row())
        lines = open(path).read().splitlines()
        fields = lines[1].split(",")
        with open(path, "a") as file:
            file.write(",".join(fields[:extra] if extra < 0 else [*fields, *fields[:extra]]) + "\n")
        orders = load_orders(spark, path)
        for read in (lambda: orders.collect(), lambda: orders.select("order_id", "quantity").collect(), lambda: orders.count()):
            with pytest.raises(Exception, match="MALFORMED"):
                read()


def test_numbers_are_judged_as_written(spark):
    texts = ["3", "3.0", "3.", " 3 ", "+3", "-3", "3e0", "3.00001", "2.5", "x", "", "99999999999", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(c.number_expr("t", "int")).collect()]
    assert got == [3, 3, 3, 3, 3, -3, 3, None, None, None, None, None, None]


def test_an_epoch_beyond_all_dates_is_null(spark):
    df = spark.createDataFrame([("99999999999999999999",), ("0",)], "t string")
    got = [r[0] for r in df.select(c.order_date_expr("t", "epoch_ms")).collect()]
    assert got[0] is None and str(got[1]) == "1970-01-01"


def test_profiles_have_a_row_for_every_column(spark):
    df = spark.createDataFrame([(1.0, None, "a", None)], "x double, y double, s string, t string")
    numbers = by(profiling.profile_numeric(df, ["x", "y"]), "column")
    assert numbers["x"]["count"] == 1 and numbers["y"]["count"] == 0 and numbers["y"]["mean"] is None
    for rows, count in ((df, 1), (df.limit(0), 0)):
        texts = by(profiling.profile_text(rows), "column")
        assert texts["s"]["count"] == count and texts["t"] == {"column": "t", "count": 0, "unique": 0, "top": None, "freq": None}


def test_a_rewritten_table_is_read_as_it_is(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "part.parquet"))
    assert table(spark, str(tmp_path), "part").columns == ["id"]
    spark.range(3).selectExpr("id as other").write.mode("overwrite").parquet(str(tmp_path / "part.parquet"))
    assert sorted(r.other for r in table(spark, str(tmp_path), "part").collect()) == [0, 1, 2]
