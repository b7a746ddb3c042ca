"""From raw order-line text to typed rows with amounts."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.schema import CATEGORY_COLUMNS, DATE_COLUMNS, NUMERIC_TYPES, snake_name

# How a date may be written, tried in turn: the text and its ISO form. Other text
# becomes "--", which is no date. So do a month or day that no calendar has: the cast would
# throw inside, per row, where a month is a day. These decide how an ambiguous
# date reads.
_MONTH, _DAY = "(0?[1-9]|1[0-2])", "(0?[1-9]|[12][0-9]|3[01])"
MONTH_DAY_YEAR = (rf"(?s)^(?:{_MONTH}/{_DAY}/([0-9]{{4}})|.*)$", "$3-$1-$2")
DAY_MONTH_YEAR = (rf"(?s)^(?:{_DAY}/{_MONTH}/([0-9]{{4}})|.*)$", "$3-$2-$1")
YEAR_MONTH_DAY = (rf"(?s)^(?:([0-9]{{4}})[-/]{_MONTH}[-/]{_DAY}|.*)$", "$1-$2-$3")
DATE_STYLES = {
    "month_first_fallback": (MONTH_DAY_YEAR, DAY_MONTH_YEAR),
    "day_first": (DAY_MONTH_YEAR,),
    "year_first": (YEAR_MONTH_DAY, MONTH_DAY_YEAR),
}
DATE_MODES = (*DATE_STYLES, "epoch_ms")

CODE_RANGES = 1_000


def normalize_columns(df: DataFrame) -> DataFrame:
    """Trim header blanks and name columns in snake_case."""
    return df.toDF(*[snake_name(c) for c in df.columns])


def order_date_expr(value: str | Column, mode: str = "month_first_fallback") -> Column:
    """Text (or epoch milliseconds) as a date; null when it cannot be read."""
    value = F.col(value) if isinstance(value, str) else value
    if mode == "epoch_ms":
        # Whole UTC days, whatever the session time zone is.
        days = F.floor(value.try_cast("double") / F.lit(86_400_000.0))
        return F.date_from_unix_date(days.try_cast("int"))
    if mode not in DATE_STYLES:
        raise ValueError(f"unknown date mode {mode!r}; one of {', '.join(DATE_MODES)}")
    # A failing cast gives null; a failing date pattern would throw inside, per row.
    return F.coalesce(
        *[F.regexp_replace(value, text, iso).try_cast("date") for text, iso in DATE_STYLES[mode]]
    )


def parse_order_dates(
    df: DataFrame, cols: Iterable[str] = DATE_COLUMNS, mode: str = "month_first_fallback"
) -> DataFrame:
    """Replace each text date by a date. Columns that are dates already stay."""
    todo = [c for c in cols if not isinstance(df.schema[c].dataType, T.DateType)]
    return df.withColumns({c: order_date_expr(c, mode) for c in todo})


def dedupe_orders(df: DataFrame, order_key: str | None = None) -> DataFrame:
    """Keep one of each group of rows equal in all columns, null equal to null. With
    an ``order_key``, which is no part of the comparison, the first one stays.

    Copies merge in the map-side aggregate, so a large group of copies sends one
    row per task through the shuffle.
    """
    if order_key is None:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c != order_key]
    return df.groupBy(*rest).agg(F.min(order_key).alias(order_key))


def number_expr(value: str | Column, type_name: str) -> Column:
    """Text as a number, null when it is not one. A whole type takes ``3.0`` too."""
    value = F.col(value) if isinstance(value, str) else value
    if type_name == "int":
        # Judged as written: rounding first would take 3.00001 for 3.
        text, exact = value.cast("string"), value.try_cast("decimal(38,18)")
        whole = F.regexp_extract(text, r"^\s*([+-]?[0-9]+)(?:\.0*)?\s*$", 1)
        return F.when(whole != "", whole.try_cast("int")).when(
            text.rlike("[eE]") & (exact == F.floor(exact)), exact.try_cast("int")
        )
    return value.try_cast(type_name)


def coerce_numerics(df: DataFrame, types: Mapping[str, str] = NUMERIC_TYPES) -> DataFrame:
    return df.withColumns({c: number_expr(c, t) for c, t in types.items()})


def add_sales_amounts(df: DataFrame) -> DataFrame:
    """Price x quantity, without and with shipping. Running it twice changes nothing."""
    sales = F.col("unit_price") * F.col("quantity")
    return df.withColumns(
        {"sales_amount": sales, "sales_amount_with_shipping": sales + F.col("shipping_cost")}
    )


def add_calendar(df: DataFrame, date: str = "order_date") -> DataFrame:
    """Calendar year and English month name of the order date."""
    return df.withColumns(
        {"order_year": F.year(date), "order_month_name": F.date_format(date, "MMMM")}
    )


def value_ranges(counted: DataFrame) -> DataFrame:
    """Add ``range`` to ``column, value`` rows that are distinct: ranges ascend with the
    values of a column and hold about one value in ``CODE_RANGES``.

    The values that bound the ranges are those of lowest hash, so every evaluation draws the
    same ones, about ``CODE_RANGES`` a column however large its domain is.
    """
    # One entry per column asked for in either map.
    sizes = (
        counted.groupBy("column")
        .agg(F.count(F.lit(1)).alias("size"))
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "size"))).alias("sizes"))
        .scalar()
    )
    share = F.pmod(F.xxhash64("value"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    bounds = (
        counted.where(share * sizes[F.col("column")] < CODE_RANGES)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list("value")).alias("bounds"))
        .agg(F.map_from_entries(F.collect_list(F.struct("column", "bounds"))).alias("bounds"))
        .scalar()
    )
    bounded = counted.withColumn("bounds", F.coalesce(bounds[F.col("column")], F.array().cast("array<string>")))
    below = F.filter("bounds", lambda bound: bound <= F.col("value"))
    return bounded.withColumn("range", F.size(below)).drop("bounds")


def category_codes(df: DataFrame, cols: Iterable[str] = CATEGORY_COLUMNS) -> DataFrame:
    """``column, value, code, n``: the domain of each categorical column; the code is
    the 0-based rank of the value in text order, nulls excluded.

    Values are ranked inside ranges of a column, and the sizes of the ranges before are
    added, so no task has a whole domain.
    """
    counted = (
        df.select(*[F.col(c).cast("string") for c in cols])
        .unpivot([], list(cols), "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranged = value_ranges(counted)
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("column", "range")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("column", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    )
    rank = F.row_number().over(Window.partitionBy("column", "range").orderBy("value"))
    placed = ranged.withColumn("rank", rank).join(starts, ["column", "range"])
    return placed.select("column", "value", (F.col("start") + F.col("rank") - 1).cast("bigint").alias("code"), "n")


def clean_orders(
    df: DataFrame, date_mode: str = "month_first_fallback", order_key: str | None = None
) -> DataFrame:
    """Names, dates, duplicates, numbers, amounts - in this order, as duplicates are
    judged on parsed dates but on the numbers as written."""
    df = parse_order_dates(normalize_columns(df), mode=date_mode)
    return add_sales_amounts(coerce_numerics(dedupe_orders(df, order_key)))


def _unreadable(raw: DataFrame, date_mode: str) -> dict[tuple[str, str], Column]:
    """By metric and column, whether a row has a value there that cleaning cannot read."""
    dates = [c for c in DATE_COLUMNS if not isinstance(raw.schema[c].dataType, T.DateType)]

    def given(c: str) -> Column:
        return F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != "")

    bad = {("unparsed_dates", c): given(c) & order_date_expr(c, date_mode).isNull() for c in dates}
    return bad | {
        ("failed_numbers", c): given(c) & number_expr(c, t).isNull() for c, t in NUMERIC_TYPES.items()
    }


def rejected_rows(raw: DataFrame, date_mode: str = "month_first_fallback") -> DataFrame:
    """The raw rows, as they came, with a date or number that cleaning cannot read, and
    ``rejected_for``: the names of those columns, comma-joined. Blank values are no rejects;
    repeated rows are repeated here. One pass, nothing is shuffled.
    """
    raw = normalize_columns(raw)
    bad = _unreadable(raw, date_mode)
    names = F.concat_ws(",", *[F.when(test, F.lit(c)) for (_, c), test in bad.items()])
    return raw.withColumn("rejected_for", names).where(F.col("rejected_for") != "")


def quality_report(
    raw: DataFrame, clean: DataFrame, date_mode: str = "month_first_fallback"
) -> DataFrame:
    """``metric, column, value``: what cleaning took in, gave out and could not read.

    One pass over each frame; neither is shuffled, only the counts meet.
    """
    raw = normalize_columns(raw)

    def long_form(df: DataFrame, counts: dict[tuple[str, str | None], Column]) -> DataFrame:
        one = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(counts.values())])
        rows = [
            F.struct(
                F.lit(metric).alias("metric"),
                F.lit(column).cast("string").alias("column"),
                F.col(f"m{i}").cast("bigint").alias("value"),
            )
            for i, (metric, column) in enumerate(counts)
        ]
        return one.select(F.inline(F.array(*rows)))

    n = F.count(F.lit(1))
    before = {("rows_in", None): n, ("duplicate_rows", None): n}
    before |= {key: F.count_if(bad) for key, bad in _unreadable(raw, date_mode).items()}
    after = {
        ("rows_out", None): n,
        ("duplicate_rows", None): -n,
        ("columns", None): F.max(F.lit(len(clean.columns))),
    }
    after |= {("non_null", c): F.count(c) for c in clean.columns}
    # Cleaning drops rows only as duplicates, so their number is rows in - rows out.
    return (
        long_form(raw, before)
        .unionByName(long_form(clean, after))
        .groupBy("metric", "column")
        .agg(F.sum("value").alias("value"))
    )
