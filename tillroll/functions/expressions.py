"""Column expressions shared by the operators. All are built-in and null-safe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_double(value: Column) -> Column:
    """Exact decimal sums become doubles only here, after summing."""
    return value.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """True division in doubles; null when the divisor is 0 or null."""
    return F.try_divide(as_double(num), as_double(den))


def growth_pct(current: Column, previous: Column) -> Column:
    """``(current / previous - 1) * 100``."""
    return (ratio(current, previous) - 1) * 100


def change_pct(current: Column, previous: Column, integer_division: bool = False) -> Column:
    """``(current - previous) / previous * 100``. With ``integer_division`` the
    quotient is cut to a whole number first, as INT / INT is in T-SQL."""
    quotient = ratio(current - previous, previous)
    if integer_division:
        quotient = quotient.cast("bigint")
    return quotient * 100


def compound_rate(first: Column, last: Column, periods: Column) -> Column:
    """``(last / first) ** (1 / periods) - 1`` in doubles, so the exponent is not
    a decimal of limited scale. Null when a divisor is 0."""
    return F.pow(ratio(last, first), ratio(F.lit(1), periods)) - 1


def number_or_null(value: Column) -> Column:
    """NaN is the largest double in Spark; drop it before comparing."""
    return F.nanvl(as_double(value), F.lit(None).cast("double"))


def right_closed(value: Column, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label of the bin ``(edges[i], edges[i + 1]]``; null outside and for null/NaN.

    An edge may be a number or a Column. A last edge of infinity is open.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("one label per bin: need len(edges) == len(labels) + 1")
    edge = [e if isinstance(e, Column) else F.lit(float(e)) for e in edges]
    value = number_or_null(value)
    out = F.when(value <= edge[0], F.lit(None).cast("string"))
    for upper, label in zip(edge[1:], labels):
        out = out.when(value <= upper, F.lit(label))
    return out


def money_text(value: Column) -> Column:
    """``1234.5`` -> ``$1,234.50`` (half-even on the binary value)."""
    return F.concat(F.lit("$"), F.format_number(as_double(value), 2))


def percent_text(value: Column) -> Column:
    """``1234.5`` -> ``1234.50%``, without thousands separators."""
    return F.concat(F.replace(F.format_number(as_double(value), 2), F.lit(","), F.lit("")), F.lit("%"))


def resolve_year(orders: DataFrame, as_of_year: int | None, date: str = "order_date") -> Column:
    """The analysis year as a Column: the given one, or the last year in the data.

    The default is an uncorrelated scalar subquery over one column; Spark runs it
    once per query however often it is used.
    """
    if as_of_year is not None:
        return F.lit(int(as_of_year))
    return orders.agg(F.year(F.max(date)).alias("as_of_year")).scalar()


def year_start(year: int) -> Column:
    """1 January as a literal, so a filter on it reaches the file scan."""
    return F.lit(f"{int(year):04d}-01-01").cast("date")
