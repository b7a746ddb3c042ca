"""What several test modules share. Not in a conftest, whose module name every folder of tests has."""

from __future__ import annotations

from pyspark.sql import types as T

LINE_SCHEMA = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("shipping_cost", T.DecimalType(10, 2)),
        T.StructField("place", T.LongType()),
    ]
)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def by(df, *keys):
    rows = [r.asDict() for r in df.collect()]
    out = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(out) == len(rows)
    return out
