"""Retail sales analytics on Spark: lazy operators over one order-lines DataFrame."""
