"""The order-lines data model: one row per order line, 18 columns as loaded."""

from __future__ import annotations

import re

# The headers of the raw order file, in file order. A header may
# carry stray blanks (the real file has "Quantity "), see snake_name.
RAW_HEADERS = (
    "Order Priority",
    "Unit Price",
    "Shipping Cost",
    "Customer ID",
    "Customer Name",
    "Ship Mode",
    "Customer Segment",
    "Product Category",
    "Product Sub-Category",
    "Product Container",
    "Product Name",
    "Region",
    "State or Province",
    "City",
    "Order Date",
    "Ship Date",
    "Quantity",
    "Order ID",
)

DATE_COLUMNS = ("order_date", "ship_date")

NUMERIC_TYPES = {
    "unit_price": "decimal(10,2)",
    "shipping_cost": "decimal(10,2)",
    "quantity": "int",
}

CATEGORY_COLUMNS = (
    "order_priority",
    "customer_segment",
    "product_category",
    "product_sub_category",
    "ship_mode",
)


def snake_name(header: str) -> str:
    """``'Quantity '`` -> ``quantity``, ``'Product Sub-Category'`` and
    ``ProductSubCategory`` -> ``product_sub_category``."""
    spaced = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", " ", header.strip())
    return re.sub(r"[^0-9a-z]+", "_", spaced.lower()).strip("_")


ORDER_COLUMNS = tuple(snake_name(h) for h in RAW_HEADERS)
