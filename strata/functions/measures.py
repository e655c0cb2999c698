"""Sales measures as fixed-point decimals.

Names, types and formulas of the measures are fixed values: stored hashes cover their results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)
BASE_MEASURES = ("Quantity", "UnitPrice", "TaxRate", "PickedQuantity")


def or_zero(column: str) -> Column:
    """Missing measures count as zero."""
    return F.coalesce(F.col(column), F.lit(0)).cast(MONEY)


def net_amount(quantity: Column, price: Column) -> Column:
    return (quantity * price).cast(MONEY)


def tax_on(net: Column, percent: Column) -> Column:
    return (net * percent / 100).cast(MONEY)


def sales_measures() -> dict[str, Column]:
    """The base measures as decimals, and net, tax and gross built on them; each result is rounded half up to four digits."""
    base = {name: or_zero(name) for name in BASE_MEASURES}
    net = net_amount(base["Quantity"], base["UnitPrice"])
    tax = tax_on(net, base["TaxRate"])
    return {**base, "sales_amount_net": net, "tax_amount": tax, "sales_amount_gross": (net + tax).cast(MONEY)}


def with_sales_measures(df: DataFrame) -> DataFrame:
    """All measures in one projection."""
    return df.withColumns(sales_measures())
