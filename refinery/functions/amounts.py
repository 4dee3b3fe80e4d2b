"""Repair of sales amounts and unit prices; both look at the raw values, so the order does not matter."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def repaired_amount(amount: Column, quantity: Column, price: Column) -> Column:
    """An amount that is missing, not positive, or other than quantity * |price| gives way to that product.

    With a missing quantity or price there is no product to differ from, so a positive amount stays. The product is
    taken in bigint, so it cannot overflow; one that is no int becomes NULL.
    """
    product = quantity.cast("bigint") * F.abs(price.cast("bigint"))
    missing, not_positive, other = amount.isNull(), amount <= 0, amount != product
    return F.when(missing | not_positive | other, product.try_cast("int")).otherwise(amount)


def repaired_price(price: Column, amount: Column, quantity: Column) -> Column:
    """A price that is missing or not positive gives way to amount / quantity, NULL for no quantity."""
    missing, not_positive = price.isNull(), price <= 0
    return F.when(missing | not_positive, amount / F.nullif(quantity, F.lit(0))).otherwise(price.cast("double"))
