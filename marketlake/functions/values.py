"""Prices: text to decimal, and the test for a usable price."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.schemas import PRICE


def to_price(value: Column) -> Column:
    """Text or number to decimal(20,8); text that is no number raises (ANSI cast)."""
    return value.cast(PRICE)


def try_price(value: Column) -> Column:
    """The same, with NULL for text that is no number, so the row can be set aside."""
    return value.try_cast(PRICE)


def is_priced(price: Column) -> Column:
    """True for a price that is present and not zero."""
    return F.coalesce(price != 0, F.lit(False))
