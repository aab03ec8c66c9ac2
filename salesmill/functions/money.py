"""Exact money arithmetic.

A sum of doubles depends on the order of the rows, and so on the partitioning. Sums
here add decimals instead: the same on one core and on a thousand executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

LINE_AMOUNT = "decimal(10,2)"
TOTAL_AMOUNT = "decimal(15,2)"
# Doubles enter a sum with six decimals each, the sum is rounded to cents.
EXACT_AMOUNT = "decimal(20,6)"


def cents(amount: Column) -> Column:
    """Two decimals, halves away from zero."""
    return amount.cast(LINE_AMOUNT)


def exact(df: DataFrame, name: str, amount: str = EXACT_AMOUNT) -> Column:
    """A column as decimal; one that is decimal already is taken as it is. Others are cut to
    the scale of ``amount`` row by row: six decimals unless another is asked for."""
    is_decimal = isinstance(df.schema[name].dataType, DecimalType)
    return F.col(name) if is_decimal else F.col(name).cast(amount)


def exact_sum(amount: Column) -> Column:
    """Order-independent sum of a decimal, rounded to two places once at the end."""
    return F.round(F.sum(amount), 2).cast(TOTAL_AMOUNT)
