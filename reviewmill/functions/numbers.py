"""Lenient number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Double.valueOf would also take "5d" or "0x1p3", which are not numbers in a review file.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def to_number(column: Column) -> Column:
    """String to double; anything that is not a decimal number becomes null."""
    text = column.cast("string")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_flag(column: Column) -> Column:
    """0/1 flag: parsed as a number, null, unreadable or out of range becomes 0, fraction cut off."""
    return F.coalesce(to_number(column).try_cast("int"), F.lit(0))


def whole_number_text(column: Column) -> Column:
    """A value that reads as a whole number in its shortest form ("5.00" becomes "5"); others as they are."""
    number = to_number(column)
    whole = F.when(number == F.floor(number), number.try_cast("long").cast("string"))
    return F.coalesce(whole, column.cast("string"))
