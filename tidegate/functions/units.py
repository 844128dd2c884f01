from __future__ import annotations

from pyspark.sql import Column, functions as F


def leading_number(text: Column) -> Column:
    """The number at the start of a text with a unit, as double; null where there is none."""
    return F.regexp_extract(text, r"^\s*([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)", 1).try_cast("double")


def celsius(text: Column) -> Column:
    """Degrees Celsius from text such as ``12.13°C`` or ``-28.87°F``."""
    degrees = leading_number(text)
    return F.when(F.regexp_extract(text, r"°\s*([A-Za-z])", 1) == "F", (degrees - 32) * 5 / 9).otherwise(degrees)
