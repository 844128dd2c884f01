from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Accepted date layouts, tried in this order (month first unless invalid).
DATE_FORMATS = ("yyyy/MM/dd", "MM/dd/yyyy", "MM-dd-yyyy", "dd-MM-yyyy")


def layout_pattern(layout: str) -> str:
    """The texts that can hold a date in a numeric layout."""
    parts = {"yyyy": r"\d{4}", "MM": "(0[1-9]|1[0-2])", "dd": r"(0[1-9]|[12]\d|3[01])"}
    return "^" + "".join(parts.get(part, re.escape(part)) for part in re.split("(yyyy|MM|dd)", layout)) + "$"


def normalise_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """A date from text in mixed layouts; null where none fits.

    A failed parse costs an exception, so a text is only parsed in layouts whose
    pattern it has.
    """
    return F.coalesce(
        *[F.when(text.rlike(layout_pattern(layout)), F.try_to_date(text, layout)) for layout in formats]
    )


def iso_date(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def compact_date(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd")


def compact_timestamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMddHHmmss")
