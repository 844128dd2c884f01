from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def nth_match(text: Column, pattern: str, n: int, default: str = "") -> Column:
    """The n-th match (from 1) of ``pattern``; ``default`` where there are fewer, or text is null."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(F.try_element_at(matches, F.lit(n)), F.lit(default))


def import_date(path: Column) -> Column:
    """The first run of eight digits in a path, or an empty string."""
    return F.regexp_extract(path, "[0-9]{8}", 0)


def parent_folder(path: Column) -> Column:
    """A path without its last segment."""
    return F.regexp_replace(path, "/[^/]*$", "")


def contains_ignoring_case(text: Column, token: str) -> Column:
    return F.lower(text).contains(token.lower())


def concat_key(columns: Sequence[str | Column], separator: str = "$$") -> Column:
    """Key text that leaves nulls out, so keys with nulls in different places can meet."""
    return F.concat_ws(separator, *columns)


def split_list(text: Column, separator: str = ",") -> Column:
    return F.split(text, separator)
