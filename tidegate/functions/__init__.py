"""Column functions: every one returns a native Spark expression."""

from tidegate.functions.dates import (
    DATE_FORMATS,
    compact_date,
    compact_timestamp,
    iso_date,
    normalise_date,
)
from tidegate.functions.text import (
    concat_key,
    contains_ignoring_case,
    import_date,
    nth_match,
    parent_folder,
    split_list,
)
from tidegate.functions.units import celsius, leading_number

__all__ = [
    "DATE_FORMATS", "celsius", "compact_date", "compact_timestamp", "concat_key",
    "contains_ignoring_case", "import_date", "iso_date", "leading_number",
    "normalise_date", "nth_match", "parent_folder", "split_list",
]
