"""Projection operators: lineage, padding, renaming, casting, tenant id, stamps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import import_date, iso_date, nth_match
from tidegate.operators.flatten import quoted
from tidegate.spec import LINEAGE

# Partition keys of dated layouts, and the stamps of row versions.
IMPORT_KEYS = ("import_year", "import_month", "import_day", "import_date")
SNAPSHOT_KEYS = ("snapshot_year", "snapshot_month", "snapshot_day", "snapshot_date")
CURRENT_FLAG = "N"
EXPIRED_FLAG = "Y"
OPEN_END = "9999-12-31"

# Working columns that the readers add and the loaders drop again.
SOURCE_FILE = "__source_file"
SOURCE_ORDER = "__source_order"
# When a stream took the row up.
ARRIVED = "__arrived"
# Text of a record that could not be parsed, or of the values that do not fit their types.
CORRUPT = "corrupt_record"
# Names of the columns whose values do not fit the types a dataset declares.
MISFITS = "misfit_columns"


def resolve_name(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of a column name, or None, under the session's rule for case."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return None
    return next((other for other in df.columns if other.lower() == name.lower()), None)


def stamp_lineage(
    df: DataFrame,
    job_id: str | Column,
    file_name: str | Column | None,
    load_date: str | Column | None = None,
    columns: Sequence[str] = LINEAGE,
) -> DataFrame:
    """Add job id, file name and load date (or the ``columns`` of these that are wanted).

    A pinned date makes a rerun give the same rows.
    """
    def literal(value):
        return value if isinstance(value, Column) else F.lit(value)

    day = iso_date(F.current_timestamp()) if load_date is None else literal(load_date)
    stamps = {"job_id": literal(job_id), "file_name": literal(file_name), "file_load_dt": day}
    return df.withColumns({name: stamps[name] for name in columns})


def pad_and_project(
    df: DataFrame,
    columns: Sequence[str],
    optional: Iterable[str] = (),
    missing_value: str | None = "",
) -> DataFrame:
    """The declared columns in declared order; absent ones hold ``missing_value``, others go.

    Columns named in ``optional`` follow where the frame has them.
    """
    chosen = []
    for name in columns:
        found = resolve_name(df, name)
        value = quoted((found,)) if found is not None else F.lit(missing_value).cast("string")
        chosen.append(value.alias(name))
    for name in optional:
        found = resolve_name(df, name)
        if found is not None and name not in columns:
            chosen.append(quoted((found,)).alias(name))
    return df.select(*chosen)


def settle_types(
    df: DataFrame,
    types: Mapping[str, str],
    corrupt: str = CORRUPT,
    casts: Mapping[str, str] | None = None,
    misfits: str | None = None,
) -> DataFrame:
    """Give columns their types; values that do not fit become null and are kept as text in ``corrupt``.

    ``types`` are those of text columns whose files hold typed values. ``casts`` are declared for
    columns of any type, where blank text stands for no value; they go before ``types``. With
    ``misfits`` the names of the columns that did not fit are kept there, for counting. A record
    that is corrupt as a whole keeps its own text.
    """
    declared = {name: kind for name, kind in (casts or {}).items() if name in df.columns}
    kinds = {name: types[name] for name, kind in df.dtypes if kind == "string" and types.get(name, "string") != "string"}
    kinds |= declared
    whole = [F.col(corrupt)] if corrupt in df.columns else []
    if not kinds:
        return df if misfits is None else df.withColumn(misfits, F.lit(None).cast("array<string>"))
    text = {name: quoted((name,)).cast("string") for name in kinds}
    cast = {name: text[name].try_cast(kind) for name, kind in kinds.items()}

    def wrong(name: str) -> Column:
        held = text[name].isNotNull() & (F.trim(text[name]) != "") if name in declared else text[name].isNotNull()
        return F.when(held & cast[name].isNull(), F.struct(F.lit(name).alias("key"), text[name].alias("value")))

    found = F.array_compact(F.array(*map(wrong, kinds)))
    kept = {corrupt: F.coalesce(*whole, F.when(F.size(found) > 0, F.to_json(F.map_from_entries(found))))}
    if misfits is not None:
        kept[misfits] = F.when(F.size(found) > 0, F.transform(found, lambda pair: pair["key"]))
    return df.withColumns({**kept, **cast})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename in order; names the frame does not have are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old != new})


def cast_declared(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Apply declared types; text that does not fit (also the empty text of a padded column) becomes null."""
    present = {name: kind for name, kind in casts.items() if name in df.columns}
    return df.withColumns({name: quoted((name,)).cast("string").try_cast(kind) for name, kind in present.items()})


def cast_failures(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """One row: per column, how many non-blank values do not fit their declared type."""
    def failed(name: str, kind: str) -> Column:
        text = quoted((name,)).cast("string")
        return F.count_if(text.isNotNull() & (F.trim(text) != "") & text.try_cast(kind).isNull())

    return df.agg(*[failed(name, kind).alias(name) for name, kind in casts.items()])


def tenant_id(link: Column, pattern: str = "[^/]+") -> Column:
    """The tenant in a link: its second path segment, or an empty text."""
    return nth_match(link, pattern, 2)


def add_tenant(df: DataFrame, link_column: str, pattern: str = "[^/]+", target: str = "company_id") -> DataFrame:
    """Replace the link by the tenant id of each row; without a link column nothing is added."""
    if link_column not in df.columns:
        return df
    return df.withColumn(link_column, tenant_id(quoted((link_column,)), pattern)).withColumnRenamed(link_column, target)


def file_tenants(
    links: DataFrame,
    link_column: str,
    pattern: str = "[^/]+",
    target: str = "company_id",
    file_column: str = SOURCE_FILE,
    order_column: str = SOURCE_ORDER,
) -> DataFrame:
    """The tenant id of each file, taken from the link in its first row: one row per file."""
    first = links.groupBy(file_column).agg(F.min_by(link_column, order_column).alias("__first_link"))
    return first.select(file_column, tenant_id(F.col("__first_link"), pattern).alias(target))


def add_file_tenant(df: DataFrame, tenants: DataFrame, link_column: str, file_column: str = SOURCE_FILE) -> DataFrame:
    """Replace the link by the tenant id of the row's file.

    The join has no hint: adaptive execution broadcasts the lookup once it has
    measured it to be small, and splits the rows of a very large file otherwise.
    """
    return df.drop(link_column).join(tenants, file_column, "left")


def add_import_date(df: DataFrame, path: Column | str) -> DataFrame:
    """Date and date parts from the first eight digits of a path (a column, or one text for all rows)."""
    day = import_date(path if isinstance(path, Column) else F.lit(path))
    return df.withColumns({
        "import_date": day,
        "import_day": F.substring(day, 7, 2),
        "import_month": F.substring(day, 5, 2),
        "import_year": F.substring(day, 1, 4),
    })


def date_parts(df: DataFrame, day: Column, keys: Sequence[str] = IMPORT_KEYS) -> DataFrame:
    """Year, month, day and date columns, named for a dated layout."""
    layouts = ("yyyy", "MM", "dd", "yyyyMMdd")
    return df.withColumns({key: F.date_format(day, layout) for key, layout in zip(keys, layouts)})


def mark_current(df: DataFrame) -> DataFrame:
    return df.withColumns({"flag_del": F.lit(CURRENT_FLAG), "last_updt_dt": F.lit(OPEN_END)})


def mark_expired(df: DataFrame, run_date: str | Column) -> DataFrame:
    day = run_date if isinstance(run_date, Column) else F.lit(run_date)
    return df.withColumns({"flag_del": F.lit(EXPIRED_FLAG), "last_updt_dt": day})


def drop_duplicates(df: DataFrame, keys: Sequence[str] | None = None, ignore: Sequence[str] = ()) -> DataFrame:
    """Drop equal rows, or rows equal in ``keys``, or in all columns but ``ignore``.

    Copies meet in a partial aggregate before the shuffle, so a value that is
    repeated very often reaches the reducers as one row per task.
    """
    if keys is None and not ignore:
        return df.dropDuplicates()
    chosen = list(keys) if keys is not None else [name for name in df.columns if name not in ignore]
    return df.dropDuplicates(chosen)


# Between the texts of a packed row; the mark in front of one that a text holds itself, and of a null.
_BETWEEN, _MARK = "\x1e", "\x1b"


def drop_text_duplicates(df: DataFrame) -> DataFrame:
    """Drop equal rows, like :func:`drop_duplicates`, of many text columns with well-formed texts, as parsers give.

    The texts of a row go through the aggregate and the shuffle as one, so a short text takes its own
    length and not the 16 bytes and more that a column of its own takes in every row.
    """
    texts = [name for name, kind in df.dtypes if kind == "string"]
    packed = "__packed"
    if len(texts) < 2 or packed in df.columns:
        return drop_duplicates(df)

    def pack(text: Column) -> Column:
        plain = F.replace(F.replace(text, F.lit(_MARK), F.lit(f"{_MARK}0")), F.lit(_BETWEEN), F.lit(f"{_MARK}1"))
        return F.coalesce(plain, F.lit(f"{_MARK}2"))

    def unpack(part: Column) -> Column:
        plain = F.replace(F.replace(part, F.lit(f"{_MARK}1"), F.lit(_BETWEEN)), F.lit(f"{_MARK}0"), F.lit(_MARK))
        return F.when(part != f"{_MARK}2", plain)

    others = [quoted((name,)) for name in df.columns if name not in texts]
    rows = df.select(F.concat_ws(_BETWEEN, *[pack(quoted((name,))) for name in texts]).alias(packed), *others).dropDuplicates()
    parts = rows.select(F.split(packed, _BETWEEN, -1).alias(packed), *others)
    place = {name: n for n, name in enumerate(texts)}
    return parts.select(*[unpack(F.col(packed)[place[name]]).alias(name) if name in place else quoted((name,)) for name in df.columns])
