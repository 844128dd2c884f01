"""Nested documents to flat rows.

Names and steps come from the schema alone, so flattening adds no job: one
generator per array, and one projection per nesting level that Catalyst merges
with its neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructField, StructType

from tidegate.spec import SpecError

Namer = Callable[[tuple[str, ...]], str]

NAMING: dict[str, Namer] = {
    "path": "_".join,
    "leaf": lambda path: path[-1],
}


def quoted(path: Sequence[str]) -> Column:
    """A column reference that also works for names holding dots or back-ticks."""
    return F.col(".".join("`" + part.replace("`", "``") + "`" for part in path))


def leaf_paths(schema: StructType, parent: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], DataType]]:
    """Paths of everything that is not a struct: a level's own columns, then its structs, last one first."""
    structs = []
    for column in schema.fields:
        path = (*parent, column.name)
        if isinstance(column.dataType, StructType):
            structs.append((path, column.dataType))
        else:
            yield path, column.dataType
    for path, struct in reversed(structs):
        yield from leaf_paths(struct, path)


def _named(df: DataFrame, names: Iterable[str], on_collision: str) -> list[str]:
    """Check flat names for clashes, under the session's own rule for upper and lower case."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    used: dict[str, int] = {}
    result = []
    for name in names:
        key = name if exact else name.lower()
        used[key] = used.get(key, 0) + 1
        if used[key] > 1:
            if on_collision != "suffix":
                raise SpecError(f"flattening gives more than one column named {name!r}")
            name = f"{name}_{used[key]}"
        result.append(name)
    return result


def flatten_structs(
    df: DataFrame,
    naming: str = "path",
    on_collision: str = "error",
    keep: Callable[[str, DataType], bool] = lambda name, kind: True,
) -> DataFrame:
    """Replace every struct by its leaves in one projection; arrays and maps stay as they are."""
    leaves = [
        (path, NAMING[naming](path))
        for path, kind in leaf_paths(df.schema)
        if keep(NAMING[naming](path), kind)
    ]
    names = _named(df, (name for _, name in leaves), on_collision)
    return df.select(*[quoted(path).alias(name) for (path, _), name in zip(leaves, names)])


def array_columns(df: DataFrame) -> list[str]:
    return [column.name for column in df.schema.fields if isinstance(column.dataType, ArrayType)]


def explode_column(df: DataFrame, name: str) -> DataFrame:
    """One row per element, in the array's place; a null or empty array keeps its row with a null."""
    return df.select(
        *[
            F.explode_outer(quoted((other,))).alias(other) if other == name else quoted((other,))
            for other in df.columns
        ]
    )


# The tag of a document that has no element in any of its arrays.
DOCUMENT = "document"


def explode_tagged(df: DataFrame, names: Sequence[str], tag: str) -> DataFrame:
    """One row per element of any of the arrays, tagged with its array's name: their sum instead of their product.

    Each array becomes a column of its elements, null in the rows of the others. The elements go
    through one generator. A document without any element keeps its row, tagged ``document``.
    """
    if tag in df.columns:
        raise SpecError(f"a tagged explode gives a column {tag!r}, which the documents have")
    kinds = {name: df.schema[name].dataType.elementType for name in names}

    def tagged(label: str, own: str | None = None, element: Column | None = None) -> Column:
        values = (element if name == own else F.lit(None).cast(kind) for name, kind in kinds.items())
        return F.struct(F.lit(label).alias(tag), *[value.alias(name) for name, value in zip(kinds, values)])

    def listed(name: str) -> Column:
        none = F.filter(F.array(tagged(name)), lambda x: F.lit(False))
        return F.coalesce(F.transform(quoted((name,)), lambda x: tagged(name, name, x)), none)

    elements = F.concat(*map(listed, names))
    others = [quoted((name,)) for name in df.columns if name not in kinds]
    rows = df.select(*others, F.explode(F.when(F.size(elements) > 0, elements).otherwise(F.array(tagged(DOCUMENT)))).alias("__element"))
    return rows.select(*others, *[quoted(("__element", name)).alias(name) for name in (tag, *names)])


def _keeper(wanted: frozenset[str] | None, naming: str) -> Callable[[str, DataType], bool]:
    if wanted is None or naming != "path":
        return lambda name, kind: True

    def keep(name: str, kind: DataType) -> bool:
        if name in wanted:
            return True
        return isinstance(kind, ArrayType) and any(other.startswith(name + "_") for other in wanted)

    return keep


def prune_schema(schema: StructType, wanted: Iterable[str], parent: str = "") -> StructType:
    """The fields of a nested schema that lead to wanted flat names."""
    wanted = frozenset(wanted)

    def pruned(kind: DataType, name: str) -> DataType | None:
        if isinstance(kind, StructType):
            inner = prune_schema(kind, wanted, name + "_")
            return inner if inner.fields else None
        if isinstance(kind, ArrayType):
            element = pruned(kind.elementType, name)
            return None if element is None else ArrayType(element, kind.containsNull)
        return kind if name in wanted else None

    fields = [(field, pruned(field.dataType, parent + field.name)) for field in schema.fields]
    return StructType([StructField(f.name, kind, f.nullable) for f, kind in fields if kind is not None])


def flatten(
    df: DataFrame,
    naming: str = "path",
    on_collision: str = "error",
    wanted: Iterable[str] | None = None,
    always: bool = True,
    separate: str | None = None,
) -> DataFrame:
    """Explode arrays and expand structs until only scalars and maps are left.

    Sibling arrays multiply within their own document. With ``separate``, the name of a column,
    those of the first level that has several give a row per element instead, and the column says
    of which array; arrays below are exploded within it. ``wanted`` drops columns
    that no caller needs before they are exploded: arrays that only repeat the
    other columns' rows then cost nothing. It changes how often a row is
    repeated, so it belongs in front of a duplicate drop. With ``always=False`` a
    document without a top-level array is returned as it is.
    """
    if separate is not None and wanted is not None:
        wanted = frozenset(wanted) | {separate}
    keep = _keeper(frozenset(wanted) if wanted is not None else None, naming)
    if not always and not array_columns(df):
        return df
    if wanted is not None:
        top_level = {path[0] for path, kind in leaf_paths(df.schema) if keep(NAMING[naming](path), kind)}
        df = df.select(*[quoted((name,)) for name in df.columns if name in top_level])
    while True:
        names = array_columns(df)
        if separate is not None and len(names) > 1:
            df, separate = explode_tagged(df, names, separate), None
        else:
            for name in names:
                df = explode_column(df, name)
        df = flatten_structs(df, naming, on_collision, keep)
        if not array_columns(df):
            return df


def sibling_arrays(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The arrays that ``flatten(separate=...)`` tells apart: those of the first level that has several."""
    keep = _keeper(frozenset(wanted), "path")
    top_level = {path[0] for path, kind in leaf_paths(df.schema) if keep("_".join(path), kind)}
    df = df.select(*[quoted((name,)) for name in df.columns if name in top_level])
    while True:
        names = array_columns(df)
        if len(names) != 1:
            return names
        df = flatten_structs(explode_column(df, names[0]), "path", "error", keep)


def flatten_separately(df: DataFrame, keys: Sequence[str], on_collision: str = "error") -> dict[str, DataFrame]:
    """Sibling arrays as tables of their own instead of their product.

    Returns the document's scalars under ``""`` and, for each array found after
    expanding structs, a child table of the key columns, the element's position
    and the element's own flattened columns.
    """
    flat = flatten_structs(df, on_collision=on_collision)
    arrays = array_columns(flat)
    tables = {"": flat.select(*[quoted((name,)) for name in flat.columns if name not in arrays])}
    for name in arrays:
        child = flat.select(
            *[quoted((key,)) for key in keys],
            F.posexplode(quoted((name,))).alias(f"{name}_position", name),
        )
        tables[name] = flatten(child, on_collision=on_collision)
    return tables
