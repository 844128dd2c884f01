"""File scans. All of them take one path or many, and an optional file-name glob."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidegate.operators.shape import SOURCE_FILE, SOURCE_ORDER

Paths = str | Sequence[str]
Schema = str | StructType | None


def _reader(spark: SparkSession, schema: Schema, glob: str | None, options: dict) -> DataFrameReader:
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.options(**options)


def with_source(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Add the file each row came from and, on request, a value that rises with the row's place in its file."""
    columns = [F.col("*"), F.col("_metadata.file_path").alias(SOURCE_FILE)]
    if ordered:
        # Block start, then row within the block; both padded so that text order is row order.
        place = (F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        columns.append(F.concat(*[F.lpad(part.cast("string"), 20, "0") for part in place]).alias(SOURCE_ORDER))
    return df.select(*columns)


def read_json(
    spark: SparkSession, path: Paths, schema: Schema = None, glob: str | None = None, **options
) -> DataFrame:
    """One JSON document per line.

    With a schema there is no inference pass and the parser skips undeclared
    fields, so large reads should have one.
    """
    return _reader(spark, schema, glob, options).json(path)


def read_json_multiline(
    spark: SparkSession,
    path: Paths,
    schema: Schema = None,
    glob: str | None = None,
    corrupt_column: str | None = None,
    **options,
) -> DataFrame:
    """One JSON document (or array of documents) per file; malformed ones give nulls, not an error.

    ``corrupt_column`` keeps the malformed text; with a schema it has to be one
    of its string columns.
    """
    options = {"multiLine": True, "mode": "PERMISSIVE", **options}
    if corrupt_column:
        options["columnNameOfCorruptRecord"] = corrupt_column
    return _reader(spark, schema, glob, options).json(path)


RECORD_END = "\n}"


def read_json_records(
    spark: SparkSession,
    path: Paths,
    schema: Schema,
    glob: str | None = None,
    record_end: str = RECORD_END,
    **options,
) -> DataFrame:
    """JSON documents over many lines, any number of them in a file, which many tasks read together.

    Documents are told apart by how each ends: with the text ``record_end``, which must not occur
    within one. In pretty-printed documents one after another that is a brace at the start of a
    line; in a pretty-printed array of them, one behind the array's indentation. Blanks, line ends,
    commas and brackets between documents are passed over. With a string column named by the option
    ``columnNameOfCorruptRecord`` in the schema, a document that does not parse is kept there as text;
    one that lacks its end takes the next one with it, and one that another text follows, that text.
    """
    if not schema:
        raise ValueError("documents are parsed as they are read, so they need a schema")
    reader = spark.read.option("lineSep", record_end)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    # The separator is not part of what is read; a last piece without one is whatever follows the last document.
    body = F.regexp_replace("value", r"^[\s,\[\]\uFEFF]+", "")
    text = F.concat(body, F.lit(record_end))
    rows = reader.text(path).where(body != "")
    return rows.select(F.from_json(text, schema, {"mode": "PERMISSIVE", **options}).alias("__document")).select("__document.*")


def read_delimited(
    spark: SparkSession,
    path: Paths,
    schema: Schema = None,
    separator: str = "|",
    glob: str | None = None,
    **options,
) -> DataFrame:
    """Delimited text with a header row; every column is text unless a schema is given.

    Columns are taken by place, so a file whose header differs from the first
    one's (or from the schema) is refused rather than read into wrong columns.
    """
    options = {"header": True, "sep": separator, "enforceSchema": False, **options}
    return _reader(spark, schema, glob, options).csv(path)


def read_csv(spark: SparkSession, path: Paths, schema: Schema = None, **options) -> DataFrame:
    """Comma-separated sample tables: header row, quoted fields may hold commas."""
    return read_delimited(spark, path, schema, separator=",", **options)


def literal_path(path: str) -> str:
    """A path in which no character stands for a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def list_files(spark: SparkSession, root: Paths, glob: str | None = None, modified_after: str | None = None) -> DataFrame:
    """Paths of all files below a folder, as rows; file contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path")
