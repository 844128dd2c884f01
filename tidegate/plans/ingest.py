"""Raw files to a checked staging table.

A load is one Spark plan with one write: parse, flatten, shape, drop duplicates,
check, and write loaded and quarantined rows side by side. Counts come from the
footers of the files just written, so they hold even if tasks were run twice.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from tidegate.operators import quality, shape
from tidegate.operators.flatten import DOCUMENT, flatten, prune_schema, sibling_arrays
from tidegate.session import leave_mark, new_folder, path_exists, sized_shuffles
from tidegate.sinks import audit as audit_log
from tidegate.sinks import files as sink
from tidegate.sources.database import Database
from tidegate.sources.files import Paths, list_files, literal_path, read_delimited, read_json, read_json_multiline, read_json_records, with_source
from tidegate.sources.layouts import read_layouts
from tidegate.sources.routing import ROUTES, add_route, key_below, route_token, spec_name
from tidegate.sources.rules import read_rules, rules_from_frame
from tidegate.spec import LINEAGE, DatasetSpec, RuleSpec
from tidegate.specs import SET_A


UNROUTED = "unrouted"


@dataclass(frozen=True)
class LoadResult:
    job_id: str
    folder: str
    total: int
    loaded: int
    rejected: int
    quarantine_path: str
    corrupt: int = 0
    #: Rows whose value does not fit the declared type, by source column.
    misfits: Mapping[str, int] = field(default_factory=dict)


def scan_schema(spec: DatasetSpec) -> str | StructType | None:
    """The part of the input schema that reaches the output; JSON parsing skips the rest."""
    if spec.input_schema is None or spec.format == "delimited":
        return spec.input_schema
    return prune_schema(StructType.fromDDL(spec.input_schema), spec.wanted)


def as_text(kind: DataType) -> DataType:
    """The type with every value as text, so that parsing loses none."""
    if isinstance(kind, StructType):
        return StructType([StructField(field.name, as_text(field.dataType)) for field in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(as_text(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(kind.keyType, as_text(kind.valueType))
    return StringType()


def file_schema(spec: DatasetSpec) -> str | StructType | None:
    """How files are parsed: JSON values as text, and a column for the text of records that cannot be parsed."""
    schema = scan_schema(spec)
    if not isinstance(schema, StructType):
        return schema
    return StructType([*as_text(schema).fields, StructField(shape.CORRUPT, StringType())])


def file_options(spec: DatasetSpec) -> dict[str, str]:
    """Reader options that go with :func:`file_schema`."""
    keeps = isinstance(scan_schema(spec), StructType)
    return {"columnNameOfCorruptRecord": shape.CORRUPT} if keeps else {}


def declared_types(spark: SparkSession, spec: DatasetSpec) -> dict[str, str]:
    """Types of the spec's flattened source columns, where its schema says them."""
    schema = scan_schema(spec)
    if not isinstance(schema, StructType):
        return {}
    flat = flatten(spark.createDataFrame([], schema), wanted=set(spec.wanted))
    named = ((name, shape.resolve_name(flat, name)) for name in spec.columns)
    kinds = dict(flat.dtypes)
    return {name: kinds[found] for name, found in named if found is not None}


def read_raw(spark: SparkSession, spec: DatasetSpec, path: Paths, **options) -> DataFrame:
    """The spec's files as they are, with their file name (and row order where the tenant needs it).

    With an input schema nothing a file holds is lost in parsing: see :func:`file_schema`. Delimited
    files without one are read each by its own header and matched by name.
    """
    if spec.format == "delimited" and spec.input_schema is None:
        return read_layouts(
            spark, path, wanted=spec.wanted, missing_value=spec.missing_value, ordered=spec.tenant_scope == "file", **options
        )
    readers = {
        "delimited": read_delimited, "json": read_json, "json_multiline": read_json_multiline, "json_records": read_json_records,
    }
    raw = readers[spec.format](spark, path, file_schema(spec), **file_options(spec), **options)
    return with_source(raw, ordered=spec.tenant_scope == "file")


def parsed_once(rows: DataFrame, label: str = "parsed") -> DataFrame:
    """Parsed documents as a columnar table in the shared folder, for plans that read them more than once."""
    folder = new_folder(rows.sparkSession, label)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def shape_rows(
    raw: DataFrame,
    spec: DatasetSpec,
    job_id: str,
    file_name: str | Column | None = None,
    load_date: str | Column | None = None,
    distinct: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Raw rows to distinct staging rows with their check flag.

    ``distinct`` drops duplicates in a way of its own: it gets the rows before they are stamped.
    Where the tenant is that of a file's first row, the parsed documents are written first: the lookup
    reads three columns of them, the rows the others, and no file is parsed again.

    ``file_name`` is one text for all rows; without it each row names its own file.
    Rows of a corrupt record, and rows with values that do not fit the types of their
    schema or declared casts, are flagged and keep the text in ``corrupt_record``; rows of a
    dataset with casts name the columns in ``misfit_columns``.
    """
    working = [name for name in (shape.SOURCE_FILE, shape.SOURCE_ORDER, shape.ARRIVED) if name in raw.columns]
    kept = [shape.CORRUPT] if shape.CORRUPT in raw.columns else []
    documents = raw = parsed_once(raw) if spec.tenant_column and spec.tenant_scope == "file" else raw
    if spec.format != "delimited":
        separate = sink.CHILD if spec.arrays == "separate" else None
        raw = flatten(documents, wanted=spec.wanted | {*working, *kept}, separate=separate)
    # Lineage and padding are equal for all rows: they come after the duplicate drop, out of its shuffle.
    stamped = [name for name in spec.columns if name in LINEAGE]
    if file_name is None and "file_name" in stamped:
        raw = raw.withColumn("file_name", F.col(shape.SOURCE_FILE))
        stamped.remove("file_name")
    found = [name for name in spec.columns if name not in stamped and shape.resolve_name(raw, name) is not None]
    child = [sink.CHILD] if spec.arrays == "separate" and sink.CHILD in raw.columns else []
    extra = ([spec.tenant_column] if spec.tenant_column else []) + working + kept + child
    rows = shape.pad_and_project(raw, found, extra)
    types = declared_types(raw.sparkSession, spec) if kept else {}
    if spec.casts:
        rows = shape.settle_types(rows, types, casts=spec.casts, misfits=shape.MISFITS)
        kept = [shape.CORRUPT, shape.MISFITS]
        rows = rows if shape.CORRUPT in rows.columns else rows.withColumn(shape.CORRUPT, F.lit(None).cast("string"))
    elif kept:
        rows = shape.settle_types(rows, types)
    rows = shape.rename(rows, {name: spec.renames.get(name, name) for name in (*found, *extra)})
    link = spec.renames.get(spec.tenant_column, spec.tenant_column)
    if link in rows.columns and spec.tenant_scope == "row":
        rows = shape.add_tenant(rows, link, spec.tenant_pattern, spec.tenant_target)
    elif link in rows.columns:
        # Links are looked up in the documents as they are, before their arrays are exploded.
        links = flatten(documents, wanted={spec.tenant_column, *working})
        tenants = shape.file_tenants(links, spec.tenant_column, spec.tenant_pattern, spec.tenant_target)
        rows = shape.add_file_tenant(rows, tenants, link)
    if distinct is None:
        rows = rows.drop(*working)
        rows = shape.drop_text_duplicates(rows) if spec.format == "delimited" else shape.drop_duplicates(rows)
    else:
        rows = distinct(rows).drop(*working)
    tenant = [name for name in rows.columns if name not in spec.targets]
    stamps = {name: spec.renames.get(name, name) for name in stamped}
    rows = shape.stamp_lineage(rows, job_id, file_name, load_date, stamped).transform(shape.rename, stamps)
    rows = shape.pad_and_project(rows, spec.targets, tenant, spec.missing_value)
    absent = {spec.renames.get(name, name): kind for name, kind in spec.casts.items() if name not in found}
    checked = shape.cast_declared(rows, absent)
    owners = column_owners(documents, spec) if child else {}
    checked = quality.flag_missing_by(checked, _present(spec, rows), owners, sink.CHILD, DOCUMENT)
    if not kept:
        return checked
    names = [name for name in checked.columns if name not in kept]
    names[len(spec.targets):len(spec.targets)] = kept
    return checked.withColumn(quality.FLAG, F.col(quality.FLAG) | F.col(shape.CORRUPT).isNotNull()).select(*names)


def column_owners(documents: DataFrame, spec: DatasetSpec) -> dict[str, str]:
    """The array each target column comes from, of those that are loaded separately; the document's own are left out."""
    arrays = sibling_arrays(documents, spec.wanted)
    own = {name: array for name in spec.columns for array in arrays if name == array or name.startswith(f"{array}_")}
    return {spec.renames.get(name, name): array for name, array in own.items()}


def read_child(spark: SparkSession, output: str, spec: DatasetSpec, child: str, status: str = sink.LOADED) -> DataFrame:
    """Rows of one separately loaded array: its columns and those of the document; other folders are not read."""
    documents = spark.createDataFrame([], StructType.fromDDL(spec.input_schema))
    owners = column_owners(documents, spec)
    rows = sink.read_loads(spark, output, status).where(F.col(sink.CHILD) == child).drop(sink.CHILD)
    return rows.select(*[name for name in rows.columns if owners.get(name, child) == child])


def _present(spec: DatasetSpec, rows: DataFrame) -> list[str]:
    """Required columns; the tenant id only where the files have a link."""
    return [name for name in spec.required if name != spec.tenant_target or name in rows.columns]


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    path: Paths,
    job_id: str,
    output: str,
    *,
    audit: str | None = None,
    description: str = "",
    file_name: str | None = None,
    load_date: str | None = None,
    table: str | None = None,
    database: Database | None = None,
    source_path: str | None = None,
) -> LoadResult:
    """Load files into ``output``, and from there into a table where one is named.

    The table append reads the columnar files just written; sources are parsed once.
    """
    spec.validate()
    raw = read_raw(spark, spec, path)
    return load_rows(
        spark, shape_rows(raw, spec, job_id, file_name, load_date), job_id, output,
        audit=audit, description=description or spec.name, source_path=source_path or str(path), table=table, database=database,
    )


def load_rows(
    spark: SparkSession,
    rows: DataFrame,
    job_id: str,
    output: str,
    *,
    audit: str | None = None,
    description: str = "",
    source_path: str = "",
    table: str | None = None,
    database: Database | None = None,
) -> LoadResult:
    """Write checked rows as one load, count them, and record the job's start and end."""
    started = audit_log.now()

    def record(status: str, **counts) -> None:
        if audit is not None:
            row = audit_log.audit_row(
                spark, job_id, description, status, source_path, started, audit_log.now(), **counts
            )
            audit_log.append_audit(row, audit)

    record(audit_log.STARTED)
    with sized_shuffles(rows):
        folder = sink.write_load(rows, output, job_id, quality.FLAG)
    counts = sink.count_load(spark, folder)
    loaded, rejected = counts[sink.LOADED], counts[sink.QUARANTINED]
    if table is not None and loaded:
        good = sink.read_loads(spark, output, load_id=job_id)
        if database is not None:
            database.write(good, table)
        else:
            sink.append_table(good, table, job_id)
    quarantine = sink.quarantine_folder(output, job_id) if rejected else ""
    record(audit_log.COMPLETED, total=loaded + rejected, loaded=loaded, rejected=rejected, dq_path=quarantine)
    corrupt = sink.count_corrupt(spark, quarantine) if rejected and shape.CORRUPT in rows.columns else 0
    misfits = sink.count_misfits(spark, quarantine) if rejected and shape.MISFITS in rows.columns else {}
    return LoadResult(job_id, folder, loaded + rejected, loaded, rejected, quarantine, corrupt, misfits)


def new_job_id(name: str, moment: datetime | None = None) -> str:
    """A job id no other run has: dataset name, start time, random suffix."""
    return f"{name}_{audit_log.compact(moment or audit_log.now())}_{uuid.uuid4().hex[:6]}"


def run_dataset(
    spark: SparkSession,
    path: str,
    output: str,
    job_id: str | None = None,
    specs: Mapping[str, DatasetSpec] = SET_A,
    **options,
) -> LoadResult | None:
    """Load one file or folder as the dataset its name stands for; None where no dataset fits."""
    token = route_token(path)
    if token is None:
        return None
    name = spec_name(token)
    return ingest(spark, specs[name].repaired(), path, job_id or new_job_id(token), f"{output}/{name}", **options)


def run_folder(
    spark: SparkSession,
    folder: str,
    job_id: str,
    output: str,
    specs: Mapping[str, DatasetSpec] = SET_A,
    **options,
) -> dict[str, LoadResult]:
    """Load a folder of mixed files, at any depth, each dataset in one plan over its own files.

    A file is routed by its whole path below the folder. Files that no dataset
    takes are listed below ``<output>/unrouted`` and counted as rejected in the
    result of that name, so none is left out unseen. Only paths are read for
    routing; the driver holds them, as it does for every file scan.
    """
    files = list_files(spark, folder)
    return load_routed(spark, files, folder, job_id, output, specs, **options)


def load_routed(
    spark: SparkSession,
    files: DataFrame,
    folder: str,
    job_id: str,
    output: str,
    specs: Mapping[str, DatasetSpec] = SET_A,
    marks: str | None = None,
    **options,
) -> dict[str, LoadResult]:
    """Load listed files (column ``path``) below a folder, each dataset in one plan over its own.

    With ``marks``, a folder of this job alone, every dataset that is done leaves a mark there, and
    one that has its mark is left out: a job that broke off between datasets goes on with the next.
    """
    routed = add_route(files.withColumn("key", key_below(folder, F.col("path"))), "key")
    found: dict[str | None, list[str]] = {}
    for row in routed.select("path", "spec").toLocalIterator():
        found.setdefault(row["spec"], []).append(row["path"])
    results = {}
    for name in [*(name for _, name in ROUTES), None]:
        mark = f"{marks}/{name or UNROUTED}"
        if name not in found or marks and path_exists(spark, mark):
            continue
        paths = sorted(found[name])
        if name is None:
            place = sink.load_folder(f"{output}/{UNROUTED}", job_id)
            spark.createDataFrame([(path,) for path in paths], "path string").write.mode("overwrite").parquet(place)
            results[UNROUTED] = LoadResult(job_id, place, len(paths), 0, len(paths), place)
        else:
            results[name] = ingest(
                spark, specs[name].repaired(), list(map(literal_path, paths)), job_id, f"{output}/{name}", source_path=folder, **options,
            )
        if marks:
            leave_mark(spark, mark)
    return results


def export_flat_csv(
    spark: SparkSession, path: Paths, output: str, schema: str | None = None, record_end: str | None = None, **options
) -> None:
    """Multi-line JSON documents as flat CSV files, appended to a folder.

    One document (or array) is a file, read by one task; with ``record_end`` a file holds any number
    of documents and is read by many, see :func:`tidegate.sources.files.read_json_records`.
    """
    documents = read_json_multiline(spark, path, schema) if record_end is None else read_json_records(spark, path, schema, record_end=record_end)
    flat = flatten(documents)
    maps = {name: F.to_json(name) for name, kind in flat.dtypes if kind.startswith("map")}
    sink.write_csv(flat.withColumns(maps), output, mode="append", **options)


def check_documents(documents: DataFrame, rules: Sequence[RuleSpec], on_collision: str = "suffix") -> DataFrame:
    """Documents flattened to leaf names, each row with the rules it breaks and its flag."""
    flat = flatten(documents, naming="leaf", on_collision=on_collision)
    checked = quality.check_rules(flat, rules)
    return checked.withColumn(quality.FLAG, F.size("violated_rules") > 0)


def validate_files(
    spark: SparkSession,
    path: Paths,
    rules_path: Paths,
    job_id: str,
    output: str,
    *,
    schema: str | None = None,
    audit: str | None = None,
    description: str = "",
    single_file: bool = False,
) -> LoadResult:
    """Report the rows that break a rule document as CSV; nothing is loaded.

    Rows are counted while the report is written, in the same pass.
    """
    started = audit_log.now()
    folder = f"{output.rstrip('/')}/{sink.check_load_id(job_id)}"
    rules = rules_from_frame(read_rules(spark, rules_path, job_id))
    checked = check_documents(read_json(spark, path, schema), rules)
    observed, counts = quality.observe_load(checked, f"validate {job_id}")
    broken = observed.where(quality.FLAG).withColumn("violated_rules", F.to_json("violated_rules"))
    if audit is not None:
        row = audit_log.audit_row(spark, job_id, description, audit_log.STARTED, str(path), started, started)
        audit_log.append_audit(row, audit)
    sink.write_csv(broken.drop(quality.FLAG), folder, single_file=single_file)
    found = counts.get
    total, loaded, rejected = (found[f"{part}_record_count"] for part in ("total", "load", "error"))
    if audit is not None:
        row = audit_log.audit_row(
            spark, job_id, description, audit_log.COMPLETED, str(path), started, audit_log.now(),
            total, loaded, rejected, folder,
        )
        audit_log.append_audit(row, audit)
    return LoadResult(job_id, folder, total, loaded, rejected, folder if rejected else "")
