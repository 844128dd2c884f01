"""Continuous ingestion: every new file becomes part of one micro-batch load.

The checkpoint remembers which files were taken; a batch that is repeated after a
failure has the same id, and its load replaces its own folder. Together that
gives each file's rows once.

``start_ingest`` streams the files of one dataset. ``start_routed`` watches a folder at any depth
for files of all datasets, of any format: the stream carries only their paths, and each batch is
routed and loaded dataset by dataset.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.flatten import quoted
from tidegate.operators.shape import ARRIVED, SOURCE_FILE
from tidegate.plans.ingest import file_options, file_schema, load_routed, load_rows, shape_rows
from tidegate.session import bounded_tasks, remove_folder
from tidegate.sources.database import Database
from tidegate.sources.files import with_source
from tidegate.sources.routing import routed_to, token_glob
from tidegate.spec import DatasetSpec, SpecError
from tidegate.specs import SET_A
from tidegate.streaming.dedup import drop_stream_duplicates

DIGEST = "__digest"


def read_stream(
    spark: SparkSession,
    spec: DatasetSpec,
    folder: str,
    token: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of one dataset. Streams need the input schema up front.

    ``token`` keeps to the files that are routed to it.
    """
    if spec.input_schema is None:
        raise SpecError(f"dataset {spec.name!r} has no input schema, which a stream needs")
    reader = spark.readStream.schema(file_schema(spec)).options(**file_options(spec))
    path = folder if token is None else token_glob(folder, token)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if spec.format == "json_records":
        raise SpecError(f"dataset {spec.name!r}: files of many documents are loaded through start_routed")
    if spec.format == "delimited":
        rows = reader.options(header=True, sep="|", enforceSchema=False).csv(path)
    else:
        rows = reader.options(multiLine=spec.format == "json_multiline").json(path)
    rows = with_source(rows, ordered=spec.tenant_scope == "file")
    if token is not None:
        rows = rows.where(routed_to(token, folder, F.col(SOURCE_FILE)))
    return rows


def start_ingest(
    documents: DataFrame,
    spec: DatasetSpec,
    output: str,
    checkpoint: str,
    *,
    job_prefix: str | None = None,
    audit: str | None = None,
    load_date: str | Column | None = None,
    table: str | None = None,
    database: Database | None = None,
    trigger: dict | None = None,
    distinct_within: str | None = None,
    salts: int = 0,
) -> StreamingQuery:
    """Run each micro-batch through the batch load under the id ``<prefix>_<batch>``.

    With a ``table`` each batch is also brought there; a batch that is repeated
    replaces its own rows. Duplicates are dropped within a batch, and with
    ``distinct_within`` across batches too: a row, file names aside, that was taken up less than
    that time ago is dropped. See :func:`shape_distinct`.
    """
    spec.validate()
    prefix = job_prefix or spec.name
    stamp = spec.renames.get("job_id", "job_id")
    shaped = None if distinct_within is None else shape_distinct(documents, spec, distinct_within, load_date, salts)

    def load(batch: DataFrame, batch_id: int) -> None:
        job_id = f"{prefix}_{batch_id}"
        if shaped is None:
            rows = shape_rows(batch, spec, job_id, load_date=load_date)
        else:
            rows = batch.withColumns({stamp: F.lit(job_id)} if stamp in batch.columns else {})
        load_rows(
            batch.sparkSession, rows, job_id, output,
            audit=audit, description=spec.name, source_path=prefix, table=table, database=database,
        )

    writer = (documents if shaped is None else shaped).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    # A stream keeps the settings it starts with, and plans its scans before a batch gets to its load.
    with bounded_tasks(documents.sparkSession):
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def shape_distinct(
    documents: DataFrame, spec: DatasetSpec, within: str, load_date: str | Column | None = None, salts: int = 0
) -> DataFrame:
    """A stream of staging rows without those that were taken up within a time before.

    What a row is known by is a digest of its columns but for the file name, so the state holds 32
    bytes and a time for each row of that time. The time is that of the batch, which a repeated
    batch keeps, and no row is ever late by it. Digests that are old enough leave the state when the
    watermark passes them. ``salts`` is for values that make up much of a batch.
    """
    if spec.tenant_scope == "file":
        raise SpecError(f"dataset {spec.name!r} takes its tenant from the whole file, which a stream of rows has not")
    arrived = documents.withColumn(ARRIVED, F.current_timestamp())
    names = {"file_name", spec.renames.get("file_name", "file_name"), SOURCE_FILE, ARRIVED}

    def distinct(rows: DataFrame) -> DataFrame:
        values = [quoted((name,)) for name in rows.columns if name not in names]
        text = F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
        keyed = rows.withColumn(DIGEST, F.unhex(F.sha2(text, 256)))
        return drop_stream_duplicates(keyed, [DIGEST], event_time=ARRIVED, within=within, salts=salts).drop(DIGEST)

    return shape_rows(arrived, spec, F.lit(""), load_date=load_date, distinct=distinct)


def watch_folder(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Paths of new files at any depth below a folder; what they hold is not read."""
    reader = spark.readStream.format("binaryFile").option("recursiveFileLookup", True)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.schema("path string, modificationTime timestamp, length bigint, content binary").load(folder).select("path")


def start_routed(
    spark: SparkSession,
    folder: str,
    output: str,
    checkpoint: str,
    *,
    specs: Mapping[str, DatasetSpec] = SET_A,
    job_prefix: str = "stream",
    files_per_batch: int | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """One stream into many datasets: new files are routed by their paths and loaded under ``<prefix>_<batch>``.

    Datasets are loaded one after another, and each leaves a mark beside the checkpoint. A batch
    that broke off is repeated by Spark over the same files: datasets with a mark are left out, the
    one that broke off replaces its own load, the others follow. Marks of earlier batches, which
    are never repeated, are removed. Files of no dataset are listed below ``unrouted``.
    ``options`` are those of :func:`tidegate.plans.ingest.ingest`.
    """
    for spec in specs.values():
        spec.repaired().validate()
    marks = f"{checkpoint.rstrip('/')}/routed"

    def load(batch: DataFrame, batch_id: int) -> None:
        load_routed(
            batch.sparkSession, batch, folder, f"{job_prefix}_{batch_id}", output, specs, marks=f"{marks}/{batch_id}", **options,
        )
        remove_folder(batch.sparkSession, f"{marks}/{batch_id - 1}")

    return (
        watch_folder(spark, folder, files_per_batch).writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
