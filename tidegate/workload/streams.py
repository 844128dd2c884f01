"""File streams (T1, T2)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from tidegate.session import new_folder
from tidegate.sinks import files as sink
from tidegate.specs import SET_A
from tidegate.streaming.dedup import drop_stream_duplicates
from tidegate.streaming.ingest import read_stream, start_ingest, start_routed
from tidegate.operators.shape import CORRUPT
from tidegate.workload import documents as docs
from tidegate.workload.files import INVOICES, LOAD_DATE, _write_invoices, payment_rows
from tidegate.workload.registry import Tables, query


@query("stream_ingest", f"""
    SELECT * EXCLUDE (job_id, file_name) FROM ({INVOICES}) WHERE invoice_no IS NOT NULL
""")
def stream_ingest(t: Tables) -> DataFrame:
    """Written documents taken up as a stream of files, with no limit on a batch."""
    spec = replace(SET_A["invoice"], columns=tuple(c for c in SET_A["invoice"].columns if c != "file_name"))
    root, checkpoint = new_folder(t.spark, "staging"), new_folder(t.spark, "checkpoint")
    documents = read_stream(t.spark, spec, _write_invoices(t))
    start_ingest(documents, spec, root, checkpoint, load_date=LOAD_DATE).awaitTermination()
    return sink.read_loads(t.spark, root).drop("job_id")


@query("stream_ingest_whole", f"""
    SELECT * REPLACE ('invoice' AS job_id, 'txt' AS file_name) FROM ({INVOICES}) WHERE invoice_no IS NOT NULL
""")
def stream_ingest_whole(t: Tables) -> DataFrame:
    """The shipped spec as a stream, all columns. Job ids are compared without the batch, file names by their suffix."""
    spec = SET_A["invoice"]
    root, checkpoint = new_folder(t.spark, "staging"), new_folder(t.spark, "checkpoint")
    documents = read_stream(t.spark, spec, _write_invoices(t))
    start_ingest(documents, spec, root, checkpoint, load_date=LOAD_DATE).awaitTermination()
    return sink.read_loads(t.spark, root).drop(CORRUPT).withColumns({
        "job_id": F.regexp_extract("job_id", r"^(invoice)_\d+$", 1),
        "file_name": F.regexp_extract("file_name", r"/part-[^/]+\.(txt)$", 1),
    })


@query("stream_ingest_distinct", f"""
    SELECT * EXCLUDE (job_id, file_name) FROM ({INVOICES}) WHERE invoice_no IS NOT NULL
""")
def stream_ingest_distinct(t: Tables) -> DataFrame:
    """Every document comes in two folders of files, taken up in several batches: each row is loaded once."""
    folder, root, checkpoint = (new_folder(t.spark, label) for label in ("invoices", "staging", "checkpoint"))
    texts = docs.as_json(docs.invoice_documents(t))
    for copy in ("first", "second"):
        texts.repartition(3).write.text(f"{folder}/{copy}")
    documents = read_stream(t.spark, SET_A["invoice"], f"{folder}/*", files_per_batch=2)
    start_ingest(documents, SET_A["invoice"], root, checkpoint, load_date=LOAD_DATE, distinct_within="1 day").awaitTermination()
    return sink.read_loads(t.spark, root).drop("job_id", "file_name")


@query("stream_routed", """
    SELECT 'invoice' AS dataset, CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderstatus = 'P' THEN 'quarantined' ELSE 'loaded' END AS status,
           CAST(o_totalprice AS DOUBLE) AS amount
    FROM orders
    UNION ALL
    SELECT DISTINCT 'trizetto_payments', concat(CAST(l_orderkey AS VARCHAR), '/', CAST(l_linenumber AS VARCHAR)),
           CASE WHEN l_returnflag = 'R' THEN 'quarantined' ELSE 'loaded' END, CAST(l_extendedprice AS DOUBLE)
    FROM lineitem
    UNION ALL
    SELECT 'unrouted', CAST(n AS VARCHAR), 'listed', CAST(NULL AS DOUBLE) FROM range(1, 3) AS r(n)
""")
def stream_routed(t: Tables) -> DataFrame:
    """JSON and pipe files of two datasets at several depths, and files of none, through one stream in batches of a few files."""
    folder, root, checkpoint = (new_folder(t.spark, label) for label in ("landing", "staging", "checkpoint"))
    texts = docs.as_json(docs.invoice_documents(t)).withColumn("lot", F.abs(F.xxhash64("value")) % 2)
    for lot, place in enumerate(("Invoices_1.json", "2024/09/invoices_2")):
        texts.where(F.col("lot") == lot).select("value").write.text(f"{folder}/{place}")
    sink.write_csv(payment_rows(t), f"{folder}/2024/TPSPayments_1", sep="|")
    for place in ("notes", "2024/other"):
        t.nation.select("n_name").coalesce(1).write.text(f"{folder}/{place}")
    start_routed(t.spark, folder, root, checkpoint, files_per_batch=8, load_date=LOAD_DATE).awaitTermination()
    states = t.spark.read.schema("invoice_id string, total_amt double, load_status string").parquet(f"{root}/invoice")
    paid = t.spark.read.schema("pay_id string, claim_id string, pay_amt string, load_status string").parquet(f"{root}/trizetto_payments")
    listed = t.spark.read.schema("path string").parquet(f"{root}/unrouted")
    return (
        states.select(F.lit("invoice").alias("dataset"), F.col("invoice_id").alias("id"), F.col("load_status").alias("status"), F.col("total_amt").alias("amount"))
        .unionByName(paid.select(
            F.lit("trizetto_payments").alias("dataset"), F.concat_ws("/", "pay_id", "claim_id").alias("id"),
            F.col("load_status").alias("status"), F.col("pay_amt").cast("double").alias("amount"),
        ))
        .unionByName(listed.select(
            F.lit("unrouted").alias("dataset"), F.when(F.col("path").contains("/2024/other/"), "2").otherwise("1").alias("id"),
            F.lit("listed").alias("status"), F.lit(None).cast("double").alias("amount"),
        ))
    )


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    output, checkpoint = new_folder(t.spark, "distinct"), new_folder(t.spark, "checkpoint")
    # The pattern names the table whether it is one file or a folder of files.
    table = f"{t.folder.rstrip('/')}/events.parquet*"
    rows = t.spark.readStream.schema(t.events.schema).parquet(table).select("user_id", "event_type")
    (
        drop_stream_duplicates(rows, salts=int(t.spark.conf.get("spark.sql.shuffle.partitions"))).writeStream.format("parquet").option("path", output)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    )
    return t.spark.read.schema("user_id bigint, event_type string").parquet(output).select(F.col("user_id"), "event_type")
