"""One query for each operator, over its whole table, with the digests its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import alignment, byte_bpe, chat, decontaminate, language, line_dedup, near_dups, neighbours, pitman_yor, quality, repair, token_files, warc
from tidegate.llm.store import storage
from tidegate.session import new_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document that holds a benchmark item."""
    docs = table(spark, sf_dir, "documents")
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), storage(docs, "leaks"))
    return decontaminate.leaking_documents(leaks).drop("text_hash")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(docs, storage(docs, "lines"))
    return found.select("doc_id", "n_lines", "n_deleted", "kept", F.md5("text").alias("text_md5"))


SQL["op2_line_dedup"] = """
WITH split AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(lines) AS raw, generate_subscripts(lines, 1) AS line_no FROM split
), full_lines AS (
  SELECT doc_id, line_no, trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos
  FROM numbered WHERE trim(raw, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''
), pairs AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS next_line FROM full_lines
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) AS nth,
         row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, pos) AS nth_pair
  FROM pairs
), copied AS (
  SELECT doc_id, line_no FROM ranked WHERE nth > 1 AND length(line) >= 20
  UNION SELECT doc_id, line_no FROM ranked WHERE next_line IS NOT NULL AND nth_pair > 1
  UNION SELECT r.doc_id, n.line_no FROM ranked r JOIN full_lines n ON n.doc_id = r.doc_id AND n.pos = r.pos + 1
        WHERE r.next_line IS NOT NULL AND r.nth_pair > 1
), rebuilt AS (
  SELECT a.doc_id, string_agg(a.raw, chr(10) ORDER BY a.line_no) FILTER (WHERE c.line_no IS NULL) AS text,
         count(c.line_no) AS n_deleted
  FROM numbered a LEFT JOIN copied c ON c.doc_id = a.doc_id AND c.line_no = a.line_no GROUP BY a.doc_id
), counts AS (
  SELECT doc_id, count(*) AS n_lines FROM full_lines GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n.n_lines, 0) AS n_lines, coalesce(r.n_deleted, 0) AS n_deleted,
       coalesce(r.n_deleted, 0) = 0 OR r.n_deleted < n.n_lines AS kept,
       CASE WHEN coalesce(r.n_deleted, 0) = 0 THEN md5(d.text) ELSE md5(coalesce(r.text, '')) END AS text_md5
FROM documents d LEFT JOIN rebuilt r ON r.doc_id = d.doc_id LEFT JOIN counts n ON n.doc_id = d.doc_id
"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    pages = table(spark, sf_dir, "pages")
    planned = warc.plan_records(pages, storage(pages, "warc-plan"))
    manifest = warc.store_manifest(warc.write_warc(planned, f"{folder}/archives"), folder)
    records = warc.read_warc(manifest)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dups.find_classes(docs, storage(docs, "near")).select("doc_id", "class_id", "class_size")


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    docs = table(spark, sf_dir, "documents")
    written = token_files.write_token_files(docs, f"{folder}/files", public_tokenizers.path("byte_bpe_50k.json"))
    manifest = token_files.store_manifest(written, folder)
    return token_files.read_token_files(manifest, with_ids=False)


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    decoded = byte_bpe.decode(encoded, vocabulary, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    own = [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    turns = turns.unionByName(spark.createDataFrame(own, "conv_id long, turn long, role string, text string"))
    typed = turns.select("conv_id", "turn", "role", chat.text_part(F.col("text")).alias("parts"))
    return chat.read_back(chat.format_chat(typed))


def remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's text, modulo."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 5) == 0
    identify = language.predictor(language.fit(docs.where(~held_out)))
    found = docs.select("doc_id", held_out.alias("held_out"), identify("text").alias("found"))
    return found.select("doc_id", "held_out", "found.*")


@query
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    store = storage(docs, "quality")
    stats = store(quality.measure(docs), "stats")
    judged = quality.judge(stats, store)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


@query
def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = (remainder("doc_id", 7) == 2).alias("held_out")
    return pitman_yor.score_documents(docs.select("doc_id", held_out, "text"), new_folder(spark, "scores"))


@query
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.find_nearest(vectors, F.col("vec_id") % 20 == 0, storage(vectors, "neighbours"))


SQL["op12_neighbours"] = """
WITH vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT vec_id, v FROM vectors
  WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM usable q JOIN usable c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth FROM scored
)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM ranked WHERE nth <= 20
"""


@query
def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    damaged = repair.damage(turns)
    summary, repaired = repair.repair(damaged, storage(turns, "repair"))
    numbers = [name for name, kind in summary.dtypes if kind == "bigint" and name != "conv_id"]
    digests = repair.digest_turns(repaired).withColumnRenamed("conv_id", "digest_id")
    found = summary.withColumnRenamed("conv_id", "found_id")
    asked = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return (
        asked.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left")
        .join(digests, F.col("conv_id").eqNullSafe(F.col("digest_id")), "left")
        .select(
            "conv_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in numbers],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align(docs, *files, storage(docs, "alignment"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")
