"""Token ids in binary files: frequency-ranked ids, byte-aligned variable-length coding.

A file (shard) ranks its own ids by how often they occur, so the 256 most frequent take one
byte, the rest two (three and four for larger vocabularies). Two-bit lengths of four ids share
one control byte; control bytes and data bytes stand in separate runs, so that numpy decodes a
file by table lookup, without a loop over ids.

    magic 8 bytes | n_docs, n_ids, n_ranks, n_data (u8 each) | ids by rank (u4) |
    doc has an id (u1), doc ids (i8), doc lengths (u8) | control bytes | data bytes

Documents are laid out in ascending id order over all files. Nulls sort first and are stored
with their flag off; a null text is an empty text; documents that repeat are each written, in
order of their texts' hash. Strings of special tokens get those tokens' ids, as the library gives
them by itself. Only names in the manifest count: what a failed attempt leaves
behind is never read.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.byte_bpe import text_groups
from tidegate.llm.files import attempt_name, join_path, open_input, open_output
from tidegate.llm.pretokens import PieceEncoder

MAGIC = b"RANKIDS1"
SHARD_IDS = 4_000_000
END_ID = 0
_HEAD = struct.Struct("<8s4Q")
_LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)

MANIFEST = T.StructType([
    T.StructField("part", T.IntegerType()),
    T.StructField("shard", T.IntegerType()),
    T.StructField("file", T.StringType()),
    T.StructField("n_docs", T.LongType()),
    T.StructField("n_ids", T.LongType()),
])


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """Ids by rank, control bytes and data bytes of a run of ids."""
    count = np.bincount(ids)
    seen = np.flatnonzero(count)
    by_rank = seen[np.lexsort((seen, -count[seen]))]
    rank_of = np.zeros(len(count), "<u4")
    rank_of[by_rank] = np.arange(len(seen))
    ranks = rank_of[ids]
    size = np.ones(len(ranks), np.uint8)
    for limit in (0xFF, 0xFFFF, 0xFFFFFF):
        if len(seen) > limit:
            size += ranks > limit
    data = ranks.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[:len(ranks)] = size - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return by_rank.astype("<u4"), control.tobytes(), data.tobytes()


def unpack(by_rank: np.ndarray, control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    size = _LENGTHS[control].ravel()[:n].astype(np.int64)
    at = np.cumsum(size) - size
    ranks = data[at].astype("<u4")
    for i in (1, 2, 3):
        more = np.flatnonzero(size > i)
        ranks[more] |= data[at[more] + i].astype("<u4") << np.uint32(8 * i)
    return by_rank[ranks]


def write_shard(path: str, doc_ids: list[int | None], ids: list[bytes]) -> int:
    """Write documents and their id bytes to one file; gives the number of ids."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    by_rank, control, data = pack(flat)
    with open_output(path) as out:
        out.write(_HEAD.pack(MAGIC, len(ids), len(flat), len(by_rank), len(data)))
        out.write(by_rank.tobytes())
        out.write(np.array([d is not None for d in doc_ids], np.uint8).tobytes())
        out.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
        out.write(np.array([len(x) // 4 for x in ids], "<u8").tobytes())
        out.write(control)
        out.write(data)
    return len(flat)


def read_shard(path: str) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, their lengths and all ids of one file."""
    with open_input(path) as source:
        magic, n_docs, n_ids, n_ranks, n_data = _HEAD.unpack(source.read(_HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"not a token file: {path}")
        by_rank = np.frombuffer(source.read(4 * n_ranks), "<u4")
        known = np.frombuffer(source.read(n_docs), np.uint8)
        doc_ids = np.frombuffer(source.read(8 * n_docs), "<i8")
        lengths = np.frombuffer(source.read(8 * n_docs), "<u8").astype(np.int64)
        control = np.frombuffer(source.read(-(-n_ids // 4)), np.uint8)
        data = np.frombuffer(source.read(n_data), np.uint8)
    ids = unpack(by_rank, control, data, n_ids) if n_ids else np.zeros(0, "<u4")
    return [int(d) if k else None for d, k in zip(doc_ids, known, strict=True)], lengths, ids


def byte_alphabet() -> dict[int, str]:
    """The characters a byte-level vocabulary writes bytes with: printable Latin-1 as itself, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


class _TokenizerPieces:
    """Ids of text pieces by a tokenizers file.

    A piece that is one pre-token for certain (letters, with a leading blank or none) goes straight
    to the tokenizer's model.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.alphabet = byte_alphabet()
        self.blank = self.alphabet[ord(" ")]
        self.split = self.tokenizer.model.tokenize

    def pretoken(self, text: str) -> list[int]:
        if text.isascii():  # of a pre-token's ASCII characters only a leading blank is written differently
            written = self.blank + text[1:] if text[:1] == " " else text
        else:
            written = text.encode("utf-8").decode("latin-1").translate(self.alphabet)
        return [token.id for token in self.split(written)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain = [(text[1:] if text[:1] == " " else text).isalpha() for text in texts]
        others = [text for text, own in zip(texts, plain, strict=True) if not own]
        found = iter(self.tokenizer.encode_batch_fast(others, add_special_tokens=False) if others else [])
        return [array("I", self.pretoken(text) if own else next(found).ids).tobytes() for text, own in zip(texts, plain, strict=True)]


@lru_cache(maxsize=2)
def _encoder(vocabulary: str) -> PieceEncoder:
    """One encoder for each worker process, kept between its tasks."""
    return PieceEncoder(_TokenizerPieces(vocabulary))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode ``doc_id, text`` and write the files; gives their manifest.

    Texts are range-partitioned by document id, the only shuffle. ``vocabulary`` is the path of a
    tokenizers file on every executor. ``end_id`` follows each document.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    tie = F.xxhash64("text")
    ordered = source.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    return ordered.mapInArrow(_writer(folder, vocabulary, end_id, shard_ids), MANIFEST)


def _writer(folder: str, vocabulary: str, end_id: int, shard_ids: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        encoder = _encoder(vocabulary)
        doc_ids: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> pa.RecordBatch:
            path = join_path(folder, attempt_name(f"tokens-{part:06d}-{shard:05d}", ".ids"))
            n = write_shard(path, doc_ids, ids)
            return pa.RecordBatch.from_pylist(
                [{"part": part, "shard": shard, "file": path, "n_docs": len(ids), "n_ids": n}],
                schema=pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

        for batch in batches:
            own, at = batch.column("doc_id").to_pylist(), 0
            for texts in text_groups(batch.column("text")):
                for doc_id, found in zip(own[at:at + len(texts)], encoder.encode(texts), strict=True):
                    doc_ids.append(doc_id)
                    ids.append(found + end)
                    held += len(found) // 4 + 1
                    if held >= shard_ids:
                        yield flush()
                        doc_ids, ids, held, shard = [], [], 0, shard + 1
                at += len(texts)
        if ids:
            yield flush()
    return run


def read_token_files(manifest: DataFrame, with_ids: bool = True) -> DataFrame:
    """A row for each document of the files: doc_id, start, n_tokens, ids_crc32, and its ids (little-endian unsigned 32-bit).

    ``with_ids=False`` leaves the ids out, for readers that want only places and checksums.

    ``start`` counts the ids of all documents before it, over all files. The running total is
    taken over the manifest, which has a row for each file, not over documents.
    """
    order = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else []),
    ])
    # A file is a row here but much work: the number of tasks is set, or Spark would merge the few rows into one.
    # It follows the cluster and not the files, of which a task reads one after another.
    spark = manifest.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism)
    return placed.select("file", "before").repartition(max(1, min(manifest.count(), most))).mapInArrow(_reader(with_ids), schema)


def _reader(with_ids: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _read_files(batch, with_ids)
    return run


def _read_files(batch: pa.RecordBatch, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
        doc_ids, lengths, ids = read_shard(file)
        ends = np.cumsum(lengths)
        starts = ends - lengths
        for a in range(0, len(doc_ids), 2000):
            own = [ids[i:j].tobytes() for i, j in zip(starts[a:a + 2000], ends[a:a + 2000], strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(doc_ids[a:a + 2000], pa.int64()),
                pa.array(starts[a:a + 2000] + before, pa.int64()),
                pa.array(lengths[a:a + 2000], pa.int64()),
                pa.array([zlib.crc32(x) for x in own], pa.int64()),
                *([pa.array(own, pa.binary())] if with_ids else []),
            ], names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"][:5 if with_ids else 4])


def store_manifest(manifest: DataFrame, folder: str) -> DataFrame:
    """Write the manifest and read it back: from here on the file names are fixed."""
    path = join_path(folder, "manifest")
    manifest.write.parquet(path)
    return SparkSession.active().read.schema(MANIFEST).parquet(path)
