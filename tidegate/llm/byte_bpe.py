"""Byte-level BPE encoding and decoding through a sentencepiece model made from a rank file.

The model is serialised from the vocabulary alone, nothing is trained: every token's bytes
become a piece of byte characters (byte b is U+0100 + b), scored by its negative rank, with
identity normalisation. Merging the pair of highest score is then merging the pair of lowest
rank, and a piece's number is its rank. Each match of the split pattern is encoded alone.

Nulls are empty texts: no ids, no bytes. Repeated rows each give a row. Columns of the input
other than the id and the text are left out, so their names cannot clash. Rows are encoded
where they are read: no shuffle, one record batch in memory.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as pb

from tidegate.llm.memory import tidy
from tidegate.llm.pretokens import PieceEncoder
from tidegate.llm.words import pieces

FIRST_BYTE_CHARACTER = 0x100
TEXTS_BYTES = 2 << 20
CACHED_PIECES = 100_000  # forgotten at a task's end: other stages need the worker's memory
_TO_CHARACTERS = {b: FIRST_BYTE_CHARACTER + b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 token, rank per line), in order of rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [base64.b64decode(token) for token, _ in sorted(pairs, key=lambda pair: int(pair[1]))]
    if [int(rank) for _, rank in sorted(pairs, key=lambda pair: int(pair[1]))] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if {bytes([b]) for b in range(256)} - set(tokens):
        raise ValueError("every single byte needs a rank")
    return tokens


def byte_characters(data: bytes) -> str:
    return data.decode("latin-1").translate(_TO_CHARACTERS)


def build_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece BPE model whose piece numbers are the tokens' ranks."""
    model = pb.ModelProto()
    for rank, token in enumerate(tokens):
        model.pieces.add(piece=byte_characters(token), score=-float(rank), type=pb.ModelProto.SentencePiece.NORMAL)
    model.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    model.trainer_spec.model_type = pb.TrainerSpec.BPE
    model.trainer_spec.vocab_size = len(tokens) + 1
    model.trainer_spec.unk_id = len(tokens)
    model.trainer_spec.bos_id = model.trainer_spec.eos_id = model.trainer_spec.pad_id = -1
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = False
    model.normalizer_spec.remove_extra_whitespaces = False
    model.normalizer_spec.escape_whitespaces = False
    return model.SerializeToString()


class Codec:
    """Encoder and decoder of one worker."""

    def __init__(self, model: bytes, pattern: str):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.split = regex.compile(pattern).findall
        size = self.processor.get_piece_size() - 1
        self.bytes_of = [
            bytes(ord(c) - FIRST_BYTE_CHARACTER for c in self.processor.id_to_piece(i)) for i in range(size)
        ]
        self.pieces = PieceEncoder(self._encode_pieces, CACHED_PIECES)

    def _encode_pieces(self, texts: list[str]) -> Iterator[bytes]:
        cuts = [self.split(text) for text in texts]
        flat = [byte_characters(match.encode("utf-8")) for cut in cuts for match in cut]
        ids = iter(self.processor.encode(flat, out_type=int, num_threads=1) if flat else [])
        for cut in cuts:
            yield array("I", [i for _ in cut for i in next(ids)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.pieces.encode(texts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec(model: bytes, pattern: str) -> Codec:
    """One codec for each worker process, kept between its tasks."""
    return Codec(model, pattern)


def text_groups(column: pa.Array) -> Iterator[list[str]]:
    """Texts of a batch in groups of about TEXTS_BYTES; a null is an empty text."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in pieces(np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]), TEXTS_BYTES):
        yield [text or "" for text in column.slice(a, b - a).to_pylist()]


def encode(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """Rows of (id, n_tokens, ids): ``ids`` are little-endian unsigned 32-bit integers.

    With ``decoded`` the bytes that the ids decode to follow, in the same pass: one Python worker
    for a task instead of the two of ``encode`` and ``decode`` in a row.
    ``vocabulary`` is read once, by the driver; the model (about 1 MB) travels with the tasks.
    """
    model = build_model(read_ranks(vocabulary))
    source = docs.select(docs[id_col].alias(id_col), docs[text_col].alias(text_col))
    schema = T.StructType([
        T.StructField(id_col, docs.schema[id_col].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        *([T.StructField("decoded", T.BinaryType())] if decoded else []),
    ])
    return source.mapInArrow(tidy(_encoder(model, pattern, id_col, text_col, decoded)), schema)


def _encoder(model: bytes, pattern: str, id_col: str, text_col: str, decoded: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, pattern)
        for batch in batches:
            at = 0
            for texts in text_groups(batch.column(text_col)):
                ids = own.encode(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(id_col).slice(at, len(texts)),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    *([pa.array([own.decode(x) for x in ids], pa.binary())] if decoded else []),
                ], names=[id_col, "n_tokens", "ids", *(["decoded"] if decoded else [])])
                at += len(texts)
        own.pieces.forget()
    return run


def decode(encoded: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """The frame with the column ``decoded``: the bytes of the ids, by the inverse mapping of the pieces.

    A null list of ids gives null.
    """
    model = build_model(read_ranks(vocabulary))
    schema = T.StructType([f for f in encoded.schema if f.name != "decoded"] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                texts = [None if ids is None else own.decode(ids) for ids in part.column(ids_col).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[*part.schema.names, "decoded"])

    return encoded.select(*[f.name for f in schema if f.name != "decoded"]).mapInArrow(tidy(run), schema)
