"""Alignment of two tokenizers' tokens over the same texts, by merge path.

Each text is encoded by A (a byte-level BPE file of the tokenizers library, which is given a blank
and the text) and by B (a sentencepiece model, which puts that blank there itself). Both cut the
same bytes, so each gives a rising list of byte offsets where its tokens end. The texts of a batch
follow one another, so these are two rising lists for the whole batch, whatever the lengths of its
texts. Merging them is cut into pieces of equal work: diagonal binary searches, all at once, find
where the merge path crosses every ``PIECE``-th diagonal, and between two crossings a piece has
that many ends of A and B together. Pieces know nothing of each other. Each gives the ends that
both lists hold within it. Where a crossing parts two equal ends (A's is merged first) the
boundary is stitched, and so is the group that spans it: groups are what lies between one common
end and the next, of whichever piece.

A link is a pair of occurrences of an A and a B token that end together. How often two ids are
linked is counted over the whole corpus: a block of texts counts its own links first, so that one
row for each block and pair of ids is shuffled, never a row for each link; the blocks get the
totals of their pairs back, and each text's sums are looked up there.

Texts that are null or empty, or whose joined A or B bytes differ from a blank and the text (B
writes U+2581 for a blank, so a text that holds that character is one) have no tokens: zeros, and
the column ``groups`` is empty. Strings of special tokens are ordinary text. Rows that repeat are
rows of their own and each count. A very long text is one row of one task to the encoders, and
many pieces to the merge. An empty table gives an empty result. Columns other than the id and the
text are not read and cannot clash.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.byte_bpe import text_groups
from tidegate.llm.memory import tidy
from tidegate.llm.token_files import byte_alphabet

PIECE = 4096
BLOCK_LINKS = 2_000_000
BLANK_MARK = "▁"

CODED = T.StructType([
    T.StructField("block", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("links", T.BinaryType()),
    T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("counts", T.ArrayType(T.LongType())),
])
FOUND = T.StructType([
    *CODED.fields[1:6],
    T.StructField("n_best", T.LongType()),
    T.StructField("count_sum", T.LongType()),
    T.StructField("groups", T.StringType()),
])


def crossings(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> np.ndarray:
    """How many of a's ends come before each ``step``-th diagonal of the merge of a and b, from 0 to all.

    On diagonal d the path has taken i ends of a and d - i of b. Equal ends are taken from a first,
    so i is the least number with a[i] > b[d - i - 1]; a binary search for all diagonals together.
    """
    d = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b))
    low, high = np.maximum(d - len(b), 0), np.minimum(d, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        taken = np.zeros(len(d), bool)
        taken[open_] = a[mid[open_]] <= b[d[open_] - mid[open_] - 1]
        low = np.where(open_ & taken, mid + 1, low)
        high = np.where(open_ & ~taken, mid, high)
    return low


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one piece's ends of a and of b are the same."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(b, a)
    same = np.flatnonzero(b[np.minimum(at, len(b) - 1)] == a)
    return same, at[same]


def common_ends(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of the ends they have in common, from pieces of equal work."""
    i = crossings(a, b, step)
    j = np.append(np.arange(0, len(a) + len(b), step), len(a) + len(b)) - i
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for p in range(len(i) - 1):
        if p and i[p] and j[p] < len(b) and a[i[p] - 1] == b[j[p]]:  # the boundary fell between two equal ends
            found_a.append(i[p:p + 1] - 1)
            found_b.append(j[p:p + 1])
        own_a, own_b = overlaps(a[i[p]:i[p + 1]], b[j[p]:j[p + 1]])
        found_a.append(own_a + i[p])
        found_b.append(own_b + j[p])
    return np.concatenate(found_a), np.concatenate(found_b)


class Pair:
    """Both tokenizers of one worker, the lengths of their tokens, and their ids as text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        byte_of = {c: byte for byte, c in byte_alphabet().items()}
        n = self.a.get_vocab_size()
        self.bytes_a = [bytes(byte_of.get(c, 0) for c in self.a.id_to_token(i) or "") for i in range(n)]
        b = self.b
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if b.is_byte(i) else b"" if b.is_control(i) else piece.replace(BLANK_MARK, " ").encode()
            for i, piece in enumerate(map(b.id_to_piece, range(b.get_piece_size())))
        ]
        self.length_a, self.length_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        # Ids as text with what may follow them: in a group, at A's last, at B's last.
        self.written = [f"{i}{after}" for after in ",|" for i in range(n)] + [f"{i}{after}" for after in ",;" for i in range(b.get_piece_size())]

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both; none for texts that either does not give back byte by byte."""
        full = [f" {text}" for text in texts]
        a = [found.ids for found in self.a.encode_batch_fast(full, add_special_tokens=False)]
        b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(full):
            data = text.encode("utf-8")
            if len(data) == 1 or any(b"".join(map(x.__getitem__, ids)) != data for x, ids in ((self.bytes_a, a[k]), (self.bytes_b, b[k]))):
                a[k], b[k] = [], []
        return a, b


@lru_cache(maxsize=1)
def pair(path_a: str, path_b: str) -> Pair:
    """The tokenizers of each worker process, kept between its tasks."""
    return Pair(path_a, path_b)


class Aligned:
    """The alignment of a batch of texts: everything in arrays over all its tokens."""

    def __init__(self, own: Pair, texts: list[str], step: int = PIECE):
        a, b = own.encode(texts)
        self.n_a, self.n_b = (np.array(list(map(len, x)), np.int64) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), np.int64, int(n.sum())) for x, n in ((a, self.n_a), (b, self.n_b)))
        at_a, at_b = common_ends(own.length_a[ids_a].cumsum(), own.length_b[ids_b].cumsum(), step)
        self.pairs = ids_a[at_a] << 32 | ids_b[at_b]
        # A text's last end is common, so groups never span texts.
        self.n_groups = np.diff(np.searchsorted(at_a, np.append(0, self.n_a.cumsum())))
        self.groups = self._write(own, ids_a, ids_b, at_a, at_b)

    def _write(self, own: Pair, ids_a: np.ndarray, ids_b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text: of each group A's ids, then B's."""
        group_a, group_b = np.searchsorted(at_a, np.arange(len(ids_a))), np.searchsorted(at_b, np.arange(len(ids_b)))
        before_b, upto_a = np.append(0, at_b + 1), at_a + 1
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[at_a], last_b[at_b] = 1, 1
        row = np.empty(len(ids_a) + len(ids_b), np.int64)
        row[np.arange(len(ids_a)) + before_b[group_a]] = ids_a + last_a * len(own.bytes_a)
        row[np.arange(len(ids_b)) + upto_a[group_b]] = 2 * len(own.bytes_a) + ids_b + last_b * len(own.bytes_b)
        words = list(map(own.written.__getitem__, row.tolist()))
        ends = (self.n_a + self.n_b).cumsum().tolist()
        return ["".join(words[start:end])[:-1] for start, end in zip([0, *ends], ends, strict=False)]


def _coder(path_a: str, path_b: str, digest: bool, block_links: int) -> Callable:
    schema = pa.schema([
        *[(f.name, pa.int64()) for f in CODED.fields[:6]],
        ("groups", pa.string()), ("links", pa.binary()), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block = pair(path_a, path_b), TaskContext.get().partitionId() << 32
        held: list[tuple] = []
        pairs: list[np.ndarray] = []

        def close() -> Iterator[pa.RecordBatch]:
            """The block's texts with their links as places in its list of pairs, and that list."""
            distinct, at, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            ends = np.cumsum([row[4] for row in held]).tolist()
            at = at.astype("<u4")
            links = [at[start:end].tobytes() for start, end in zip([0, *ends], ends, strict=False)]
            for k in range(0, len(held), 1000):
                columns = [pa.array(column, kind.type) for column, kind in zip(zip(*held[k:k + 1000], strict=True), list(schema)[1:7], strict=True)]
                size = len(columns[0])
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * size, pa.int64()), *columns, pa.array(links[k:k + 1000], pa.binary()),
                    *[pa.nulls(size, pa.list_(pa.int64()))] * 2,
                ], schema=schema)
            none = [pa.nulls(1, kind.type) for kind in list(schema)[1:8]]
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), *none, *(pa.array([x], pa.list_(pa.int64())) for x in (distinct, n)),
            ], schema=schema)

        for batch in batches:
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            for texts in text_groups(batch.column("text")):
                found = Aligned(own, texts)
                groups = found.groups
                if digest:
                    groups = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in groups]
                n_groups = found.n_groups.tolist()
                held += zip(doc_ids[at:at + len(texts)], found.n_a.tolist(), found.n_b.tolist(), n_groups, n_groups, groups, strict=True)
                pairs.append(found.pairs)
                at += len(texts)
                if sum(map(len, pairs)) >= block_links:
                    yield from close()
                    held, pairs, block = [], [], block + 1
        if held:
            yield from close()
    return run


def align(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    store: Callable[[DataFrame, str], DataFrame],
    digest: bool = False,
    block_links: int = BLOCK_LINKS,
) -> DataFrame:
    """A row for each document: numbers of tokens, groups and links, its links' sums, and its groups.

    ``groups`` is text of the form ``a1,a2|b1;a3|b2,b3``, with ``digest`` its SHA-256 in hex ('' where
    there is none). The paths name files on every executor. ``block_links`` bounds what a block
    holds: a block ends with the batch of texts that brings its links to that number.
    """
    source = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    coded = store(source.mapInArrow(tidy(_coder(path_a, path_b, digest, block_links)), CODED), "coded")
    own = coded.where(F.col("pairs").isNotNull()).select(F.col("block").alias("of_block"), F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "own"))
    own = own.select("of_block", "at", F.col("own.pairs").alias("pair"), F.col("own.counts").alias("n"))
    totals = store(own.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    id_b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = totals.groupBy(id_b.alias("id_b")).agg(F.max("total").alias("highest"))
    judged = totals.withColumn("id_b", id_b).join(highest, "id_b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    looked_up = own.drop("n").join(judged, "pair").select("of_block", "at", "total", "best")
    texts = coded.where(F.col("pairs").isNull()).drop("pairs", "counts")
    return texts.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(_sums, FOUND)


def _sums(texts: pa.Table, looked_up: pa.Table) -> pa.Table:
    """Sums over the links of one block's texts, whose pairs' totals came back in any order."""
    at = looked_up.column("at").to_numpy()
    total, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    total[at], best[at] = looked_up.column("total").to_numpy(), looked_up.column("best").to_numpy()
    n_best, sums = [], []
    for data in texts.column("links").to_pylist():
        own = np.frombuffer(data, "<u4")
        n_best.append(int(best[own].sum()))
        sums.append(int(total[own].sum()))
    return pa.Table.from_arrays([
        *(texts.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")), pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()), texts.column("groups"),
    ], names=[f.name for f in FOUND])
