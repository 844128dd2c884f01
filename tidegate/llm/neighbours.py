"""Nearest neighbours by inner product: a block matrix join over int8 tiles with error bounds.

Vectors are packed into blocks of rows, each vector x as a scale s and int8 codes c with the
lengths of s*c and of the rest x - s*c. Query groups and candidate groups form a grid; a cell
gets the blocks of both and goes over its tiles one block of candidates at a time. A tile is the
product of int8 codes (exact whole numbers). For x and y the product of the scaled codes differs
from <x, y> by at most |s*c_x| |rest_y| + |rest_x| |y|, so a pair whose upper bound lies below the
query's k-th best so far cannot be among its k nearest. The other pairs are recomputed from the
original vectors in double precision, summed from the first component to the last, and kept in a
heap of k for each query; heaps of different cells are merged by query. The result is exact.

Vectors that are null, empty, zero, or hold a null or non-finite component take no part, neither
as queries nor as candidates. Only vectors of the same number of components meet. Every row is a
candidate but the query's own row: rows that repeat an id or a vector are candidates like others,
also of each other. Ties go to the smaller id, a null id counts as the largest. Components so
large that their products overflow give what double arithmetic gives; a score that is not a
number counts as minus infinity. Empty tables give an empty result. Only the id, the vector and
the query condition are read, so other columns cannot clash.

What a task holds: a cell's queries (``query_rows``), one block of candidates, a strip of a tile.
A cell ships ``span_rows`` candidates and ``query_rows`` queries for their product's work.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.memory import tidy

QUERY_ROWS = 2048
SPAN_ROWS = 16384
BLOCK_ROWS = 2048
BLOCK_BYTES = 1 << 20
STRIP = 256
EXACT_PAIRS = 16384
WHOLE_NUMBERS = 1024  # components whose int8 products, summed, are exact in float32
SLACK = 2.0**-50  # of |x| |y| for each component: rounding of sums in double precision
_PLACE_BITS = 40

BLOCKS = T.StructType([
    T.StructField("is_query", T.BooleanType()),
    T.StructField("dim", T.IntegerType()),
    T.StructField("part", T.LongType()),
    T.StructField("seq", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("places", T.BinaryType()),
    T.StructField("vectors", T.BinaryType()),
    T.StructField("codes", T.BinaryType()),
    T.StructField("bounds", T.BinaryType()),
])
HEAPS = T.StructType([
    T.StructField("place", T.LongType()),
    T.StructField("query_id", T.LongType()),
    T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("scores", T.ArrayType(T.DoubleType())),
])
NEIGHBOURS = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("vec_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 codes of the rows, and for each row: scale, length of the scaled codes, of the rest, of the row."""
    x = vectors.astype("f8")
    with np.errstate(all="ignore"):
        scale = np.abs(x).max(axis=1, initial=0.0) / 127
        codes = np.where(scale[:, None] > 0, np.rint(x / scale[:, None]), 0).clip(-127, 127).astype(np.int8)
        near = codes * scale[:, None]
        bounds = np.stack([scale, *(np.sqrt(np.square(m).sum(axis=1)) for m in (near, x - near, x))], axis=1)
    return codes, bounds


def tile(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of int8 rows, exactly: float32 holds whole numbers up to 2^24."""
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], WHOLE_NUMBERS):
        out += a[:, k:k + WHOLE_NUMBERS].astype("f4") @ b[:, k:k + WHOLE_NUMBERS].astype("f4").T
    return out


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, first component to last."""
    score = np.zeros(len(a))
    with np.errstate(all="ignore"):
        for x, y in zip(a.astype("f8").T, b.astype("f8").T, strict=True):
            score += x * y
    return np.where(np.isnan(score), -np.inf, score)


class Block:
    """Rows of one block, or of several put together."""

    def __init__(self, rows: list[dict], item: str):
        self.ids = [i for row in rows for i in row["ids"]]
        self.dim = rows[0]["dim"]
        read = lambda name, kind: np.frombuffer(b"".join(row[name] for row in rows), kind)
        self.places = read("places", "<i8")
        self.vectors = read("vectors", item).reshape(-1, self.dim)
        self.codes = read("codes", np.int8).reshape(-1, self.dim)
        self.scale, self.near, self.rest, self.length = read("bounds", "<f8").reshape(-1, 4).T
        self.known = np.array([i is not None for i in self.ids])
        self.keys = np.array([0 if i is None else i for i in self.ids], np.int64)


class Nearest:
    """The k nearest candidates so far of a group of queries."""

    def __init__(self, queries: Block, k: int):
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, bool, int]]] = [[] for _ in queries.ids]

    def meet(self, block: Block) -> None:
        for a in range(0, len(self.heaps), STRIP):
            self._strip(slice(a, min(a + STRIP, len(self.heaps))), block)

    def _strip(self, rows: slice, block: Block) -> None:
        q, k = self.queries, self.k
        own = np.searchsorted(block.places, q.places[rows]).clip(max=len(block.places) - 1)
        mine = np.flatnonzero(block.places[own] == q.places[rows])
        with np.errstate(all="ignore"):
            score = tile(q.codes[rows], block.codes) * q.scale[rows, None] * block.scale
            error = q.near[rows, None] * block.rest + q.rest[rows, None] * block.length
            error += SLACK * (q.dim + 16) * q.length[rows, None] * block.length
            least = np.array([h[0][0] if len(h) == k else -np.inf for h in self.heaps[rows]])
            if np.isneginf(least).any() and score.shape[1] > k:
                low = score - error
                low[mine, own[mine]] = -np.inf
                least = np.fmax(least, np.partition(low, -k, axis=1)[:, -k])
            left = ~(score + error < least[:, None])
        left[mine, own[mine]] = False
        i, j = np.nonzero(left)
        for a in range(0, len(i), EXACT_PAIRS):
            self._push(rows.start + i[a:a + EXACT_PAIRS], j[a:a + EXACT_PAIRS], block)

    def _push(self, i: np.ndarray, j: np.ndarray, block: Block) -> None:
        score = exact(self.queries.vectors[i], block.vectors[j])
        order = np.lexsort((block.keys[j], ~block.known[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        nth = np.arange(len(i)) - np.repeat(first, np.diff(np.r_[first, len(i)]))
        kept = nth < self.k
        heaps, k = self.heaps, self.k
        for q, s, known, key in zip(i[kept].tolist(), score[kept].tolist(), block.known[j[kept]].tolist(), block.keys[j[kept]].tolist(), strict=True):
            add(heaps[q], (s, known, -key), k)

    def rows(self) -> pa.RecordBatch:
        found = [sorted(heap, reverse=True) for heap in self.heaps]
        return pa.RecordBatch.from_arrays([
            pa.array(self.queries.places, pa.int64()),
            pa.array(self.queries.ids, pa.int64()),
            pa.array([[-key if known else None for _, known, key in heap] for heap in found], pa.list_(pa.int64())),
            pa.array([[score for score, _, _ in heap] for heap in found], pa.list_(pa.float64())),
        ], names=HEAPS.names)


def add(heap: list, item: tuple[float, bool, int], k: int) -> None:
    """Put an item into a heap of the k largest: score first, then known ids, then small ids (kept negated)."""
    if len(heap) < k:
        heapq.heappush(heap, item)
    elif item > heap[0]:
        heapq.heapreplace(heap, item)


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(wrong, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def pack(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """Blocks of the vectors that take part; those of queries once more, as query blocks."""
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    item = T.FloatType() if single else T.DoubleType()
    source = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        vectors[vector_col].cast(T.ArrayType(item)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    return source.where(usable(F.col("vector"))).mapInArrow(tidy(_packer("<f4" if single else "<f8")), BLOCKS)


def _packer(item: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[tuple[bool, int], list[tuple[int | None, int, np.ndarray]]] = {}
        place, seq = part << _PLACE_BITS, 0

        def block(kind: tuple[bool, int]) -> pa.RecordBatch:
            nonlocal seq
            rows = held.pop(kind)
            matrix = np.stack([row[2] for row in rows])
            codes, bounds = quantise(matrix)
            seq += 1
            return pa.RecordBatch.from_pylist([{
                "is_query": kind[0], "dim": kind[1], "part": part, "seq": seq, "n": len(rows),
                "ids": [row[0] for row in rows], "places": np.array([row[1] for row in rows], "<i8").tobytes(),
                "vectors": matrix.tobytes(), "codes": codes.tobytes(), "bounds": bounds.astype("<f8").tobytes(),
            }], schema=_ARROW_BLOCKS)

        for batch in batches:
            column = batch.column("vector")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(item, copy=False)
            ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
            asked = batch.column("is_query").to_pylist()
            for i, (own, end) in enumerate(zip(batch.column("id").to_pylist(), ends.tolist(), strict=True)):
                vector = flat[(ends[i - 1] if i else 0):end]
                place += 1
                for kind in [(False, len(vector)), (True, len(vector))][:2 if asked[i] else 1]:
                    rows = held.setdefault(kind, [])
                    rows.append((own, place, vector.copy()))
                    if len(rows) == BLOCK_ROWS or len(rows) * vector.nbytes >= BLOCK_BYTES:
                        yield block(kind)
        for kind in list(held):
            yield block(kind)
    return run


_ARROW_BLOCKS = pa.schema([
    ("is_query", pa.bool_()), ("dim", pa.int32()), ("part", pa.int64()), ("seq", pa.int64()), ("n", pa.int64()),
    ("ids", pa.list_(pa.int64())), ("places", pa.binary()), ("vectors", pa.binary()), ("codes", pa.binary()), ("bounds", pa.binary()),
])


def find_nearest(
    vectors: DataFrame,
    is_query: Column,
    store: Callable[[DataFrame, str], DataFrame],
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_rows: int = QUERY_ROWS,
    span_rows: int = SPAN_ROWS,
) -> DataFrame:
    """Rows of (query_id, rank, vec_id, score): the k nearest candidates of each query, nearest first.

    ``is_query`` marks the rows that ask; all rows are candidates.
    """
    blocks = store(pack(vectors, is_query, id_col, vector_col), "blocks")
    rows_of = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    groups = lambda rows, size: F.greatest(F.lit(1), F.ceil(rows / size))
    grid = store(blocks.groupBy("dim").agg(
        groups(rows_of(F.col("is_query")), query_rows).alias("n_query"),
        groups(rows_of(~F.col("is_query")), span_rows).alias("n_span"),
    ), "grid")
    # Blocks of a part are dealt in turn, so groups are alike whether tasks made one block or many.
    turn = F.col("part") + F.col("seq")
    dealt = blocks.join(grid, "dim").select(
        *blocks.columns,
        F.explode(F.when(F.col("is_query"), F.array(F.pmod(turn, "n_query"))).otherwise(F.sequence(F.lit(0), F.col("n_query") - 1))).alias("q"),
        "n_span", turn.alias("turn"),
    ).select(
        *blocks.columns, "q",
        F.explode(F.when(F.col("is_query"), F.sequence(F.lit(0), F.col("n_span") - 1)).otherwise(F.array(F.pmod("turn", "n_span")))).alias("c"),
    )
    cells = grid.agg(F.sum(F.col("n_query") * F.col("n_span")).alias("n")).first()["n"] or 1
    spark = vectors.sparkSession
    tasks = min(cells, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8 * spark.sparkContext.defaultParallelism))
    single = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    laid = dealt.repartition(tasks, "dim", "q", "c").sortWithinPartitions("dim", "q", "c", F.desc("is_query"), "part", "seq")
    heaps = laid.mapInArrow(tidy(_searcher(k, "<f4" if single else "<f8")), HEAPS)
    return heaps.repartition("place").sortWithinPartitions("place").mapInArrow(_merger(k), NEIGHBOURS)


def _searcher(k: int, item: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asking, nearest = None, [], None
        for row in (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(batch.num_rows)):
            if (row["dim"], row["q"], row["c"]) != cell:
                if nearest:
                    yield nearest.rows()
                cell, asking, nearest = (row["dim"], row["q"], row["c"]), [], None
            if row["is_query"]:
                asking.append(row)
            elif asking:
                nearest = nearest or Nearest(Block(asking, item), k)
                nearest.meet(Block([row], item))
        if nearest:
            yield nearest.rows()
    return run


def _merger(k: int) -> Callable:
    def rows_of(query_id: int | None, heap: list) -> list[dict]:
        return [{"query_id": query_id, "rank": n, "vec_id": -key if known else None, "score": score}
                for n, (score, known, key) in enumerate(sorted(heap, reverse=True), 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, query_id, heap, out = None, None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["place"] != place:
                    out += rows_of(query_id, heap)
                    place, query_id, heap = row["place"], row["query_id"], []
                for own, score in zip(row["ids"], row["scores"], strict=True):
                    add(heap, (score, own is not None, -(own or 0)), k)
            yield pa.RecordBatch.from_pylist(out, schema=_ARROW_NEIGHBOURS)
            out = []
        yield pa.RecordBatch.from_pylist(rows_of(query_id, heap), schema=_ARROW_NEIGHBOURS)
    return run


_ARROW_NEIGHBOURS = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])
