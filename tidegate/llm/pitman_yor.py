"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling, that scores whole texts.

The model has three levels. A uniform base feeds the root restaurant, which serves words; under it
stand the context restaurants, one for each previous word (by its 64-bit hash), all sharing the root
as their parent. Every table of a context restaurant is a customer of the root.

    P(w | u) = (c_uw - d t_uw + (theta + d t_u) P(w)) / (theta + c_u)

Sampling. Given the root's measure G (drawn from its posterior) and one Gamma variable x_u for each
context, the dishes of all contexts are independent: t tables of sizes n_k have the weight
(x_u G(w))^t / t! times the product of Sibuya(d) probabilities of the n_k, given that the sizes add
up to the dish's customers. ``reseat`` draws all customers of every dish anew in each sweep by
Metropolis steps that leave this law as it is, in time that grows with tables, not with customers.
The root is seated in the same way, hot words too. Seats are stored, and the chain goes on from
round to round; predictive probabilities are averaged over the last KEPT of ROUNDS rounds. One part
is approximate: the root's mass for new tables is spread by a Dirichlet law with the mean and
variance of the process. Discounts follow from the counts of counts, n1 / (n1 + 2 n2).

How it is dealt. Pairs (context, word) are counted in each block of tokens before they are shuffled,
so a hot pair arrives as one count for each block. Pairs are dealt by context to buckets, whose
number follows from the number of tokens; hot contexts (found in a first pass, at most HOT_PARTS of
them) by context and word. Words are dealt to root parts, as many as buckets but ROOT_PARTS at most,
so that a bucket of any table sends a bounded number of messages. In a round, buckets send each root
part the tables of its words, and get the words' mass back; only totals and a few numbers by hot
context pass the driver. In the end the probabilities of a block's pairs are sent back to the block, where
the tokens have stayed.

Defined results: a null text is an empty one and has one token, its end. Words are cut at white
space, A-Z lower-cased. Repeated rows are documents of their own, also in training. Null ids are
ordinary values. If nothing is to be learned from, every word is unknown. Other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.files import join_path
from tidegate.llm.memory import tidy
from tidegate.llm.words import mix, words_of
from tidegate.session import remove_folder

BLOCK_TOKENS = 1_000_000
BUCKET_TOKENS = 2_000_000
LEAST_BUCKETS = 16  # so many tasks share few tokens, if there are as many shuffle partitions
ROOT_PARTS = 256  # messages of a bucket in a round, at most
HOT_TOKENS = 500_000
HOT_PARTS = 256  # a word is hot from about 1 / HOT_PARTS of all tokens on
ROUNDS = 4
KEPT = 2  # the last rounds, whose predictions are averaged
SLICES = 4  # of buckets and of blocks, scored one after another
SWEEPS = 4
ROOT_SWEEPS = 8
GROUP_TABLES = 2.0  # expected tables of those that are drawn anew together
CONCENTRATION = 1.0

_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
_SPREAD = np.uint64(0xD1342543DE82EF95)
_GRAIN = float(1 << 20)  # sums of Gamma draws are taken in whole grains, so that their order does not matter


# ---- tokens of a batch ----------------------------------------------------------------------

def tokens_of(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For pieces of a text column: first text, tokens of each text, token hashes."""
    for words in words_of(column):
        counts = words.counts
        ends = np.cumsum(counts + 1) - 1
        token = np.full(int(counts.sum()) + len(counts), _END, np.uint64)
        inside = np.ones(len(token), bool)
        inside[ends] = False
        token[inside] = words.hash
        yield words.first, counts + 1, token


# ---- first pass: hot contexts ---------------------------------------------------------------

def find_hot(docs: DataFrame, path: str) -> tuple[np.ndarray, int]:
    """Hashes of the words that make up about 1 / HOT_PARTS of all tokens (every word over 8 times that is among them), and the number of tokens.

    Tasks report the words that are frequent among their own tokens, at most 4 HOT_PARTS for a
    block, so what is shuffled is bounded by the number of blocks. The list only decides where
    pairs go, not what they score. A text's start is always among the contexts dealt by word.
    """
    def report(parts: list[np.ndarray]) -> pa.RecordBatch:
        word, count = np.unique(np.concatenate(parts), return_counts=True)
        often = count * (4 * HOT_PARTS) >= count.sum()
        word, own = word[often], count[often]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.append(word.view(np.int64), 0)), pa.array(np.append(own, count.sum()).astype(np.int64)),
             pa.array([False] * len(word) + [True])], names=["word", "n", "total"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for *_, token in tokens_of(batch.column("text")):
                parts.append(token)
                size += len(token)
                if size >= HOT_TOKENS:
                    yield report(parts)
                    parts, size = [], 0
        if parts:
            yield report(parts)

    sums = docs.select("text").mapInArrow(tidy(run), "word long, n long, total boolean").groupBy("total", "word").agg(F.sum("n").alias("n"))
    sums.write.parquet(path)
    sums = docs.sparkSession.read.schema(sums.schema).parquet(path)
    tokens = sums.agg(F.max(F.when(F.col("total"), F.col("n"))).alias("n")).first()["n"] or 0
    rows = sums.where(~F.col("total") & (F.col("n") * HOT_PARTS >= F.lit(tokens))).select("word").take(HOT_PARTS)
    return np.unique(np.append(np.array([row["word"] for row in rows], np.int64).view(np.uint64), _START)), tokens


# ---- rows that tasks send -------------------------------------------------------------------

_CELLS = "abcdefghij"
ROW = "to long, kind string, frm long, sums array<double>, " + ", ".join(f"{x} binary" for x in _CELLS)
_KINDS = (pa.int64(), pa.string(), pa.int64(), pa.list_(pa.float64()), *[pa.binary()] * len(_CELLS))
_NAMES = ["to", "kind", "frm", "sums", *_CELLS]


def _pack(numbers: np.ndarray) -> bytes:
    """Bytes of an array; of four-byte numbers all first bytes, then all second ones, which compress better."""
    return _planes(numbers) if numbers.dtype == np.uint32 else numbers.tobytes()


def _planes(numbers: np.ndarray) -> bytes:
    """All first bytes of an array's numbers, then all second ones, and so on."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def _doubles(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<f8").ravel()


def _row(to: int, kind: str, frm: int, *cells: np.ndarray, sums: np.ndarray | None = None) -> tuple:
    packed = [_pack(x) for x in cells]
    return (int(to), kind, int(frm), None if sums is None else np.asarray(sums, float).tolist(), *packed, *[None] * (len(_CELLS) - len(packed)))


def _slice(name: str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(SLICES)).cast("int")


def _table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
    return pa.table([pa.array(list(x), k) for x, k in zip(columns, _KINDS, strict=True)], names=_NAMES)


def _sorted(rows: list[dict], kind: str) -> list[dict]:
    return sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["frm"])


def _small(numbers: np.ndarray) -> np.ndarray:
    return numbers.astype("<u4" if not len(numbers) or numbers.max() < 1 << 32 else "<u8")


def _ints(data: bytes, n: int) -> np.ndarray:
    return _u4(data) if len(data) == 4 * n else np.frombuffer(data, "<u8").astype(np.int64)


def _u4(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


# ---- dealing pairs to buckets ---------------------------------------------------------------

def deal(docs: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """For every block of tokens its counted pairs, to their buckets, and a row that stays with the block.

    Kind ``pairs``: words (u8), each pair's word (u4), contexts (u8), their pairs (u4), training
    counts (u4). Kind ``docs``: ids with flags, held out, token counts, the pair of each token (u4).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = 0, _Block()
        base = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids, out = batch.column("doc_id"), batch.column("held_out")
            for first, counts, token in tokens_of(batch.column("text")):
                held.add(ids.slice(first, len(counts)).to_pylist(), out.slice(first, len(counts)).to_pylist(), counts, token)
                if held.size >= BLOCK_TOKENS:
                    yield from held.rows(base + number, hot, buckets)
                    number, held = number + 1, _Block()
        if held.size:
            yield from held.rows(base + number, hot, buckets)

    return docs.select("doc_id", "held_out", "text").mapInArrow(tidy(run), ROW)


class _Block:
    def __init__(self):
        self.ids, self.out, self.counts, self.tokens, self.size = [], [], [], [], 0

    def add(self, ids, out, counts, token):
        self.ids += ids
        self.out += out
        self.counts.append(counts)
        self.tokens.append(token)
        self.size += len(token)

    def rows(self, block: int, hot: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
        out = np.array(self.out, bool)
        counts = np.concatenate(self.counts)
        words, word = np.unique(np.concatenate(self.tokens), return_inverse=True)
        before = np.empty_like(word)
        before[1:] = word[:-1] + 1
        before[np.cumsum(counts) - counts] = 0
        pairs, back = np.unique(before.astype(np.int64) << 32 | word, return_inverse=True)
        trained = np.bincount(back[np.repeat(~out, counts)], minlength=len(pairs))
        before, word = pairs >> 32, pairs & 0xFFFFFFFF
        contexts = np.append(_START, words)
        key = contexts[before]
        is_hot = np.isin(contexts, hot)[before]
        key[is_hot] ^= mix(words[word[is_hot]]) * _SPREAD
        bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), "<u4")
        place[order] = np.arange(len(order))
        bucket = bucket[order]
        begins = np.flatnonzero(np.diff(bucket, prepend=-1))
        for begin, end in zip(begins.tolist(), [*begins[1:].tolist(), len(bucket)], strict=True):
            own = order[begin:end]
            met, at = np.unique(word[own], return_inverse=True)
            heads = np.flatnonzero(np.diff(before[own], prepend=-1))
            yield from _table([_row(
                bucket[begin], "pairs", block, words[met], at.astype("<u4"), contexts[before[own][heads]],
                np.diff(np.append(heads, len(own))).astype("<u4"), trained[own].astype("<u4"),
            )]).to_batches()
        has_id = np.array([i is not None for i in self.ids], np.uint8)
        ids = np.array([i or 0 for i in self.ids], "<i8")
        yield from _table([_row(block % buckets, "docs", block, ids, has_id, out.astype(np.uint8), counts.astype("<u4"), place[back])]).to_batches()


# ---- counting in a bucket -------------------------------------------------------------------

def count(pairs: DataFrame, hot: np.ndarray, parts: int) -> DataFrame:
    """For every bucket its dishes with their training counts.

    Kind ``static``: word of each dish, dishes of each context, hot number of each context, counts,
    (root part, words, words with seats to draw) for each part met, the dish of each pair, (block,
    pairs). Kind ``seats``: see ``_Seating``. Kind ``words``, to the root parts: words, tables, training
    counts, words with seats to draw. Its sums: tokens, n1, n2, then customers and tables by hot context.
    """
    def run(table: pa.Table) -> pa.Table:
        return _table(_count_bucket(_sorted(table.to_pylist(), "pairs"), hot, parts))

    return pairs.groupBy("to").applyInArrow(run, ROW)


def _count_bucket(rows: list[dict], hot: np.ndarray, parts: int) -> list[tuple]:
    bucket, word, context, trained, blocks = rows[0]["to"], [], [], [], []
    for r in rows:
        word.append(np.frombuffer(r["a"], "<u8")[_u4(r["b"])])
        context.append(np.repeat(np.frombuffer(r["c"], "<u8"), _u4(r["d"])))
        trained.append(_u4(r["e"]))
        blocks.append((r["frm"], len(word[-1])))
    words, word = np.unique(np.concatenate(word), return_inverse=True)
    contexts, context = np.unique(np.concatenate(context), return_inverse=True)
    dishes, pair_dish = np.unique(context.astype(np.int64) * len(words) + word, return_inverse=True)
    counts = np.bincount(pair_dish, np.concatenate(trained), minlength=len(dishes)).astype(np.int64)
    context, word = dishes // len(words), dishes % len(words)
    # Words in the order of their root parts, in each part those first that have seats to draw.
    part = (mix(words ^ _SPREAD) % np.uint64(parts)).astype(np.int64)
    drawn = np.bincount(word[counts > 1], minlength=len(words)) > 0
    order = np.lexsort((words, ~drawn, part))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    words, part, drawn, word = words[order], part[order], drawn[order], place[word]
    where = np.minimum(np.searchsorted(hot, contexts), len(hot) - 1)
    hot_number = np.where(hot[where] == contexts, where, -1)
    seen, several = counts > 0, np.flatnonzero(counts > 1)
    by_hot = np.zeros((2, len(hot)))
    for i, x in enumerate((counts, seen)):
        is_hot = hot_number[context] >= 0
        np.add.at(by_hot[i], hot_number[context][is_hot], x[is_hot])
    tables = np.bincount(word[seen], minlength=len(words))
    word_count = np.bincount(word, counts, minlength=len(words)).astype(np.int64)
    met, begin = np.unique(part, return_index=True)
    ends = np.append(begin[1:], len(part))
    n_drawn = np.add.reduceat(drawn.astype(np.int64), begin)
    shape = np.stack([met, ends - begin, n_drawn], axis=1).astype("<i8")
    own, at = np.unique(context[several], return_inverse=True)
    singles = np.bincount(context[counts == 1], minlength=len(contexts))[own]
    word_singles = np.bincount(word[counts == 1], minlength=len(words))[drawn]
    number = np.cumsum(drawn) - 1
    sums = np.concatenate([[counts.sum(), (counts == 1).sum(), (counts == 2).sum()], by_hot.ravel()])
    out = [
        _row(bucket, "static", bucket, word.astype("<u4"), np.bincount(context).astype("<u4"), hot_number.astype("<i4"), _small(counts),
             shape, pair_dish.astype("<u4"), np.array(blocks, "<i8"), sums=sums),
        _row(bucket, "seats", bucket, number[word[several]].astype("<u4"), at.astype("<u4"), _small(counts[several]), singles.astype("<u4"),
             hot_number[own].astype("<i4"), np.zeros(0, "<u4"), np.zeros(0, "<u4"), np.zeros(0), word_singles.astype("<u4"), shape),
    ]
    for (p, _, k), a, b in zip(shape.tolist(), begin.tolist(), ends.tolist(), strict=True):
        out.append(_row(-1 - p, "words", bucket, words[a:b], tables[a:b].astype("<u4"), word_count[a:b].astype("<u8"), np.array([k], "<i8")))
    return out


# ---- totals ---------------------------------------------------------------------------------

@dataclass
class Model:
    """What tasks know of each other: a few numbers, and totals by hot context."""

    tokens: float = 0.0
    words: float = 0.0
    discount: float = 0.5
    root_discount: float = 0.5
    hot_count: np.ndarray = field(default_factory=lambda: np.zeros(1))
    hot_tables: np.ndarray = field(default_factory=lambda: np.zeros(1))
    root_customers: float = 0.0
    root_tables: float = 0.0
    root_mass: float = 0.0  # of the last draw of the root's measure, at tables
    root_spread: float = 1.0  # and of that of its mass for new tables
    kept: list = field(default_factory=list)  # (root customers, root tables, tables by hot context) of the rounds kept

    @property
    def spread(self) -> float:
        """Concentration of the Dirichlet law with the variance of the root's mass for new tables."""
        return (1 + CONCENTRATION + self.root_discount * self.root_tables) / (1 - self.root_discount) - 1

    @property
    def base(self) -> float:
        return 1.0 / (self.words + 1)


def add_up(rows: DataFrame, n: int) -> np.ndarray:
    found = rows.where("sums is not null").select(F.posexplode("sums").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(n)
    for r in found:
        out[r["at"]] = r["x"]
    return out


def _discount(n1: float, n2: float) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5


# ---- seating --------------------------------------------------------------------------------

class Seats:
    """Customers of many dishes at their tables; ``step`` re-seats one customer of each dish by a Gibbs step.

    One step of Python for every customer of the largest dish: this is what tests hold ``reseat`` against.
    """

    def __init__(self, customers: np.ndarray, tables: np.ndarray):
        self.n, self.tables = customers, tables.copy()
        self.at = np.cumsum(customers) - customers
        slot = np.arange(int(customers.sum())) - np.repeat(self.at, customers)
        t, n = np.repeat(tables, customers), np.repeat(customers, customers)
        self.seat = (slot % t).astype(np.int32)
        self.size = np.where(slot < t, n // t + (slot < n % t), 0).astype(np.int32)
        self.free = np.minimum(slot + t, n - 1).astype(np.int32)  # unused tables of a dish, the first n - t entries
        self.n_free = customers - tables

    def step(self, random: np.random.Generator, new: np.ndarray, discount: float) -> None:
        m, at = len(self.n), self.at
        who = at + (random.random(m) * self.n).astype(np.int64)
        left = self.seat[who]
        self.size[at + left] -= 1
        gone = np.flatnonzero(self.size[at + left] == 0)
        self.free[at[gone] + self.n_free[gone]] = left[gone]
        self.n_free[gone] += 1
        self.tables[gone] -= 1
        known = self.n - 1 - discount * self.tables
        opens = random.random(m) * (new + known) < new
        rest = np.flatnonzero(~opens)
        while len(rest):
            # A table by its size less the discount: that of another customer, taken with probability 1 - d / size.
            other = at[rest] + (random.random(len(rest)) * (self.n[rest] - 1)).astype(np.int64)
            other += other >= who[rest]
            table = self.seat[other]
            size = self.size[at[rest] + table]
            taken = random.random(len(rest)) * size < size - discount
            own, to = rest[taken], table[taken]
            self.seat[who[own]] = to
            self.size[at[own] + to] += 1
            rest = rest[~taken]
        own = np.flatnonzero(opens)
        self.n_free[own] -= 1
        to = self.free[at[own] + self.n_free[own]]
        self.seat[who[own]] = to
        self.size[at[own] + to] = 1
        self.tables[own] += 1


_TABLE = 4096


def _log_sibuya(n: np.ndarray, discount: float) -> np.ndarray:
    """log of d (1-d)(2-d)...(n-1-d) / n!; from _TABLE on by the ratio of Gamma functions, to within 1e-7."""
    k = np.arange(1, _TABLE)
    first = np.cumsum(np.append(math.log(discount), np.log((k - discount) / (k + 1))))
    far = np.maximum(n, 1).astype(float)
    tail = math.log(discount) - math.lgamma(1 - discount) - (1 + discount) * np.log(far) + np.log1p(discount * (1 + discount) / (2 * far))
    return np.where(n <= _TABLE, first[np.clip(n, 1, _TABLE) - 1], tail)


def _sibuya(random: np.random.Generator, n: int, discount: float) -> np.ndarray:
    p = np.clip(random.beta(discount, 1 - discount, n), 1e-300, 1 - 1e-16)
    return 1 + np.minimum(np.log(1 - random.random(n)) / np.log1p(-p), float(1 << 46)).astype(np.int64)


def reseat(random: np.random.Generator, size: np.ndarray, dish: np.ndarray, rate: np.ndarray, discount: float) -> tuple[np.ndarray, np.ndarray]:
    """One sweep: all customers of all dishes re-seated, by Metropolis steps that keep the law of the seats.

    ``size`` and ``dish`` describe the tables, ``rate`` the expected number of tables of a dish if
    its customers were not given. Tables are dealt to groups at random, about GROUP_TABLES expected in
    each. Each group is drawn anew given its customers: a Poisson number of tables of Sibuya sizes,
    and one table for those that are left. With r customers there and t tables, a draw has
    P(r) / t of its probability under the law.
    """
    groups = np.maximum(1, np.ceil(rate / GROUP_TABLES)).astype(np.int64)
    first = np.cumsum(groups) - groups
    label = first[dish] + (random.random(len(dish)) * groups[dish]).astype(np.int64)
    order = np.lexsort((random.random(len(dish)), label))
    label, size, dish = label[order], size[order], dish[order]
    heads = np.flatnonzero(np.diff(label, prepend=-1))
    if not len(heads):
        return size, dish
    t = np.diff(np.append(heads, len(label)))
    total, owner = np.add.reduceat(size, heads), dish[heads]
    last = size[heads]  # any one: tables of a group are in random order
    more = random.poisson(rate[owner] / groups[owner])
    group = np.repeat(np.arange(len(heads)), more)
    drawn = np.minimum(_sibuya(random, len(group), discount), total[group])
    left = total - np.bincount(group, drawn, minlength=len(heads)).astype(np.int64)
    odds = _log_sibuya(left, discount) - np.log(more + 1.0) - _log_sibuya(last, discount) + np.log(t)
    taken = (left > 0) & (np.log(1 - random.random(len(heads))) < odds)
    stay = ~np.repeat(taken, t)
    come = taken[group]
    size = np.concatenate([size[stay], drawn[come], left[taken]])
    dish = np.concatenate([dish[stay], owner[group[come]], owner[taken]])
    order = np.argsort(dish, kind="stable")
    return size[order], dish[order]


class _Seating:
    """Dishes of a bucket with more than one customer.

    Cells: word, context, customers of each dish; dishes with one customer and hot number of each
    context; tables of each dish, their sizes; what is kept (the sum of tables by dish, then the
    tables by context for each round kept); dishes with one customer by word; the parts' shape.
    """

    def __init__(self, row: dict):
        self.row = row
        self.word, self.context = _u4(row["a"]), _u4(row["b"])
        self.count = _ints(row["c"], len(self.word))
        self.singles = _u4(row["d"])
        self.hot = np.frombuffer(row["e"], "<i4").astype(np.int64)
        self.tables = _u4(row["f"]) if row["f"] else np.zeros(0, np.int64)
        self.size = _ints(row["g"], int(self.tables.sum()))
        kept = np.frombuffer(row["h"], "<f8")
        self.table_sum = kept[:len(self.word)] if len(kept) else np.zeros(len(self.word))
        self.kept = kept[len(self.word):].reshape(-1, len(self.singles)) if len(kept) and len(self.singles) else np.zeros((0, len(self.singles)))
        self.word_singles = _u4(row["i"])
        self.shape = np.frombuffer(row["j"], "<i8").reshape(-1, 3)

    def sweep(self, model: Model, turn: int, hot_x: np.ndarray, mass: np.ndarray, keep: bool) -> list[tuple]:
        """Seats drawn under the words' ``mass`` in the root's measure, and messages to the root parts."""
        bucket = self.row["to"]
        random = np.random.default_rng([turn, bucket])
        at = np.repeat(np.arange(len(self.word)), self.tables) if len(self.tables) else None
        size, by_dish = self.size, self.tables if at is not None else np.ones(len(self.word), np.int64)
        for _ in range(SWEEPS):
            t = self.singles + np.bincount(self.context, by_dish, minlength=len(self.singles))
            x = random.gamma(CONCENTRATION / model.discount + t)
            x[self.hot >= 0] = hot_x[self.hot[self.hot >= 0]]
            rate = x[self.context] * mass[self.word]
            if at is None:  # a first guess from which the chain starts
                by_dish = 1 + np.minimum(random.poisson(np.minimum(rate, self.count)), self.count - 1)
                at = np.repeat(np.arange(len(self.word)), by_dish)
                size = np.ones(len(at), np.int64)
                size[np.cumsum(by_dish) - by_dish] += self.count - by_dish
            size, at = reseat(random, size, at, rate, model.discount)
            by_dish = np.bincount(at, minlength=len(self.word))
        by_context = self.singles + np.bincount(self.context, by_dish, minlength=len(self.singles))
        kept = np.concatenate([self.table_sum, self.kept.ravel()])
        if keep:
            kept = np.concatenate([self.table_sum + by_dish, self.kept.ravel(), by_context])
        # Tables of hot contexts that are drawn; their dishes with one customer are in the first totals.
        by_hot = np.zeros(len(hot_x))
        own = self.hot[self.context]
        np.add.at(by_hot, own[own >= 0], by_dish[own >= 0] - 1)
        r = self.row
        out = [(bucket, "seats", bucket, by_hot.tolist(), r["a"], r["b"], r["c"], r["d"], r["e"], _pack(by_dish.astype("<u4")), _pack(_small(size)),
                kept.astype("<f8").tobytes(), r["i"], r["j"])]
        by_word = self.word_singles + np.bincount(self.word, by_dish, minlength=len(self.word_singles)).astype(np.int64)
        ends = np.cumsum(self.shape[:, 2])
        for (p, _, k), end in zip(self.shape.tolist(), ends.tolist(), strict=True):
            if k:
                out.append(_row(-1 - p, "tables", bucket, by_word[end - k:end].astype("<u4")))
        return out


def seat(rows: DataFrame, model: Model, turn: int, keep: bool) -> DataFrame:
    """One round in the buckets, from their seats and the root's messages."""
    random = np.random.default_rng([turn, 1 << 40])
    hot_x = random.gamma(CONCENTRATION / model.discount + model.hot_tables)
    unseated = random.gamma(CONCENTRATION + model.root_discount * model.root_tables)
    shared = rows.sparkSession.sparkContext.broadcast((model, hot_x, unseated))

    def run(table: pa.Table) -> pa.Table:
        found = table.to_pylist()
        model, hot_x, unseated = shared.value
        seating = _Seating(next(r for r in found if r["kind"] == "seats"))
        mass, spread = (np.concatenate([np.zeros(0), *[np.frombuffer(r[x], "<f8") for r in _sorted(found, "mass")]]) for x in "ab")
        mass = (mass + unseated * spread / model.root_spread) / (model.root_mass + unseated)
        return _table(seating.sweep(model, turn, hot_x, mass, keep))

    return rows.where("kind in ('seats', 'mass')").groupBy("to").applyInArrow(run, ROW)


def seat_root(rows: DataFrame, model: Model, turn: int, keep: bool, last: bool) -> DataFrame:
    """The root's seats, by word, from the buckets' messages; each bucket is sent its words' mass.

    Kind ``root``: the word of each place in the messages, (bucket, words, words drawn), tables at
    each place, tables of each word, its customers outside one table, training counts, what is kept.
    Sums: words, customers, tables, words with one and with two customers, grains of mass at tables
    and for new ones. Kind ``mass`` holds both draws for words with seats to draw, kind ``final`` what was kept for all words.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        found, model = table.to_pylist(), shared.value
        to = found[0]["to"]
        random = np.random.default_rng([turn, 1 << 41, -1 - to])
        first = _sorted(found, "words")
        if first:
            words, index = np.unique(np.concatenate([np.frombuffer(r["a"], "<u8") for r in first]), return_inverse=True)
            shape = np.array([(r["frm"], len(r["b"]) // 4, np.frombuffer(r["d"], "<i8")[0]) for r in first], "<i8")
            tables = np.concatenate([_u4(r["b"]) for r in first])
            word_count = np.bincount(index, np.concatenate([np.frombuffer(r["c"], "<u8") for r in first])).astype(np.int64)
            own_tables, outside, kept = np.ones(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros((0, len(words)))
        else:
            row = next(r for r in found if r["kind"] == "root")
            index, shape, tables = _u4(row["a"]), np.frombuffer(row["b"], "<i8").reshape(-1, 3), _u4(row["c"])
            word_count = np.frombuffer(row["f"], "<u8").astype(np.int64)
            own_tables, outside = _u4(row["d"]), _ints(row["e"], len(word_count))
            kept = np.frombuffer(row["g"], "<f8").reshape(-1, len(word_count))
            begin = dict(zip(shape[:, 0].tolist(), (np.cumsum(shape[:, 1]) - shape[:, 1]).tolist(), strict=True))
            for r in _sorted(found, "tables"):
                new = _u4(r["a"])
                tables[begin[r["frm"]]:begin[r["frm"]] + len(new)] = new
        n = np.bincount(index, tables, minlength=len(word_count)).astype(np.int64)
        if model.root_tables:
            own_tables, outside = _root_seats(random, n, own_tables, outside, model)
        own_tables = np.where(n > 0, own_tables, 0)
        rest = np.maximum(n - model.root_discount * own_tables, 0)
        mass = np.where(n > 0, np.rint(random.gamma(np.maximum(rest, 1e-12)) * _GRAIN), 0)
        # The first draw comes before the number of words is known.
        spread = np.rint(random.gamma(model.spread * model.base, size=len(n)) * _GRAIN) if model.words else np.full(len(n), _GRAIN)
        if keep:
            kept = np.concatenate([kept, rest[None]])
        out = [_row(to, "root", to, index.astype("<u4"), shape, tables.astype("<u4"), own_tables.astype("<u4"), _small(outside), word_count.astype("<u8"), kept,
                    sums=[(n > 0).sum(), n.sum(), own_tables.sum(), (n == 1).sum(), (n == 2).sum(), mass.sum(), spread.sum()])]
        at = 0
        for bucket, k, drawn in shape.tolist():
            own = index[at:at + k]
            at += k
            if last:
                out.append(_row(bucket, "final", -1 - to, word_count[own].astype("<u8"), np.ascontiguousarray(kept[:, own])))
            else:
                out.append(_row(bucket, "mass", -1 - to, mass[own[:drawn]] / _GRAIN, spread[own[:drawn]] / _GRAIN))
        return _table(out)

    return rows.where("kind in ('words', 'root', 'tables')").groupBy("to").applyInArrow(run, ROW)


def _root_seats(random: np.random.Generator, n: np.ndarray, tables: np.ndarray, outside: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each word at the root and their customers outside the one table that takes what is left; the steps of ``reseat`` with one group."""
    d = model.root_discount
    lost = (n <= outside) | (tables < 1)
    tables, outside = np.where(lost, 1, tables), np.where(lost, 0, outside)
    several = np.flatnonzero(n > 1)
    customers, t, rest = n[several], tables[several], n[several] - outside[several]
    for _ in range(ROOT_SWEEPS):
        rate = random.gamma(CONCENTRATION / d + model.root_tables) * model.base
        more = random.poisson(rate, len(several))
        group = np.repeat(np.arange(len(several)), more)
        drawn = np.minimum(_sibuya(random, len(group), d), customers[group])
        left = customers - np.bincount(group, drawn, minlength=len(several)).astype(np.int64)
        odds = _log_sibuya(left, d) - np.log(more + 1.0) - _log_sibuya(rest, d) + np.log(t)
        taken = (left > 0) & (np.log(1 - random.random(len(several))) < odds)
        t, rest = np.where(taken, more + 1, t), np.where(taken, left, rest)
    tables, outside = np.minimum(n, 1), np.zeros(len(n), np.int64)
    tables[several], outside[several] = t, customers - rest
    return tables, outside


# ---- scoring --------------------------------------------------------------------------------

SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def predict(rows: DataFrame, model: Model) -> DataFrame:
    """For every block and bucket, log10 of the probability of each pair and its word's training count."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(table: pa.Table) -> pa.Table:
        found, model = table.to_pylist(), shared.value
        static = next(r for r in found if r["kind"] == "static")
        seating = _Seating(next(r for r in found if r["kind"] == "seats"))
        word, n_dishes, hot = _u4(static["a"]), _u4(static["b"]), np.frombuffer(static["c"], "<i4").astype(np.int64)
        count, pair_dish = _ints(static["d"], len(word)), _u4(static["f"])
        finals = _sorted(found, "final")
        word_count = np.concatenate([np.frombuffer(r["a"], "<u8") for r in finals])
        kept = np.concatenate([np.frombuffer(r["b"], "<f8").reshape(len(model.kept), -1) for r in finals], axis=1)
        context = np.repeat(np.arange(len(n_dishes)), n_dishes)
        of_context = np.bincount(context, count, minlength=len(n_dishes))
        is_hot = hot >= 0
        of_context[is_hot] = model.hot_count[hot[is_hot]]
        several = np.flatnonzero(count > 1)
        own = np.unique(context[several])
        tables = (count > 0).astype(float)
        tables[several] = seating.table_sum / len(model.kept)
        seen = np.bincount(context, count > 0, minlength=len(n_dishes))
        p = count - model.discount * tables
        for i, (customers, root_tables, hot_tables) in enumerate(model.kept):
            of_root = (kept[i] + (CONCENTRATION + model.root_discount * root_tables) * model.base) / (CONCENTRATION + customers)
            by_context = seen.copy()
            if len(own):
                by_context[own] = seating.kept[i]
            by_context[is_hot] = hot_tables[hot[is_hot]]
            p += (CONCENTRATION + model.discount * by_context)[context] * of_root[word] / len(model.kept)
        p = np.log10(p / (CONCENTRATION + of_context[context]))
        out, at = [], 0
        for block, n in np.frombuffer(static["g"], "<i8").reshape(-1, 2).tolist():
            dish = pair_dish[at:at + n]
            at += n
            out.append(_row(block, "scores", static["to"], np.frombuffer(_planes(p[dish]), np.uint8), _small(word_count[word[dish]])))
        return _table(out)

    return rows.groupBy("to").applyInArrow(run, ROW)


def score(rows: DataFrame, model: Model) -> DataFrame:
    """A row for each document, from its block's tokens and the scores of the block's pairs."""
    tokens, scale = int(model.tokens), math.log10(model.tokens + model.words + 1)

    def gather(table: pa.Table) -> pa.Table:
        found = table.to_pylist()
        docs = next(r for r in found if r["kind"] == "docs")
        scores = _sorted(found, "scores")
        p = np.concatenate([_doubles(r["a"]) for r in scores])
        count = np.concatenate([_ints(r["b"], len(r["a"]) // 8) for r in scores])
        n, pair = _u4(docs["d"]), _u4(docs["e"])
        begin = np.cumsum(n) - n
        has_id = np.frombuffer(docs["b"], np.uint8).astype(bool)
        return pa.table([
            pa.array(np.frombuffer(docs["a"], "<i8"), mask=~has_id), pa.array(np.frombuffer(docs["c"], np.uint8).astype(bool)),
            pa.array(n), pa.array(np.add.reduceat((count > 0)[pair].astype(np.int64), begin)), pa.array(np.full(len(n), tokens)),
            pa.array(np.add.reduceat(np.log10(count + 1)[pair], begin) - n * scale), pa.array(np.add.reduceat(p[pair], begin)),
        ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return rows.groupBy(F.col("block")).applyInArrow(gather, SCORES)


def score_documents(docs: DataFrame, folder: str, buckets: int | None = None) -> DataFrame:
    """Learn from the rows of (doc_id, held_out, text) whose held_out is false, and score all of them.

    ``folder`` is in the shared folder; dishes, seats and messages of each step are kept there.
    There is a bucket for each BUCKET_TOKENS tokens, but one for each shuffle partition up to LEAST_BUCKETS at least.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("held_out", F.lit(False)).alias("held_out"), "text")

    def collect_garbage() -> None:
        spark.sparkContext._jvm.System.gc()  # shuffles of steps that are stored are cleaned once nothing refers to them

    def stored(rows: DataFrame, name: str) -> DataFrame:
        path = join_path(folder, name)
        rows.write.option("compression", "zstd").parquet(path)
        del rows  # its own shuffle goes as well
        collect_garbage()
        return spark.read.schema(ROW).parquet(path)

    def forget(name: str) -> None:
        """Remove a step that its successor, now written in full, has taken the place of: nothing reads it again."""
        remove_folder(spark, join_path(folder, name))

    def added(rows: DataFrame, name: str, *keys: str) -> None:
        """Add rows to a step; those of every key have a folder of their own, which can be forgotten by itself."""
        rows.write.mode("append").option("compression", "zstd").partitionBy(*keys).parquet(join_path(folder, name))
        del rows
        collect_garbage()

    def sliced(rows: DataFrame) -> DataFrame:
        return rows.withColumn("slice", _slice("to"))

    def read_sliced(name: str) -> DataFrame:
        return spark.read.schema(f"{ROW}, slice int").parquet(join_path(folder, name))

    hot, n = find_hot(source, join_path(folder, "hot"))
    buckets = buckets or max(-(-n // BUCKET_TOKENS), min(LEAST_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    root_parts = min(buckets, ROOT_PARTS)
    # In slices, so that no shuffle holds a second copy of all pairs, which go as soon as they are counted.
    added(sliced(deal(source, hot, buckets)), "counted", "kind", "slice")
    pairs = read_sliced("counted").where("kind = 'pairs'")
    for part in range(SLICES):
        added(sliced(count(pairs.where(F.col("slice") == part).select(*_NAMES), hot, root_parts)), "counted", "kind", "slice")
        forget(f"counted/kind=pairs/slice={part}")
    forget("counted/kind=pairs")
    counted = read_sliced("counted").select(*_NAMES)
    sums = add_up(counted, 3 + 2 * len(hot))
    start = sums[3 + len(hot):]
    model = Model(sums[0], 0.0, _discount(sums[1], sums[2]), 0.5, sums[3:3 + len(hot)], start)
    seats, static = counted.where("kind = 'seats'"), counted.where("kind = 'static'")
    root = counted.where("kind = 'words'")
    # The root's discount follows from its first customers, so they are counted before the first round.
    for turn in range(ROUNDS + 1):
        keep, last = turn > ROUNDS - KEPT, turn == ROUNDS
        if turn:
            seats = stored(seat(seats.unionAll(root.where("kind = 'mass'")), model, turn, keep), f"seats-{turn}")
            forget(f"seats-{turn - 1}" if turn > 1 else "counted/kind=seats")
            model.hot_tables = start + add_up(seats, len(hot))
            root = root.where("kind = 'root'").unionAll(seats.where("kind = 'tables'"))
            seats = seats.where("kind = 'seats'")
        root = stored(seat_root(root, model, turn, keep, last), f"root-{turn}")
        forget(f"root-{turn - 1}" if turn else "counted/kind=words")
        words, model.root_customers, model.root_tables, n1, n2, mass, spread = add_up(root, 7)
        # The unknown word has a share of the mass for new tables as well.
        model.root_mass, model.root_spread = mass / _GRAIN, spread / _GRAIN + (model.spread * model.base if turn else 1)
        if not turn:
            model.words, model.root_discount = words, _discount(n1, n2)
        if keep:
            model.kept.append((model.root_customers, model.root_tables, model.hot_tables))
    parts = static.unionAll(seats).unionAll(root.where("kind = 'final'"))
    # Stored, so that texts meet their scores when all else is gone; both in slices.
    for part in range(SLICES):
        added(sliced(predict(parts.where(_slice("to") == part), model)), "scores/pairs", "slice")
    for step in ("counted/kind=static", f"seats-{ROUNDS}", f"root-{ROUNDS}"):
        forget(step)
    documents = counted.where("kind = 'docs'").withColumn("block", F.col("frm"))
    scores = read_sliced("scores/pairs").withColumn("block", F.col("to"))
    for part in range(SLICES):
        own = documents.where(_slice("block") == part).unionAll(scores.where(F.col("slice") == part).drop("slice"))
        added(score(own, model), "scores/documents")
        forget(f"scores/pairs/slice={part}")
    return spark.read.schema(SCORES).parquet(join_path(folder, "scores/documents"))
