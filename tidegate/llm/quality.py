"""Quality rules: fixed rules on word counts, then robust multivariate outliers.

Statistics of each text are taken over all of it. The transformed statistic vectors of every source
of a language, of every language and of all rows get a minimum-covariance-determinant estimate:

* four deterministic starts: medians with median deviations, the correlation of tanh scores, the
  covariance of spatial signs, and plain mean and covariance;
* concentration steps, each taking mean and covariance anew from the COVERAGE of rows nearest by
  Mahalanobis distance; after FIRST_STEPS the start with the least determinant goes on until its
  determinant no longer changes (STEPS at most). As in every search of this kind the least one found
  need not be the least there is: against the best of 100 random starts it was within 0.02 (in
  logarithms) in groups of 100 rows and more, and up to 0.2 above in smaller ones;
* scaled so that the median distance is a normal vector's, never sharper than estimated;
* reweighted: mean and covariance of the rows within the chi-square quantile REWEIGHT.

A source is then judged by a mixture of its estimate with PRIOR rows' worth of its language's, which
itself is mixed with PRIOR rows' worth of that of all rows. So a verdict changes smoothly with the
size of a group; no size switches judging on or off. A text is rejected if its distance lies beyond
the chi-square quantile TAIL. Texts that fail the fixed rules are not used for estimates.

Shares are shrunk by a few pseudo words, so that a short text is not judged by its noise, and
covariances have a floor (VARIANCE_FLOOR, added to the diagonal), since most texts of a clean group have
no symbol or repeated line at all and the plain estimate would be singular.

Percentiles are exact up to PERCENTILE_ACCURACY rows in a group, beyond that within 1/PERCENTILE_ACCURACY
of a group's rows: a task sends at most so many points of a group at a time.

Rows are packed once into blocks of a group, as bytes; a pass is numpy over blocks, and what meets
an estimate is a block with all its group's estimates.

Defined results: a null text has no words and fails; null languages and sources are groups of
their own; repeated rows each count and each give a row; empty tables give none; very long texts are
read whole; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.memory import tidy
from tidegate.llm.words import utf8, windows, words_of

MIN_WORDS = 10
MOST_REPEATED_PERCENT = 20
REPEAT_WINDOW = 5
COVERAGE = 0.75
FIRST_STEPS, STEPS = 2, 15
SETTLED = 1e-6  # change of the log determinant that ends the steps
REWEIGHT = 0.975
PRIOR = 60
TAIL = 0.9999
# Least variance of each feature: a deviation is only one if it also matters by itself. Repeats have
# more room, as a repeated line or two is common in good texts and the fixed rules judge the rest.
VARIANCE_FLOOR = (0.0025, 0.0016, 0.02, 0.02, 0.0025, 0.0025)
PERCENTILE_ACCURACY = 10_000
SALTS = 32  # parts in which the rows of one source meet its law
BLOCK_ROWS = 2048
PACKED_ROWS = 1 << 16  # rows a task packs at a time
ENTRY_ROWS = 1 << 14  # rows a pass works on at a time
HELD_VALUES = 1 << 20  # values a task holds before it sends them
LEVELS = ("source_group", "lang_group", "all_group")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("f_word_length", "f_symbols", "f_dup_lines", "f_repeats", "f_upper", "f_signs")
P = len(FEATURES)

SYMBOLS = b"#*$%&|<>"
_IS = {name: np.zeros(256, bool) for name in ("symbol", "upper", "sign", "head")}
_IS["symbol"][list(SYMBOLS)] = True
_IS["upper"][65:91] = True
_IS["sign"][[b for b in range(33, 127) if not chr(b).isalnum() and b not in SYMBOLS]] = True
_IS["head"][:] = True
_IS["head"][128:192] = False  # continuation bytes of UTF-8
_IS["head"][[32, *range(9, 14)]] = False
_BLANK = " \t\n\v\f\r"


def chi_square(x: float, k: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term = total = math.exp(-x / 2)
    for i in range(1, k // 2):
        term *= x / 2 / i
        total += term
    return 1 - total


def chi_square_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, k) < p else (low, middle)
    return (low + high) / 2


def repeated_words(hashes: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """For each text, the words inside a window of REPEAT_WINDOW words that the text has twice or more."""
    values, at = windows(hashes, text, REPEAT_WINDOW)
    if not len(at):
        return np.zeros(n_texts, np.int64)
    owners = text[at]
    order = np.lexsort((values, owners))
    same = (values[order][1:] == values[order][:-1]) & (owners[order][1:] == owners[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for i in range(REPEAT_WINDOW):
        covered[at[twice] + i] = True
    return np.bincount(text[covered], minlength=n_texts)


def duplicate_lines(text: str | None) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier one."""
    lines = [line for line in (text or "").split("\n") if line.strip(_BLANK)]
    return len(lines), len(lines) - len(set(lines))


def text_statistics(column: pa.Array) -> dict[str, np.ndarray]:
    data, offsets = utf8(column)
    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask[data], dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    n_words, repeats = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for words in words_of(column, fold=False):
        n_words.append(words.counts)
        repeats.append(repeated_words(words.hash, words.text, words.texts))
    lines = np.array([duplicate_lines(text) for text in column.to_pylist()], np.int64).reshape(-1, 2)
    out = {
        "n_words": np.concatenate(n_words),
        "word_chars": per_text(_IS["head"]),
        "n_symbols": per_text(_IS["symbol"]),
        "n_dup_lines": lines[:, 1],
        "n_repeat_words": np.concatenate(repeats),
    }
    words, chars = out["n_words"] + 50, out["word_chars"] + 250
    return out | {
        "f_word_length": np.log(chars / words),
        "f_symbols": np.sqrt(out["n_symbols"] / chars),
        "f_dup_lines": np.sqrt(lines[:, 1] / (lines[:, 0] + 5)),
        "f_repeats": np.sqrt(out["n_repeat_words"] / words),
        "f_upper": np.sqrt(per_text(_IS["upper"]) / chars),
        "f_signs": np.sqrt(per_text(_IS["sign"]) / chars),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and the transformed statistics of every row."""
    source = docs.select("doc_id", F.col("lang").cast("string"), F.col("source").cast("string"), "text")
    kinds = [(n, T.LongType()) for n in COUNTS] + [(n, T.DoubleType()) for n in FEATURES]
    schema = T.StructType([*(source.schema[n] for n in ("doc_id", "lang", "source")), *(T.StructField(n, t) for n, t in kinds)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("doc_id", "lang", "source")), *(pa.array(found[n]) for n, _ in kinds)], names=schema.names
            )

    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return source.mapInArrow(tidy(run), schema).withColumn("base_failed", failed)


def assign_groups(stats: DataFrame) -> DataFrame:
    """The rows that passed, with the names of their three groups and a salt."""
    lang = F.concat_ws("\u0001", F.col("lang").isNull().cast("int"), F.coalesce("lang", F.lit("")))
    source = F.concat_ws("\u0001", lang, F.col("source").isNull().cast("int"), F.coalesce("source", F.lit("")))
    salt = F.pmod(F.xxhash64("doc_id", *FEATURES), F.lit(SALTS)).cast("int")
    names = {"all_group": F.lit("all"), "lang_group": F.concat(F.lit("lang "), lang), "source_group": F.concat(F.lit("source "), source), "salt": salt}
    return stats.where(~F.col("base_failed")).withColumns(names)


def _packed(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    x = np.column_stack([rows.column(f).to_numpy() for f in FEATURES])
    for level in LEVELS:
        names, index = np.unique(np.array(rows.column(level).to_pylist(), dtype=object), return_inverse=True)
        order, ends = np.argsort(index, kind="stable"), np.cumsum(np.bincount(index, minlength=len(names)))
        groups, packed = [], []
        for name, start, end in zip(names, [0, *ends[:-1]], ends, strict=True):
            for at in range(start, end, BLOCK_ROWS):
                groups.append(name)
                packed.append(x[order[at : min(at + BLOCK_ROWS, end)]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.string()), pa.array(packed, pa.binary())], names=["group", "x"])


def in_blocks(rows: DataFrame) -> DataFrame:
    """Every row's features in each of its groups, packed into blocks of up to BLOCK_ROWS rows of a group.

    A task packs the rows it reads as they come, so nothing is shuffled. Estimates meet blocks, not rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= PACKED_ROWS:
                yield from _packed(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from _packed(pa.Table.from_batches(held))

    return rows.select(*LEVELS, *FEATURES).mapInArrow(run, "`group` string, x binary")


class Entries(NamedTuple):
    """Some blocks, each once for every estimate beside it: the rows of all, and what is known of each entry."""

    groups: list[str]
    sizes: np.ndarray
    x: np.ndarray
    which: np.ndarray  # the entry of each row
    beside: dict[str, np.ndarray]

    @property
    def first(self) -> np.ndarray:
        """The place of each entry's first row."""
        return np.cumsum(self.sizes) - self.sizes


def _numbers(column: pa.Array) -> np.ndarray:
    """A column of numbers, or of as many numbers in every row."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def entries(batch: pa.RecordBatch) -> Iterator[Entries]:
    """What a batch of blocks holds, up to some ENTRY_ROWS rows at a time."""
    if not batch.num_rows:
        return
    packed = batch.column("x").cast(pa.binary())
    offsets = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1] // (8 * P)
    x = np.frombuffer(packed.buffers()[2], count=offsets[-1] * P).reshape(-1, P)
    names = batch.column("group").to_pylist()
    if "starts" in batch.schema.names:
        starts = batch.column("starts")
        block, inner = np.repeat(np.arange(len(packed)), starts.value_lengths().to_numpy()), starts.flatten()
        beside = {field.name: _numbers(values) for field, values in zip(inner.type, inner.flatten(), strict=True)}
    else:
        block = np.arange(len(packed))
        beside = {name: _numbers(batch.column(name)) for name in batch.schema.names if name not in ("group", "x")}
    sizes = np.diff(offsets)[block].astype(np.int64)
    up_to, at = np.cumsum(sizes), 0
    while at < len(block):
        end = max(at + 1, int(np.searchsorted(up_to, up_to[at] - sizes[at] + ENTRY_ROWS, "right")))
        n = sizes[at:end]
        which = np.repeat(np.arange(end - at), n)
        rows = np.arange(len(which)) + (offsets[block[at:end]] - (np.cumsum(n) - n))[which]
        yield Entries([names[i] for i in block[at:end]], n, x[rows], which, {k: v[at:end] for k, v in beside.items()})
        at = end


def with_estimates(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Rows beside their group's estimates. A group's rows are dealt out, and sums over it come back through a map-side aggregate."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    return rows.join(estimates.select("*", salts), ["group", "salt"]).drop("salt")


def beside_blocks(blocks: DataFrame, estimates: DataFrame) -> DataFrame:
    """Blocks beside what is known of their group. A group has one block for some thousand rows, and nothing
    stands on the join's order, so adaptive execution can split the blocks of a very large group."""
    return blocks.join(estimates, "group")


def squared_distance() -> Column:
    """Mahalanobis distance from a row's features to its group's ``center`` under ``precision``, squared."""
    deltas = [F.col(f) - F.col("center")[i] for i, f in enumerate(FEATURES)]
    terms = [deltas[i] * deltas[j] * F.col("precision")[i * P + j] for i in range(P) for j in range(P)]
    return sum(terms[1:], terms[0])


ESTIMATE = "`group` string, start int, n long, center array<double>, cov array<double>, precision array<double>, log_det double"


def thinned(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values in order with their weights; of more than PERCENTILE_ACCURACY, as many that stand each for an equal share."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    if len(values) <= PERCENTILE_ACCURACY:
        return values, weights
    up_to = np.cumsum(weights)
    ends = up_to[-1] * np.arange(PERCENTILE_ACCURACY + 1) // PERCENTILE_ACCURACY
    return values[np.searchsorted(up_to, (ends[:-1] + ends[1:] + 1) // 2)], np.diff(ends)


def percentiles(blocks: DataFrame, series: Callable[[Entries], Iterator[tuple[Iterable[int], np.ndarray]]], share: float) -> DataFrame:
    """(group, start, value): the percentile of each group's series, which are made of entries: a number for each, a value for each row.

    A task sends the values of a group, thinned where they are many; where they meet they are not thinned again.
    """
    def sent(held: dict[tuple[str, int], list[np.ndarray]]) -> pa.RecordBatch:
        points, weights = [], []
        for parts in held.values():
            values = np.concatenate(parts)
            few = len(values) <= PERCENTILE_ACCURACY
            values, own = (values, np.zeros(0, np.int64)) if few else thinned(values, np.ones(len(values), np.int64))
            points.append(values.tobytes())
            weights.append(own.tobytes())  # none where each is one
        columns = [pa.array([g for g, _ in held], pa.string()), pa.array([k for _, k in held], pa.int32()), pa.array(points, pa.binary()), pa.array(weights, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["group", "start", "points", "weights"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = {}, 0
        for batch in batches:
            for found in entries(batch):
                for keys, values in series(found):
                    for group, key, start, size in zip(found.groups, keys, found.first.tolist(), found.sizes.tolist(), strict=True):
                        held.setdefault((group, key), []).append(values[start : start + size])
                    n += len(values)
                if n >= HELD_VALUES:
                    yield sent(held)
                    held, n = {}, 0
        if held:
            yield sent(held)

    def value(parts: list[tuple[bytes, bytes]]) -> float:
        points = np.frombuffer(b"".join(v for v, _ in parts))
        if not any(w for _, w in parts):
            return float(np.sort(points)[max(1, math.ceil(share * len(points))) - 1])
        weights = np.concatenate([np.frombuffer(w, np.int64) if w else np.ones(len(v) // 8, np.int64) for v, w in parts])
        order = np.argsort(points, kind="stable")
        up_to = np.cumsum(weights[order])
        return float(points[order[np.searchsorted(up_to, max(1, math.ceil(share * up_to[-1])))]])

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come in the order of their keys, so the parts of one follow each other.
        key, parts = None, []

        def result(rows: list[tuple[str, int, float]]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.float64()), strict=True)], names=["group", "start", "value"])

        for batch in batches:
            out = []
            for group, start, points, weights in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if (group, start) != key:
                    if key:
                        out.append((*key, value(parts)))
                    key, parts = (group, start), []
                parts.append((points, weights))
            yield result(out)
        if key:
            yield result([(*key, value(parts))])

    points = blocks.mapInArrow(tidy(summarise), "`group` string, start int, points binary, weights binary")
    dealt = points.repartition("group", "start").sortWithinPartitions("group", "start")
    return dealt.mapInArrow(ranked, "`group` string, start int, value double")


SUMS = [f"m{i}" for i in range(P)] + [f"c{i}_{j}" for i in range(P) for j in range(i + 1)]
_LOWER = np.tril_indices(P)


def sums(blocks: DataFrame, sets: Callable[[Entries], Iterator[tuple[Iterable[int], np.ndarray, np.ndarray]]]) -> DataFrame:
    """(group, start, n_used, SUMS): sums over each numbered set of vectors, and of their products, over all blocks of a group.

    A set has a number for each entry, a vector for each row, and which of these rows are used.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in entries(batch):
                for keys, y, used in sets(found):
                    y = np.where(used[:, None], y, 0.0)
                    parts = np.add.reduceat(np.concatenate([y, y[:, _LOWER[0]] * y[:, _LOWER[1]]], axis=1), found.first)
                    n = np.add.reduceat(used.astype(np.int64), found.first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(found.groups, pa.string()), pa.array(keys, pa.int32()), pa.array(n), *map(pa.array, parts.T.copy())],
                        names=["group", "start", "n_used", *SUMS],
                    )

    kinds = ", ".join(f"{name} double" for name in SUMS)
    found = blocks.mapInArrow(tidy(run), f"`group` string, start int, n_used long, {kinds}")
    return found.groupBy("group", "start").agg(*[F.sum(name).alias(name) for name in ("n_used", *SUMS)])


def _moments(n: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and covariances of what rows of :func:`sums` add up."""
    totals = totals / n[:, None]
    mean, cov = totals[:, :P], np.zeros((len(n), P, P))
    cov[:, _LOWER[0], _LOWER[1]] = cov[:, _LOWER[1], _LOWER[0]] = totals[:, P:]
    return mean, cov - mean[:, :, None] * mean[:, None, :]


def estimate(group: str, start: int, n: int, center: np.ndarray, cov: np.ndarray) -> tuple:
    """A row of ESTIMATE; determinant and precision are those of the covariance with its floor."""
    full = cov + np.diag(VARIANCE_FLOOR)
    return group, start, n, list(center), cov.ravel().tolist(), np.linalg.inv(full).ravel().tolist(), float(np.linalg.slogdet(full)[1])


def _estimates(groups: list[str], starts: Iterable[int], n: np.ndarray, centers: np.ndarray, covs: np.ndarray) -> pa.RecordBatch:
    """Rows of ESTIMATE, as :func:`estimate` makes one."""
    full = covs + np.diag(VARIANCE_FLOOR)
    precisions, log_dets = np.linalg.inv(full), np.linalg.slogdet(full)[1]

    def lists(x: np.ndarray) -> pa.Array:
        width = x[0].size if len(x) else 0
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * width), pa.array(x.ravel()))

    columns = [pa.array(groups, pa.string()), pa.array(starts, pa.int32()), pa.array(n, pa.int64()), lists(centers), lists(covs), lists(precisions), pa.array(log_dets)]
    return pa.RecordBatch.from_arrays(columns, names=["group", "start", "n", "center", "cov", "precision", "log_det"])


def starting_covariances(mad: np.ndarray, tanh: np.ndarray, sign: np.ndarray) -> list[np.ndarray]:
    """Scatter of the first three starts from median deviations and the moments of tanh scores and spatial signs."""
    variance = (1.4826 * mad) ** 2
    scale = np.sqrt(variance + VARIANCE_FLOOR)
    deviation = np.sqrt(np.diag(tanh))
    correlation = tanh / np.maximum(np.outer(deviation, deviation), 1e-12)
    signs = sign * P / max(np.trace(sign), 1e-12)
    return [np.diag(variance), correlation * np.outer(scale, scale), signs * np.outer(scale, scale)]


def first_estimates(blocks: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The four starts of every group."""
    def by_feature(found: DataFrame, name: str) -> DataFrame:
        values = F.sort_array(F.collect_list(F.struct("start", "value")))
        return found.groupBy("group").agg(F.transform(values, lambda x: x["value"]).alias(name))

    def features(found: Entries) -> Iterator[tuple[Iterable[int], np.ndarray]]:
        return (([i] * len(found.sizes), x) for i, x in enumerate(found.x.T))

    def away(found: Entries) -> Iterator[tuple[Iterable[int], np.ndarray]]:
        apart = np.abs(found.x - found.beside["middle"][found.which])
        return (([i] * len(found.sizes), x) for i, x in enumerate(apart.T))

    middles = store(by_feature(percentiles(blocks, features, 0.5), "middle"), "medians")
    near = store(middles.join(by_feature(percentiles(beside_blocks(blocks, middles), away, 0.5), "mad"), "group"), "deviations")

    def sets(found: Entries) -> Iterator[tuple[Iterable[int], np.ndarray, np.ndarray]]:
        apart = found.x - found.beside["middle"][found.which]
        z = apart / np.sqrt((1.4826 * found.beside["mad"]) ** 2 + VARIANCE_FLOOR)[found.which]
        for k, y in enumerate((np.tanh(z), z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12), apart)):
            yield [k] * len(found.sizes), y, np.ones(len(y), bool)

    three = F.sort_array(F.collect_list(F.struct("start", "n_used", *SUMS))).alias("sets")
    found = near.join(sums(beside_blocks(blocks, near), sets).groupBy("group").agg(three), "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inner = batch.column("sets").flatten()
            numbers = dict(zip([field.name for field in inner.type], map(_numbers, inner.flatten()), strict=True))
            n, totals = numbers["n_used"], np.column_stack([numbers[name] for name in SUMS])
            mean, cov = _moments(n, totals)
            middle, mad, groups = _numbers(batch.column("middle")), _numbers(batch.column("mad")), batch.column("group").to_pylist()
            # Three sets of a group follow each other: tanh scores, signs and the rows themselves.
            scatters = [[*starting_covariances(mad[i], cov[3 * i], cov[3 * i + 1]), cov[3 * i + 2]] for i in range(len(groups))]
            for k in range(4):
                centers = middle + mean[2::3] if k == 3 else middle
                yield _estimates(groups, [k] * len(groups), n[::3], centers, np.array([x[k] for x in scatters]).reshape(-1, P, P))

    return found.mapInArrow(run, ESTIMATE)


def squared_distances(found: Entries) -> np.ndarray:
    """Of each row from the center of its entry, under the entry's precision."""
    apart = found.x - found.beside["center"][found.which]
    precision = found.beside["precision"].reshape(-1, P, P)
    if len(found.sizes) * 32 > len(found.x):  # small blocks: all at once
        return np.einsum("ri,rij,rj->r", apart, precision[found.which], apart)
    ends = np.cumsum(found.sizes)
    return np.concatenate([np.einsum("ij,ij->i", apart[a:b] @ m, apart[a:b]) for a, b, m in zip(found.first, ends, precision, strict=True)])


def distances(found: Entries) -> Iterator[tuple[Iterable[int], np.ndarray]]:
    yield found.beside["start"].tolist(), squared_distances(found)


def by_group(estimates: DataFrame, *columns: str) -> DataFrame:
    """A row for each group with all its estimates, so that a block goes through a pass once."""
    return estimates.groupBy("group").agg(F.collect_list(F.struct("start", "n", "center", "precision", *columns)).alias("starts"))


def _fit(blocks: DataFrame, limited: DataFrame, factor: float = 1.0) -> DataFrame:
    """Mean and covariance, times a factor, of each estimate's rows up to its ``limit``."""
    def near(found: Entries) -> Iterator[tuple[Iterable[int], np.ndarray, np.ndarray]]:
        apart = found.x - found.beside["center"][found.which]
        yield found.beside["start"], apart, squared_distances(found) <= found.beside["limit"][found.which]

    known = limited.select("group", F.explode("starts").alias("known")).select("group", "known.start", "known.n", "known.center")
    found = sums(beside_blocks(blocks, limited), near).join(known, ["group", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, cov = _moments(_numbers(batch.column("n_used")), np.column_stack([_numbers(batch.column(name)) for name in SUMS]))
            center = _numbers(batch.column("center")).reshape(-1, P) + mean
            yield _estimates(batch.column("group").to_pylist(), _numbers(batch.column("start")), _numbers(batch.column("n")), center, factor * cov)

    return found.mapInArrow(run, ESTIMATE)


def concentrate(blocks: DataFrame, estimates: DataFrame, store: Callable[[DataFrame, str], DataFrame], name: str) -> DataFrame:
    """One concentration step: mean and covariance of each group's COVERAGE nearest rows."""
    limits = percentiles(beside_blocks(blocks, by_group(estimates)), distances, COVERAGE)
    # The limit is one of the distances, computed again: a last digit must not leave its row out.
    limited = estimates.join(limits, ["group", "start"]).withColumn("limit", F.col("value") * (1 + 1e-12) + 1e-12)
    return store(_fit(blocks, store(by_group(limited, "limit"), f"{name}-limits")), name)


def least_determinant(rows: DataFrame, store: Callable[[DataFrame, str], DataFrame], steps: int = STEPS) -> DataFrame:
    """The estimate of every group whose nearest rows have the least covariance determinant."""
    return search(store(in_blocks(rows), "blocks"), store, steps)


def search(blocks: DataFrame, store: Callable[[DataFrame, str], DataFrame], steps: int) -> DataFrame:
    """:func:`least_determinant` of rows in blocks."""
    estimates = store(first_estimates(blocks, store), "starts")
    for step in range(FIRST_STEPS):
        estimates = concentrate(blocks, estimates, store, f"first-{step}")
    best = estimates.groupBy("group").agg(F.min(F.struct("log_det", "start")).alias("best")).select("group", F.col("best.start").alias("start"))
    estimates = store(estimates.join(best, ["group", "start"]), "best")
    for step in range(steps):
        before, estimates = estimates, concentrate(blocks, estimates, store, f"step-{step}")
        change = estimates.join(before.select("group", F.col("log_det").alias("was")), "group").agg(F.max(F.abs(F.col("log_det") - F.col("was"))))
        if (change.first()[0] or 0.0) <= SETTLED:
            break
    return estimates


def reweight(blocks: DataFrame, estimates: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Mean and covariance of the rows within the quantile REWEIGHT of the scaled estimate."""
    middles = percentiles(beside_blocks(blocks, by_group(estimates)), distances, 0.5)
    usual, limit = chi_square_quantile(0.5, P), chi_square_quantile(REWEIGHT, P)
    scaled = estimates.join(middles, ["group", "start"]).withColumn("limit", F.lit(limit) * F.greatest(F.lit(1.0), F.col("value") / usual))
    return store(_fit(blocks, store(by_group(scaled, "limit"), "distances"), REWEIGHT / chi_square(limit, P + 2)), "reweighted")


def mix_estimates(n: float, own: tuple[np.ndarray, np.ndarray], wider: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of n rows of a group's law with PRIOR rows of the wider one's."""
    share = n / (n + PRIOR)
    apart = own[0] - wider[0]
    cov = share * own[1] + (1 - share) * wider[1] + share * (1 - share) * np.outer(apart, apart)
    return share * own[0] + (1 - share) * wider[0], cov


def mixtures(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """(group, center, precision) by which each source is judged."""
    groups = rows.select("source_group", "lang_group", "all_group").distinct()
    for level in ("source", "lang", "all"):
        own = estimates.select(F.col("group").alias(f"{level}_group"), F.struct("n", "center", "cov").alias(level))
        groups = groups.join(own, f"{level}_group")

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                law = None
                for level in ("all", "lang", "source"):
                    own = np.array(row[level]["center"]), np.array(row[level]["cov"]).reshape(P, P)
                    law = own if law is None else mix_estimates(row[level]["n"], own, law)
                _, _, _, center, _, precision, _ = estimate("", 0, 0, *law)
                out.append((row["source_group"], center, precision))
            yield pd.DataFrame(out, columns=["group", "center", "precision"])

    return groups.select("source_group", "all", "lang", "source").mapInPandas(run, "`group` string, center array<double>, precision array<double>")


def judge(stats: DataFrame, store: Callable[[DataFrame, str], DataFrame], steps: int = STEPS, tail: float = TAIL) -> DataFrame:
    """The rows of ``measure`` with ``distance`` and ``kept``.

    ``store(frame, name)`` writes a frame to the shared folder and reads it back; every step ends
    with the table of estimates (a row for each group) stored, so lineages stay short. Of those
    tables the driver sees the greatest change of a determinant, nothing else.
    """
    rows = store(assign_groups(stats), "groups")
    blocks = store(in_blocks(rows), "blocks")
    estimates = reweight(blocks, search(blocks, store, steps), store)
    laws = store(mixtures(rows, estimates), "laws")
    judged = with_estimates(rows.withColumn("group", F.col("source_group")), laws).select("*", squared_distance().alias("d2"))
    verdict = judged.withColumn("kept", F.col("d2") <= chi_square_quantile(tail, P))
    verdict = verdict.withColumn("distance", F.sqrt(F.greatest("d2", F.lit(0.0)))).select(*stats.columns, "distance", "kept")
    failed = stats.where("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    return verdict.unionByName(failed)
