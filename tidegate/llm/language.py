"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary classifier over hashed byte
n-grams (1 and 3 bytes, letters only, lower case) tells the languages whose bit is 1 from those
whose bit is 0: its weights are the log-odds of each n-gram's smoothed frequency on both sides.
A text's score for a bit is the mean log-odds of its n-grams. Decoding adds, bit by bit, the
logistic loss of a codeword against the scores, each bit weighted by how well its classifier did
on the texts it learned from, and takes the codeword of least loss. Where the runner-up is close
the text is flagged as ambiguous.

All counts are sums over all training texts, taken inside tasks and added up by Spark; no sample
is drawn. What goes to the driver is a table of fixed size for each language.

Defined results: a null text and a text without a letter are ``und`` with score 0, as are all
texts if nothing was learned; with one language every other text is that language. Repeated rows
each give a row. Only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.llm.memory import tidy
from tidegate.llm.words import mix, pieces, utf8

BINS = 1 << 15
SIZES = (1, 3)
SUM_PARTS = 16
UNKNOWN = "und"
SHARPNESS = 4.0  # steepness of the logistic loss in mean log-odds
AMBIGUOUS = 0.55  # score below which the decision is flagged
MOST_LANGUAGES = 512  # refused beyond: the model would no longer be small

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_ASCII_LETTER = _LETTER & (np.arange(256) < 128)
_LOWER[~_LETTER] = 32  # everything between words is one blank


@dataclass(frozen=True)
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # BINS x bits
    trust: np.ndarray  # weight of each bit's loss


def codewords(n: int) -> np.ndarray:
    """Codewords of n languages, entries -1 and 1.

    Up to 5 languages all splits are used, 2^(n-1) - 1 bits. Beyond, 15 log2(n) columns of a
    fixed pseudo-random code, each with both signs.
    """
    if n < 2:
        return np.zeros((n, 0))
    if n <= 5:
        splits = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits).T.astype(float)
    bits = math.ceil(15 * math.log2(n))
    draws = mix(np.arange(1, n * bits * 8 + 1, dtype=np.uint64)).reshape(n, -1) & np.uint64(1)
    code = draws.astype(float) * 2 - 1
    both = np.abs(code.sum(axis=0)) < n
    return code[:, both][:, :bits]


def ngrams(part: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every size: bins of a piece's n-grams in order, and the text of each. Those that are only blanks at both ends are left out."""
    low = _LOWER[part]
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    for n in SIZES:
        m = len(low) - n + 1
        if m <= 0:
            continue
        code = np.full(m, n, np.uint32)
        for i in range(n):
            code = code * np.uint32(0x01000193) + low[i:m + i]
        keep = (low[:m] != 32) | (low[n - 1:] != 32)
        keep &= text[:m] == text[n - 1:]
        code = code[keep]
        code ^= code >> np.uint32(15)
        code *= np.uint32(0x2C1B3C6D)
        yield (code ^ (code >> np.uint32(13))) & np.uint32(BINS - 1), text[:m][keep]


def lettered(part: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has a letter, in any script."""
    ascii_letters = np.concatenate([[0], np.cumsum(_ASCII_LETTER[part])])
    found = ascii_letters[offsets[1:]] > ascii_letters[offsets[:-1]]
    for i in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[i] = any(c.isalpha() for c in part[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return found


def _batches(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(column)
    for a, b in pieces(offsets):
        yield a, b, data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]


def count_ngrams(labelled: DataFrame) -> DataFrame:
    """Rows of (lang, bins): n-gram counts of every language, bins being BINS doubles.

    Each task adds up its own texts and gives one row for each language it met.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            for a, b, part, offsets in _batches(batch.column("text")):
                names, number = np.unique(langs[a:b].astype(str), return_inverse=True)
                for bins, owners in ngrams(part, offsets):
                    counts = np.bincount(number[owners] * BINS + bins, minlength=len(names) * BINS).reshape(-1, BINS)
                    for name, own in zip(names, counts, strict=True):
                        total[name] = total.get(name, 0) + own
        part_of_sum = TaskContext.get().partitionId() % SUM_PARTS
        for name, own in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([own.astype("<f8").tobytes()], pa.binary()), pa.array([part_of_sum], pa.int32())],
                names=["lang", "bins", "part"],
            )

    partial = labelled.select("lang", "text").mapInArrow(tidy(run), "lang string, bins binary, part int")
    # Summed in two steps, so that no task reads the rows of all the others.
    dealt = partial.repartition("lang", "part").mapInArrow(_add_up, "lang string, bins binary")
    return dealt.repartition("lang").mapInArrow(_add_up, "lang string, bins binary")


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for name, own in zip(batch.column("lang").to_pylist(), batch.column("bins").to_pylist(), strict=True):
            total[name] = total.get(name, 0) + np.frombuffer(own, "<f8")
    for name, own in total.items():
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([own.tobytes()], pa.binary())], names=["lang", "bins"])


def build_model(counts: dict[str, np.ndarray]) -> Model:
    """Binary classifiers of all bits from the languages' n-gram counts; every language counts alike."""
    languages = sorted(counts)
    codes = codewords(len(languages))
    weights = np.zeros((BINS, codes.shape[1]), np.float32)
    share = np.array([(counts[name] + 0.5) / (counts[name].sum() + 0.5 * BINS) for name in languages]).reshape(-1, BINS)
    for bit in range(codes.shape[1]):
        one, zero = share[codes[:, bit] > 0].mean(axis=0), share[codes[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log(one) - np.log(zero)
    return Model(languages, codes, weights, np.ones(codes.shape[1]))


def bit_scores(model: Model, part: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean log-odds of every text for every bit; nan where a text has no letter."""
    n = len(offsets) - 1
    total, count = np.zeros((n, max(1, model.weights.shape[1]))), np.zeros(n)
    for bins, owners in ngrams(part, offsets):
        own = np.bincount(owners, minlength=n)
        count += own
        if model.weights.shape[1] and len(bins):
            full = own > 0
            begin = (np.cumsum(own) - own)[full]
            total[full] += np.add.reduceat(model.weights[bins], begin, axis=0)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where(lettered(part, offsets)[:, None], total / count[:, None], np.nan)


def decode(model: Model, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest codeword and its share of the belief, exp(-loss) over all languages."""
    if len(model.languages) < 2:
        return np.zeros(len(scores), int), np.ones(len(scores))
    loss = np.logaddexp(0, -SHARPNESS * scores[:, None, :] * model.codes[None]) @ model.trust
    belief = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    best = loss.argmin(axis=1)
    return best, belief[np.arange(len(best)), best] / belief.sum(axis=1)


def measure_trust(labelled: DataFrame, model: Model) -> np.ndarray:
    """How often each bit's classifier is right on the texts it learned from, as a weight: 2 accuracy - 1."""
    places = {name: i for i, name in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, n = np.zeros(model.codes.shape[1], np.int64), 0
        for batch in batches:
            own = np.array([places[x] for x in batch.column("lang").to_pylist()], int)
            for a, b, part, offsets in _batches(batch.column("text")):
                scores = bit_scores(model, part, offsets)
                full = ~np.isnan(scores[:, 0])
                right += (scores[full] * model.codes[own[a:b][full]] > 0).sum(axis=0)
                n += int(full.sum())
        yield pa.RecordBatch.from_arrays([pa.array([right.tolist()], pa.list_(pa.int64())), pa.array([n], pa.int64())], names=["hits", "n"])

    rows = labelled.select("lang", "text").mapInArrow(tidy(run), "hits array<long>, n long")
    sums = rows.agg(*[F.sum(F.col("hits")[i]).alias(f"b{i}") for i in range(model.codes.shape[1])], F.sum("n").alias("n")).first()
    if not sums or not sums["n"]:
        return model.trust
    accuracy = np.array([sums[f"b{i}"] for i in range(model.codes.shape[1])], float) / sums["n"]
    return np.maximum(2 * accuracy - 1, 0.01)


def fit(labelled: DataFrame) -> Model:
    """Learn from all rows of (lang, text) whose language is not null."""
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string"), "text")
    found = count_ngrams(labelled).take(MOST_LANGUAGES + 1)
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = {row["lang"]: np.frombuffer(row["bins"], "<f8") for row in found}
    model = build_model({k: v for k, v in counts.items() if v.sum()})
    if len(model.languages) < 2:
        return model
    return Model(model.languages, model.codes, model.weights, measure_trust(labelled.where(F.col("lang").isin(model.languages)), model))


PREDICTION = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("ambiguous", T.BooleanType()),
])


def predictor(model: Model) -> Callable[[Column | str], Column]:
    """A column function: text to (lang_pred, score, ambiguous)."""
    names = np.array([*model.languages, UNKNOWN], object)

    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            langs, beliefs = [], []
            for _, _, part, offsets in _batches(column):
                scores = bit_scores(model, part, offsets)
                none = np.isnan(scores[:, 0]) | (not model.languages)
                best, belief = decode(model, np.where(none[:, None], 0, scores))
                langs += names[np.where(none, len(names) - 1, best)].tolist()
                beliefs.append(np.where(none, 0.0, belief))
            score = np.concatenate(beliefs) if beliefs else np.zeros(0)
            yield pa.StructArray.from_arrays(
                [pa.array(langs, pa.string()), pa.array(score), pa.array(score < AMBIGUOUS)], names=["lang_pred", "score", "ambiguous"]
            )

    return F.arrow_udf(predict, PREDICTION)
