"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are word sequences (lower case, signs dropped). A seed is a run of
MIN_MATCH words; a shorter item is one seed of all its words, and only a copy of all of them in a
row matches it. Documents meet items through seeds they share; each pair is then tiled by running
Karp-Rabin greedy string tiling: windows of the search length are hashed, equal ones grown to
maximal matches, the longest are marked first and never overlap, and the search length is halved
down to MIN_MATCH. The share of the item's words that lie in tiles is its coverage, whatever the
order the tiles stand in, so a passage whose sentences were moved around is found as well.

What is shuffled: a scan drops every word that is in no seed of the benchmark, by a bitmap of
fixed size. Only the words left, with their places, travel on; texts never do. False hits of the
bitmap drop out in the join on seeds. A pair is tiled only if the seeds it shares could cover
enough, a bound that loses nothing.

Defined results: a null or empty text, of a document or an item, matches nothing; repeated items (same id and words) count once, items that share an
id but not their words are tested apart and the best is reported; repeated documents (same id and
text) are reported once. Null ids are ordinary values. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.memory import tidy
from tidegate.llm.store import unused
from tidegate.llm.words import Words, windows, words_of

MIN_MATCH = 5
FIRST_LENGTH = 20
MIN_COVERAGE = 0.6
BITMAP_BITS = 1 << 24

ITEMS = "item_id long, tokens array<long>, seeds array<long>"
HITS = "doc_id long, text_hash long, places array<int>, tokens array<long>, seeds array<long>"


def _ranges(texts: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(texts, minlength=n))])


def _lists(values: np.ndarray, texts: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """A list for each of n texts; values are in order of their texts."""
    return pa.ListArray.from_arrays(pa.array(_ranges(texts, n), pa.int32()), pa.array(values.astype(kind.to_pandas_dtype(), copy=False), kind))


def item_words(benchmark: DataFrame, min_match: int = MIN_MATCH) -> DataFrame:
    """(item_id, tokens, seeds) of every different item; a seed stands as often as it occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text"), letters=True):
                seeds, text = _item_seeds(words, min_match)
                yield pa.RecordBatch.from_arrays([
                    batch.column("item_id").slice(words.first, words.texts),
                    _lists(words.hash.view(np.int64), words.text, words.texts, pa.int64()),
                    _lists(seeds.view(np.int64), text, words.texts, pa.int64()),
                ], names=["item_id", "tokens", "seeds"])

    source = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    return source.mapInArrow(tidy(run), ITEMS).where(F.size("seeds") > 0).distinct()


def _item_seeds(words: Words, min_match: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds of all items and the items they belong to, in order of items."""
    seeds, texts, counts = [], [], words.counts
    for length in range(1, min_match + 1):
        found, at = windows(words.hash, words.text, length)
        text = words.text[at]
        own = np.full(len(text), True) if length == min_match else counts[text] == length
        seeds.append(found[own])
        texts.append(text[own])
    seeds, texts = np.concatenate(seeds), np.concatenate(texts)
    order = np.argsort(texts, kind="stable")
    return seeds[order], texts[order]


def seed_lengths(items: DataFrame, min_match: int = MIN_MATCH) -> list[int]:
    """Lengths of seeds that occur, at most ``min_match`` different ones."""
    rows = items.select(F.least(F.size("tokens"), F.lit(min_match)).alias("n")).distinct().collect()
    return sorted(row["n"] for row in rows)


def seed_bitmap(items: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """Which seed hashes occur, modulo ``bits``. At most ``bits / 64`` rows reach the driver, however large the benchmark."""
    bit = items.select(F.explode("seeds").alias("seed")).select(F.col("seed").bitwiseAND(F.lit(bits - 1)).alias("bit"))
    rows = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("set")
    )
    out = np.zeros(bits // 64, np.int64)
    for row in rows.toLocalIterator():
        out[row["word"]] = row["set"]
    return out


def find_hits(docs: DataFrame, bitmap: np.ndarray, lengths: Iterable[int] = (MIN_MATCH,)) -> DataFrame:
    """For every document with a seed in the bitmap: the words inside such seeds, their places, and the different seeds."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        bits = np.uint64(len(found) * 64 - 1)
        for batch in batches:
            for words in words_of(batch.column("text"), letters=True):
                inside, hits = np.zeros(len(words.hash), bool), []
                for length in lengths:
                    seeds, at = windows(words.hash, words.text, length)
                    low = (seeds & bits).astype(np.int64)
                    hit = ((found[low >> 6] >> (low & 63)) & 1).astype(bool)
                    hits.append((seeds[hit], at[hit]))
                    for i in range(length):
                        inside[at[hit] + i] = True
                seeds, at = (np.concatenate(x) for x in zip(*hits, strict=True)) if hits else ((), ())
                if not len(at):
                    continue
                inside = np.flatnonzero(inside)
                owners = words.text[inside]
                counts = words.counts
                places = inside - (np.cumsum(counts) - counts)[owners]
                docs_hit = np.unique(owners)
                number = np.zeros(words.texts, np.int64)
                number[docs_hit] = np.arange(len(docs_hit))
                pairs = np.unique(np.stack([number[words.text[at]].astype(np.uint64), seeds]), axis=1)
                rows = pa.array(docs_hit + words.first)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(rows),
                    batch.column("text_hash").take(rows),
                    _lists(places, number[owners], len(docs_hit), pa.int32()),
                    _lists(words.hash[inside].view(np.int64), number[owners], len(docs_hit), pa.int64()),
                    _lists(pairs[1].view(np.int64), pairs[0].astype(np.int64), len(docs_hit), pa.int64()),
                ], names=["doc_id", "text_hash", "places", "tokens", "seeds"])

    return docs.select("doc_id", "text_hash", F.lower("text").alias("text")).mapInArrow(tidy(run), HITS)


def tile(pattern: list, text: list, min_match: int = MIN_MATCH, first_length: int = FIRST_LENGTH) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences: (place in pattern, place in text, length) of each tile.

    ``None`` in the text equals nothing: it stands where words were left out.
    """
    in_pattern, in_text = [False] * len(pattern), [token is None for token in text]
    tiles: list[tuple[int, int, int]] = []
    length = max(first_length, min_match)
    while True:
        longest, found = _scan(pattern, text, in_pattern, in_text, length)
        if longest > 2 * length:
            length = longest
            continue
        for size, a, b in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if any(in_pattern[a:a + size]) or any(in_text[b:b + size]):
                continue  # what is left of it is found again at a shorter length
            in_pattern[a:a + size] = in_text[b:b + size] = [True] * size
            tiles.append((a, b, size))
        if found and any(size >= length for size, *_ in found) and _left(found, in_pattern, in_text, length):
            continue
        if length == min_match:
            return sorted(tiles)
        length = max(min_match, length // 2)


def _left(found, in_pattern, in_text, length) -> bool:
    """Whether an occluded match may still have a free stretch of the search length."""
    for size, a, b in found:
        free = 0
        for i in range(size):
            free = 0 if in_pattern[a + i] or in_text[b + i] else free + 1
            if free >= length:
                return True
    return False


_BASE, _MODULUS = 1_000_003, (1 << 61) - 1


def _rolling(tokens: list, used: list[bool], length: int) -> Iterator[tuple[int, int]]:
    """(place, Karp-Rabin hash) of every window of unused tokens."""
    lead, value, run = pow(_BASE, length - 1, _MODULUS), 0, 0
    for i, token in enumerate(tokens):
        if used[i]:
            value = run = 0
            continue
        if run == length:
            value = (value - (tokens[i - length] % _MODULUS) * lead) % _MODULUS
            run -= 1
        value = (value * _BASE + token % _MODULUS) % _MODULUS
        run += 1
        if run == length:
            yield i - length + 1, value


def _scan(pattern, text, in_pattern, in_text, length):
    """Length of the longest match, and all maximal matches of at least ``length``."""
    table: dict[int, list[int]] = defaultdict(list)
    for a, value in _rolling(pattern, in_pattern, length):
        table[value].append(a)
    if not table:
        return 0, []
    longest, found = 0, set()
    for b, value in _rolling(text, in_text, length):
        for a in table.get(value, ()):
            if a and b and not in_pattern[a - 1] and not in_text[b - 1] and pattern[a - 1] == text[b - 1]:
                continue  # part of a match that began earlier
            size = 0
            while (a + size < len(pattern) and b + size < len(text) and not in_pattern[a + size]
                   and not in_text[b + size] and pattern[a + size] == text[b + size]):
                size += 1
            if size >= length:
                found.add((size, a, b))
                longest = max(longest, size)
    return longest, list(found)


def spread_out(places: list[int], tokens: list[int]) -> list[int | None]:
    """The document's words with a gap mark wherever words were left out."""
    out: list[int | None] = []
    for i, (place, token) in enumerate(zip(places, tokens, strict=True)):
        if i and place != places[i - 1] + 1:
            out.append(None)
        out.append(token)
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    store: Callable[[DataFrame, str], DataFrame],
    min_coverage: float = MIN_COVERAGE,
    min_match: int = MIN_MATCH,
) -> DataFrame:
    """Pairs (doc_id, text_hash, item_id, item_words, covered, tiles) whose coverage reaches ``min_coverage``.

    ``store(frame, name)`` writes a frame to the shared folder and reads it back.
    """
    items = store(item_words(benchmark, min_match), "items")
    # Items are told apart by id and words; the words' hash is the second half of the key.
    items = items.withColumn("item_key", F.xxhash64("tokens"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash"))
    hits = store(find_hits(source, seed_bitmap(items), seed_lengths(items, min_match)), "hits")

    seeds = items.select("item_id", "item_key", F.size("tokens").alias("item_words"), F.explode("seeds").alias("seed"))
    seeds = seeds.groupBy("seed", "item_id", "item_key", "item_words").agg(F.count("*").alias("times"))
    shared = hits.select("doc_id", "text_hash", F.explode("seeds").alias("seed")).join(seeds, "seed")
    # A tile of n words holds n - min_match + 1 seeds: so many seeds are needed to cover enough.
    pairs = shared.groupBy("doc_id", "text_hash", "item_id", "item_key", "item_words").agg(F.sum("times").alias("times"))
    pairs = pairs.where(F.col("times") * min_match >= F.lit(min_coverage) * F.col("item_words"))
    pairs = pairs.select(*[F.col(c).alias(f"p_{c}") for c in ("doc_id", "text_hash", "item_id", "item_key")])

    own = hits.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text_hash", "places", F.col("tokens").alias("words"))
    sided = pairs.join(own, F.col("p_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("p_text_hash") == F.col("text_hash")))
    sides = sided.join(
        items.select("item_id", "item_key", F.col("tokens").alias("item")),
        F.col("p_item_id").eqNullSafe(F.col("item_id")) & (F.col("p_item_key") == F.col("item_key")),
    ).select("doc_id", "text_hash", "item_id", "places", "words", "item")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covered, count = [], []
            for row in batch.select(["places", "words", "item"]).to_pylist():
                tiles = tile(row["item"], spread_out(row["places"], row["words"]), min(min_match, len(row["item"])))
                covered.append(sum(size for *_, size in tiles))
                count.append(len(tiles))
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("doc_id", "text_hash", "item_id")),
                pa.compute.list_value_length(batch.column("item")).cast(pa.int64()),
                pa.array(covered, pa.int64()),
                pa.array(count, pa.int64()),
            ], names=["doc_id", "text_hash", "item_id", "item_words", "covered", "tiles"])

    tiled = sides.mapInArrow(tidy(run), "doc_id long, text_hash long, item_id long, item_words long, covered long, tiles long")
    return tiled.where(F.col("covered") >= F.lit(min_coverage) * F.col("item_words"))


def leaking_documents(leaks: DataFrame) -> DataFrame:
    """A row for each document with a leak: its best item, coverage, and how many items it holds."""
    return leaks.groupBy("doc_id", "text_hash").agg(
        F.max(F.struct((F.col("covered") / F.col("item_words")).alias("coverage"), (-F.col("item_id")).alias("i"), "tiles")).alias("best"),
        F.countDistinct("item_id").alias("n_items"),
    ).select("doc_id", "text_hash", (-F.col("best.i")).alias("item_id"), "best.coverage", "best.tiles", "n_items")


def remove_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """Documents without those that leak."""
    doc, text_hash = unused(docs, "leak_doc", "leak_hash")
    bad = leaks.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text_hash)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(bad[doc]) & (F.xxhash64(docs["text"]) == bad[text_hash])
    return docs.join(bad, same, "left_anti")
