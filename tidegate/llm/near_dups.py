"""Near-duplicates by BagMinHash signatures, banding and exact multiset overlap.

A text is the multiset of its five-word runs (lower case, words cut at white space; a text of
fewer words is one run). BagMinHash draws, for every run and every weight level, the points of a
Poisson process over time, numbered to signature components at random; a component keeps the
earliest point below the run's weight. Two texts agree in a component with a probability equal to
their weighted Jaccard similarity.

Weight levels are the dyadic intervals [0,1), [1,2), [2,4), ...: a run that occurs w times has the
processes of the intervals below w. An interval's process has its width as rate; in the interval
that w cuts, a point carries a place and counts only if it lies below w. So a run costs log2(w)
processes, and equal runs of different weights see the same points. Times beyond the bound at
which all components are filled are never drawn.

Copies (equal word sequences) become one node before anything is compared. Nodes that agree in a
band of ROWS components meet in a bucket; 28 bands of 4 miss a pair of similarity 0.8 with a
probability of 4e-7. In a bucket nodes are not compared all with all. First every node is
verified against one leader, and joined to its component where the overlap reaches the threshold.
For buckets that still hold several components, the runs that no other node of theirs has are
counted: they bound every overlap a node can have, exactly. In the next rounds the node with the
least share of such runs leads, which in a group of altered copies is their original. After that
comes the exact rest: nodes of buckets that still hold several components are written as their
differences from a centre, and pairs whose shared differences can lift them to the threshold are
verified (``rest_pairs``). Components are the classes.

Defined results: texts that are null or have no word are alone in their class; repeated rows are
in one class; ties are no matter, a class is named after its smallest id. Null ids are ordinary
values, the smallest. Only id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.components import connected_components
from tidegate.llm.memory import tidy
from tidegate.llm.store import unused
from tidegate.llm.words import Words, mix, shingles, unit, words_of

THRESHOLD = 0.8
BANDS, ROWS = 28, 4
SIZE = BANDS * ROWS
ROUNDS = 2
BOUND = 5.0  # a text's components are all filled by its first bound with a probability of 1 - exp(-BOUND)

_LEVEL = np.uint64(0xD6E8FEB86659FD93)
_DRAW = np.uint64(0xA0761D6478BD642F)

SIGNATURES = "doc_id long, text_hash long, node binary, weight long, bands array<long>"


def multiset(hashes: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different runs of each text with their counts, in order of texts: (text, run, count)."""
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], hashes[at], np.diff(np.append(at, len(hashes)))


def bag_minhash(text: np.ndarray, run: np.ndarray, count: np.ndarray, n: int, size: int = SIZE, bound: float = BOUND) -> np.ndarray:
    """Earliest point times, n texts by ``size`` components; infinite for a text without runs."""
    times = np.full(n * size, np.inf)
    total = np.bincount(text, count, minlength=n)
    levels = 1 + np.ceil(np.log2(count)).astype(np.int64)
    which = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0).astype(np.float64)
    width = np.maximum(low, 1.0)
    seed = mix(run[which] + level.astype(np.uint64) * _LEVEL)
    owner, weight = text[which], count[which].astype(np.float64)
    with np.errstate(divide="ignore"):
        limits = size * (math.log(size) + bound) / total
    limit, at, draw = limits[owner], np.zeros(len(which)), 0
    while len(seed):
        draw += 1
        random = mix(seed + np.uint64(draw * int(_DRAW) % (1 << 64)))
        at = at - np.log(unit(random)) / width
        live = at <= limit
        if not live.all():
            seed, owner, weight, low, width, limit, at, random = (x[live] for x in (seed, owner, weight, low, width, limit, at, random))
        if not len(seed):
            break
        second = mix(random + _LEVEL)
        component = (second % np.uint64(size)).astype(np.int64)
        counts = low + unit(mix(second + _DRAW)) * width < weight
        np.minimum.at(times, (owner * size + component)[counts], at[counts])
    times = times.reshape(n, size)
    open_ = np.flatnonzero((total > 0) & np.isinf(times).any(axis=1))
    if len(open_):
        number = np.full(n, -1)
        number[open_] = np.arange(len(open_))
        own = number[text] >= 0
        times[open_] = bag_minhash(number[text[own]], run[own], count[own], len(open_), size, bound * 3)
    return times


def band_keys(times: np.ndarray) -> np.ndarray:
    """Signatures as one 64-bit number for each band of four components, 16 bits each."""
    short = (mix(times.view(np.uint64)) & np.uint64(0xFFFF)).astype("<u2")
    return np.ascontiguousarray(short).view("<i8")


def sequence_keys(words: Words) -> list[bytes | None]:
    """128 bits for each text's sequence of words; None for a text without words."""
    counts = words.counts
    begin = np.cumsum(counts) - counts
    place = (np.arange(len(words.hash)) - begin[words.text]).astype(np.uint64)
    full = np.flatnonzero(counts)
    out: list[bytes | None] = [None] * words.texts
    if len(full):
        halves = [
            mix(np.add.reduceat(mix(words.hash + (place + np.uint64(1)) * factor), begin[full]) + counts[full].astype(np.uint64))
            for factor in (_LEVEL, _DRAW)
        ]
        keys = np.stack(halves, axis=1).astype(">u8").tobytes()
        for i, t in enumerate(full):
            out[t] = keys[16 * i:16 * i + 16]
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, weight, bands) of every row; node and bands are null for a text without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text")):
                text, runs, count = multiset(*shingles(words))
                n = words.texts
                bands = band_keys(bag_minhash(text, runs, count, n))
                nodes = sequence_keys(words)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(bands.ravel(), pa.int64()), BANDS).cast(pa.list_(pa.int64()))
                full = pa.array([node is not None for node in nodes])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(words.first, n),
                    batch.column("text_hash").slice(words.first, n),
                    pa.array(nodes, pa.binary()),
                    pa.array(np.bincount(text, count, minlength=n).astype(np.int64)),
                    pa.compute.if_else(full, lists, pa.scalar(None, lists.type)),
                ], names=["doc_id", "text_hash", "node", "weight", "bands"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return source.mapInArrow(tidy(run), SIGNATURES)


def similarity(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Weighted Jaccard similarity of the run multisets of two columns of texts, row by row."""
    texts, runs, sides = [], [], []
    for side, column in enumerate((left, right)):
        for words in words_of(column):
            hashes, text = shingles(words)
            texts.append(text + words.first)
            runs.append(hashes)
            sides.append(np.full(len(text), side))
    text, run, side = (np.concatenate(x) for x in (texts, runs, sides))
    order = np.lexsort((run, text))
    text, run, side = text[order], run[order], side[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return np.zeros(len(left))
    two = np.add.reduceat(side, at)
    one = np.diff(np.append(at, len(run))) - two
    shared = np.bincount(text[at], np.minimum(one, two), minlength=len(left))
    union = np.bincount(text[at], np.maximum(one, two), minlength=len(left))
    with np.errstate(invalid="ignore"):
        return np.where(union > 0, shared / union, 0.0)


def verify(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs (u, v) of nodes whose texts' multiset overlap reaches the threshold."""
    sides = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("left")), "u")
    sides = sides.join(texts.select(F.col("node").alias("v"), F.col("text").alias("right")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                near = pa.array(similarity(part.column("left"), part.column("right")) >= threshold - 1e-12)
                yield part.select(["u", "v"]).filter(near)

    return sides.select("u", "v", "left", "right").mapInArrow(tidy(run), "u binary, v binary")


def _labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    known = labels.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return rows.join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _close(threshold: float) -> Column:
    """Whether the overlap can reach the threshold: runs a node has alone are in the union only."""
    most = F.least(F.col("weight") - F.col("alone"), F.col("other_weight") - F.col("other_alone"))
    return most * F.lit(1 + threshold) + F.lit(1e-9) >= F.lit(threshold) * (F.col("weight") + F.col("other_weight"))


def weights_alone(texts: DataFrame) -> DataFrame:
    """(id, alone): how many of a node's runs no other of these nodes has. ``id`` is a hash of the node; nodes with none are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for words in words_of(batch.column("text")):
                text, runs, count = multiset(*shingles(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs.view(np.int64)), pa.array(ids[text + words.first]), pa.array(count.astype(np.int64))], names=["run", "id", "times"]
                )

    rows = texts.select(F.xxhash64("node").alias("id"), "text").mapInArrow(tidy(run), "run long, id long, times long")
    # With one row to a run, its minimum is the row.
    single = rows.groupBy("run").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min("times").alias("times")).where("n = 1")
    return single.groupBy("id").agg(F.sum("times").alias("alone"))


def open_members(members: DataFrame, labels: DataFrame, texts: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Members of buckets that hold several components, with the weight they have alone among those."""
    placed = _labelled(members, labels)
    several = placed.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    rows = store(placed.join(several, "bucket", "left_semi").select("bucket", "node", "weight"), "open")
    nodes = rows.select("node").distinct()
    alone = weights_alone(texts.join(nodes, "node", "left_semi"))
    # Where two nodes should share an id, nothing is known of them.
    sole = nodes.groupBy(F.xxhash64("node").alias("id")).agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    found = sole.join(alone, "id").select("node", "alone")
    return store(rows.join(found, "node", "left").withColumn("alone", F.coalesce("alone", F.lit(0))), "open-alone")


def leader_pairs(members: DataFrame, turn: int, threshold: float, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Every member of a bucket beside one leader of another component: the one with the least share of runs alone, then by lot."""
    share = F.col("alone") / F.col("weight")
    lot = F.struct(share, F.xxhash64("node", F.lit(turn)), F.col("node").alias("n"), F.col("weight").alias("w"), F.col("alone").alias("x"), F.col("label").alias("l"))
    leaders = members.groupBy("bucket").agg(F.min(lot).alias("lead"), F.min("label").alias("a"), F.max("label").alias("b"))
    names = {"n": "other", "w": "other_weight", "x": "other_alone", "l": "other_label"}
    leaders = leaders.where("a <> b").select("bucket", *[F.col(f"lead.{k}").alias(v) for k, v in names.items()])
    return _pairs(members.join(store(leaders, f"leaders-{turn}"), "bucket"), threshold)


def _differences(run: np.ndarray, text: np.ndarray, side: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that the texts of side 0 have more often (extra) or less often (missing) than those of side 1: (text, run, difference)."""
    order = np.lexsort((run, text))
    run, text, side = run[order], text[order], side[order]
    new = np.ones(len(run), bool)
    new[1:] = (run[1:] != run[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    if not len(at):
        return text, run, side
    change = np.add.reduceat(1 - 2 * side, at)
    own = change != 0
    return text[at[own]], run[at[own]], change[own]


def differences(members: DataFrame, texts: DataFrame) -> DataFrame:
    """(family, node, label, weight, missing, extra, element, times) of nodes beside their family's centre.

    An element is a run with a sign: one that the node lacks (or has less often), or has beyond the
    centre; ``times`` is by how much. The arrays are no longer than both texts together.
    """
    sides = members.join(texts.select("node", F.col("text").alias("left")), "node")
    sides = sides.join(texts.select(F.col("node").alias("centre"), F.col("text").alias("right")), "centre")
    kept = ["family", "node", "label", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                n, found = part.num_rows, []
                for side, name in enumerate(("left", "right")):
                    for words in words_of(part.column(name)):
                        runs, text = shingles(words)
                        found.append((runs, text + words.first, np.full(len(runs), side)))
                text, runs, change = _differences(*(np.concatenate(x) for x in zip(*found, strict=True)), n)
                element = mix(runs + np.where(change > 0, _LEVEL, _DRAW)).view(np.int64)
                offsets = pa.array(np.append(0, np.cumsum(np.bincount(text, minlength=n))), pa.int32())
                lost, more = (np.bincount(text, np.maximum(sign * change, 0), minlength=n).astype(np.int64) for sign in (-1, 1))
                yield pa.RecordBatch.from_arrays([
                    *[part.column(name) for name in kept], pa.array(lost), pa.array(more),
                    pa.ListArray.from_arrays(offsets, pa.array(element)), pa.ListArray.from_arrays(offsets, pa.array(change.astype(np.int64))),
                ], names=[*kept, "missing", "extra", "element", "times"])

    schema = "family binary, node binary, label binary, weight long, missing long, extra long, element array<long>, times array<long>"
    return sides.select(*kept, "left", "right").mapInArrow(tidy(run), schema)


def rest_pairs(members: DataFrame, texts: DataFrame, threshold: float, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The pairs of different components that can still reach the threshold, and every node beside its centre.

    Buckets that share nodes are a family, with one centre C (the node with the least share of runs
    alone). Let u lack the runs M of C and have the runs D beyond it. Then

        |u and v| = |C| - |M_u| - |M_v| + |M_u and M_v| + |D_u and D_v|,

    so a pair reaches the threshold t exactly if its shared differences weigh r(u) + r(v) or more,
    with r(u) = t/(1+t) |u| + |M_u| - |C|/2. r is least for C itself, and r(u) + r(C) is above 0 for
    every u that is not linked to C: such a u has to share differences with its partner. Only
    differences that several components hold can be shared. Of these each node sends the first in
    a common order, what a node has beyond C before what it lacks, and rare before frequent, until
    what is left weighs less than its least possible partner asks for (prefix filter): pairs that
    reach the threshold meet there. Copies altered each in their own way share too little and meet nowhere.
    """
    several = members.groupBy("bucket").agg(F.min("label").alias("a"), F.max("label").alias("b"), F.min("node").alias("v")).where("a <> b")
    rows = store(members.join(store(several.select("bucket", "v"), "rest-buckets"), "bucket"), "rest-open")
    families = connected_components(rows.select(F.col("node").alias("u"), "v").distinct(), store, "rest-families")
    nodes = rows.select("node", "weight", "alone", "label").distinct().join(families.select(F.col("u").alias("node"), F.col("v").alias("family")), "node", "left")
    nodes = store(nodes.withColumn("family", F.coalesce("family", "node")), "rest-nodes")
    lot = F.struct(F.col("alone") / F.col("weight"), F.xxhash64("node"), "node", "label", "weight")
    centres = nodes.groupBy("family").agg(F.min(lot).alias("c"))
    centres = store(centres.select("family", F.col("c.node").alias("centre"), F.col("c.label").alias("centre_label"), F.col("c.weight").alias("size")), "rest-centres")

    found = store(differences(nodes.join(centres.select("family", "centre"), "family"), texts), "rest-differences")
    need = F.lit(threshold / (1 + threshold)) * F.col("weight") + F.col("missing") - F.col("size") / 2
    reaches = (F.col("size") - F.col("missing")) * F.lit(1.0) >= F.lit(threshold) * (F.col("size") + F.col("extra")) - F.lit(1e-9)
    placed = found.join(centres, "family").withColumn("need", need)
    placed = placed.withColumn("far", (F.col("label") != F.col("centre_label")) & ~reaches)
    to_centre = placed.where((F.col("label") != F.col("centre_label")) & reaches).select(F.greatest("node", "centre").alias("u"), F.least("node", "centre").alias("v"))

    # What the partner asks for at least: ``far_need`` if it is far from the centre, ``near_need`` if not.
    bounds = placed.groupBy("family").agg(F.min(F.when(F.col("far"), F.col("need"))).alias("far_need"), F.min(F.when(~F.col("far"), F.col("need"))).alias("near_need"))
    bounds = store(bounds.where("far_need IS NOT NULL"), "rest-bounds")
    live = placed.join(bounds, "family").select("family", "node", "label", "far", "need", "far_need", "near_need", "element", "times")
    each = F.explode(F.arrays_zip("element", "times")).alias("e")
    elements = store(
        live.select("family", "node", "label", "far", "need", "far_need", "near_need", each)
        .select("*", F.col("e.element").alias("x"), F.abs("e.times").alias("times"), (F.col("e.times") < 0).alias("lacks")).drop("e"), "rest-elements"
    )
    shared = elements.groupBy("family", "x").agg(F.count("*").alias("n"), F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b")
    ranked = elements.join(store(shared.select("family", "x", "n"), "rest-shared"), ["family", "x"])
    after = Window.partitionBy("node").orderBy(F.desc("lacks"), F.desc("n"), F.desc("x")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("node")
    ranked = ranked.withColumn("left", F.sum("times").over(after)).withColumn("all", F.sum("times").over(whole))

    def prefix(least: str) -> Column:
        return F.col("left") + F.lit(1e-6) >= F.col("need") + F.col(least)

    side = ranked.select("family", "x", "node", "label", "need", "all", "far", prefix("far_need").alias("to_far"), prefix("near_need").alias("to_near"))
    side = store(side.where("to_far OR (far AND to_near)"), "rest-prefixes")
    ones = side.where("far").withColumn("other_far", F.explode(F.expr("filter(array(if(to_far, true, null), if(to_near, false, null)), f -> f IS NOT NULL)")))
    ones = ones.select("family", "x", "other_far", "node", "label", "need", "all")
    twos = side.where("to_far").select(
        "family", "x", F.col("far").alias("other_far"), F.col("node").alias("other"), F.col("label").alias("other_label"),
        F.col("need").alias("other_need"), F.col("all").alias("other_all"),
    )
    enough = F.col("need") + F.col("other_need") <= F.least("all", "other_all") + F.lit(1e-6)
    once = ~F.col("other_far") | (F.col("node") < F.col("other"))
    met = ones.join(twos, ["family", "x", "other_far"]).where((F.col("label") != F.col("other_label")) & enough & once)
    met = met.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v"))
    return to_centre.unionByName(met).distinct()


def _pairs(joined: DataFrame, threshold: float) -> DataFrame:
    near = joined.where((F.col("label") != F.col("other_label")) & _close(threshold))
    return near.select(F.greatest("node", "other").alias("u"), F.least("node", "other").alias("v")).distinct()


def find_classes(
    docs: DataFrame,
    store: Callable[[DataFrame, str], DataFrame],
    threshold: float = THRESHOLD,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(doc_id, text_hash, class_id, first_hash, class_size) of every row.

    ``class_id`` is the smallest id of the class and ``first_hash`` tells the text it stands for.
    ``store(frame, name)`` writes a frame to the shared folder and reads it back.
    """
    signed = store(signatures(docs), "signatures")
    first = F.min(F.struct("doc_id", "text_hash", "weight", "bands")).alias("first")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(first)
    rows = nodes.select("node", F.col("first.weight").alias("weight"), F.posexplode("first.bands").alias("band", "key"))
    banded = rows.select("node", "weight", F.xxhash64("band", "key").alias("bucket"))
    # Tables with a row for each bucket or class are stored before they are joined, so that Spark can split a large one.
    shared = store(banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").drop("n"), "buckets")
    members = store(banded.join(shared, "bucket", "left_semi"), "members")

    # The texts of nodes that share a bucket; all verifying reads them from here.
    wanted = members.select("node").distinct().join(nodes.select("node", "first.doc_id", "first.text_hash"), "node")
    wanted = wanted.select("node", F.col("doc_id").alias("d"), F.col("text_hash").alias("h"))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h"))
    texts = store(source.join(wanted, same).select("node", "text").dropDuplicates(["node"]), "texts")

    labels, tested = None, None
    open_ = members.withColumn("alone", F.lit(0).cast("long"))
    for turn in range(rounds + 1):
        if turn == 1:
            open_ = open_members(members, labels, texts, store)
        placed = _labelled(open_, labels)
        pairs = leader_pairs(placed, turn, threshold, store) if turn < rounds else rest_pairs(placed, texts, threshold, store)
        if tested is not None:
            pairs = pairs.join(tested, ["u", "v"], "left_anti")
        pairs = store(pairs, f"pairs-{turn}")
        found = store(verify(pairs, texts, threshold), f"links-{turn}")
        tested = pairs if tested is None else tested.unionByName(pairs)
        # Earlier links are in the labels they made, which are already stars.
        labels = connected_components(found if labels is None else labels.unionByName(found), store, f"components-{turn}")
    return name_classes(signed, labels, store)


def name_classes(signed: DataFrame, labels: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Every row beside the smallest row of its class."""
    placed = _labelled(signed.select("doc_id", "text_hash", "node"), labels)
    classes = placed.where("label IS NOT NULL").groupBy("label").agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.count("*").alias("class_size")
    )
    named = placed.join(store(classes, "class-names"), "label", "left")
    alone = F.col("label").isNull()
    return named.select(
        "doc_id",
        "text_hash",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, F.col("text_hash")).otherwise(F.col("first.text_hash")).alias("first_hash"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"),
    )


def keep_one(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The first document of every class. Repeated rows of it are one document."""
    gone = classes.where(~(F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("first_hash"))))
    doc, text_hash = unused(docs, "gone_doc", "gone_hash")
    gone = gone.select(F.col("doc_id").alias(doc), F.col("text_hash").alias(text_hash)).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(gone[doc]) & (F.xxhash64(docs["text"]) == gone[text_hash])
    return docs.join(gone, same, "left_anti")
