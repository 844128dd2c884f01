"""Repeated runs of lines by a suffix array over line ids, in DataFrame operations only.

Every line that occurs twice or more gets a line id; a line that occurs once separates nothing
from nothing, its suffix is settled at once. The suffixes left are sorted by prefix doubling: a
suffix's rank over 2k lines follows from its rank over k lines and the rank of the suffix k lines
on. Ranks come from sorting the *different* pairs, not the suffixes, so a line or passage that
makes up a third of the input is a single row there; it is counted map-side. A suffix that is
alone in its class has found its place and leaves the table. Doubling ends when all have left.

The classes over k lines are the intervals of the suffix array whose longest common prefix is at
least k: every member shares k lines with the others. From the interval of depth ``min_lines``
all members but the first, by document id and place, are later copies, and so are those of the
depth-1 intervals whose line has ``min_chars`` characters or more. Later copies overlap along a
longer repeated run, so what they cover together is the whole of every maximal run; the first
copy of each line stays.

Lines are compared without white space at their ends; blank lines are not counted and stay where
they are. A document left without a line that is not blank was a copy as a whole: ``kept`` is
false.

Defined results: null and empty texts have no lines, lose nothing and are kept; documents that
repeat (same id and text) are one document and share the outcome; of equal ids the text with the
smaller hash comes first; null ids come first of all. Other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.store import unused

MIN_LINES = 2
MIN_CHARS = 20
BLANKS = " \t\u000b\f\r"
PLACE = ("doc", "hash", "pos")


class SuffixLevels(NamedTuple):
    """``ranks[j]``: (doc, hash, pos, rank) of suffixes whose first 2^j lines repeat; the last is not empty unless it is the first."""

    lines: DataFrame  # (doc, hash, pos, line_no, chars, rank) of repeated lines
    ranks: list[DataFrame]


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS))


def line_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, hash, pos, line_no, chars, h1, h2) of every line that is not blank; h1, h2 are 128 bits of the line."""
    numbered = F.transform(split_lines(docs[text_col]), lambda line, i: F.struct(i.alias("no"), _trimmed(line).alias("line")))
    full = F.filter(numbered, lambda x: x["line"] != "")
    rows = docs.select(docs[id_col].alias("doc"), F.xxhash64(docs[text_col]).alias("hash"), F.posexplode(full).alias("pos", "item"))
    return rows.select(
        *PLACE,
        F.col("item.no").alias("line_no"),
        F.length("item.line").alias("chars"),
        F.xxhash64("item.line").alias("h1"),
        F.xxhash64(F.lit(1), "item.line").alias("h2"),
    )


def _ordered_ids(keys: DataFrame, *order: str) -> DataFrame:
    """The rows with ``rank``: numbers that ascend in the given order, over all partitions."""
    return keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rank", F.monotonically_increasing_id())


def repeated_lines(docs: DataFrame, store: Callable[[DataFrame, str], DataFrame], id_col: str, text_col: str) -> DataFrame:
    """Places of the lines that occur more than once, with their line ids as ``rank``."""
    lines = store(line_rows(docs, id_col, text_col), "lines")
    often = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    ids = store(_ordered_ids(often, "h1", "h2"), "line-ids")
    found = lines.join(ids, ["h1", "h2"]).select(*PLACE, "line_no", "chars", "rank")
    return store(found.dropDuplicates(list(PLACE)), "repeated-lines")


def _same_place(left: DataFrame, right: DataFrame, ahead: int) -> Column:
    here = left["doc"].eqNullSafe(right["doc_2"]) & (left["hash"] == right["hash_2"])
    return here & (left["pos"] + F.lit(ahead) == right["pos_2"])


def _ahead(ranks: DataFrame, by: int) -> DataFrame:
    """Each place with its own rank (r1) and that of the place ``by`` lines on (r2), where both are ranked."""
    other = ranks.select(*[F.col(c).alias(f"{c}_2") for c in PLACE], F.col("rank").alias("r2"))
    return ranks.join(other, _same_place(ranks, other, by)).select(*PLACE, F.col("rank").alias("r1"), "r2")


def sort_suffixes(docs: DataFrame, store: Callable[[DataFrame, str], DataFrame], id_col: str = "doc_id", text_col: str = "text") -> SuffixLevels:
    """Rank the suffixes of all documents' line sequences by prefix doubling."""
    lines = repeated_lines(docs, store, id_col, text_col)
    ranks = [lines.select(*PLACE, "rank")]
    while True:
        level = len(ranks)
        pairs = store(_ahead(ranks[-1], 1 << (level - 1)), f"pairs-{level}")
        again = pairs.groupBy("r1", "r2").agg(F.count("*").alias("n")).where("n > 1").select("r1", "r2")
        classes = store(_ordered_ids(again, "r1", "r2"), f"classes-{level}")
        if classes.isEmpty():
            return SuffixLevels(lines, ranks)
        ranks.append(store(pairs.join(classes, ["r1", "r2"]).select(*PLACE, "rank"), f"ranks-{level}"))


def later_copies(ranked: DataFrame, store: Callable[[DataFrame, str], DataFrame], name: str, *keys: str) -> DataFrame:
    """Places that share their class (the columns ``keys``) with an earlier place.

    The first places, a row for each class, are stored before they are joined: the join then reads
    plain rows on both sides, and Spark can split a class that holds a large part of them.
    """
    first = store(ranked.groupBy(*keys).agg(F.min(F.struct(*PLACE)).alias("first")), f"first-{name}")
    return ranked.join(first, list(keys)).where(~F.struct(*PLACE).eqNullSafe(F.col("first"))).select(*PLACE)


def copied_places(
    levels: SuffixLevels, store: Callable[[DataFrame, str], DataFrame], min_lines: int = MIN_LINES, min_chars: int = MIN_CHARS
) -> DataFrame:
    """(doc, hash, pos) of every line in a later copy: runs of min_lines lines, and single lines of min_chars characters."""
    if min_lines < 2:
        return later_copies(levels.lines, store, "line", "rank")
    single = later_copies(levels.lines.where(F.col("chars") >= min_chars), store, "line", "rank")
    top = min_lines.bit_length() - 1
    if top >= len(levels.ranks):
        return single
    ranks, rest = levels.ranks[top], min_lines - (1 << top)
    # Two windows of 2^top lines that overlap make up a depth between the doublings.
    runs = later_copies(_ahead(ranks, rest), store, "run", "r1", "r2") if rest else later_copies(ranks, store, "run", "rank")
    covered = runs.select("doc", "hash", F.explode(F.sequence(F.col("pos"), F.col("pos") + F.lit(min_lines - 1))).alias("pos"))
    return single.unionByName(covered).distinct()


def dedup_lines(
    docs: DataFrame,
    store: Callable[[DataFrame, str], DataFrame],
    min_lines: int = MIN_LINES,
    min_chars: int = MIN_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
    reports: tuple[str, str, str] = ("n_lines", "n_deleted", "kept"),
) -> DataFrame:
    """The rows with their text less later copies, and three reports: lines, deleted lines, whether the document is kept.

    Columns that have the name of a report are replaced.

    ``store(frame, name)`` writes a frame to the shared folder and reads it back.
    """
    levels = sort_suffixes(docs.select(id_col, text_col), store, id_col, text_col)
    places = copied_places(levels, store, min_lines, min_chars).select(*[F.col(c).alias(f"_{c}") for c in PLACE])
    same = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("hash") == F.col("_hash")) & (F.col("pos") == F.col("_pos"))
    gone = levels.lines.join(places, same, "left_semi").groupBy("doc", "hash").agg(F.array_sort(F.collect_list("line_no")).alias("_gone"))
    docs = docs.drop(*reports)
    n_lines, n_deleted, kept = reports
    doc, text_hash, lost = unused(docs, "copied_doc", "copied_hash", "copied_lines")
    gone = gone.select(F.col("doc").alias(doc), F.col("hash").alias(text_hash), F.col("_gone").alias(lost))
    here = docs[id_col].eqNullSafe(gone[doc]) & (F.xxhash64(docs[text_col]) == gone[text_hash])
    joined = docs.join(gone, here, "left")
    lines = split_lines(F.col(text_col))
    hit = F.col(lost).isNotNull()
    full = F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.size(F.filter(lines, lambda x: _trimmed(x) != "")))
    counted = joined.withColumns({
        n_lines: full.cast("long"),
        n_deleted: F.when(hit, F.size(lost)).otherwise(F.lit(0)).cast("long"),
    })
    left = (F.col(n_deleted) == 0) | (F.col(n_deleted) < F.col(n_lines))
    text = F.when(hit, F.array_join(without(lines, F.col(lost)), "\n")).otherwise(F.col(text_col))
    return counted.withColumns({kept: left, text_col: text}).select(*docs.columns, *reports)


def without(values: Column, gone: Column) -> Column:
    """An array less the places listed in ascending order: the stretches between them, strung together."""
    def stretch(i: Column) -> Column:
        begin = F.coalesce(F.get(gone, i - 1), F.lit(-1)) + 1
        end = F.coalesce(F.get(gone, i), F.size(values))
        return F.slice(values, begin + 1, F.greatest(end - begin, F.lit(0)))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), stretch))
