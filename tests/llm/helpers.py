"""Small tables with the cases every operator has to take."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = ("node", "label", "hash", "pos", "rank", "doc", "group", "salt", "bucket", "block", "kind", "words", "tokens",
            "seeds", "found", "text_hash", "copied_doc", "copied_hash", "copied_lines", "gone_doc", "leak_doc", "n", "d2")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def prose(seed, n):
    """n invented words of a small vocabulary, in lines."""
    draw = random.Random(seed)
    syllables = ["ba", "ko", "ri", "tu", "me", "lo", "sa", "vi", "né", "da", "po", "xu"]
    out = []
    for i in range(n):
        out.append("".join(draw.choices(syllables, k=draw.randint(2, 4))))
        out.append("\n" if i % 12 == 11 else " ")
    return "".join(out).strip()


def edge_rows():
    """Nulls in every column, empty and blank texts, ties and repeated rows, a very long text."""
    base = prose(1, 60)
    return [
        (1, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, base, None, "a", None),
        (3, None, "en", None, None),
        (4, "", "en", "a", 0),
        (5, " \n\t\n ", "fr", "b", 5),
        (None, prose(2, 40), "fr", None, 7),
        (None, prose(2, 40), "fr", None, 7),
        (None, None, None, None, None),
        (6, prose(3, 40).upper(), "fr", "b", 7),
        (6, prose(4, 40), "fr", "b", 7),
        (7, "é", "fr", "b", 1),
        (8, prose(5, 30_000), "en", "a", 1),
        (9, "word " * 5000, "en", "a", 1),
        (10, "x" * 100_000, "en", "a", 1),
    ]


def edge_docs(spark):
    docs = spark.createDataFrame(edge_rows(), DOCUMENTS)
    return docs.select("*", *[F.lit("clash").alias(name) for name in CLASHING])


def empty_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)
