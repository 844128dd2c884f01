"""Chat formatting of typed content parts, with a loss mask, and reading it back.

A turn is a list of parts (text, image, audio, document). A visitor flattens them in order:
text stays text, any other part becomes a placeholder, and its reference and the number of
tokens it will expand to are recorded. The template marks turns:

    ### <role>: <content> </turn>\\n

Inside roles (there also ``:``) and texts the characters ``\\``, ``#``, ``<`` and ``[`` get a ``\\`` in front, so no
text can hold a marker or a placeholder, and taking the ``\\`` out gives the text back. The loss
mask covers the text parts of assistant turns.

Defined results: a null text is an empty one; a null role is written as the role ``""`` and a
null turn comes first; turns of one number stand in order of role and text, repeated rows are
repeated turns; a conversation without id is one conversation. A conversation is one row of the
output and has to fit in a task; conversations are never joined with each other.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("ref", T.StringType()),
    T.StructField("width", T.LongType()),
    T.StructField("height", T.LongType()),
    T.StructField("seconds", T.DoubleType()),
    T.StructField("pages", T.LongType()),
])
ATTACHMENT = T.StructType([
    T.StructField("turn", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("ref", T.StringType()),
    T.StructField("tokens", T.LongType()),
    T.StructField("at", T.LongType()),
])
SPAN = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])

IMAGE_TILE = 28
AUDIO_TOKENS_A_SECOND = 25
PAGE_TOKENS = 600

_ESCAPED = re.compile(r"[\\#<\[]")
_ESCAPED_ROLE = re.compile(r"[\\#<\[:]")
_QUOTED = r"\\\g<0>"
_UNESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:\\.|[^\\#<:])*): ((?:\\.|[^\\#<])*) </turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return _ESCAPED.sub(_QUOTED, text)


def unescape(text: str) -> str:
    return _UNESCAPED.sub(r"\1", text)


@dataclass
class Flattener:
    """Visitor of content parts: appends to ``content`` and keeps what the parts stand for."""

    content: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)
    masked: bool = False
    turn: int = 0

    def put(self, text: str) -> None:
        self.content.append(text)
        self.length += len(text)

    def visit(self, number: int, part: dict) -> None:
        kind = part["kind"] or "text"
        method = getattr(self, f"visit_{kind}", None)
        if method is None:
            raise ValueError(f"unknown kind of content part: {kind}")
        method(number, part)

    def visit_text(self, _: int, part: dict) -> None:
        text = escape(part["text"] or "")
        if self.masked and text:
            self.spans.append((self.length, self.length + len(text)))
        self.put(text)

    def visit_image(self, number: int, part: dict) -> None:
        tiles = [max(1, -(-(part[side] or IMAGE_TILE) // IMAGE_TILE)) for side in ("width", "height")]
        self.attach("image", number, part, tiles[0] * tiles[1])

    def visit_audio(self, number: int, part: dict) -> None:
        self.attach("audio", number, part, max(1, round((part["seconds"] or 0) * AUDIO_TOKENS_A_SECOND)))

    def visit_document(self, number: int, part: dict) -> None:
        self.attach("document", number, part, max(1, part["pages"] or 1) * PAGE_TOKENS)

    def attach(self, kind: str, number: int, part: dict, tokens: int) -> None:
        self.attachments.append({
            "turn": self.turn, "part": number, "kind": kind, "ref": part["ref"], "tokens": tokens, "at": self.length,
        })
        self.put(f"[{kind} {len(self.attachments) - 1}]")


def format_turns(turns: list[dict]) -> dict:
    """Text, loss spans and attachments of one conversation; turns have ``role`` and ``parts``."""
    out = Flattener()
    for number, turn in enumerate(turns):
        role = turn["role"] or ""
        out.turn, out.masked = number, role == "assistant"
        out.put(f"### {_ESCAPED_ROLE.sub(_QUOTED, role)}: ")
        for place, part in enumerate(turn["parts"] or []):
            out.visit(place, part)
        out.put(" </turn>\n")
    return {
        "formatted": "".join(out.content),
        "loss_spans": [{"begin": a, "end": b} for a, b in out.spans],
        "attachments": out.attachments,
        "n_turns": len(turns),
        "expanded_tokens": sum(a["tokens"] for a in out.attachments),
    }


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn; placeholders stay in the text. Raises if the text is not of the template."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def text_part(text: Column) -> Column:
    """An array with one text part, for conversations whose turns are plain texts."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in PART.fields[2:]]
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), *nulls).cast(PART))


def format_chat(turns: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, parts) to a row for each conversation."""
    chats = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "parts"))).alias("turns"))
    schema = T.StructType([
        turns.schema["conv_id"],
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_spans", T.ArrayType(SPAN)),
        T.StructField("attachments", T.ArrayType(ATTACHMENT)),
        T.StructField("n_turns", T.LongType()),
        T.StructField("expanded_tokens", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                rows = [format_turns(turns) for turns in part.column("turns").to_pylist()]
                columns = {name: [row[name] for row in rows] for name in schema.names[1:]}
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), *(pa.array(columns[name], _ARROW[name]) for name in schema.names[1:])],
                    names=schema.names,
                )

    return chats.mapInArrow(run, schema)


_ARROW = {
    "formatted": pa.string(),
    "loss_spans": pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])),
    "attachments": pa.list_(pa.struct([
        ("turn", pa.int64()), ("part", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64()), ("at", pa.int64()),
    ])),
    "n_turns": pa.int64(),
    "expanded_tokens": pa.int64(),
}


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted texts hold: turns, and the unescaped text under the loss mask."""
    schema = T.StructType([
        formatted.schema["conv_id"],
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("loss_spans").to_pylist(), strict=True):
                turns = parse_turns(text)
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                loss = "".join(unescape(text[s["begin"]:s["end"]]) for s in spans)
                rows.append((len(turns), _sha(whole), len(loss), _sha(loss), len(text)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))], names=schema.names
            )

    return formatted.select("conv_id", "formatted", "loss_spans").mapInArrow(run, schema)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
