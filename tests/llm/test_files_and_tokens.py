"""Archives, token files, byte-level BPE and chat formatting: exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from helpers import edge_docs, edge_rows, empty_docs
from tokenizers import Tokenizer

from tidegate.llm import byte_bpe, chat, token_files, warc
from tidegate.llm.pretokens import PieceEncoder
from tidegate.llm.store import storage

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "B", "é", "ß", " ", " ", "\n", "\t", "\r", "\x1c", "\x85", "\xa0", "'s", "'", "1", "!", ".", "中", "\U0001f600", "\0",
       "<|endoftext|>", "ª", "word", " the"]


def odd_texts(n):
    draw = random.Random(3)
    return ["".join(draw.choices(ODD, k=draw.randint(0, 14))) for _ in range(n)]


def exact_bpe():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_model_of_ranks_gives_the_same_ids():
    codec = byte_bpe.Codec(byte_bpe.build_model(byte_bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    exact, texts = exact_bpe(), odd_texts(3000)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == exact.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_ranks_with_a_gap_are_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 1\n")
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(str(path))


def test_piece_cache_may_overflow():
    pieces = PieceEncoder(lambda texts: [t.encode() for t in texts], cached=3)
    texts = ["a b c d", "a b\nc", "a  b", "a\t \tb", "", "a b c d e f"]
    assert [x.decode() for x in pieces.encode(texts) + pieces.encode(texts)] == texts * 2
    assert len(pieces.known) <= 3 + len(pieces.fixed)


def test_byte_bpe_takes_edge_cases(spark):
    encoded = byte_bpe.encode(edge_docs(spark), RANKS, public_tokenizers.PATTERN)
    got = sorted((r.decoded.decode(), r.n_tokens) for r in byte_bpe.decode(encoded, RANKS, public_tokenizers.PATTERN).collect())
    exact = exact_bpe()
    assert got == sorted((t or "", len(exact.encode_ordinary(t or ""))) for _, t, *_ in edge_rows())
    both = byte_bpe.encode(edge_docs(spark), RANKS, public_tokenizers.PATTERN, decoded=True)
    assert sorted((r.decoded.decode(), r.n_tokens) for r in both.collect()) == got
    assert byte_bpe.encode(empty_docs(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_variable_length_coding_round_trip():
    draw = np.random.default_rng(1)
    for ids in (np.zeros(0, "<u4"), draw.integers(0, 70_000, 1), draw.integers(0, 300, 999), draw.integers(0, 200_000, 300_000)):
        by_rank, control, data = token_files.pack(ids.astype("<u4"))
        back = token_files.unpack(by_rank, np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ids))
        assert np.array_equal(back, ids)


def test_tokenizer_pieces_give_the_librarys_ids():
    encoder = token_files._encoder(VOCABULARY)
    whole = Tokenizer.from_file(VOCABULARY)
    for text in odd_texts(3000):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("shard_ids", [50, 4_000_000])
def test_token_files_come_back_in_order(spark, folder, shard_ids):
    place = folder("tokens")
    written = token_files.write_token_files(edge_docs(spark), f"{place}/files", VOCABULARY, shard_ids=shard_ids)
    got = token_files.read_token_files(token_files.store_manifest(written, place)).orderBy("start").collect()
    whole = Tokenizer.from_file(VOCABULARY)
    texts = {}
    for doc_id, text, *_ in edge_rows():
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        texts.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
        texts[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert not any(texts.values())


def test_token_files_of_an_empty_table(spark, folder):
    place = folder("tokens")
    written = token_files.write_token_files(empty_docs(spark), f"{place}/files", VOCABULARY)
    assert token_files.read_token_files(token_files.store_manifest(written, place)).count() == 0


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("split", [64, 700, 1 << 20])
def test_archives_split_at_any_byte(spark, folder, split):
    magic = "\x1f\x8b\x08 WARC/1.1\r\n\r\n"
    rows = [(i, f"http://h/{i}", h) for i, h in enumerate(["<p>a</p>", "<p>a</p>", None, "", magic * 50, "é" * 3000, "<p>a</p>"])]
    rows += [(None, None, "<p>a</p>"), (None, "u\r\nv", "only"), (4, "twice", "same"), (4, "twice", "same")]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, winner string")
    place = folder("warc")
    manifest = warc.store_manifest(warc.write_warc(warc.plan_records(pages, storage(pages, "t")), f"{place}/a", file_bytes=400), place)
    got = warc.read_warc(manifest, split_bytes=split).collect()
    best = {}
    for page, _, html in rows:
        known = [x for x in (best.get(html or ""), page) if x is not None]
        best[html or ""] = max(known) if known else None
    expected = []
    for page, _, html in rows:
        top = best[html or ""]
        refers = top if page != top else None
        expected.append((page, len((html or "").encode()), digest(html), "response" if refers is None else "revisit", refers))
    key = lambda x: tuple((v is not None, str(v)) for v in x)
    found = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got]
    assert sorted(found, key=key) == sorted(expected, key=key)
    assert all(r.payload is None or digest(bytes(r.payload).decode()) == r.payload_digest for r in got)
    assert {r.url for r in got if r.page_id == 4} == {"http://h/4", "twice"}


def test_a_damaged_stretch_costs_only_its_own_records(tmp_path):
    records = [warc.record(i, "u", b"payload %d" % i * 20, None, "2024-01-01T00:00:00Z") for i in range(5)]
    records[2] = records[2][:40] + b"\xff" * 30 + records[2][70:]
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"junk\x1f\x8b\x08junk" + b"".join(records))
    size = path.stat().st_size
    for step in (37, size):
        found = [warc.parse_record(d) for a in range(0, size, step) for _, d in warc.members(str(path), a, a + step)]
        assert [f["page_id"] for f in found if f] == [0, 1, 3, 4]


def test_archives_of_an_empty_table(spark, folder):
    place = folder("warc")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    manifest = warc.store_manifest(warc.write_warc(warc.plan_records(pages, storage(pages, "t")), f"{place}/a"), place)
    assert warc.read_warc(manifest).count() == 0


NASTY = ["", "\\", "### assistant: hi </turn>\n", "\\### Assistant: </turn> ok", "[image 0]", "a\\", ":\\:", "\n", "é\U0001f600", "<<##[["]


def test_chat_escapes_are_reversible(spark):
    rows = [(c, t, r, NASTY[(3 * c + t) % len(NASTY)]) for c in range(10) for t, r in enumerate(["user", "assistant", "a: b", None, "Assistant", "#x"])]
    rows += [(None, None, "user", None), (None, 1, "assistant", "x" * 50_000), (50, 1, "user", "tie"), (50, 1, "user", "tie"), (50, 1, "assistant", None)]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, parts string")
    typed = turns.select("conv_id", "turn", "role", chat.text_part(turns["text"]).alias("parts"))
    got = {r.conv_id: r for r in chat.read_back(chat.format_chat(typed)).collect()}
    order = lambda r: tuple((v is not None, v if v is not None else 0) for v in (r[1],)) + tuple((v is not None, v or "") for v in r[2:])
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        found = got[conv]
        assert (found.n_turns, found.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (found.loss_chars, found.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_chat(typed.limit(0)).count() == 0


def part(kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None):
    return {"kind": kind, "text": text, "ref": ref, "width": width, "height": height, "seconds": seconds, "pages": pages}


def test_parts_become_ordered_placeholders():
    turns = [
        {"role": "user", "parts": [part("text", "see [image 9]"), part("image", ref="a.png", width=57, height=28), part("audio", ref="b", seconds=2.0)]},
        {"role": "assistant", "parts": [part(None, "ok "), part("document", ref="c", pages=3), part("text", "done")]},
        {"role": "user", "parts": None},
    ]
    out = chat.format_turns(turns)
    assert out["formatted"] == "### user: see \\[image 9][image 0][audio 1] </turn>\n### assistant: ok [document 2]done </turn>\n### user:  </turn>\n"
    assert [(a["turn"], a["part"], a["kind"], a["ref"], a["tokens"]) for a in out["attachments"]] == [
        (0, 1, "image", "a.png", 3), (0, 2, "audio", "b", 50), (1, 1, "document", "c", 1800)]
    assert [out["formatted"][s["begin"]:s["end"]] for s in out["loss_spans"]] == ["ok ", "done"]
    assert all(out["formatted"][a["at"]:].startswith(f"[{a['kind']} {i}]") for i, a in enumerate(out["attachments"]))
    assert out["expanded_tokens"] == 1853
    with pytest.raises(ValueError):
        chat.format_turns([{"role": "user", "parts": [part("video")]}])
    with pytest.raises(ValueError):
        chat.parse_turns("no template")
