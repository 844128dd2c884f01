"""Token alignment against a brute-force version."""

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import edge_docs, edge_rows, empty_docs
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidegate.llm import alignment, queries
from tidegate.llm.store import storage
from tidegate.llm.token_files import byte_alphabet

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Tokens:
    def __init__(self):
        self.a, self.b = Tokenizer.from_file(FILES[0]), SentencePieceProcessor(model_file=FILES[1])
        self.a.encode_special_tokens = True
        self.byte_of = {c: b for b, c in byte_alphabet().items()}

    def of_a(self, i):
        return bytes(self.byte_of[c] for c in self.a.id_to_token(i))

    def of_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def both(self, text):
        """[(id, end)] of A and of B."""
        full = (" " + (text or "")).encode()
        out = []
        for ids, read in ((self.a.encode(" " + (text or ""), add_special_tokens=False).ids, self.of_a), (self.b.encode(text or ""), self.of_b)):
            parts = [read(i) for i in ids]
            if not text or b"".join(parts) != full:
                return [], []
            ends = np.cumsum([len(p) for p in parts]).tolist()
            out.append(list(zip(ids, ends, strict=True)))
        return out


@pytest.fixture(scope="module")
def tokens():
    return Tokens()


def brute_force(tokens, docs):
    """Sorted (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups), with sets of ends."""
    held, counts = [], Counter()
    for doc_id, text in docs:
        a, b = tokens.both(text)
        end_of_b = {end: i for i, end in b}
        common = sorted({end for _, end in a} & set(end_of_b))
        links = [(i, end_of_b[end]) for i, end in a if end in end_of_b]
        counts.update(links)
        lists = []
        for side in (a, b):
            own = defaultdict(list)
            for i, end in side:
                own[bisect_left(common, end)].append(str(i))
            lists.append(own)
        groups = [",".join(lists[0][g]) + "|" + ",".join(lists[1][g]) for g in range(len(common))]
        held.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return sorted(((doc_id, a, b, n, len(links), sum(counts[x] == highest[x[1]] for x in links), sum(counts[x] for x in links), groups)
                   for doc_id, a, b, n, links, groups in held), key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in alignment.align(df, *FILES, storage(df, "align"), **options).collect()), key=repr)


TEXTS = [
    "Plain words, twice: plain words.", "", None, " ", "  leading  and   doubled ", "tab\tnew\nline\r\n", "é ü ñ 漢字 и 😀👍🏽", "holds ▁ itself",
    "<|endoftext|> and <s> </s> <unk> <0x0A>", "\x00\x01", "aaaaaaaaaaaaaaaaaaaaaaaaa", "x", "don't we'll I'M", "1234567 8.9", "﻿mark", "é" * 3000,
]


def test_texts_of_all_kinds(spark, tokens):
    docs = [(i, text) for i, text in enumerate(TEXTS)] + [(i, text) for i, text in enumerate(TEXTS)] + [(None, TEXTS[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute_force(tokens, docs)
    for options in ({}, {"block_links": 1}):
        assert found(df.repartition(3), **options) == want
    assert [r[1:5] for r in want if r[0] in (1, 2, 7)] == [(0, 0, 0, 0)] * 6


def test_edge_rows_with_clashing_columns(spark, tokens):
    assert found(edge_docs(spark)) == brute_force(tokens, [row[:2] for row in edge_rows()])


def test_empty_table(spark):
    assert found(empty_docs(spark)) == []


def test_a_pair_that_most_links_hold_is_counted_over_all_blocks(spark, tokens):
    docs = [(i, "the same line again" if i % 3 else f"line {i} of its own") for i in range(300)]
    assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), block_links=40) == brute_force(tokens, docs)


ends = st.lists(st.integers(1, 5), max_size=60).map(lambda steps: np.cumsum([0, *steps])[1:])


@settings(max_examples=500, deadline=None)
@given(ends, ends, st.integers(1, 9))
def test_pieces_find_every_common_end(a, b, step):
    at_a, at_b = alignment.common_ends(a, b, step)
    assert a[at_a].tolist() == b[at_b].tolist() == sorted({*a.tolist()} & {*b.tolist()})


@settings(max_examples=200, deadline=None)
@given(ends, ends, st.integers(1, 9))
def test_pieces_have_equal_work(a, b, step):
    i = alignment.crossings(a, b, step)
    diagonals = [*range(0, len(a) + len(b), step), len(a) + len(b)]
    merged = sorted([(x, 0) for x in a.tolist()] + [(x, 1) for x in b.tolist()])
    assert i.tolist() == [sum(side == 0 for _, side in merged[:d]) for d in diagonals]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6), st.integers(1, 50))
def test_groups_of_random_texts(texts, step):
    tokens = _tokens()
    texts = [text.encode("utf-8", "ignore").decode() for text in texts]
    own = alignment.Aligned(alignment.pair(*FILES), texts, step)
    want = {row[0]: row for row in brute_force(tokens, enumerate(texts))}
    assert [own.groups[k] for k in range(len(texts))] == [want[k][7] for k in range(len(texts))]
    assert own.n_groups.tolist() == [want[k][3] for k in range(len(texts))]


def _tokens(cache=[]):  # noqa: B006
    cache or cache.append(Tokens())
    return cache[0]


def test_query_on_whole_table(spark, tokens):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = [(*row[:-1], hashlib.sha256(row[-1].encode()).hexdigest() if row[-1] else "") for row in brute_force(tokens, docs)]
    assert sorted((tuple(r) for r in queries.op11_alignment(spark, folder).collect()), key=repr) == sorted(want, key=repr)
