"""Line runs, near-duplicates and benchmark leaks against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import CLASHING, edge_docs, edge_rows, empty_docs, lower, prose, words

from tidegate.llm import decontaminate, line_dedup, near_dups
from tidegate.llm.components import _small_stars, _stars, connected_components
from tidegate.llm.store import storage


def brute_lines(rows, min_lines, min_chars):
    """Text of each document without later copies, in order of ids."""
    places = []
    for doc, text in sorted(rows):
        full = [(i, x.strip(" \t\v\f\r")) for i, x in enumerate(text.split("\n")) if x.strip(" \t\v\f\r")]
        places += [(doc, [x for _, x in full], k, i) for k, (i, _) in enumerate(full)]
    seen, gone = set(), defaultdict(set)
    lines_of = {doc: [i for d, _, _, i in places if d == doc] for doc, _ in rows}
    for doc, full, k, _ in places:
        for n in sorted({1, min_lines}):
            run = tuple(full[k:k + n])
            if len(run) < n or (n == 1 and min_lines > 1 and len(run[0]) < min_chars):
                continue
            if (n, run) in seen:
                gone[doc].update(lines_of[doc][k:k + n])
            seen.add((n, run))
    return {doc: "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[doc]) for doc, text in rows}


@pytest.mark.parametrize("min_lines", [1, 2, 3, 5])
def test_line_runs_equal_brute_force(spark, min_lines):
    draw = random.Random(min_lines)
    pool = ["a", "b", "", "  c\t", "c", "a line of more than twenty characters", "d"]
    rows = [(i, "\n".join(draw.choices(pool, k=draw.randint(1, 25)))) for i in range(25)]
    rows += [(100 + i, rows[3][1]) for i in range(6)] + [(200, "a\n" * 70), (201, "a\n" * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs, storage(docs, "t"), min_lines=min_lines).collect()}
    expected = brute_lines(rows, min_lines, line_dedup.MIN_CHARS)
    assert {d: r.text for d, r in got.items()} == expected
    assert not got[100].kept and got[0].kept


def test_line_runs_take_edge_cases(spark):
    docs = edge_docs(spark)
    found = line_dedup.dedup_lines(docs, storage(docs, "t"))
    assert found.columns == [*docs.columns, "n_lines", "n_deleted", "kept"]
    got = found.collect()
    assert len(got) == len(edge_rows())
    by_id = defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    base = prose(1, 60)
    assert [r.text for r in by_id[1]] == [base, base]  # repeated rows are one document
    assert by_id[2][0].text == "" and not by_id[2][0].kept
    assert [(r.text, r.kept) for r in by_id[3] + by_id[4] + by_id[5]] == [(None, True), ("", True), (" \n\t\n ", True)]
    assert all(r.kept for r in by_id[None] + by_id[6])
    empty = empty_docs(spark)
    assert line_dedup.dedup_lines(empty, storage(empty, "t")).count() == 0


def test_ranks_follow_the_order_of_suffixes(spark):
    rows = [(0, "b\na\nb\na\nc\nb\na"), (1, "a\nb\na\nb\nz\nc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    levels = line_dedup.sort_suffixes(docs, storage(docs, "t"))
    ids = {(r.doc, r.pos): r.rank for r in levels.ranks[0].collect()}
    sequences = {d: [ids.get((d, k)) for k in range(len(t.split("\n")))] for d, t in rows}
    assert len(levels.ranks) == 2
    for level, ranks in enumerate(levels.ranks):
        got = {(r.doc, r.pos): r.rank for r in ranks.collect()}
        prefix = {p: tuple(sequences[p[0]][p[1]:p[1] + 2**level]) for p in got}
        places = sorted(got)
        for a in places:
            for b in places:
                assert (got[a] < got[b]) == (prefix[a] < prefix[b])


def bag(text):
    w = words(lower(text or ""))
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_classes(rows):
    bags = [(d, bag(t)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(bags):
        for b, y in bags[:i]:
            union = sum((x | y).values())
            if union and sum((x & y).values()) >= 0.8 * union:
                p, q = sorted((top(a), top(b)))
                parent[q] = p
    return {d: top(d) for d, _ in rows}


def mutated(text, seed, n):
    draw, w = random.Random(seed), text.split(" ")
    for _ in range(n):
        w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
    return " ".join(w)


def test_near_duplicates_equal_brute_force(spark):
    rows = []
    for g in range(8):
        base = prose(g, 40 + 40 * g)
        rows += [(100 * g + i, mutated(base, 31 * g + i, i // 4)) for i in range(20)]
    rows += [(1000 + i, "a b c d e f g h " * (20 + i)) for i in range(6)]  # weights decide
    rows += [(2000, "one two"), (2001, "One two"), (2002, "one two three"), (2003, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for rounds in (0, 2):  # the exact rest alone, and behind rounds of leaders
        found = near_dups.find_classes(docs, storage(docs, "t"), rounds=rounds).collect()
        assert {r.doc_id: r.class_id for r in found} == brute_classes(rows)
        sizes = Counter(r.class_id for r in found)
        assert all(r.class_size == sizes[r.class_id] for r in found)


def test_shared_differences_link_what_the_centre_does_not(spark):
    """Copies that are far from the original but near each other: the same words changed, added or left out, some more often."""
    rows, w = [], prose(77, 90).split()
    for g in range(6):
        draw = random.Random(g)
        variant = list(w)
        for k in draw.sample(range(90), 3):
            variant[k] = f"v{g}x{k}"
        if g % 2:
            del variant[10 * g:10 * g + 14]
        for i in range(5):
            rows.append((100 * g + i, mutated(" ".join(variant), 17 * g + i, i // 2)))
    rows += [(900 + i, " ".join([*w, *(["and so on it goes"] * (6 + i))])) for i in range(4)] + [(990, " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_classes(rows)
    assert 3 < len(set(expected.values())) < len(rows)
    got = near_dups.find_classes(docs, storage(docs, "t"), rounds=0).collect()
    assert {r.doc_id: r.class_id for r in got} == expected


def test_copies_altered_each_in_its_own_way_meet_nowhere(spark):
    base, counted = prose(78, 110), {}
    rows = [(0, base)] + [(1 + i, mutated(base, i, 3)) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    store = storage(docs, "t")

    def counting(frame, name):
        out = store(frame, name)
        counted[name] = out.count()
        return out

    got = near_dups.find_classes(docs, counting, rounds=1).collect()
    assert {r.doc_id: r.class_id for r in got} == brute_classes(rows)
    assert counted["rest-nodes"] > 50 and counted["pairs-1"] <= 2 * len(rows)


def test_near_duplicates_take_edge_cases(spark):
    docs = edge_docs(spark)
    store = storage(docs, "t")
    classes = store(near_dups.find_classes(docs, store), "classes")
    got = classes.collect()
    assert len(got) == len(edge_rows())
    assert {r.class_id for r in got if r.doc_id in (1, 2)} == {1}
    assert all(r.class_size == 1 for r in got if r.doc_id in (3, 4, 5))
    assert {r.class_size for r in got if r.doc_id == 1} == {3}
    kept = near_dups.keep_one(docs, classes)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 2 and ids[2] == 0 and ids[3] == ids[4] == ids[5] == 1 and ids[6] == 2 and ids[None] == 3
    empty = empty_docs(spark)
    assert near_dups.find_classes(empty, storage(empty, "t")).count() == 0


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(0)
    runs = draw.integers(0, 2**63, 400).astype(np.uint64)
    one, two = draw.integers(1, 40, 400), draw.integers(1, 40, 400)
    times = near_dups.bag_minhash(np.repeat([0, 1], 400), np.tile(runs, 2), np.concatenate([one, two]), 2, size=4096)
    exact = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((times[0] == times[1]).mean() - exact) < 0.03
    assert np.isfinite(times).all()


def test_components_of_a_path_a_star_and_a_ring(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.u: r.v for r in connected_components(df, storage(df, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, **{200 + i: 200 for i in range(1, 9)}}


def test_a_step_of_components_shuffles_its_edges_three_times(spark, capsys):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)], "u long, v long")
    _small_stars(_stars(edges)).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 3


def test_tiles_are_longest_first_and_do_not_overlap():
    code = lambda s: [ord(c) for c in s]
    tiles = decontaminate.tile(code("abcdefghijklmnop"), code("xxijklmnopyyabcdefghzz"), 3)
    assert sorted(size for *_, size in tiles) == [8, 8]
    assert decontaminate.tile(code("aaaa"), code("aaaaaaaaaa"), 3) == [(0, 0, 4)]
    assert decontaminate.tile(code("abcdef"), [*code("abc"), None, *code("def")], 3) == [(0, 0, 3), (3, 4, 3)]
    draw = random.Random(5)
    for _ in range(60):
        a, b = ([draw.randrange(4) for _ in range(draw.randint(3, 60))] for _ in range(2))
        tiles = decontaminate.tile(a, b, 3, 8)
        used_a, used_b = Counter(), Counter()
        for i, j, n in tiles:
            assert a[i:i + n] == b[j:j + n] and n >= 3
            used_a.update(range(i, i + n))
            used_b.update(range(j, j + n))
        assert max([*used_a.values(), *used_b.values(), 1]) == 1
        longest = max((n for i in range(len(a)) for j in range(len(b)) for n in [common(a[i:], b[j:])]), default=0)
        assert max((n for *_, n in tiles), default=0) == (longest if longest >= 3 else 0)
        # Nothing of the least length is left between free words.
        free_a, free_b = [None if k in used_a else x for k, x in enumerate(a)], [-1 if k in used_b else x for k, x in enumerate(b)]
        assert all(common(free_a[i:], free_b[j:]) < 3 for i in range(len(a)) for j in range(len(b)))


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def test_leaks_are_found_reordered_and_clean_texts_left(spark):
    item = prose(50, 36)
    w = item.split()
    reordered = " ".join([*w[18:], "between", *w[:18]])
    rows = [
        (1, f"{prose(1, 30)} {item.upper().replace(' ', ', ')} {prose(2, 30)}"), (2, f"x {reordered} y"), (3, prose(3, 200)),
        (4, f"{' '.join(w[:8])} {prose(4, 50)}"), (5, None), (6, ""), (7, " ".join(w[:24])), (None, item), (8, item), (8, item),
    ]
    docs = spark.createDataFrame([(*r, *["clash"] * len(CLASHING)) for r in rows], "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHING))
    benchmark = spark.createDataFrame([(7, item), (7, item), (8, "too short"), (9, None), (None, prose(60, 20))], "item_id long, text string")
    store = storage(docs, "t")
    leaks = store(decontaminate.find_leaks(docs, benchmark, store), "leaks")
    found = {r.doc_id: r for r in decontaminate.leaking_documents(leaks).collect()}
    assert set(found) == {1, 2, 7, None, 8}
    assert found[2].coverage == 1.0 and found[2].tiles == 2 and found[7].coverage == pytest.approx(24 / 36)
    assert Counter(r.doc_id for r in decontaminate.remove_leaks(docs, leaks).collect()) == Counter([3, 4, 5, 6])
    for a, b in ((empty_docs(spark), benchmark), (docs, benchmark.limit(0))):
        assert decontaminate.find_leaks(a, b, storage(a, "t")).count() == 0


def test_short_items_are_found_word_for_word(spark):
    base = prose(70, 40)
    rows = [(1, f"{base} Forty-two, PERCENT {base}"), (2, f"{base} forty percent two {base}"), (3, "forty two"), (4, "Solo"), (5, f"x {base} solo"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = [(1, "forty two percent"), (2, "solo"), (3, ""), (4, None), (5, "a b c d")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    leaks = decontaminate.find_leaks(docs, benchmark, storage(docs, "t")).collect()
    assert sorted((r.doc_id, r.item_id, r.item_words, r.covered, r.tiles) for r in leaks) == [(1, 1, 3, 3, 1), (4, 2, 1, 1, 1), (5, 2, 1, 1, 1)]


def test_words_without_signs():
    import pyarrow as pa

    from tidegate.llm.words import words_of

    texts = ["Don't stop—now… “ok” ¿qué? x y ªb", None, "", "  ", "A1 b2"]
    got = [w.data[a:b].tobytes().decode() for w in words_of(pa.array(texts), letters=True) for a, b in zip(w.start, w.end, strict=True)]
    assert got == re.findall(r"[^\W_]+", "Don't stop—now… “ok” ¿qué? x y ªb A1 b2")


def test_long_words_of_swapped_blocks_differ():
    import pyarrow as pa

    from tidegate.llm.words import words_of

    one, two = "ab" * 512, "ba" * 512
    texts = [one + two, two + one, one + one, two + two, one, one + two]
    got = [h for w in words_of(pa.array(texts)) for h in w.hash]
    assert len(set(got)) == 5 and got[0] == got[5]
