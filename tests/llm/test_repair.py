"""Conversation repair against a brute-force version."""

import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.llm import queries, repair
from tidegate.llm.store import storage

TURNS = "conv_id long, turn long, role string, text string"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def least_edits(turns):
    """(cost, audit) by carrying every state's least pair over the rows; ``turns`` are (initial, fault)."""
    def inserted(states):
        for _ in range(3):
            for state, (cost, audit) in list(states.items()):
                for made in "ua":
                    if made in NEXT[state]:
                        better(states, made, (cost + 5, audit + "I"))
        return states

    def better(states, state, pair):
        if state not in states or pair < states[state]:
            states[state] = pair

    states = inserted({"": (0, "")})
    for initial, fault in turns:
        after = {}
        for state, (cost, audit) in states.items():
            better(after, state, (cost + 2, audit + "D"))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 * (fault == "truncated")
            if initial in NEXT[state]:
                better(after, NEXT[state][initial], (cost + more, audit + "K"))
            for made in "ua":
                if made in NEXT[state]:
                    better(after, made, (cost + 1 + more, audit + "R"))
        states = inserted(after)
    return min(states[state] for state in ("", "a") if state in states)


def brute_force(turns):
    """Expected rows of conversations, by the words of the contract."""
    told = lambda x: " " if x is None else str(x)
    by_conv = defaultdict(list)
    for conv_id, turn, role, text in turns:
        by_conv[conv_id].append((turn, told(role), told(text)))
    out = {}
    for conv_id, own in by_conv.items():
        own.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), hashlib.sha256(t[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in own:
            solid = SOLID.findall(text)
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
        initials = [role[:1] for _, role, _ in own]
        numbers = [t for t, _, _ in own if t is not None]
        cost, audit = least_edits(list(zip(initials, faults, strict=True)))
        repaired, at, state = [], 0, ""
        for edit in audit:
            due = {"u": "assistant"}.get(state, "user")
            if edit == "I":
                repaired.append((due, ""))
            else:
                _, role, text = own[at]
                at += 1
                if edit == "D":
                    continue
                repaired.append((role if edit == "K" else due, text))
            state = repaired[-1][0][:1]
        assert at == len(own) and re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in repaired))
        out[conv_id] = {
            "conv_id": conv_id,
            "gaps": max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
            **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest(),
        }
    return out


def damaged(turns):
    told = lambda x: " " if x is None else str(x)
    for conv_id, turn, role, text in turns:
        lot = zlib.crc32(f"{told(conv_id)}:{told(turn)}".encode()) % 20
        role, text = told(role), told(text)
        row = (conv_id, turn, "user" if lot == 4 else role, "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text)
        yield from [row] * {0: 0, 3: 2}.get(lot, 1)


def found(spark, turns):
    df = spark.createDataFrame(turns, TURNS).withColumn("audit", F.lit("clash")).withColumn("digest", F.lit("clash"))
    summary, repaired = repair.repair(df, storage(df, "repair"))
    digests = {r["conv_id"]: r["repaired_sha256"] for r in repair.digest_turns(repaired).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r["conv_id"]: r.asDict() | {"repaired_sha256": digests.get(r["conv_id"], empty)} for r in summary.collect()}


FAULTS = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("uuuaaasx"), st.sampled_from(["", "", "", *FAULTS])), max_size=30))
def test_search_is_optimal(turns):
    codes = bytes("uas".find(kind) % 4 | FAULTS[fault] << 2 for kind, fault in turns)
    assert repair.find_edits(codes) == least_edits(turns)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("uasx"), st.sampled_from([*FAULTS])), max_size=12))
def test_bounds_never_exceed_what_is_left(turns):
    codes = bytes("uas".find(kind) % 4 | FAULTS[fault] << 2 for kind, fault in turns)
    bounds = repair.lower_bounds(codes)
    assert bounds[0][repair.START] <= least_edits(turns)[0] and len(bounds) == len(turns) + 1


@pytest.mark.parametrize("pattern", ["u", "ua", "a", "aau", "us", "x"])
def test_long_conversations_are_searched_in_time(pattern):
    turns = [(kind, ("", "", "truncated", "")[i % 4]) for i, kind in enumerate(pattern * (20_000 // len(pattern)))]
    codes = bytes("uas".find(kind) % 4 | FAULTS[fault] << 2 for kind, fault in turns)
    cost, audit = repair.find_edits(codes)
    assert len(audit) - audit.count("I") == len(turns)
    assert cost == sum({"D": 2, "I": 5, "R": 1, "K": 0}[e] for e in audit) + 5 * sum(
        e in "KR" and fault == "truncated" for e, (_, fault) in zip(audit.replace("I", ""), turns, strict=True))


EDGES = [
    (1, 0, "user", "Hello."), (1, 1, "assistant", "Yes?"),
    (2, None, "user", "First."), (2, None, "assistant", "First."), (2, 3, "assistant", "cut off"), (2, 9, "user", "Again!"), (2, 9, "user", "Again!"),
    (3, 5, None, None), (3, 6, "system", "Rules."), (3, 7, "user", "\t\n"), (3, None, "user", None),
    (None, 1, "user", "No id."), (None, 1, "user", "No id."), (None, 2, "tool", "é."), (None, None, "assistant", "x" * 50_000),
    (4, 1, "assistant", "Same."), (4, 2, "assistant", "Same."), (4, 3, "", "No role."), (4, 4, "system", "Late."),
    (5, 2, "user", ""), (6, 1, "system", "Alone."), (7, 1, "user", "end. \n"), (7, 2, "assistant", "no end.x"),
]


def test_edge_cases_agree_with_brute_force(spark):
    assert found(spark, EDGES) == brute_force(EDGES)


def test_a_conversation_holding_most_rows(spark):
    hot = [(1, i // 2, "uaa s"[i % 5].replace("u", "user").replace("a", "assistant"), f"line {i % 97}" + "." * (i % 3 > 0)) for i in range(3000)]
    assert found(spark, hot + EDGES[2:]) == brute_force(hot + EDGES[2:])


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_query_on_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute_force(damaged(turns))
    zero = {name: 0 for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    for conv_id in {t[0] for t in turns} - set(want):
        want[conv_id] = {"conv_id": conv_id, **zero, "audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    got = rows(queries.op13_repair(spark, folder))
    assert {r["conv_id"]: r for r in got} == want and len(got) == len(want)
