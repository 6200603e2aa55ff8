"""Conversation structure repair (11) against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oxbow.llm import conversations as C
from tests.llm.conftest import tuples

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"
SHAPE = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    word = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        kind, role, text = zlib.crc32(f"{word(conv)}:{word(turn)}".encode()) % 20, word(role), word(text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        yield conv, turn, "user" if kind == 4 else role, text
        if kind == 3:
            yield conv, turn, role, text


def cheapest(initials, faults):
    """(cost, audit): the least pair of all edit sequences, whole strings compared;
    a run of more than two inserts only comes back to where it began."""
    behind = {}
    for i in range(len(initials), -1, -1):
        here = {}
        for run in (3, 2, 1, 0):  # inserts just before
            for state in ("", "s", "u", "a"):  # the last initial put out
                up = "a" if state == "u" else "u"
                found = [(10**9, "")]
                if i == len(initials):
                    found += [(0, "")] * (state in ("", "a"))
                else:
                    ways = [("D", state, 2)]
                    if faults[i] in ("", "truncated"):
                        more = 5 if faults[i] else 0
                        ways.append(("R", up, more + 1))
                        if initials[i] == up or (initials[i] == "s" and state == ""):
                            ways.append(("K", initials[i], more))
                    found += [(behind[to][0] + cost, e + behind[to][1]) for e, to, cost in ways]
                if run < 3:
                    found.append((here[run + 1, up][0] + 5, "I" + here[run + 1, up][1]))
                here[run, state] = min(found)
        behind = {state: here[0, state] for state in ("", "s", "u", "a")}
    return behind[""]


def brute(rows, turns=None):
    """rows before damage (or ``turns`` behind it)."""
    after = defaultdict(list)
    for conv, turn, role, text in (turns if turns is not None else damaged(rows)):
        after[conv].append((turn, role, text))
    out, lines_of = [], {}
    for conv in {r[0] for r in rows}:
        of = after[conv]
        digest = lambda r: hashlib.sha256(
            f"{k}:{len(k.encode())}:{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
        k = "" if conv is None else f"={conv}"
        of.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:16], digest(r)))
        seen, faults = set(), []
        for _, role, text in of:
            bare = text.rstrip(WS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                          else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = "".join(r[1][:1] or "-" for r in of)
        turn = [r[0] for r in of if r[0] is not None]
        cost, audit = cheapest(initials, tuple(faults))
        lines, at, state = [], 0, ""
        for e in audit:
            up = "a" if state == "u" else "u"
            name = {"u": "user", "a": "assistant"}[up]
            if e == "I":
                lines.append((e, name, ""))
            elif e != "D":
                lines.append((e, of[at][1] if e == "K" else name, of[at][2]))
            at += e != "I"
            if e != "D":
                state = lines[-1][1][0]
        assert SHAPE.match("".join(x[1][0] for x in lines))
        out.append((conv, max(turn) - min(turn) + 1 - len(set(turn)) if turn else 0,
                    *[faults.count(x) for x in ("blank", "duplicate", "truncated")],
                    sum(p + q not in ("su", "ua", "au") for p, q in zip(initials, initials[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in lines).encode()).hexdigest()))
        lines_of[conv] = lines
    return sorted(out, key=repr), lines_of


def sample(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 4, 4, 7, 30])):
            if rng.random() < 0.1:
                continue
            role = ("system" if turn == 0 and rng.random() < 0.4 else "user assistant".split()[turn % 2])
            if rng.random() < 0.1:
                role = rng.choice(["user", "assistant", "system", "tool", "", "User", None, "umpire"])
            text = rng.choice(["Hello there.", "No!", "Why? \n", "cut off", "  ", "", None, "é.\x0b", f"Number {turn}.", "x" * 3000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn, None, turn * 3]), role, text))
    return rows + [(None, 0, "user", "Hi."), (None, None, "assistant", "Ho."), (-5, 3, "user", None)]


@pytest.mark.parametrize("piece", [C.PIECE, 5, 1])
def test_report(spark, monkeypatch, piece):
    monkeypatch.setattr(C, "PIECE", piece)
    monkeypatch.setattr(C, "CHUNK", 10)
    rows = sample(1, 60)
    rows += [(77_777, t, "user" if t % 3 else "assistant", f"Same {t % 40}.") for t in range(150)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).select(
        "*", *[F.lit("z").alias(c) for c in ("at", "same", "code", "conv", "piece", "first", "kind", "n", "audit", "cost")])
    want, lines = brute(rows)
    got = C.report(C.damage(df), df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert tuples(got) == want
    if piece == 5:
        found = defaultdict(list)
        for r in C.repaired(C.damage(df)).orderBy("place").collect():
            assert r["place"] == len(found[r["conv_id"]]) + 1
            found[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
        assert dict(found) == {k: v for k, v in lines.items() if v}


def test_rows_as_they_are_and_empty_tables(spark):
    rows = sample(2, 12)
    df = spark.createDataFrame(rows, SCHEMA)
    word = lambda x: " " if x is None else x
    assert tuples(C.report(df)) == brute(rows, [(c, t, word(r), word(x)) for c, t, r, x in rows])[0]
    none = spark.createDataFrame([], SCHEMA)
    assert C.report(none).count() == 0 and C.repaired(none).count() == 0
    gone = [(c, t, "user", "Hi.") for c in range(40) for t in [0] if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone
    df = spark.createDataFrame(gone, SCHEMA)
    empty = hashlib.sha256(b"").hexdigest()
    assert tuples(C.report(C.damage(df), df)) == sorted(((c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in gone), key=repr)
    wide = spark.createDataFrame([(1, -2**63, "user", "a."), (1, 2**63 - 1, "assistant", "b.")], SCHEMA)
    assert C.report(wide).first()["gaps"] == 2**63 - 1


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("-sua"), st.sampled_from(["", "", "", "blank", "duplicate", "truncated"])),
                max_size=14), st.integers(1, 5))
def test_edits_are_cheapest_and_least(rows, piece):
    initials, faults = "".join(r[0] for r in rows), tuple(r[1] for r in rows)
    codes = ["-sua".index(i) * 4 + ["", "blank", "duplicate", "truncated"].index(f) for i, f in rows]
    cost, audit = cheapest(initials, faults)
    stored = C.checkpoints(codes, C.END)
    assert len(stored[1]) <= len(codes) ** 0.5 + 2
    assert stored[1][-1][0] == cost and C.walk(codes, C.END, True, 0, stored)[0] == audit
    # in pieces: end vectors from matrices, states from walks
    parts = [codes[i:i + piece] for i in range(0, len(codes), piece)]
    v, ends = C.END, []
    for p in reversed(parts):
        ends.insert(0, v)
        m = C.matrix(p)
        v = tuple(min(m[4 * q + to] + v[to] for to in range(4)) for q in range(4))
    state, out = 0, ""
    for n, (p, end) in enumerate(zip(parts, ends)):
        part, state = C.walk(p, end, n == len(parts) - 1, state, C.checkpoints(p, end))
        out += part
    assert v[0] == cost and out == audit


def test_a_long_conversation():
    rng = random.Random(3)
    codes = [4 * rng.choice([1, 2, 3]) + rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(200_000)]
    stored = C.checkpoints(codes, C.END)
    assert len(stored[1]) < 460
    audit, _ = C.walk(codes, C.END, True, 0, stored)
    cost, at = 0, 0
    for e in audit:
        cost += {"K": 0, "R": 1, "D": 2, "I": 5}[e] + (5 if e in "KR" and codes[at] & 3 == 3 else 0)
        at += e != "I"
    assert at == len(codes) and cost == stored[1][-1][0]
