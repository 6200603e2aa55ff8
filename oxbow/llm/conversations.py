"""Conversation structure repair by a square-root checkpointed DP (operator 11).

A conversation's rows, in order of their turn, are edited at least cost so that
the initials of the roles read ``(s?(ua)+)?``: Keep 0 (a truncated row 5 more),
Rerole to user or assistant 1 (likewise), Delete 2 (the only edit of blank and
duplicate rows), Insert an empty user or assistant row 5. Four states -- nothing
yet, behind s, behind u, behind a -- have a cost each: that of the cheapest edits
of the remaining rows. These cost vectors are computed backwards and stored only
at checkpoints, every sqrt(n) rows; then, walking forward, each block's vectors
are computed again from its checkpoint, and of the edits that keep to the least
cost (the tight ones) the ASCII-least is emitted: D, I, K, R.

Scale: rows are numbered in (conversation, turn) order, and the numbering is cut
into pieces of ``PIECE`` rows. A conversation inside one piece is one DP. Of a
longer one (at most one begins in each piece) the pieces are reduced to 4 x 4
matrices of least costs between states, in parallel; one small group per
conversation turns them into the cost vector at each piece's end, the pieces walk
for each state they may be entered in, and a second small group picks the state.
No task holds more than ``PIECE`` rows of a conversation, and those without their
texts. Only the digest of a conversation's repaired text is sequential by its
nature: its pieces hash in parallel if they are whole conversations; the text of a
longer one streams through one task, without being held.

Defined cases: a null role or text is one space (so the text is blank); a null
``conv_id`` is a conversation of its own; null turns come first; rows that share a
turn are ordered by the first 16 characters of the role, then by a SHA-256 of role
and text, and rows equal in all of these are interchangeable; an empty role has no
initial and cannot be kept; texts of any length are read whole; other columns,
whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oxbow.llm.common import anti_hot, join_hot, materialize
from oxbow.plans.ordering import with_ordinal
from oxbow.session import ship_package

#: Rows of the numbered table that one DP takes at a time.
PIECE = 1 << 16
#: Bytes of repaired text that a piece of a longer conversation emits in one row.
CHUNK = 1 << 20
_SPACE = " \t\n\x0b\x0c\r"
_INF = 1 << 60
_START, _S, _U, _A = range(4)
_CLEAN, _BLANK, _DUPLICATE, _TRUNCATED = range(4)
#: The state behind an inserted or reroled row, and its role.
_NEXT, _ROLE = (_U, _U, _A, _U), ("user", "user", "assistant", "user")
#: Costs behind the last row: what is missing is inserted.
END = (0, 10, 5, 0)
_STATES = range(4)


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with faults, by crc32 of
    ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes
    ``.!?``, 3 repeats it, 4 makes its role user. Nulls are one space."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.encode(F.concat(word("conv_id"), F.lit(":"), word("turn")), "utf-8")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(word("text"), ".!?", "")).otherwise(word("text"))
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return turns.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(word("role")).alias("role"),
                        text.alias("text"), F.explode(F.array_repeat(F.lit(0), times)).alias("copy")).drop("copy")


# -- the DP; a code is 4 * initial + fault, initials: 1 s, 2 u, 3 a, 0 any other

def back(code: int, v: tuple) -> tuple:
    """Cost vector before a row from the one behind it."""
    r0, r1, r2, r3 = v[0] + 2, v[1] + 2, v[2] + 2, v[3] + 2
    fault, initial = code & 3, code >> 2
    if fault == _CLEAN or fault == _TRUNCATED:
        kept = 5 if fault == _TRUNCATED else 0
        u = v[2] + (kept if initial == _U else kept + 1)
        a = v[3] + (kept if initial == _A else kept + 1)
        r0, r1, r2, r3 = min(r0, u), min(r1, u), min(r2, a), min(r3, u)
        if initial == _S:
            r0 = min(r0, v[1] + kept)
    return min(r0, r2 + 5, r3 + 10), min(r1, r2 + 5, r3 + 10), min(r2, r3 + 5), min(r3, r2 + 5)


def matrix(codes) -> list[int]:
    """Least costs from each state before the rows to each state behind them."""
    out = [[0] * 4 for _ in _STATES]
    for to in _STATES:
        v = tuple(0 if q == to else _INF for q in _STATES)
        for code in reversed(codes):
            v = back(code, v)
        for q in _STATES:
            out[q][to] = min(v[q], _INF)
    return [x for row in out for x in row]


def checkpoints(codes, end: tuple) -> tuple[int, list[tuple]]:
    """(block length, vectors at the blocks' ends, last block first) and, last in
    the list, the vector before the first row."""
    block, stored, v = isqrt(len(codes)) + 1, [end], end
    for i in range(len(codes) - 1, -1, -1):
        v = back(codes[i], v)
        if i % block == 0:
            stored.append(v)
    return block, stored


def walk(codes, end: tuple, last: bool, entry: int, stored: tuple[int, list[tuple]]) -> tuple[str, int]:
    """(ASCII-least tight edits, state behind them); ``last``: nothing follows."""
    block, vectors = stored
    state, out = entry, []
    for n, start in enumerate(range(0, len(codes), block)):
        part = codes[start:start + block]
        behind = [vectors[len(vectors) - 2 - n]]  # the vectors of this block, computed again
        for code in reversed(part):
            behind.append(back(code, behind[-1]))
        behind.reverse()
        for i, code in enumerate(part):
            here, then = behind[i], behind[i + 1]
            while True:
                cost, up = here[state], _NEXT[state]
                if then[state] + 2 == cost:
                    out.append("D")
                elif here[up] + 5 == cost:
                    out.append("I")
                    state = up
                    continue
                else:
                    initial, kept = code >> 2, 5 if code & 3 == _TRUNCATED else 0
                    if initial == _S and state == _START and then[_S] + kept == cost:
                        out.append("K")
                        state = _S
                    elif initial == up and then[up] + kept == cost:
                        out.append("K")
                        state = up
                    else:
                        out.append("R")
                        state = up
                break
    while last and end[state]:
        out.append("I")
        state = _NEXT[state]
    return "".join(out), state


def _illegal(codes: np.ndarray) -> int:
    """Adjacent rows whose initials are not su, ua or au."""
    a, b = codes[:-1] >> 2, codes[1:] >> 2
    return int((~(((a == _S) & (b == _U)) | ((a == _U) & (b == _A)) | ((a == _A) & (b == _U)))).sum())


# -- Spark

def _key(conv: Column) -> Column:
    """A conversation's key, never null."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def _ordered(turns: DataFrame, stable_input: bool) -> DataFrame:
    """conv, turn, role, text, same (a digest of conversation, role and text), at (number)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select(_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                        role.alias("role"), text.alias("text"))
    whole = F.concat("conv", F.lit(":"), F.octet_length("conv"), F.lit(":"), F.octet_length("role"), F.lit(":"), "role", "text")
    rows = rows.withColumn("same", F.unhex(F.sha2(whole, 256)))
    order = [F.asc("conv"), F.asc_nulls_first("turn"), F.asc(F.substring("role", 1, 16)), F.asc("same")]
    return with_ordinal(rows, order, "at", stable_input=stable_input).withColumn(
        "piece", F.floor(F.col("at") / PIECE))


def _coded(rows: DataFrame) -> DataFrame:
    """conv, turn, at, piece, code, without the texts."""
    bare = F.rtrim(F.col("text"), F.lit(_SPACE))
    fault = (F.when(bare == "", _BLANK).when(~F.right(bare, F.lit(1)).isin(*".!?"), _TRUNCATED).otherwise(_CLEAN))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", _S).when(first == "u", _U).when(first == "a", _A).otherwise(0)
    slim = materialize(rows.select("conv", "turn", "at", "piece", "same", (initial * 4 + fault).alias("code")))
    full = slim.where(F.col("code") % 4 != _BLANK)
    seen = materialize(full.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    again = join_hot(full, seen, ["same"], "n").withColumn(
        "code", F.when(F.col("at") > F.col("first"), F.col("code") - F.col("code") % 4 + _DUPLICATE).otherwise(F.col("code")))
    parts = [slim.where(F.col("code") % 4 == _BLANK), anti_hot(full, seen, ["same"], "n"), again]
    cols = ["conv", "turn", "at", "piece", "code"]
    return materialize(parts[0].select(*cols).unionByName(parts[1].select(*cols)).unionByName(parts[2].select(*cols)))


def _counts(coded: DataFrame) -> DataFrame:
    fault = F.col("code") % 4
    span = F.max("turn").cast("decimal(20,0)") - F.min("turn") + 1 - F.count_distinct("turn")
    return coded.groupBy("conv").agg(
        F.least(F.coalesce(span, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"),
        *[F.count_if(fault == k).alias(name) for k, name in
          ((_BLANK, "blank"), (_DUPLICATE, "duplicate"), (_TRUNCATED, "truncated"))],
        F.min("piece").alias("from_piece"), F.max("piece").alias("to_piece"))


_SOLVED = "conv string, piece long, first long, entry int, audit string, cost long, illegal long"


def _solve_whole(pieces: DataFrame) -> DataFrame:
    """Conversations inside one piece."""
    def run(batches):
        for b in batches:
            found = []
            for codes in b.column("codes"):
                codes = codes.values.to_pylist()
                stored = checkpoints(codes, END)
                audit, _ = walk(codes, END, True, _START, stored)
                found.append((audit, stored[1][-1][_START], _illegal(np.array(codes))))
            audit, cost, illegal = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("piece"), b.column("first"), pa.array([_START] * len(found), pa.int32()),
                 pa.array(audit, pa.string()), pa.array(cost, pa.int64()), pa.array(illegal, pa.int64())],
                names=["conv", "piece", "first", "entry", "audit", "cost", "illegal"])
    return pieces.select("conv", "piece", "first", "codes").mapInArrow(run, _SOLVED)


def _solve_pieces(pieces: DataFrame) -> DataFrame:
    """Conversations of several pieces, a row per piece; the cost and the illegal
    pairs of the conversation stand in its first one."""
    def reduce(batches):
        for b in batches:
            for conv, piece, codes in zip(b.column("conv").to_pylist(), b.column("piece").to_pylist(), b.column("codes")):
                codes = codes.values.to_pylist()
                yield pa.RecordBatch.from_pylist([{"conv": conv, "piece": piece, "matrix": matrix(codes),
                                                   "head": codes[0], "tail": codes[-1],
                                                   "illegal": _illegal(np.array(codes))}], schema=reduced)
    reduced = pa.schema([("conv", pa.string()), ("piece", pa.int64()), ("matrix", pa.list_(pa.int64())),
                         ("head", pa.int32()), ("tail", pa.int32()), ("illegal", pa.int64())])
    matrices = pieces.select("conv", "piece", "codes").mapInArrow(
        reduce, "conv string, piece long, matrix array<long>, head int, tail int, illegal long")

    def ends(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("piece")
        v, out = END, []
        for m in reversed(rows.column("matrix").to_pylist()):
            out.append(v)
            v = tuple(min(m[4 * q + to] + v[to] for to in _STATES) for q in _STATES)
        head, tail = (rows.column(c).to_numpy() for c in ("head", "tail"))
        pairs = sum(_illegal(np.array(p)) for p in zip(tail[:-1], head[1:]))
        n = rows.num_rows
        return pa.table({"conv": rows.column("conv"), "piece": rows.column("piece"),
                         "ends": pa.array([list(v) for v in reversed(out)], pa.list_(pa.int64())),
                         "last": pa.array([False] * (n - 1) + [True]),
                         "cost": pa.array([v[_START]] + [0] * (n - 1), pa.int64()),
                         "illegal": pa.array(rows.column("illegal").to_numpy() + np.array([pairs] + [0] * (n - 1)))})
    vectors = matrices.groupBy("conv").applyInArrow(
        ends, "conv string, piece long, ends array<long>, last boolean, cost long, illegal long")

    def walks(batches):
        names = ["conv", "piece", "first", "cost", "illegal", "audits", "exits"]
        for b in batches:
            audits, exits = [], []
            for codes, end, last in zip(b.column("codes"), b.column("ends").to_pylist(), b.column("last").to_pylist()):
                codes, end = codes.values.to_pylist(), tuple(end)
                stored = checkpoints(codes, end)
                ways = [walk(codes, end, last, q, stored) for q in _STATES]
                audits.append([w[0] for w in ways])
                exits.append([w[1] for w in ways])
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names[:5]] + [pa.array(audits, pa.list_(pa.string())), pa.array(exits, pa.list_(pa.int32()))],
                names=names)
    walked = materialize(pieces.select("conv", "piece", "first", "codes").join(vectors, ["conv", "piece"]).mapInArrow(
        walks, "conv string, piece long, first long, cost long, illegal long, audits array<string>, exits array<int>"))

    def enter(rows: pa.Table) -> pa.Table:
        rows, state, out = rows.sort_by("piece"), _START, []
        for exits in rows.column("exits").to_pylist():
            out.append(state)
            state = exits[state]
        return pa.table({"conv": rows.column("conv"), "piece": rows.column("piece"), "entry": pa.array(out, pa.int32())})
    entered = walked.select("conv", "piece", "exits").groupBy("conv").applyInArrow(enter, "conv string, piece long, entry int")
    return walked.join(entered, ["conv", "piece"]).select(
        "conv", "piece", "first", "entry", F.get("audits", F.col("entry")).alias("audit"), "cost", "illegal")


def _solved(coded: DataFrame, counts: DataFrame) -> DataFrame:
    """conv, piece, first (number of the first row), entry state, audit, cost, illegal, whole."""
    ship_package(coded.sparkSession)
    pieces = coded.groupBy("conv", "piece").agg(
        F.min("at").alias("first"), F.sort_array(F.collect_list(F.struct("at", "code"))).alias("codes"))
    pieces = pieces.withColumn("codes", F.col("codes.code"))
    pieces = pieces.join(counts.select("conv", (F.col("from_piece") == F.col("to_piece")).alias("whole")), "conv")
    pieces = materialize(pieces)
    return materialize(_solve_whole(pieces.where("whole")).withColumn("whole", F.lit(True)).unionByName(
        _solve_pieces(pieces.where("NOT whole")).withColumn("whole", F.lit(False))))


class _Repair:
    """Turns the rows of one piece into repaired lines, edit by edit."""

    def __init__(self, audit: str, state: int):
        self.edits, self.state = iter(audit), state

    def lines(self, role: str | None, text: str | None):
        """The lines of the next row (its edit, and the inserts before it); with
        no row, the inserts behind the last one: (edit, role, text)."""
        for edit in self.edits:
            up = self.state
            if edit == "K" and up == _START and role[0] == "s":
                self.state = _S
            elif edit != "D":
                self.state = _NEXT[up]
            if edit == "I":
                yield edit, _ROLE[up], ""
                continue
            if edit != "D":
                yield edit, role if edit == "K" else _ROLE[up], text
            return


def _stream(rows: DataFrame, solved: DataFrame, out: str, make) -> DataFrame:
    """Runs ``make()`` over each piece: an object with ``begin(head)``,
    ``line(edit, role, text)`` and ``end()``, which all give rows of ``out``.
    Rows arrive in order behind the head that holds their piece's audit."""
    none = F.lit(None).cast("string")
    heads = solved.select("piece", F.col("first").alias("at"), F.lit(0).alias("kind"), "conv", "whole", "entry", "audit",
                          none.alias("role"), none.alias("text"))
    body = rows.select("piece", "at", F.lit(1).alias("kind"), "conv", F.lit(None).cast("boolean").alias("whole"),
                       F.lit(None).cast("int").alias("entry"), none.alias("audit"), "role", "text")
    mixed = heads.unionByName(body).repartition("piece").sortWithinPartitions("piece", "at", "kind")
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]])
                        for c in out.split(", ")])

    def run(batches):
        work, repair = make(), None
        for b in batches:
            found = []
            kinds, columns = b.column("kind").to_pylist(), {c: b.column(c) for c in b.schema.names}
            for i, kind in enumerate(kinds):
                if kind == 0:
                    if repair:
                        for line in repair.lines(None, None):
                            found += work.line(*line)
                        found += work.end()
                    head = {c: columns[c][i].as_py() for c in ("conv", "piece", "whole", "entry", "audit")}
                    repair = _Repair(head["audit"], head["entry"])
                    work.begin(head)
                else:
                    for line in repair.lines(columns["role"][i].as_py(), columns["text"][i].as_py()):
                        found += work.line(*line)
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=schema)
        if repair:
            found = [x for line in repair.lines(None, None) for x in work.line(*line)] + work.end()
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=schema)
    return mixed.mapInArrow(run, out)


class _Digest:
    """A whole conversation's digest; of a longer one its text, each line behind a line end."""

    def begin(self, head):
        self.head, self.hash, self.first, self.n, self.part = head, hashlib.sha256(), True, 0, bytearray()

    def line(self, edit, role, text):
        data = f"{role}:{text}".encode()
        if self.head["whole"]:
            self.hash.update(data if self.first else b"\n" + data)
            self.first = False
            return []
        self.part += b"\n" + data
        return self._chunk() if len(self.part) >= CHUNK else []

    def _chunk(self):
        self.n += 1
        data, self.part = bytes(self.part), bytearray()
        return [{"conv": self.head["conv"], "piece": self.head["piece"], "n": self.n, "sha": None, "data": data}]

    def end(self):
        if not self.head["whole"]:
            return self._chunk()
        return [{"conv": self.head["conv"], "piece": self.head["piece"], "n": 0, "sha": self.hash.hexdigest(), "data": None}]


class _Lines:
    """The repaired rows themselves."""

    def begin(self, head):
        self.head, self.n = head, 0

    def line(self, edit, role, text):
        self.n += 1
        return [{"conv": self.head["conv"], "piece": self.head["piece"], "n": self.n, "edit": edit, "role": role, "text": text}]

    def end(self):
        return []


def _joined_digests(chunks: DataFrame) -> DataFrame:
    """conv, sha: the digest of a conversation's chunks, which stream past in order."""
    def run(batches):
        now, h, first = None, None, True
        for b in batches:
            for conv, data in zip(b.column("conv").to_pylist(), b.column("data")):
                if conv != now:
                    if h:
                        yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([h.hexdigest()])], names=["conv", "sha"])
                    now, h, first = conv, hashlib.sha256(), True
                data = data.as_py()
                if data:
                    h.update(data[1:] if first else data)
                    first = False
        if h:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([h.hexdigest()])], names=["conv", "sha"])
    ordered = chunks.repartition("conv").sortWithinPartitions("conv", "piece", "n")
    return ordered.select("conv", "data").mapInArrow(run, "conv string, sha string")


def report(turns: DataFrame, conversations: DataFrame | None = None, stable_input: bool = False) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal,
    cost, audit, repaired_sha256 (of ``role:text`` lines joined by line ends).

    ``conversations`` (a frame with ``conv_id``, ``turns`` by default) names those
    to report; without rows they have zeros, no edits and the empty text's digest.
    ``stable_input`` says that ``turns`` reads files without a shuffle.
    """
    rows = _ordered(turns, stable_input)
    coded = _coded(rows)
    counts = materialize(_counts(coded))
    solved = _solved(coded, counts)
    streamed = materialize(_stream(rows, solved, "conv string, piece long, n long, sha string, data binary", _Digest))
    digests = (streamed.where("sha IS NOT NULL").select("conv", "sha")
               .unionByName(_joined_digests(streamed.where("sha IS NULL"))))
    edits = solved.groupBy("conv").agg(
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
        F.array_join(F.sort_array(F.collect_list(F.struct("piece", "audit")))["audit"], "").alias("audit"))
    ids = ((conversations if conversations is not None else turns)
           .select("conv_id", _key(F.col("conv_id")).alias("conv")).distinct())
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (ids.join(counts, "conv", "left").join(edits, "conv", "left").join(digests, "conv", "left")
            .select("conv_id", *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


def repaired(turns: DataFrame, stable_input: bool = False) -> DataFrame:
    """The repaired conversations: conv_id, place (from 1), edit (K, R or I), role, text."""
    rows = _ordered(turns, stable_input)
    coded = _coded(rows)
    solved = _solved(coded, materialize(_counts(coded)))
    lines = materialize(_stream(rows, solved, "conv string, piece long, n long, edit string, role string, text string", _Lines))
    # places continue from piece to piece: a sum over the pieces of a conversation, not over its rows
    sizes = lines.groupBy("conv", "piece").agg(F.count(F.lit(1)).alias("size"))
    before = sizes.select("conv", "piece", (F.sum("size").over(Window.partitionBy("conv").orderBy("piece"))
                                            - F.col("size")).alias("before"))
    ids = turns.select("conv_id", _key(F.col("conv_id")).alias("conv")).distinct()
    return lines.join(before, ["conv", "piece"]).join(ids, "conv").select(
        "conv_id", (F.col("before") + F.col("n")).alias("place"), "edit", "role", "text")
