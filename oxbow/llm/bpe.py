"""Byte-level BPE encoding and decoding by DuckDB recursive queries (operator 9).

Each Python worker keeps an in-process DuckDB connection with the merge table.
Texts are cut into segments at single spaces (no match of the split pattern
crosses such a place), each distinct segment is cut by the pattern, and the
distinct pieces become token-position rows. A recursive query joins adjacent
tokens to the merge table and contracts each piece's leftmost pair of minimum
rank until no pair is left. Decoding joins token positions to the vocabulary
and concatenates by an ordered aggregation.

Pieces of over ``SHORT`` bytes contract several pairs a round, each of which is
certain to come in the one-by-one order too:

* a pair that ranks below its neighbours, if no pair of lower rank stands within
  reach of a merge that could take one of its two tokens first, and no merge of
  its product ranks below it (then nothing earlier depends on it);
* the leftmost minimum of a bucket of bytes that is below those of both adjacent
  buckets too, where a bucket is as long as three of the longest tokens, so that
  nothing outside can reach it before. A piece's minimum is always among these;
* in pieces of over ``MIDDLE`` bytes, all pairs that share the lowest rank of three
  buckets (of a run of overlapping ones, ``aaaa``, every other, from its beginning
  on), if none of them there makes a token that merges with what stands beside it
  by a lower rank.

So rounds do not grow with a piece's length, and rows are bounded: a query holds at
most ``ROWS`` rows (or one piece; its memory limit then follows the piece's length,
about ``ROW_BYTES`` a byte), a decode ``TOKENS``, and long texts are encoded and
decoded part by part.

The caches hold what was encoded or decoded last, ``CACHE_BYTES`` at most, and no
long segment or piece; they never change a result. Rows stay in their partition.

Defined cases: a null text is encoded as the empty text (no ids); texts and pieces
of any length are encoded whole; repeated rows give repeated results; ties go to the
leftmost pair; other columns, whatever their names, are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from oxbow.llm.common import map_texts

#: Pieces up to this many bytes contract one pair a round.
SHORT = 40
#: Pieces over this many bytes have the rule for runs too.
MIDDLE = 512
#: Rows (bytes of pieces) of a query, memory a row may take, and tokens of a decode.
ROWS, ROW_BYTES, TOKENS = 1 << 18, 1024, 1 << 18
#: Bytes of a worker's caches, and the longest segment or piece they keep.
CACHE_BYTES, CACHED = 200 << 20, 64
#: A vocabulary is shipped to the workers, so its file must not exceed this.
MAX_VOCABULARY_BYTES = 64 << 20
#: Bits for the position within a piece; piece number and rank stay above them.
_POS = 31
_MEMORY = 400 << 20

_ENCODE = f"""
WITH RECURSIVE state(k, tok, done) AS (
  SELECT k, tok, false FROM pieces
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT k, tok, lead(tok) OVER o AS tok2, lead(k) OVER o AS k2, lag(k) OVER o AS k0
     FROM state WHERE NOT done WINDOW o AS (ORDER BY k)),
   best AS (
     SELECT p.k >> {_POS} AS piece, min((m.rank << {_POS}) + (p.k & {(1 << _POS) - 1})) AS b
     FROM pairs p JOIN merges m ON m.pair = CASE WHEN p.k2 >> {_POS} = p.k >> {_POS}
                                                 THEN (p.tok << {_POS}) + p.tok2 ELSE -1 END
     GROUP BY 1),
   spot AS (SELECT piece, (piece << {_POS}) + (b & {(1 << _POS) - 1}) AS k, b >> {_POS} AS tok FROM best)
   SELECT p.k, CASE WHEN p.k = s.k THEN s.tok ELSE p.tok END, s.k IS NULL
   FROM pairs p LEFT JOIN spot s ON s.piece = p.k >> {_POS}
   WHERE s.k IS NULL OR p.k0 IS DISTINCT FROM s.k))
SELECT k >> {_POS} AS piece, tok FROM state WHERE done ORDER BY k
"""


def _encode_long(bucket_bits: int, runs: bool) -> str:
    """The recursion for longer pieces, with the rule for runs or without it. ``reach_l`` (``reach_r``) of a merge is the
    length of the longest left (right) part that could take its first (second)
    token by a merge of no higher rank, null if its product may go on too early.
    ``pair`` holds the pair of a token with the one behind it, -1 at a piece's end."""
    mask, far, up = (1 << _POS) - 1, 1 << 62, _POS - bucket_bits
    run_rule = f"""
   around AS (
     SELECT k, r, e2, lag(e) OVER o AS e0, lag(tok) OVER o AS tok0, lead(k, 2) OVER o AS k3, lead(tok, 2) OVER o AS tok3
     FROM near WINDOW o AS (ORDER BY k)),
   cand AS MATERIALIZED (
     SELECT n.k, n.r, n.k >> {bucket_bits} AS bucket,
            coalesce(m1.rank < n.r, false) OR coalesce(m2.rank < n.r, false) OR coalesce(m3.rank < n.r, false) AS early
     FROM around n JOIN hood ON hood.bucket = n.k >> {bucket_bits} AND n.r = hood.h >> {_POS}
     LEFT JOIN merges m1 ON m1.pair = CASE WHEN n.e0 = n.k THEN (n.tok0 << {_POS}) + n.r ELSE -1 END
     LEFT JOIN merges m2 ON m2.pair = CASE WHEN n.k3 = n.e2 THEN (n.r << {_POS}) + n.tok3 ELSE -1 END
     LEFT JOIN merges m3 ON m3.pair = (n.r << {_POS}) + n.r),
   early AS (SELECT DISTINCT bucket + unnest([-1, 0, 1]) AS bucket FROM cand WHERE early),
   marked AS (
     SELECT n.*, c.k IS NOT NULL AS c, row_number() OVER (ORDER BY n.k) AS n
     FROM near n LEFT JOIN (SELECT k FROM cand ANTI JOIN early USING (bucket)) c ON c.k = n.k),
   begun AS (SELECT *, c AND NOT coalesce(lag(c) OVER (ORDER BY k), false) AS begins FROM marked),
   near_runs AS (
     SELECT *, max(CASE WHEN begins THEN (n << 1) + (before IS DISTINCT FROM r)::INT END)
                 OVER (ORDER BY k ROWS UNBOUNDED PRECEDING) AS run FROM begun),""" if runs else ""
    in_run = " OR (c AND run & 1 = 1 AND (n.n - (run >> 1)) % 2 = 0)" if runs else ""
    return f"""
WITH RECURSIVE state(k, e, tok, pair, done) AS (
  SELECT k, e, tok, pair, false FROM pieces
  UNION ALL
  (WITH ranked AS MATERIALIZED (
     SELECT s.k, s.e, s.tok, m.rank AS r, m.reach_l, m.reach_r
     FROM state s LEFT JOIN merges m ON m.pair = s.pair WHERE NOT s.done),
   least_of AS MATERIALIZED (
     SELECT k >> {bucket_bits} AS bucket, min((r << {_POS}) + (k & {mask})) AS v
     FROM ranked WHERE r IS NOT NULL GROUP BY 1),
   hood AS MATERIALIZED (
     SELECT bucket, v, least(v, CASE WHEN b0 = bucket - 1 AND bucket >> {up} = b0 >> {up} THEN v0 END,
                             CASE WHEN b2 = bucket + 1 AND bucket >> {up} = b2 >> {up} THEN v2 END) AS h
     FROM (SELECT bucket, v, lag(bucket) OVER o AS b0, lag(v) OVER o AS v0, lead(bucket) OVER o AS b2, lead(v) OVER o AS v2
           FROM least_of WINDOW o AS (ORDER BY bucket))),
   first AS (SELECT ((bucket >> {up}) << {_POS}) + (v & {mask}) AS k FROM hood WHERE h = v),
   alive AS (SELECT DISTINCT bucket >> {up} AS piece FROM least_of),
   near AS (
     SELECT *, lead(e) OVER o AS e2, lag(r) OVER o AS before, lead(r) OVER o AS behind,
            k - lag(k, 2) OVER o AS l1, k - lag(k, 5) OVER o AS l2,
            least(lag(r, 2) OVER o, lag(r, 3) OVER o, lag(r, 4) OVER o) AS least_l,
            lead(e, 3) OVER o - lead(e) OVER o AS r1, lead(e, 6) OVER o - lead(e) OVER o AS r2,
            least(lead(r, 2) OVER o, lead(r, 3) OVER o, lead(r, 4) OVER o) AS least_r
     FROM ranked WINDOW o AS (ORDER BY k)),{run_rule}
   flagged AS (
     SELECT n.k, n.e, n.tok, n.e2, n.r, alive.piece IS NULL AS done,
            coalesce(first.k IS NOT NULL OR (
              r IS NOT NULL AND coalesce(before, {far}) > r AND coalesce(behind, {far}) >= r
              AND (reach_l < coalesce(l1, {far}) OR (coalesce(least_l, {far}) > r AND reach_l < coalesce(l2, {far})))
              AND (reach_r < coalesce(r1, {far}) OR (coalesce(least_r, {far}) >= r AND reach_r < coalesce(r2, {far})))){in_run},
              false) AS flag
     FROM {"near_runs" if runs else "near"} n LEFT JOIN first ON first.k = n.k LEFT JOIN alive ON alive.piece = n.k >> {_POS}),
   merged AS (SELECT k, done, flag, CASE WHEN flag THEN e2 ELSE e END AS e, CASE WHEN flag THEN r ELSE tok END AS tok
              FROM flagged),
   moved AS (
     SELECT k, e, tok, done, lag(flag) OVER o AS gone,
            CASE WHEN flag THEN lead(k, 2) OVER o ELSE lead(k) OVER o END AS next_k,
            CASE WHEN flag THEN lead(tok, 2) OVER o ELSE lead(tok) OVER o END AS next_tok
     FROM merged WINDOW o AS (ORDER BY k))
   SELECT k, e, tok, CASE WHEN next_k = e THEN (tok << {_POS}) + next_tok ELSE -1 END, done
   FROM moved WHERE gone IS NOT TRUE))
SELECT k >> {_POS} AS piece, tok FROM state WHERE done ORDER BY k
"""


#: Characters encoded at a time, about.
_STEP_CHARS = 2_000_000
_DECODE = """
SELECT text, list(bytes ORDER BY pos) AS parts
FROM (SELECT text, pos, bytes FROM tokens JOIN vocabulary USING (id)) GROUP BY text ORDER BY text
"""
#: White space other than the space and the line end: such texts are cut with more care.
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]").search


def read_ranks(path: str) -> bytes:
    """The rank file (``base64 rank`` lines), read on the driver, size checked."""
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary over {MAX_VOCABULARY_BYTES} bytes")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (x.split() for x in data.splitlines() if x)}


def merge_rows(ranks: dict[bytes, int]) -> Iterator[tuple[int, int, int | None, int | None]]:
    """(pair, rank, reach_l, reach_r) of each two tokens that make a third."""
    rows = sorted((r, t[:i], t[i:]) for t, r in ranks.items() for i in range(1, len(t))
                  if t[:i] in ranks and t[i:] in ranks)
    lists: tuple = defaultdict(list), defaultdict(list)  # token -> (rank, longest other part so far), as second, first
    for r, a, b in rows:
        for side, token, other in ((0, b, a), (1, a, b)):
            known = lists[side][token]
            known.append((r, max(len(other), known[-1][1] if known else 0)))
    second, first = ({t: tuple(zip(*of)) for t, of in side.items()} for side in lists)

    def reach(of: dict, token: bytes, upto: int) -> int:
        if token not in of:
            return 0
        at = bisect_right(of[token][0], upto)
        return of[token][1][at - 1] if at else 0

    for r, a, b in rows:
        pair = (ranks[a] << _POS) + ranks[b]
        early = min(of[a + b][0][0] if a + b in of else r for of in (second, first)) < r
        yield (pair, r, None, None) if early else (pair, r, reach(second, a, r), reach(first, b, r - 1))


class Codec:
    """Encoder and decoder of one vocabulary, in one worker process."""

    def __init__(self, data: bytes, pattern: str):
        import duckdb
        import regex

        self.ranks = parse_ranks(data)
        self.tokens = {r: t for t, r in self.ranks.items()}
        ranks = self.ranks
        rows = list(merge_rows(ranks))
        pair, rank, reach_l, reach_r = (pa.array([r[i] for r in rows], pa.int64()) for i in range(4))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": f"{_MEMORY}B", "temp_directory": ""})
        self._table("merges", pair=pair, rank=rank, reach_l=reach_l, reach_r=reach_r)
        bits = max(7, (3 * max(map(len, ranks), default=1) - 1).bit_length())
        self.queries = _ENCODE, _encode_long(bits, False), _encode_long(bits, True)
        self._table("vocabulary", id=pa.array(self.tokens, pa.int64()),
                    bytes=pa.array(self.tokens.values(), pa.binary()))
        self.byte_ids = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.token_ids = {t: r.to_bytes(4, "little") for t, r in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        space = regex.compile(r"(?<=\S) (?=\S)")
        self.at_spaces, self.space = space.split, space.search
        self.first_ids: dict[str, bytes] = {}    # segments that begin a text
        self.segment_ids: dict[str, bytes] = {}  # segments behind a space (left out of the key)
        self.piece_ids: dict[str, bytes] = {}
        self.cached = 0                          # bytes of the three, about

    def _table(self, name: str, **columns) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _query(self, sql: str, name: str, **columns) -> pa.Table:
        self.con.register(name, pa.table(columns))
        out = self.con.sql(sql).to_arrow_table()
        self.con.unregister(name)
        return out

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece: a piece that is a token is that token; all others
        start from their bytes in a recursive query."""
        out = [self.token_ids.get(p) for p in pieces]
        rest = [i for i, p in enumerate(out) if p is None]
        kinds: tuple = [], [], []
        for i in rest:
            kinds[(len(pieces[i]) > SHORT) + (len(pieces[i]) > MIDDLE)].append(i)
        for query, of in zip(self.queries, kinds):
            part, size = [], 0
            for i in of:
                if part and size + len(pieces[i]) > ROWS:
                    self._contract(query, pieces, part, out)
                    part, size = [], 0
                part.append(i)
                size += len(pieces[i])
            if part:
                self._contract(query, pieces, part, out)
        return out

    def _contract(self, query: str, pieces: list[bytes], part: list[int], out: list) -> None:
        """Put the ids of ``part`` of the pieces into ``out``."""
        sizes = np.array([len(pieces[i]) for i in part], np.int64)
        ends = np.cumsum(sizes)
        number = np.repeat(np.arange(len(part), dtype=np.int64), sizes)
        k = (number << _POS) + np.arange(ends[-1], dtype=np.int64) - np.repeat(ends - sizes, sizes)
        tok = self.byte_ids[np.frombuffer(b"".join([pieces[i] for i in part]), np.uint8)]
        columns = {"k": k, "tok": tok}
        if query is not _ENCODE:
            pair = np.append((tok[:-1] << _POS) + tok[1:], -1)
            pair[ends - 1] = -1
            columns |= {"e": k + 1, "pair": pair}
        large = len(k) * ROW_BYTES > _MEMORY
        if large:  # a single piece
            self.con.execute(f"SET memory_limit = '{len(k) * ROW_BYTES}B'")
        found = self._query(query, "pieces", **columns)
        if large:
            self.con.execute(f"SET memory_limit = '{_MEMORY}B'")
        ids = found.column("tok").to_numpy().astype("<u4").tobytes()
        stops = 4 * np.cumsum(np.bincount(found.column("piece").to_numpy(), minlength=len(part)))
        start = 0
        for i, stop in zip(part, stops.tolist()):
            out[i] = ids[start:stop]
            start = stop

    def _learn(self, first: set[str], later: set[str]) -> None:
        """Encode the segments that are not known yet, each distinct piece once."""
        known = self.piece_ids
        cut = [(self.first_ids, list(first), list(map(self.pieces, first))),
               (self.segment_ids, list(later), list(map(self._behind_space, later)))]
        new = list({p for _, _, found in cut for ps in found for p in ps}.difference(known))
        known.update(zip(new, self.encode_pieces([p.encode() for p in new]), strict=True))
        entries = [(known, new)]
        for to, names, found in cut:
            to.update(zip(names, [known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]) for ps in found]))
            entries.append((to, names))
        for cache, names in entries:
            sizes = list(map(len, names))
            # a segment's ids take about two bytes a letter
            self.cached += 200 * len(names) + 4 * sum(sizes)
            if sizes and max(sizes) > CACHED:
                self.long += [(cache, s) for s in names if len(s) > CACHED]

    def _forget(self) -> None:
        """Drop long entries, and all of them if they take too much room."""
        for cache, s in self.long:
            self.cached -= 200 + 4 * len(s)
            del cache[s]
        self.long = []
        if self.cached > CACHE_BYTES:
            for cache in (self.first_ids, self.segment_ids, self.piece_ids):
                cache.clear()
            self.cached = 0

    def _behind_space(self, s: str) -> list[str]:
        """Pieces of a segment behind a space. Letters alone are one piece, and
        a stop or comma after them another; the pattern cuts all else."""
        if s.isalpha():
            return [" " + s]
        if s[-1] in ".," and s[:-1].isalpha():
            return [" " + s[:-1], s[-1]]
        return self.pieces(" " + s)

    def _segments(self, text: str) -> list[str]:
        """Cut at each single space: one with no white space on either side."""
        if ("  " in text or "\n " in text or " \n" in text or text[:1] == " " or text[-1:] == " "
                or _RARE_SPACE(text)):
            return self.at_spaces(text)
        return text.split(" ")

    def _parts(self, texts: list[str | None]) -> Iterator[list[tuple[int, bool, str]]]:
        """(text, whether it begins it, part), about ``_STEP_CHARS`` at a time; long
        texts are cut at single spaces."""
        batch, size = [], 0
        for i, t in enumerate(texts):
            t, start = t or "", 0
            while True:
                cut = self.space(t, start + _STEP_CHARS) if len(t) - start > _STEP_CHARS else None
                part = t[start:cut.start()] if cut else t[start:] if start else t
                batch.append((i, start == 0, part))
                size += len(part)
                if size >= _STEP_CHARS:
                    yield batch
                    batch, size = [], 0
                if not cut:
                    break
                start = cut.end()
        if batch:
            yield batch

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        for parts in self._parts(texts):
            split = [self._segments(t) for _, _, t in parts]
            first = {s[0] for s, (_, begins, _) in zip(split, parts) if begins}.difference(self.first_ids)
            later: set[str] = set()
            for s, (_, begins, _) in zip(split, parts):
                if begins:
                    s[0], head = "", s[0]  # the empty segment is known to both and has no ids
                later.update(set(s).difference(self.segment_ids))
                if begins:
                    s[0] = head
            later.discard("")
            self.long = []
            if first or later:
                self._learn(first, later)
            begin, find = self.first_ids, self.segment_ids.__getitem__
            for s, (i, begins, _) in zip(split, parts):
                out[i].append(begin[s[0]] + b"".join(map(find, s[1:])) if begins else b"".join(map(find, s)))
            self._forget()
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes of each id sequence: token positions join the vocabulary,
        and an ordered aggregation strings the tokens' bytes together, ``TOKENS`` at a time."""
        sizes = np.array([len(e) // 4 for e in encoded], np.int64)
        text = np.repeat(np.arange(len(encoded)), sizes)
        ids = np.frombuffer(b"".join(encoded), "<u4")
        out: list[list[bytes]] = [[] for _ in encoded]
        for at in range(0, len(ids), TOKENS):
            some = ids[at:at + TOKENS].astype(np.int64)
            found = self._query(_DECODE, "tokens", text=text[at:at + TOKENS],
                                pos=np.arange(len(some), dtype=np.int64), id=some)
            for batch in found.to_batches():
                lists = batch.column("parts")
                tokens = lists.flatten()  # one run of bytes, in order; the lists' ends cut it into texts
                ends = np.frombuffer(tokens.buffers()[1], _offset_type(tokens))[tokens.offset:tokens.offset + len(tokens) + 1]
                data = memoryview(tokens.buffers()[2]) if len(tokens) else b""
                stops = np.cumsum(pa.compute.list_value_length(lists).to_numpy())
                start = 0
                for i, stop in zip(batch.column("text").to_pylist(), stops.tolist()):
                    out[i].append(bytes(data[ends[start]:ends[stop]]))
                    start = stop
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]


def _offset_type(values: pa.Array):
    return np.int64 if pa.types.is_large_binary(values.type) else np.int32


_CODECS: dict[tuple[bytes, str], Codec] = {}


def codec(data: bytes, pattern: str) -> Codec:
    """The worker's codec of a vocabulary; built once, kept for later batches."""
    key = (hashlib.sha256(data).digest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(data, pattern)
    return _CODECS[key]


def _steps(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts of about ``_STEP_CHARS`` together, so that few ids are held at a time."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= _STEP_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def encode(docs: DataFrame, ranks: bytes, pattern: str, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``carry`` columns, ``n_tokens`` and ``ids`` (binary, little-endian uint32)."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)  # at most MAX_VOCABULARY_BYTES

    def make():
        c = codec(shared.value, pattern)

        def run(texts):
            ids = c.encode(texts)
            return [[len(x) // 4 for x in ids], ids]
        return run
    return map_texts(docs, list(carry), make, "n_tokens long, ids binary")


def round_trip(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode whole texts, then
    decode the ids; the ids themselves need not leave the task."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def make():
        c = codec(shared.value, pattern)

        def run(texts):
            out = []
            for some in _steps(texts):
                ids = c.encode(some)
                out += [(len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(d).hexdigest())
                        for x, d in zip(ids, c.decode(ids))]
            return list(zip(*out)) or [(), (), ()]
        return run
    return map_texts(docs, ["doc_id"], make, "n_tokens long, ids_sha256 string, decoded_sha256 string")
