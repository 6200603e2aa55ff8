"""Phrase collocation mining by Rabin-Karp fingerprints (operator 13).

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into
words ``[^\\x20\\x09]+``. Prefix polynomials over the bytes of a chunk of texts
(numpy, modulo 2**64) give the fingerprint of any run of words by one
subtraction and one product, without building its text.

1. Every one- and two-word run is hashed; a shuffle adds up the occurrences of
   each fingerprint. The fingerprints seen ``least`` times become a bitmap.
2. Longer runs are hashed, level by level, where both shorter runs inside them
   are in the bitmap (no run is more frequent than a run inside it), and are
   counted and mapped in the same way.
3. The texts are read once more. Occurrences in the bitmaps are grouped by
   fingerprint under a pointer to their first occurrence in the chunk, each is
   compared with the words at that pointer (words byte by byte, longer runs word
   by word), and those that differ -- collisions -- get a pointer of their own.
   Only these phrases are written out, and a shuffle adds up their counts by text.

So a collision, in the fingerprint or in the bitmap, costs a comparison and never
changes a count: fingerprints only choose which phrases are written out. The
pointer stays with its chunk, where the text is; what goes back from the shuffle
to the texts is the bitmap, ``MAX_BITS`` bits at most (32 MB) at any input size.
If more fingerprints are frequent than that can tell apart, more phrases are
written out and shuffled, with the same result.

Defined cases: a null text is empty, an empty one has no words; a null ``lang``
is ``und``; texts of any length are read whole, in chunks that overlap by the
longest run less one word; ties in the report are broken by count, then by the
UTF-8 bytes of the phrase; repeated rows count each; other columns, whatever
their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oxbow.llm.common import materialize
from oxbow.session import ship_package

#: Upper bound of the bitmap of frequent fingerprints, in bits.
MAX_BITS = 1 << 28
#: Bits a frequent fingerprint should have for itself.
BITS_EACH = 64
#: Bits of one row of ``bitmap_construct_agg``.
_ROW_BITS = 8 * 4096
#: Bytes of text hashed at a time.
CHUNK = 1 << 20
#: Parts of a language that are ranked on their own before the last ranking.
_RANK_PARTS = 64
_SPACE, _BREAK = 0x20, 0x0A
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\x0d",
                        b"abcdefghijklmnopqrstuvwxyz " + 9 * b"\n")
#: Fixed seed of the polynomial's base and of its value for each byte.
_SEED = 13


def chunks(texts: list[bytes], context: int, size: int = CHUNK) -> Iterator[tuple[bytes, int]]:
    """(folded bytes, leading words that the chunk before has counted already).

    Chunks hold whole texts, or whole pieces of one text, of about ``size`` bytes
    together; a longer piece is cut between words, and ``context`` words are
    repeated."""
    part, total = [], 0
    for text in texts:
        data = text.translate(_FOLD)
        if part and total + len(data) > size:
            yield b"\n".join(part), 0
            part, total = [], 0
        seen, head = 0, 0  # words and bytes repeated from the chunk before
        while len(data) > size:
            cut = data.rfind(b"\n", head, max(size, head))
            if cut < 0:
                cut = data.rfind(b" ", head + 1, max(size, head))
            if cut <= head:  # a word over the size: up to its end
                ends = [e for e in (data.find(b" ", max(size, head + 1)), data.find(b"\n", max(size, head + 1))) if e > 0]
                cut = min(ends, default=len(data))
            yield data[:cut], seen
            again = [] if data[cut:cut + 1] != b" " else re.findall(rb"[^ ]+", data[data.rfind(b"\n", 0, cut) + 1:cut])
            again = again[len(again) - min(context, len(again)):]
            seen = len(again)
            repeated = b"".join(w + b" " for w in again)
            data, head = repeated + data[cut + 1:], len(repeated)
        if seen:
            yield data, seen
        else:
            part.append(data)
            total += len(data) + 1
    if part:
        yield b"\n".join(part), 0


class _Polynomial:
    """Powers of an odd base and its inverse modulo 2**64, as long as needed."""

    def __init__(self):
        rng = np.random.default_rng(_SEED)
        self.values = rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(1 << 61, 1 << 63)) * 2 + 1
        self.base, self.inverse = np.uint64(base % (1 << 64)), np.uint64(pow(base, -1, 1 << 64))
        self.powers = self.back = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.powers) < n:
            ones = np.ones(1, np.uint64)
            self.powers = np.cumprod(np.concatenate([ones, np.full(n, self.base)]), dtype=np.uint64)
            self.back = np.cumprod(np.concatenate([ones, np.full(n, self.inverse)]), dtype=np.uint64)


class Words:
    """The words of a chunk, joined by single spaces, and their prefix polynomial."""

    def __init__(self, data: bytes, seen: int, lang: str, poly: _Polynomial):
        raw = np.frombuffer(data + b"\n", np.uint8)
        gap = (raw == _SPACE) | (raw == _BREAK)
        edge = np.flatnonzero(np.diff(gap.view(np.int8), prepend=np.int8(1)))
        first, last = edge[::2], edge[1::2]
        self.size = last - first
        piece = np.cumsum(raw == _BREAK)[first] if len(first) else first
        keep = ~gap
        keep[last] = True
        self.bytes = raw[keep]
        self.end = np.cumsum(self.size + 1) - 1
        self.start = self.end - self.size
        self.bytes[self.end] = _SPACE
        self.piece, self.seen = piece, seen
        poly.upto(len(self.bytes) + 1)
        terms = poly.values[self.bytes] * poly.powers[:len(self.bytes)]
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        self.back = poly.back[self.start]
        self.salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))

    def __len__(self) -> int:
        return len(self.size)

    def runs(self, n: int, counted: bool = True) -> np.ndarray:
        """First words of the runs of ``n`` words within a piece; ``counted``:
        less those that the chunk before has counted."""
        at = np.arange(max(0, len(self) - n + 1))
        ok = self.piece[at] == self.piece[at + n - 1]
        return at[ok & (at + n > self.seen)] if counted else at[ok]

    def prints(self, at: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the runs of ``n`` words from the words ``at``."""
        h = (self.prefix[self.end[at + n - 1]] - self.prefix[self.start[at]]) * self.back[at] + self.salt
        h ^= h >> np.uint64(32)
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        return h.view(np.int64)

    def text(self, at: int, n: int) -> str:
        return self.bytes[self.start[at]:self.end[at + n - 1]].tobytes().decode()

    def same_word(self, a: np.ndarray, b: np.ndarray, step: int = 1 << 18) -> np.ndarray:
        """Whether words ``a`` and ``b`` have the same bytes, pair by pair."""
        same = self.size[a] == self.size[b]
        for i in range(0, len(a), step):
            at = i + np.flatnonzero(same[i:i + step])
            if len(at):
                size = self.size[a[at]]
                ends = np.cumsum(size)
                inner = np.arange(ends[-1]) - np.repeat(ends - size, size)
                equal = (self.bytes[np.repeat(self.start[a[at]], size) + inner]
                         == self.bytes[np.repeat(self.start[b[at]], size) + inner])
                same[at] = np.logical_and.reduceat(equal, ends - size)
        return same


def pointers(prints: np.ndarray, at: np.ndarray, same: Callable, text: Callable) -> np.ndarray:
    """For each occurrence ``at`` the first occurrence of the same phrase: the
    first of its fingerprint, if ``same`` finds them equal, else by ``text``."""
    _, first, group = np.unique(prints, return_index=True, return_inverse=True)
    head = at[first][group]
    other = np.flatnonzero(~same(at, head))
    if len(other):  # collisions
        found: dict[str, int] = {}
        for i in other.tolist():
            head[i] = found.setdefault(text(int(at[i])), int(at[i]))
    return head


def in_bitmap(bitmap: np.ndarray, prints: np.ndarray) -> np.ndarray:
    bit = prints & (8 * len(bitmap) - 1)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def _frequent_runs(words: Words, n: int, bitmaps: list[np.ndarray], counted: bool = True) -> np.ndarray:
    """Runs of ``n`` words whose shorter runs are all in the bitmaps; ``bitmaps``
    has one for runs of up to two words, then one per further word."""
    at = words.runs(n, counted)
    for m in range(2, n):
        if m - 2 < len(bitmaps):
            for shift in range(n - m + 1):
                at = at[in_bitmap(bitmaps[m - 2], words.prints(at + shift, m))]
    return at


def _over_chunks(docs: DataFrame, longest: int, out: str, make: Callable) -> DataFrame:
    """Rows of ``out`` from ``make()(words, lang)``, a dict of columns or several."""
    ship_package(docs.sparkSession)
    slim = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                       F.encode(F.coalesce(F.col("text"), F.lit("")), "utf-8").alias("text"))

    def run(batches):
        fn, poly = make(), _Polynomial()
        for b in batches:
            texts: dict[str, list[bytes]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, of in texts.items():
                for data, seen in chunks(of, longest - 1):
                    yield from fn(Words(data, seen, lang, poly), lang)
    return slim.mapInArrow(run, out)


def _print_counts(docs: DataFrame, levels: tuple[int, ...], shared: list, longest: int) -> DataFrame:
    def make():
        bitmaps = [np.frombuffer(b.value, np.uint8) for b in shared]

        def fn(words, lang):
            for n in levels:
                at = _frequent_runs(words, n, bitmaps)
                prints, count = np.unique(words.prints(at, n), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(prints), pa.array(count)], names=["print", "n"])
        return fn
    return _over_chunks(docs, longest, "print long, n long", make)


def _bitmap(prints: DataFrame, most: int) -> bytes:
    """Bitmap of the fingerprints, by their low bits: at most ``most`` bits,
    built on the executors in rows of 4 kB."""
    count = prints.count()
    bits = min(most, max(_ROW_BITS, 1 << math.ceil(math.log2(max(1, count * BITS_EACH)))))
    bit = F.col("print").bitwiseAND(F.lit(bits - 1))
    rows = (prints.select((bit / _ROW_BITS).cast("long").alias("row"), (bit % _ROW_BITS).alias("bit"))
            .groupBy("row").agg(F.bitmap_construct_agg("bit").alias("bits")).collect())
    out = bytearray(bits // 8)
    for r in rows:  # at most MAX_BITS / _ROW_BITS
        out[r["row"] * 4096:(r["row"] + 1) * 4096] = r["bits"]
    return bytes(out)


def phrase_counts(docs: DataFrame, longest: int = 3, least: int = 10, max_bits: int = MAX_BITS) -> DataFrame:
    """lang, words, phrase, f: every phrase of up to ``longest`` words with at
    least ``least`` occurrences, and a row with words 0 and no phrase whose ``f``
    counts all words of the language. ``longest`` is at least 2."""
    sc = docs.sparkSession.sparkContext
    shared: list = []
    for n in range(2, longest + 1):
        counts = _print_counts(docs, (1, 2) if n == 2 else (n,), list(shared), longest)
        often = materialize(counts.groupBy("print").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("print"))
        shared.append(sc.broadcast(_bitmap(often, max_bits)))

    def make():
        bitmaps = [np.frombuffer(b.value, np.uint8) for b in shared]

        def rows(lang, n, phrases, counts):
            k = len(phrases)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * k, pa.string()), pa.array([n] * k, pa.int32()),
                 pa.array(phrases, pa.string()), pa.array(counts, pa.int64())], names=["lang", "words", "phrase", "f"])

        def fn(words, lang):
            if len(words) > words.seen:
                yield rows(lang, 0, [None], [len(words) - words.seen])
            at = words.runs(1, counted=False)
            prints = words.prints(at, 1)
            on = in_bitmap(bitmaps[0], prints)
            at, word = at[on], np.full(len(words), -1)
            word[at] = pointers(prints[on], at, words.same_word, lambda i: words.text(i, 1))
            for n in range(1, longest + 1):
                at = _frequent_runs(words, n, bitmaps)
                prints = words.prints(at, n)
                on = in_bitmap(bitmaps[max(0, n - 2)], prints)
                for i in range(n):
                    on &= word[at + i] >= 0  # a word that is not frequent
                at, prints = at[on], prints[on]

                def same(a, b, n=n):
                    return np.logical_and.reduce([word[a + i] == word[b + i] for i in range(n)])
                heads, count = np.unique(pointers(prints, at, same, lambda i, n=n: words.text(i, n)), return_counts=True)
                yield rows(lang, n, [words.text(i, n) for i in heads.tolist()], count)
        return fn
    found = _over_chunks(docs, longest, "lang string, words int, phrase string, f long", make)
    return (found.groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))
            .where((F.col("words") == 0) | (F.col("f") >= least)))


def _part(start: Column, length: Column) -> Column:
    return F.array_join(F.slice("split", start, length), " ")


def _scores(counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with their lowest-scoring cut."""
    phrases = counts.where("words >= 2").withColumn("split", F.split("phrase", " "))
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("left", _part(F.lit(1), F.col("k")))
            .withColumn("right", _part(F.col("k") + 1, F.col("words") - F.col("k"))).drop("split"))
    side = counts.where("words >= 1").select("lang", "phrase", "f")
    cuts = (cuts.join(side.toDF("lang", "left", "l"), ["lang", "left"])
            .join(side.toDF("lang", "right", "r"), ["lang", "right"]))
    whole = lambda c: F.col(c).cast("decimal(16,0)")  # noqa: E731  (products up to 38 digits are exact)
    cuts = cuts.withColumns({"top": whole("f") * whole("f") * F.lit(1_000_000).cast("decimal(7,0)"),
                             "low": whole("l") * whole("r")})
    cuts = cuts.withColumn("score", F.expr("top div low"))
    return (cuts.groupBy("lang", "words", "phrase", "f")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("lang", "words", "phrase", "f", "cut.l", "cut.r", "cut.score"))


def _inside(counts: DataFrame) -> DataFrame:
    """lang, phrase, longer: each run of two words and more inside a longer
    phrase, with the count of the most frequent one."""
    parts = (counts.where("words >= 3").withColumn("split", F.split("phrase", " "))
             .withColumn("m", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
             .withColumn("i", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1))))
    return (parts.select("lang", _part(F.col("i"), F.col("m")).alias("phrase"), "f")
            .groupBy("lang", "phrase").agg(F.max("f").alias("longer")))


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000,
                 inside_pct: int = 50, max_bits: int = MAX_BITS) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase; ``score`` is floor(1000000 a a / (l r)) for the cut
    into two parts, counted ``l`` and ``r``, that scores lowest (then the one with
    the shortest first part). Phrases inside a longer one that has at least
    ``inside_pct`` percent of their occurrences are left out. ``n`` counts the
    words of the language. Exact for counts of up to 15 digits (products up to 38).
    """
    counts = materialize(phrase_counts(docs, longest, least, max_bits))
    totals = counts.where("words = 0").select("lang", F.col("f").alias("n"))
    scored = _scores(counts).join(_inside(counts), ["lang", "phrase"], "left")
    scored = scored.where(F.col("longer").isNull() | (100 * F.col("longer") < inside_pct * F.col("f")))
    order = [F.desc("score"), F.desc("f"), F.asc("phrase")]
    # a language is ranked in parts first, so that the last ranking gets a bounded number of rows
    parted = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(_RANK_PARTS)))
    parted = (parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
              .where(F.col("rank") <= top))
    ranked = (parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
              .where(F.col("rank") <= top))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
