"""Phrase collocation mining (13) against brute force."""

import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oxbow.llm import collocations as C
from tests.llm.conftest import SCHEMA, odd_rows, tuples

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        for n in range(1, longest + 1):
            for i in range(len(words) - n + 1):
                yield " ".join(words[i:i + n])


def brute(rows, longest=3, least=10, top=2000, pct=50):
    """rows: (text, lang)."""
    out = []
    for lang in {x or "und" for _, x in rows if x is None or x}:
        f = Counter(g for t, x in rows if (x or "und") == lang for g in runs(t, longest))
        n = sum(v for k, v in f.items() if " " not in k)
        cand = {k: v for k, v in f.items() if " " in k and v >= least}
        found, longer = [], {}
        for k, b in cand.items():
            for part in set(runs(k, longest)) - {k}:
                longer[part] = max(b, longer.get(part, 0))
        for k, a in cand.items():
            w = k.split(" ")
            cuts = [(1_000_000 * a * a // (f[" ".join(w[:i])] * f[" ".join(w[i:])]), i) for i in range(1, len(w))]
            score, i = min(cuts)
            if 100 * longer.get(k, -1) < pct * a:
                found.append((-score, -a, k.encode(), k, f[" ".join(w[:i])], f[" ".join(w[i:])]))
        for rank, (s, a, _, k, le, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, k, -a, le, r, n, -s))
    return sorted(out, key=repr)


COLS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def corpus(seed, n):
    rng = random.Random(seed)
    word = ["the", "The", "of", "a", "new", "york", "city", "été", "über", "x\x00y", "\x1c", "Is", "to"]
    gap = [" ", "  ", "\t", ". ", ", ", "\n", " \x0b", "! "]
    return [("".join(rng.choice(word) + rng.choices(gap, [30, 3, 3, 2, 2, 1, 1, 1])[0] for _ in range(rng.randint(0, 90))),
             rng.choice(["en", "de", None])) for _ in range(n)]


def test_collocations(spark, odd, none):
    rows = [(r[1], r[2]) for r in odd_rows()]
    for least, longest in ((10, 3), (2, 4)):
        got = C.collocations(odd, longest=longest, least=least)
        assert got.columns == list(COLS)
        assert tuples(got) == brute(rows, longest, least)
    assert C.collocations(none).count() == 0


def test_collocations_of_dense_texts(spark):
    rows = corpus(3, 300)
    df = spark.createDataFrame([(i, t, x, "a", 1) for i, (t, x) in enumerate(rows)], SCHEMA).repartition(5)
    clash = df.select("*", *[F.lit("z").alias(c) for c in ("print", "n", "phrase", "f", "words", "rank", "part", "cut")])
    for kw in ({}, {"longest": 4, "least": 3}, {"longest": 2, "least": 1, "top": 7}, {"inside_pct": 90, "least": 5}):
        args = {"longest": 3, "least": 10, "top": 2000} | kw
        want = brute(rows, args["longest"], args["least"], args["top"], args.get("inside_pct", 50))
        assert want
        assert tuples(C.collocations(clash, **kw)) == want


def test_collisions_do_not_change_counts(spark, monkeypatch):
    """A full bitmap lets everything through; equal fingerprints part by text."""
    rows = corpus(4, 120)
    df = spark.createDataFrame([(i, t, x, "a", 1) for i, (t, x) in enumerate(rows)], SCHEMA)
    assert tuples(C.collocations(df, max_bits=C._ROW_BITS)) == brute(rows)
    poly = C._Polynomial()
    data, seen = next(C.chunks([t.encode() for t, _ in rows], 2, 1 << 30))
    words = C.Words(data, seen, "en", poly)
    at = words.runs(1)
    few = words.prints(at, 1) % 3  # nearly all words collide
    head = C.pointers(few, at, words.same_word, lambda i: words.text(i, 1))
    assert [words.text(int(i), 1) for i in head] == [words.text(int(i), 1) for i in at]
    first = {}
    assert head.tolist() == [first.setdefault(words.text(int(i), 1), h) for i, h in zip(at, head.tolist())]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aB \t.\n", max_size=60), max_size=4), st.integers(1, 30), st.integers(1, 4))
def test_chunks_count_each_run_once(texts, size, longest):
    poly, got = C._Polynomial(), Counter()
    for data, seen in C.chunks([t.encode() for t in texts], longest - 1, size):
        words = C.Words(data, seen, "en", poly)
        for n in range(1, longest + 1):
            at = words.runs(n)
            got.update(words.text(int(i), n) for i in at)
            prints = words.prints(at, n)
            assert len(np.unique(prints)) == len({words.text(int(i), n) for i in at})
    assert got == Counter(g for t in texts for g in runs(t, longest))


def test_a_long_text_without_breaks():
    rng = random.Random(1)
    text = " ".join(rng.choice("abcde") * rng.randint(1, 3) for _ in range(200_000))
    poly, got = C._Polynomial(), Counter()
    for data, seen in C.chunks([text.encode()], 2, 50_000):
        assert len(data) <= 50_100
        words = C.Words(data, seen, "en", poly)
        for n in (1, 2, 3):
            got.update(words.text(int(i), n) for i in words.runs(n))
    assert got == Counter(runs(text, 3))
