"""Operators that work on each text: 1, 8, 9, 10 and the WARC builder (5)."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from oxbow.llm import bpe, licenses, quality_rules, token_counts, warc
from tests.llm.conftest import WORD, odd_rows, prose, tuples

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
VOCABULARY = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
REFERENCE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=VOCABULARY, special_tokens={})
CODEC = bpe.Codec(RANKS, P.PATTERN)


def greedy(word: bytes, begin: set, inner: set) -> int:
    """Longest match, piece by piece; 1 if the word cannot be cut."""
    at, n = 0, 0
    while at < len(word):
        entries = inner if at else begin
        end = next((e for e in range(len(word), at, -1) if word[at:e] in entries), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


@settings(max_examples=300, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=5).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=25),
       st.sets(st.binary(min_size=1, max_size=4).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=15),
       st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=8))
def test_automaton_counts_greedy_pieces(begin, inner, words):
    plain = token_counts.Automaton(begin)
    marked = token_counts.Automaton([*begin, *(b"##" + t for t in inner)], b"##")
    for w in words:
        assert plain.count(w) == greedy(w, begin, begin)
        assert marked.count(w) == greedy(w, begin, inner)


def test_token_counts(spark, odd, none):
    pieces = regex.compile(P.PATTERN)
    entries = set(VOCABULARY)
    want = [(i, len(found), sum(greedy(w.encode(), entries, entries) for w in found))
            for i, t, *_ in odd_rows() for found in [pieces.findall(t or "")]]
    assert tuples(token_counts.token_counts(odd, RANKS, P.PATTERN)) == sorted(want, key=repr)
    assert token_counts.token_counts(none, RANKS, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), min_size=1, max_size=4))
def test_bpe_encodes_as_tiktoken(texts):
    encoded = CODEC.encode(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoded] == [REFERENCE.encode_ordinary(t) for t in texts]
    assert CODEC.decode(encoded) == [t.encode() for t in texts]


@pytest.mark.parametrize("text", [
    "a" * 5000, "ab" * 3000, "\x1c\x1d \x85  x    y", " leading", "trailing ", "a  b", "\n\n a\t b",
    "".join(random.Random(3).choice("abcdefghij") for _ in range(3000)), "<|endoftext|>", "don't we'll 123 4½",
    "日本語のテキスト 混在", "é" * 700])
def test_bpe_special_texts(text):
    ids = CODEC.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == REFERENCE.encode_ordinary(text)
    assert CODEC.decode([ids]) == [text.encode()]


def one_by_one(piece: bytes, ranks: dict) -> list[int]:
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_bpe_pieces_of_any_length():
    rng = random.Random(5)
    pieces = [bytes(rng.choice(b"etaoins ") for _ in range(rng.randint(1, 60))) for _ in range(200)]
    pieces += [bytes(rng.choice(alphabet) for _ in range(rng.randint(100, 900)))
               for alphabet in (b"etaoinshrdlu", b"a", b"ab", b" \n", bytes(range(256)), "漢字中文的".encode()) for _ in range(8)]
    got = [np.frombuffer(x, "<u4").tolist() for x in CODEC.encode_pieces(pieces)]
    assert got == [[VOCABULARY[p]] if p in VOCABULARY else one_by_one(p, VOCABULARY) for p in pieces]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.binary(min_size=2, max_size=6).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=40, unique=True),
       st.lists(st.binary(min_size=1, max_size=400).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=1, max_size=5),
       st.randoms(use_true_random=False))
def test_bpe_rounds_keep_the_order_of_any_vocabulary(tokens, pieces, rng):
    """Ranks in any order, products below their parts among them."""
    rng.shuffle(tokens)
    ranks = {bytes([i]): i for i in range(256)} | {t: 256 + i for i, t in enumerate(tokens)}
    data = b"".join(base64.b64encode(t) + b" %d\n" % r for t, r in ranks.items())
    own = bpe.Codec(data, P.PATTERN)
    old, (bpe.SHORT, bpe.MIDDLE) = (bpe.SHORT, bpe.MIDDLE), rng.choice([(0, 0), (0, 1000), (5, 20), (24, 512)])
    try:
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode_pieces(pieces)]
    finally:
        bpe.SHORT, bpe.MIDDLE = old
    assert got == [[ranks[p]] if p in ranks else one_by_one(p, ranks) for p in pieces]


def tokens_of(text):
    return np.array(REFERENCE.encode_ordinary(text), "<u4").tobytes()


def test_bpe_many_long_pieces_and_long_texts():
    """Memory stays bounded: many pieces of 300 bytes, Han text, a text of 12 M characters."""
    rng = random.Random(6)
    pieces = ["".join(rng.choices("etaoinshrdlucm", k=300)) for _ in range(500)]
    han = [chr(rng.randint(0x4E00, 0x9000)) for _ in range(3000)]
    # distinct texts, so that nothing comes from a cache
    texts = [" ".join(pieces), "\n".join("".join(rng.choices(han, k=110)) for _ in range(2000)),
             "".join(rng.choices(han, k=3000)), "x" * 50_000]
    for text in texts:
        ids = CODEC.encode([text])[0]
        assert ids == tokens_of(text)
        assert CODEC.decode([ids]) == [text.encode()]
    words = [prose(s, 1) for s in range(5000)]
    long = " ".join(rng.choices(words, k=2_200_000))
    assert len(long) > 10_000_000
    ids = CODEC.encode([None, long, "a b"])
    assert ids[1] == tokens_of(long) and ids[0] == b"" and ids[2] == tokens_of("a b")
    assert CODEC.decode(ids) == [b"", long.encode(), b"a b"]
    assert CODEC.cached < bpe.CACHE_BYTES + (64 << 20)
    assert not any(len(s) > bpe.CACHED for c in (CODEC.first_ids, CODEC.segment_ids, CODEC.piece_ids) for s in c)



def test_bpe_small_cache_changes_nothing(monkeypatch):
    texts = [t for _, t, *_ in odd_rows()]
    want = CODEC.encode(texts)
    monkeypatch.setattr(bpe, "CACHE_BYTES", 3)
    monkeypatch.setattr(bpe, "ROWS", 3000)
    monkeypatch.setattr(bpe, "TOKENS", 4001)
    small = bpe.Codec(RANKS, P.PATTERN)
    got = [small.encode([t])[0] for t in texts]
    assert got == want and [small.decode([x])[0] for x in got] == [(t or "").encode() for t in texts]


def test_round_trip(odd, none):
    def want(i, t):
        ids = REFERENCE.encode_ordinary(t or "")
        return (i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())
    assert tuples(bpe.round_trip(odd, RANKS, P.PATTERN)) == sorted((want(i, t) for i, t, *_ in odd_rows()), key=repr)
    assert bpe.round_trip(none, RANKS, P.PATTERN).count() == 0
    ids = bpe.encode(odd.where("doc_id = 7"), RANKS, P.PATTERN).first()
    assert ids.n_tokens == len(ids.ids) // 4


def brute_measures(text):
    words = WORD.findall(text or "")
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {p for i, w in enumerate(wins) if wins.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(hit), len(lines), (text or "").count("!"))


def test_quality_measures_and_policy(odd, none):
    rows = [r for r in odd_rows() if len(r[1] or "") < 10_000]
    got = quality_rules.ledger(odd.where("coalesce(length(text), 0) < 10000"))
    assert tuples(got, *quality_rules.MEASURES) == sorted(((i, *brute_measures(t)) for i, t, *_ in rows), key=repr)
    for r in quality_rules.apply_policy(quality_rules.ledger(odd), "standard.1").collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept <= (not r.base_failed)
    assert quality_rules.apply_policy(quality_rules.ledger(none), "base.1").count() == 0


def test_quality_ablation(spark, odd):
    ledger = quality_rules.ledger(odd).cache()
    bits = [r.fail_bits & quality_rules.mask(quality_rules.POLICIES["standard.1"]) for r in ledger.collect()]
    for r in quality_rules.ablation(ledger, "standard.1").collect():
        assert r.failed == sum(b & r.bit != 0 for b in bits)
        assert r.failed_alone == sum(b == r.bit for b in bits)
    ledger.unpersist()


def test_license_rules(spark, odd, none):
    mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
           "associated documentation files (the \"Software\"), to deal in the Software without restriction. The above "
           "copyright notice and this permission notice shall be included in all copies or substantial portions of "
           "the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED.")
    rows = [(1, mit), (2, mit.split(". ", 1)[1]), (3, None), (4, "Licensed under the Apache License, Version 2.0."),
            (5, "x\nReleased under the MIT License.\n" * 2), (6, "not Released under the MIT License")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].licenses for i in range(1, 7)] == ["MIT", "", "", "Apache-2.0", "MIT", ""]
    assert got[2].sentence_ids == "mitNotice,asIs" and got[5].n_sentences == 2
    odd_found = {r.doc_id: r.licenses for r in licenses.scan(odd).collect()}
    assert odd_found[15] == "MIT,CC-BY-NC-4.0" and len(licenses.scan(odd).collect()) == len(odd_rows())
    assert licenses.scan(none).count() == 0


def fields(record: str) -> dict:
    head = record.split("\r\n\r\n", 1)[0].split("\r\n")[1:]
    return dict(x.split(": ", 1) for x in head)


def test_warc_derivatives(spark, tmp_path):
    html = ("<html><head><title>A &amp; B</title><style>p{}</style><script>var t='</p>';</script></head>"
            "<body><!-- no --><p>One  two</p><p>&lt;three&gt;\t&amp;lt; café</body>")
    pages = spark.createDataFrame([(1, "http://x/", html), (2, None, None), (3, "http://y/", ""), (1, "http://x/", html)],
                                  "page_id long, url string, html string")
    records = warc.responses(pages, "page_id", "2024-01-01T00:00:00Z")
    rows = warc.derive(records, keep=("page_id",)).collect()
    assert len(rows) == 8
    source = fields(records.where("page_id = 1").first().record)
    by = {(r.page_id, r.warc_type): r for r in rows}
    text, meta = by[1, "conversion"], by[1, "metadata"]
    assert text.block == "A & B\nOne two\n<three> &lt; café"
    assert text.refers_to == meta.refers_to == source["WARC-Record-ID"] and meta.concurrent_to == text.record_id
    assert text.source_digest == source["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    for r in rows:
        head, body = fields(r.record), r.record.split("\r\n\r\n", 1)[1]
        assert body == r.block and int(head["Content-Length"]) == len(body.encode())
        assert head["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(body.encode()).hexdigest()
        assert head["WARC-Refers-To"] == r.refers_to
    assert "title: A & B" in meta.block and "http-header: Content-Type: text/html" in meta.block
    assert "digest-match: true" in meta.block
    assert by[2, "conversion"].block == "" and "Target-URI" not in by[2, "conversion"].record.replace("WARC-Target-URI: \r\n", "")
    warc.save(warc.derive(records), f"{tmp_path}/out")
    import glob
    import gzip
    data = b"".join(gzip.open(f).read() for f in sorted(glob.glob(f"{tmp_path}/out/*.gz")))
    assert data.count(b"WARC/1.1\r\n") == 8 and data.endswith(b"\r\n\r\n")


def test_warc_odd_records(spark):
    rows = [(None,), ("",), ("WARC/1.1\r\nWARC-Type: request\r\n\r\nx",), ("WARC/1.1\r\nwarc-type: response",),
            ("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:1>\r\n\r\nHTTP/1.1 404 Gone",)]
    out = warc.derive(spark.createDataFrame(rows, "record string")).collect()
    assert sorted((r.warc_type, r.refers_to or "") for r in out) == [
        ("conversion", ""), ("conversion", "<urn:uuid:1>"), ("metadata", ""), ("metadata", "<urn:uuid:1>")]
    assert any("http-status: 404" in r.block for r in out)
    assert warc.derive(spark.createDataFrame([], "record string")).count() == 0
