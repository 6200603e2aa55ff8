"""Operators that compare documents: exact, near and line dedup, mixing, toxicity, pipeline."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from oxbow.llm import common, components, exact_dedup, line_dedup, mixing, queries, simhash, toxicity
from oxbow.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tests.llm.conftest import WORD, odd_rows, prose, tuples


# ---- exact dedup ----------------------------------------------------------

def exact_brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        g = groups[norm(t)]
        out.append((i, min(g)[-1], len(g), hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("block", [4096, 7])
def test_exact_groups(odd, block):
    got = exact_dedup.exact_groups(odd, block).collect()
    want, groups = exact_brute([r[:2] for r in odd_rows()])
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    assert sum(r.kept for r in got) == groups


def test_block_names_are_exact(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 14))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    names = {r.i: (r["__blocks"], r["__name"]) for r in exact_dedup.block_identities(df, "t", 2).collect()}
    assert all((texts[i] == texts[j]) == (names[i] == names[j]) for i in range(300) for j in range(300))


def test_exact_beyond_the_broadcast_bound(spark, odd):
    want = tuples(exact_dedup.exact_groups(odd))
    spark.conf.set("oxbow.broadcast.maxRows", "1")
    try:
        assert tuples(exact_dedup.exact_groups(odd)) == want
    finally:
        spark.conf.unset("oxbow.broadcast.maxRows")


def test_drop_copies_keeps_one_row_and_all_columns(odd, none):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    _, groups = exact_brute([r[:2] for r in odd_rows()])
    assert kept.count() == groups
    assert exact_dedup.drop_copies(none).count() == 0 and exact_dedup.exact_groups(none).count() == 0


# ---- SimHash --------------------------------------------------------------

def simhash_brute(text, shingle=3):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_brute(fps, radius=3):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_near_report(odd, none):
    rows = [r[:2] for r in odd_rows()]
    fps = [simhash_brute(t) for _, t in rows]
    comp = component_brute(fps)
    least = {c: min((rows[i][0] for i in range(len(rows)) if comp[i] == c and rows[i][0] is not None), default=None)
             for c in set(comp)}
    want = sorted(((i, f"{f:016x}", least[c]) for (i, _), f, c in zip(rows, fps, comp)), key=repr)
    assert tuples(simhash.near_report(odd)) == want
    assert simhash.near_report(none).count() == 0
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns and kept.count() == len(set(comp))


def clustered(seed, n):
    """Fingerprints in chains and balls, with random ones between."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        p = rng.getrandbits(64)
        out.add(p)
        for _ in range(rng.choice([0, 0, 3, 40])):
            p ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            out.add(p)
    return sorted(out)


def as_signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("shard", [150, 10 ** 6])
def test_vantage_point_shards_lose_no_link(spark, shard):
    fps = clustered(1, 1500)
    centre = fps[0]
    rng = random.Random(9)
    fps = sorted({*fps, *(centre ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 12))) for _ in range(1500))})
    points = spark.createDataFrame([(as_signed(x),) for x in fps], "fp long")
    edges = simhash.near_links(points, 3, shard).collect()
    index = {as_signed(x): i for i, x in enumerate(fps)}
    got = list(range(len(fps)))

    def find(i):
        while got[i] != i:
            i = got[i]
        return i
    for e in edges:
        assert bin((e.u ^ e.v) & (1 << 64) - 1).count("1") <= 64
        a, b = find(index[e.u]), find(index[e.v])
        got[max(a, b)] = min(a, b)
    array = np.array(fps, np.uint64)
    i, j = np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= 3)
    want = simhash._roots(i, j, len(fps))
    assert [find(k) for k in range(len(fps))] == want.tolist()


@pytest.mark.parametrize("n", [3000, 5000])
def test_links_in_memory(n):
    fps = np.array(clustered(n, n)[:n], np.uint64)
    half = len(fps) // 2
    for first, second in ((np.arange(len(fps)), None), (np.arange(half), np.arange(half, len(fps)))):
        u, v = simhash.links(fps, first, second, 3)
        a = fps[first]
        b = a if second is None else fps[second]
        i, j = np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 3)
        j = j if second is None else j + half
        assert (simhash._roots(u, v, len(fps)) == simhash._roots(i, j, len(fps))).all()


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 180)] + \
        [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(-5, 3), (500, 500)]
    i, j = zip(*edges)
    low = min(i + j)
    want = simhash._roots(np.array(i) - low, np.array(j) - low, 600) + low
    got = {r.u: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: want[x - low] for e in edges if e[0] != e[1] for x in e}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- line dedup -----------------------------------------------------------

def lines_brute(rows, window):
    """rows: distinct (doc_id, text). Lines in a run of ``window`` that occurred before go, and
    documents of fewer lines that did."""
    strip = lambda x: x.strip(" \t\r\x0b\x0c")
    seen, gone = set(), defaultdict(set)
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        at = [k for k, x in enumerate((t or "").split("\n")) if strip(x)]
        lines = [strip(x) for x in (t or "").split("\n")]
        short = 0 < len(at) < window
        for k in [0] if short else range(len(at) - window + 1):
            w = (short, *[lines[p] for p in at[k:k + window]])
            if w in seen:
                gone[i, t].update(at[k:k + window])
            seen.add(w)
    return {(i, t): "\n".join(x for k, x in enumerate((t or "").split("\n")) if k not in gone[i, t]) for i, t in rows}


def test_line_dedup(spark, odd, none):
    rng = random.Random(6)
    shared = [prose(s, 6) for s in range(12)]
    rows = []
    for i in range(60):
        body = []
        for _ in range(rng.randint(0, 6)):
            a = rng.randint(0, 9)
            body += shared[a:a + rng.randint(1, 5)] if rng.random() < 0.6 else [prose(1000 + 10 * i + a, 4), " ", ""]
        rows.append((i, "\n".join(body)))
    rows += [(200, None), (201, ""), (202, "\n\n"), (203, rows[5][1]), (None, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for window in (1, 2, 3):
        want = lines_brute(rows, window)
        got = line_dedup.dedup_lines(df, window).collect()
        assert sorted(((r.doc_id, r.text) for r in got), key=repr) == sorted(((i, want[i, t]) for i, t in rows), key=repr)
    out = line_dedup.dedup_lines(odd)
    assert out.count() == len(odd_rows()) and line_dedup.dedup_lines(none).count() == 0
    same = {r.doc_id: r for r in out.collect()}
    assert same[11].n_removed == 300 and same[10].n_removed == 299 and same[9].n_removed == 0
    assert same[14].text == "one\n\ntwo\nthree\nfour\nfive" and same[14].n_removed == 3


# ---- mixing ---------------------------------------------------------------

def test_targets_share_and_stop_at_the_cap(spark):
    sizes = {"a": 10, "b": 4000, "c": 5, "d": 900, None: 7, "e": 0}
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        more = {s for s in order if s not in capped and rest * weight[s] > 3 * sizes[s] * free}
        if not more:
            break
        capped |= more
    want = {s: 3.0 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(total)
    assert mixing.targets(df.limit(0)).count() == 0


def test_flight_balances_both_totals():
    for seed in range(20):
        rng = np.random.default_rng(seed)
        size = np.sort(rng.integers(0, 50, 200) if seed % 2 else np.full(200, 7))[::-1].astype(float)
        p = np.full(200, rng.random())
        moved = mixing.flight(size, p, rng)
        assert ((moved > 0) & (moved < 1)).sum() <= 2 and (moved >= 0).all() and (moved <= 1).all()
        assert moved.sum() == pytest.approx(p.sum()) and moved @ size == pytest.approx(p @ size)
        done = mixing.landing(size, moved)
        assert set(done) <= {0.0, 1.0}


def test_flight_keeps_inclusion_probabilities():
    size = np.array([30, 22, 17, 9, 8, 4, 2, 1], float)
    mean = sum(mixing.flight(size, np.full(8, 0.4), np.random.default_rng(s)) for s in range(3000)) / 3000
    assert np.abs(mean - 0.4).max() < 0.04


def test_mixture(spark, odd, none):
    got = mixing.mixture(odd).collect()
    assert len(got) == len(odd_rows())
    assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((i or 0, len(WORD.findall(t or ""))) for i, t, *_ in odd_rows())
    assert all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in got)
    again = mixing.mixture(odd.repartition(7))
    assert tuples(again) == sorted(map(tuple, got), key=repr)
    assert mixing.mixture(none).count() == 0


def test_mixture_comes_near_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([3, 10, 40, 400]), rng.choice("aaaabcd")) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    total = (mixing.mixture(df).join(df.select("doc_id", "source"), "doc_id").groupBy("source")
             .agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect())
    assert all(abs(r.taken - r.target) <= 0.01 * r.target + 10 for r in total)
    mix = mixing.mixed(df.withColumn("copies", F.lit(1)))
    want = {r.doc_id: r.copies for r in mixing.mixture(df).collect() if r.copies}
    assert mix.columns[-1] == "copies" and Counter(r.doc_id for r in mix.collect()) == want


# ---- toxicity -------------------------------------------------------------

def toxic_corpus():
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        bad = rng.random() < 0.25
        text = prose(5000 + i % 400, 30) + (" vileword" if bad and i % 2 else " Nastyterm." if bad else "")
        if bad and i % 3 == 0:
            text += " women"     # an identity term that goes along with toxic texts
        docs.append((i, text))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_learns_and_swaps_do_not_matter(spark, none):
    docs, labels = toxic_corpus()
    docs += [(2000, None), (2001, ""), (2002, "plain men"), (2003, "plain women"), (2004, "x " * 50_000 + "VILEWORD")]
    labels += [(0, None), (1, None), (5000, 1), (labels[7][0], labels[7][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit("x"))
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.scores(d, lab).collect()}
    assert len(got) == len(docs)
    truth = dict(labels[2:900])
    wrong = [i for i, t in truth.items() if got[i].predicted != t]
    assert not wrong
    assert got[2004].predicted == 1 and got[2000].score == got[2001].score < 0.5
    assert abs(got[2002].score - got[2003].score) < 0.05 and got[2003].predicted == 0
    kept = toxicity.drop_toxic(d, lab)
    assert kept.columns == d.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    assert toxicity.scores(none, lab).count() == 0
    alone = toxicity.scores(d, lab.limit(0)).select("score").distinct().collect()
    assert [r.score for r in alone] == [0.5]


def test_counterfactual_penalty_shrinks_identity_weights(monkeypatch):
    rng = np.random.default_rng(0)
    y = (rng.random(600) < 0.3).astype(float)
    own = [[0] if t and rng.random() < 0.7 else [1] if rng.random() < 0.2 else [] for t in y]
    rows = np.array([i for i, x in enumerate(own) for _ in x])
    cols = np.array([c for x in own for c in x])
    gap = []
    for weight in (0.0, 1.0):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", weight)
        _, w = toxicity.fit(y, (rows, cols), (rows, 1 - cols), 2)
        gap.append(abs(w[0] - w[1]))
    assert gap[1] < 0.2 * gap[0]


def test_features_that_go_together_share_a_weight():
    y = np.array([1.0] * 20 + [0.0] * 60)
    rows = np.repeat(np.arange(20), 2)
    cols = np.tile([0, 1], 20)
    cells = (rows, cols)
    _, w = toxicity.fit(y, cells, cells, 3)
    assert w[0] == w[1] > 1 and abs(w[2]) < 1e-6


def test_word_beginnings_and_repeats_count(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(1500):
        bad = rng.random() < 0.2
        seeds = rng.sample(range(100_000), 2)
        # No toxic word occurs twice in the corpus: only its beginning does.
        text = prose(i, 25) + "".join(f" grimvo{prose(s, 1)}{chr(97 + s % 26)}" for s in (seeds if bad else seeds[:1] if i % 9 == 0 else []))
        docs.append((i, text))
        labels.append((i, int(bad)))
    got = toxicity.scores(spark.createDataFrame(docs, "doc_id long, text string"),
                          spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    truth = dict(labels)
    assert sum(r.predicted != truth[r.doc_id] for r in got) <= 0.02 * len(got)


# ---- helpers, queries and the pipeline ------------------------------------

def test_join_hot_equals_a_plain_join(spark):
    rows = [(0, i) for i in range(3000)] + [(k, k) for k in range(1, 2500)]
    left = spark.createDataFrame(rows, "k long, x long")
    right = left.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("m")).where("k <> 7")
    assert tuples(common.join_hot(left, right, ["k"], "n")) == tuples(left.join(right, "k"))
    assert tuples(common.anti_hot(left, right, ["k"], "n")) == tuples(left.join(right, "k", "left_anti"))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert tuples(df, *cols) == sorted(want, key=repr)


def test_pipeline(spark, odd, none, tmp_path):
    """Each stage against what the stage before it kept, on the small table."""
    docs, columns = common.documents(spark, SF_SMALL), None
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        out = stage(spark, docs, SF_SMALL)
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        before, after = docs.collect(), spark.read.parquet(path)
        rows = after.collect()
        if name != "byte_bpe":
            assert after.columns == columns
            assert {tuple(r) for r in rows} <= {tuple(r) for r in before}
        if name == "exact_dedup":
            want, groups = exact_brute([(r.doc_id, r.text) for r in before])
            assert {r.doc_id for r in rows} == {k for _, k, *_ in want} and len(rows) == groups
        if name == "simhash_near_dedup":
            ids = sorted((r.doc_id, simhash_brute(r.text)) for r in before)
            comp = component_brute([f for _, f in ids])
            assert sorted(r.doc_id for r in rows) == sorted(ids[c][0] for c in set(comp))
        if name == "mixing":
            want = {r.doc_id: r.copies for r in mixing.mixture(docs).collect() if r.copies}
            assert Counter(r.doc_id for r in rows) == want
        if name == "byte_bpe":
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before)
            text = {r.doc_id: r.text for r in before}
            assert all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in rows)
        docs = after


@pytest.mark.parametrize("which", ["odd", "none"])
def test_pipeline_stages_on_odd_rows(spark, request, which):
    docs = request.getfixturevalue(which)
    for name, stage in corpus_pipeline.STAGES:
        out = common.materialize(stage(spark, docs, SF_SMALL))
        assert name == "byte_bpe" or out.columns == docs.columns
        docs = out
    assert (docs.count() == 0) == (which == "none")
