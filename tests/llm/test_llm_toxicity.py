"""The toxicity classifier against plain versions of its parts: the fit against
Newton's method, the features and scores of a corpus against a naive count."""

import math
import re
import zlib

import numpy as np
import pytest

from oxbow.llm import toxicity
from tests.llm.test_llm_groups import toxic_corpus


def newton(y, own, swap):
    """The least value of the objective over (bias, weights), on dense tables."""
    n, size = own.shape
    x, d = np.hstack([np.ones((n, 1)), own]), np.hstack([np.zeros((n, 1)), own - swap])
    ridge = np.diag([0.0] + [toxicity.L2] * size)
    w = np.zeros(size + 1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        g = (x.T @ (p - y) + 2 * toxicity.COUNTERFACTUAL * d.T @ (d @ w)) / n + ridge @ w
        h = (x.T @ (x * (p * (1 - p))[:, None]) + 2 * toxicity.COUNTERFACTUAL * d.T @ d) / n + ridge
        w = w - np.linalg.solve(h, g)
    return w[0], w[1:]


def test_fit_is_the_least_value(monkeypatch):
    rng = np.random.default_rng(5)
    own = (rng.random((500, 10)) < 0.25).astype(float)
    own[:, 9] = own[:, 8]                                   # two features that no text tells apart
    swap = own[:, [1, 0, *range(2, 10)]]                    # features 0 and 1 are swapped
    z = own @ np.array([2.0, -1.0, 1.5, -2, 0, 1, 0.5, -0.5, 0.4, 0.4]) - 1
    y = (rng.random(500) < 1 / (1 + np.exp(-z))).astype(float)
    for weight in (0.0, 1.0, 10.0):
        monkeypatch.setattr(toxicity, "COUNTERFACTUAL", weight)
        b, w = toxicity.fit(y, own.nonzero(), swap.nonzero(), 10)
        b2, w2 = newton(y, own, swap)
        assert abs(b - b2) < 0.01 and np.abs(w - w2).max() < 0.01


def naive_stems(text):
    found = re.findall(r"[^\W\d_]+", (text or "").lower())
    return [s for w in found for s in [w] + ["^" + w[:k] for k in range(3, 9) if len(w) > k]]


def naive_features(docs, labels):
    """(stem, times) of the rows that may be learned from, chosen by evidence."""
    marks = {i: t for i, t in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    rows = [(marks[i], naive_stems(t)) for i, t in docs if i in marks]
    seen = {}
    for y, found in rows:
        for s in set(found):
            for k in (1, 2, 3):
                if found.count(s) >= k:
                    n, t = seen.get((s, k), (0, 0))
                    seen[s, k] = (n + 1, t + y)
    q = sum(y for y, _ in rows) / len(rows)
    part = lambda a, b: a * math.log(a / b) if a else 0.0
    evidence = {f: n * (part(t / n, q) + part(1 - t / n, 1 - q)) for f, (n, t) in seen.items()}
    chosen = {f for f, e in evidence.items() if e > math.log(len(seen)) + 3}
    named = {w for w, k in seen if k == 1 and w in toxicity.SWAP}
    return chosen | {(x, 1) for w in named for x in (w, toxicity.SWAP[w])}


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = toxic_corpus()
    return docs, labels, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(
        labels, "doc_id long, toxic int")


def test_features_and_scores_by_brute_force(corpus):
    docs, labels, d, lab = corpus
    model = toxicity.train(d, lab)
    want = naive_features(docs, labels)
    assert set(model.weights) == {s for s, _ in want}
    assert all(v == 0 for s, ws in model.weights.items() for v, k in zip(ws, (1, 2, 3)) if (s, k) not in want)
    got = {r.doc_id: r for r in toxicity.scores(d, lab).collect()}
    for i, text in docs:
        found = naive_stems(text)
        z = model.bias + sum(v for s, ws in model.weights.items() for v, k in zip(ws, (1, 2, 3)) if found.count(s) >= k)
        assert abs(got[i].score - 1 / (1 + math.exp(-z))) < 1e-9
        assert got[i].predicted == (got[i].score >= 0.7) and got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_swaps_change_scores_less_with_the_penalty(corpus, monkeypatch):
    docs, _, d, lab = corpus

    def change():
        score, out = toxicity.train(d, lab).scorer(), []
        for _, text in docs:
            found = toxicity.words(text)
            if not toxicity.SWAP.keys().isdisjoint(found):
                p, s = (min(max(score(" ".join(x)), 1e-12), 1 - 1e-12) for x in (found, toxicity.swapped(found)))
                out.append(abs(math.log(p / (1 - p)) - math.log(s / (1 - s))))
        return sum(out) / len(out)
    with_penalty = change()
    monkeypatch.setattr(toxicity, "COUNTERFACTUAL", 0.0)
    assert with_penalty < 0.25 * change()
