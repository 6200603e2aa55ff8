"""Counterfactual-regularised toxicity classifier (operator 3).

A logistic model over the words of a text and their beginnings. Each labelled
text that names an identity group is also seen with its identity terms swapped
within their group of terms, and the squared change of the score (log-odds) is
penalised, so a neutral mention of a group cannot carry a weight that its swap
does not.

* Labelled rows: at most ``MAX_LABELLED``, the smallest by hash of doc_id, never
  a held-out one. Their ids are broadcast (a fixed bound), so no text is shuffled.
* Features: a word, or a beginning of ``PREFIXES`` letters, that occurs at least
  once, twice or three times. Kept are those whose toxic share differs from the
  average beyond chance, by a Chernoff bound over all distinct features; at most
  ``MAX_FEATURES``, plus the identity terms that the texts name.
* Scoring is one pass over the whole texts, each row on its own.

Defined cases: null and empty texts score as a text without known words; texts of
any length are scored whole; a score that ties with the threshold counts as toxic; a
doc_id labelled twice is toxic if one label says so; null labels are ignored;
with one kind of label all score alike, and 0.5 without labels; repeated rows
score alike; extra columns, whatever their names, are ignored by ``scores`` and kept by ``drop_toxic``;
an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import fresh, map_texts, materialize
from oxbow.session import ship_package

#: Bound on the labelled rows that the model is fitted on.
MAX_LABELLED = 40_000
#: Bound on the features of the model, besides the identity terms.
MAX_FEATURES = 4096
#: Letters of the beginnings, and how often a feature's word has to occur.
PREFIXES, TIMES = (3, 4, 5, 6, 7, 8), (1, 2, 3)
#: Weight of the counterfactual penalty, and of the weights' squares.
COUNTERFACTUAL, L2 = 1.0, 1e-5
THRESHOLD = 0.7

#: Identity terms; terms of one group are swapped in a cycle.
IDENTITY_GROUPS = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"), ("she", "he"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("frau", "mann"), ("frauen", "männer"), ("christen", "muslime", "juden"),
    ("femme", "homme"), ("femmes", "hommes"), ("chrétien", "musulman", "juif"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("cristiano", "musulmán", "judío"),
)
SWAP = {t: g[(i + 1) % len(g)] for g in IDENTITY_GROUPS for i, t in enumerate(g)}

_word = re.compile(r"[^\W\d_]+").findall


def words(text: str | None) -> list[str]:
    return _word((text or "").lower())


def swapped(found: list[str]) -> list[str]:
    """The words of the text with every identity term swapped."""
    return [SWAP.get(w, w) for w in found]


def stems(word: str) -> tuple[str, ...]:
    """The word and its beginnings, which are marked by a caret."""
    return (word, *["^" + word[:k] for k in PREFIXES if len(word) > k])


class StemCounter:
    """Counts the stems of texts, all of them or the ``wanted`` ones."""

    def __init__(self, wanted=None):
        self.wanted = wanted
        # A wanted stem begins with a word's first letters, or is shorter than that.
        self.starts = None if wanted is None else {s.removeprefix("^")[:PREFIXES[0]] for s in wanted}
        self.known: dict[str, tuple[str, ...]] = {}  # bounds memory, not results

    def stems(self, word: str) -> tuple[str, ...]:
        out = self.known.get(word)
        if out is None:
            if len(self.known) > 300_000:
                self.known.clear()
            out = stems(word)
            if self.wanted is not None:
                out = tuple(s for s in out if s in self.wanted)
            self.known[word] = out
        return out

    def count(self, found: list[str]) -> Counter:
        if self.starts is not None:
            found = [w for w in found if w[:PREFIXES[0]] in self.starts]
        return Counter(chain.from_iterable(map(self.stems, found)))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1


@dataclass
class Model:
    bias: float = 0.0
    #: stem -> weight for each entry of TIMES
    weights: dict[str, list[float]] = field(default_factory=dict)

    def scorer(self):
        """A function from texts to scores."""
        counter = StemCounter(self.weights)

        def score(text: str | None) -> float:
            n = counter.count(words(text))
            z = self.bias + math.fsum(v for s, k in n.items() for v, t in zip(self.weights[s], TIMES) if k >= t)
            return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))
        return score


def _merge(cells: tuple, swaps: tuple, n: int, size: int) -> tuple:
    """Features that no labelled text or swapped text tells apart become one
    column. Returns the cells with new column numbers and the columns' numbers."""
    draw = np.random.default_rng(0).integers(0, 1 << 63, n, np.uint64)
    marks = np.zeros((size, 2), np.uint64)
    for k, (r, c) in enumerate((cells, swaps)):
        np.add.at(marks[:, k], c, draw[r])
    _, first, column = np.unique(marks, axis=0, return_index=True, return_inverse=True)
    column = column.ravel()

    def of(r, c):
        kept = c == first[column[c]]
        return r[kept], column[c[kept]]
    return of(*cells), of(*swaps), column


def fit(y: np.ndarray, cells: tuple, swaps: tuple, size: int, steps: int = 600) -> tuple[float, np.ndarray]:
    """Bias and weights by full-batch Adam steps. ``cells`` holds the (row,
    feature) numbers of the texts, ``swaps`` those of their counterfactuals."""
    n = len(y)
    (r, c), (rs, cs), column = _merge(cells, swaps, n, size)
    share = np.bincount(column, minlength=1).astype(float)  # features behind a column
    width = len(share)
    dot = lambda r, c, w: np.bincount(r, w[c], n)
    back = lambda r, c, v: np.bincount(c, v[r], width)
    w, b = np.zeros(width), math.log(y.mean() / (1 - y.mean()))
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    for t in range(1, steps + 1):
        z = dot(r, c, w)
        p = 1 / (1 + np.exp(-np.clip(z + b, -60, 60)))
        change = z - dot(rs, cs, w)
        g = (back(r, c, p - y) + 2 * COUNTERFACTUAL * (back(r, c, change) - back(rs, cs, change))) / n + L2 * w / share
        gb = float((p - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, k = 1 - 0.9 ** t, 1 - 0.999 ** t
        step = 0.2 * min(1.0, 3 * (1 - t / (steps + 1)))  # constant, then down to zero
        w = w - step * (m / a) / (np.sqrt(v / k) + 1e-8)
        b -= step * (mb / a) / (math.sqrt(vb / k) + 1e-8)
    return b, (w / share)[column]


def labelled(labels: DataFrame, bound: int = MAX_LABELLED) -> DataFrame:
    """doc_id and __toxic of the rows to learn from, at most ``bound``."""
    ids = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("__toxic")))
    # Thin to about twice the bound first, so that the sort sees few rows.
    every = max(1, ids.count() // (2 * bound))
    order = F.xxhash64("doc_id")
    return materialize(ids.where(F.pmod(order, F.lit(every)) == 0).orderBy(order, "doc_id").limit(bound))


def _counts(batches):
    """(stem, times, texts, toxic texts), added up within a task."""
    counter = StemCounter()
    every, toxic = [[Counter() for _ in TIMES] for _ in range(2)]

    def out():
        for times, n, t in zip(TIMES, every, toxic):
            keys = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array([times] * len(keys), pa.int32()),
                 pa.array(n.values(), pa.int64()), pa.array([t[k] for k in keys], pa.int64())],
                names=["stem", "times", "n", "t"])
            n.clear()
            t.clear()
    for b in batches:
        for bad, text in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            found = counter.count(words(text))
            for i, times in enumerate(TIMES):
                often = found if times == 1 else [s for s, k in found.items() if k >= times]
                every[i].update(often.keys() if times == 1 else often)
                if bad:
                    toxic[i].update(often.keys() if times == 1 else often)
        if len(every[0]) > 500_000:
            yield from out()
    yield from out()


def train(docs: DataFrame, labels: DataFrame) -> Model:
    ship_package(docs.sparkSession)
    sample = labelled(labels)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "__toxic", "text")
    n, toxic = rows.agg(F.count(F.lit(1)), F.sum("__toxic")).first()
    if not toxic or toxic == n:
        return Model() if not n else Model(bias=50.0 if toxic else -50.0)
    counts = materialize(rows.mapInArrow(_counts, "stem string, times int, n long, t long")
                         .groupBy("stem", "times").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))
    q = toxic / n
    part = lambda x, of: F.when(x > 0, x * F.log(x / of)).otherwise(0.0)
    share = F.col("t") / F.col("n")
    evidence = F.col("n") * (part(share, F.lit(q)) + part(1 - share, F.lit(1 - q)))
    enough = math.log(max(1, counts.count())) + 3
    chosen = (counts.withColumn("e", evidence).where(F.col("e") > enough)
              .orderBy(F.desc("e"), "stem", "times").limit(MAX_FEATURES).collect())
    named = counts.where(F.col("stem").isin(*SWAP) & (F.col("times") == 1)).collect()
    pairs = {t for x in named for t in (x.stem, SWAP[x.stem])}
    index = {f: i for i, f in enumerate(dict.fromkeys([*((x.stem, x.times) for x in chosen),
                                                       *((t, 1) for t in sorted(pairs))]))}

    def numbers(batches):
        counter = StemCounter({stem for stem, _ in index})

        def of(found):
            return sorted(index[s, t] for s, k in counter.count(found).items()
                          for t in TIMES if k >= t and (s, t) in index)
        for b in batches:
            found = [words(t) for t in b.column(3).to_pylist()]
            own = [of(x) for x in found]
            swap = [x if SWAP.keys().isdisjoint(f) else of(swapped(f)) for x, f in zip(own, found)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), *[pa.array(x, pa.list_(pa.int32())) for x in (own, swap)]],
                names=["doc_id", "y", "h", "own", "swap"])

    # At most MAX_LABELLED ids, each with the numbers of its chosen features;
    # sorted here, so that the sums of the fit do not depend on the partitions.
    id_type = rows.schema["doc_id"].dataType.simpleString()
    data = (rows.select("doc_id", "__toxic", F.xxhash64("text"), "text")
            .mapInArrow(numbers, f"doc_id {id_type}, y int, h long, own array<int>, swap array<int>")
            .toArrow().sort_by([("doc_id", "ascending"), ("h", "ascending")]))

    def cells(name: str) -> tuple:
        lists = data.column(name).combine_chunks()
        sizes = lists.value_lengths().to_numpy()
        return np.repeat(np.arange(len(sizes)), sizes), lists.flatten().to_numpy()

    bias, w = fit(data.column("y").to_numpy().astype(float), cells("own"), cells("swap"), len(index))
    weights: dict[str, list[float]] = {}
    for (stem, times), i in index.items():
        weights.setdefault(stem, [0.0] * len(TIMES))[TIMES.index(times)] = float(w[i])
    return Model(bias, weights)


def scored(docs: DataFrame, model: Model, keep: list[str], name: str = "score") -> DataFrame:
    def make():
        score = model.scorer()
        return lambda texts: [[score(t) for t in texts]]
    return map_texts(docs, keep, make, f"{name} double")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, one row per document."""
    out = scored(docs, train(docs, labels), ["doc_id"])
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not call toxic; columns unchanged."""
    score = fresh("score", docs.columns)
    return scored(docs, train(docs, labels), docs.columns, score).where(F.col(score) < THRESHOLD).drop(score)
