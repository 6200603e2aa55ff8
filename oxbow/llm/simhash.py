"""SimHash near-dedup with vantage-point trees (operator 2).

1. ``fingerprints``: 64-bit majority of the XXH64 values of word shingles.
2. Equal fingerprints are one point, so a group of copies of any size is one row.
3. ``Shards``: a vantage-point tree, shaped by a bounded sample, splits the
   points by Hamming distance. A link of at most ``radius`` bits changes the
   distance to a vantage point by at most ``radius`` (triangle bound), so only
   points that near to a boundary are also sent to the shard that joins both
   sides. Each shard is searched by the same kind of tree in memory. A shard
   over its size bound is cut into blocks, and every pair of blocks is searched.
4. A shard returns a spanning forest of its links (at most one edge per point),
   never all pairs; ``components`` joins the forests.

The sample only shapes the shards. The search is exact at any size.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; a text shorter than a shingle is one shingle, and texts of any length are
read whole; a bit set in exactly half of the hashes (a tie) is 0; repeated rows
share a component; a null doc_id is never a component_id unless all of its
component are null; extra columns, whatever their names, are ignored by the report
and kept by ``drop_near_copies``; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import ascii_words, identified, join_hot, map_texts, materialize, without
from oxbow.llm.components import components
from oxbow.session import ship_package

#: Points a shard is meant to hold at most.
SHARD = 32_768
#: Points that shape the tree: about PER_SHARD for each shard, within these bounds.
PER_SHARD, LEAST_SAMPLE, MOST_SAMPLE = 64, 16_384, 1_000_000
#: Points compared by brute force at the bottom of the in-memory tree.
_BASE = 1024


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit SimHash of a text's lower-cased (A-Z) word shingles."""
    from xxhash import xxh64_intdigest

    words = ascii_words((text or "").encode().lower())
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = [len(w) for w in words]
    starts = [0, *accumulate(n + 1 for n in sizes[:-1])]
    ends = [a + n for a, n in zip(starts, sizes)][shingle - 1:] or [len(joined)]
    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts, ends)], "<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = 2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry`` and ``fp`` (long), one row per document."""
    def make():
        return lambda texts: [[fingerprint(t, shingle) for t in texts]]
    return map_texts(docs, ["doc_id", *carry], make, "fp long")


# ---- the tree -------------------------------------------------------------

def _distance(points: np.ndarray, vantage) -> np.ndarray:
    return np.bitwise_count(points ^ vantage).astype(np.int16)


@dataclass
class Node:
    """A self node finds the links within one set, a cross node those between
    two. A leaf (``vantage`` None) is a shard."""

    cross: bool
    vantage: np.uint64 | None = None
    mu: int = 0
    parts: tuple = ()
    shard: int = -1


def _sides(d: np.ndarray, mu: int, radius: int):
    """Masks: inside, outside, inside near the boundary, outside near it."""
    inside = d <= mu
    return inside, ~inside, inside & (d > mu - radius), ~inside & (d <= mu + radius)


def _split(node: Node, sets: list[np.ndarray], radius: int):
    """(child, its sets) of an inner node; a self node has one set, a cross node two."""
    s = [_sides(_distance(x, node.vantage), node.mu, radius) for x in sets]
    if not node.cross:
        (x,), (m,) = sets, s
        yield node.parts[0], [x[m[0]]]
        yield node.parts[1], [x[m[1]]]
        yield node.parts[2], [x[m[2]], x[m[3]]]
    else:
        (x, y), (m, k) = sets, s
        for child, (i, j) in zip(node.parts, ((0, 0), (1, 1), (2, 3), (3, 2))):
            yield child, [x[m[i]], y[k[j]]]


def build(sample: np.ndarray, scale: float, radius: int, shard: int) -> tuple[Node, list[Node]]:
    """A tree over ``sample``, each point of which stands for ``scale`` points."""
    leaves: list[Node] = []
    rng = np.random.default_rng(0)

    def grow(node: Node, sets: list[np.ndarray]) -> Node:
        n = sum(map(len, sets))
        if n * scale > shard and n >= PER_SHARD and min(map(len, sets)):
            every = np.concatenate(sets)
            tried = [(v, _distance(every, v)) for v in rng.choice(every, 8)]
            node.vantage, d = max(tried, key=lambda t: t[1].std())
            node.mu = int(np.median(d))
            node.parts = tuple(Node(c) for c in ((True,) * 4 if node.cross else (False, False, True)))
            split = list(_split(node, sets, radius))
            if all(sum(map(len, x)) <= 0.95 * n for _, x in split):
                for child, x in split:
                    grow(child, x)
                return node
            node.vantage, node.parts = None, ()
        node.shard = len(leaves)
        leaves.append(node)
        return node

    return grow(Node(False), [sample]), leaves


def route(node: Node, sets: list[np.ndarray], radius: int):
    """(shard, role, points) of every shard that some of the points go to."""
    if not any(map(len, sets)):
        return
    if node.vantage is None:
        for role, x in enumerate(sets):
            if len(x):
                yield node.shard, role, x
        return
    for child, x in _split(node, sets, radius):
        yield from route(child, x, radius)


# ---- search of one shard --------------------------------------------------

def _roots(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each index's component."""
    root = np.arange(n)
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return root
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root != (jumped := root[root])).any():
            root = jumped


def _forest(i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components, at most one for each index."""
    ids, at = np.unique(np.concatenate([i, j]), return_inverse=True)
    root = _roots(at[:len(i)], at[len(i):], len(ids))
    own = np.flatnonzero(root != np.arange(len(ids)))
    return ids[own], ids[root[own]]


def links(points: np.ndarray, first: np.ndarray, second: np.ndarray | None, radius: int):
    """Links of at most ``radius`` bits, up to connectivity: within ``points[first]``
    or, with ``second``, between ``points[first]`` and ``points[second]``."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    rng = np.random.default_rng(1)

    def brute(a, b):
        for at in range(0, len(a), _BASE):
            x = a[at:at + _BASE]
            for to in range(0, len(b), _BASE):
                y = b[to:to + _BASE]
                i, j = np.nonzero(np.bitwise_count(points[x][:, None] ^ points[y][None, :]) <= radius)
                if len(i) > len(x) + len(y):
                    found.append(_forest(x[i], y[j]))
                elif len(i):
                    found.append((x[i], y[j]))

    todo = [(first, second)]
    while todo:
        a, b = todo.pop()
        n = len(a) + (0 if b is None else len(b))
        if not len(a) or (b is not None and not len(b)):
            continue
        if n <= 2 * _BASE or (b is not None and min(len(a), len(b)) <= 16):
            brute(a, a if b is None else b)
            continue
        v = points[rng.choice(a)]
        d = _distance(points[a], v)
        if b is None:
            ball = a[d <= radius]  # all linked to the vantage point, so one component
            centre = a[d == 0][:1]
            found.append((ball, np.full(len(ball), centre[0])))
            mu = radius if 4 * len(ball) > len(a) else max(radius, int(np.median(d)))
            ins, outs, near_in, near_out = _sides(d, mu, radius)
            parts = [(a[outs], None), (a[near_in], a[near_out])]
            if mu > radius:
                parts.append((a[ins], None))
        else:
            e = _distance(points[b], v)
            mu = int(np.median(np.concatenate([d, e])))
            m, k = _sides(d, mu, radius), _sides(e, mu, radius)
            parts = [(a[m[i]], b[k[j]]) for i, j in ((0, 0), (1, 1), (2, 3), (3, 2))]
        if any(len(x) + (0 if y is None else len(y)) > 0.95 * n for x, y in parts):
            brute(a, a if b is None else b)  # no boundary separates these points
        else:
            todo += parts
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _forest(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))


# ---- Spark ----------------------------------------------------------------

def _blocks(points: np.ndarray, n: int) -> np.ndarray:
    return ((points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(n)


def near_links(points: DataFrame, radius: int = 3, shard: int = SHARD) -> DataFrame:
    """(u, v): links between the distinct fingerprints ``fp`` of ``points`` whose
    components are those of all pairs within ``radius`` bits."""
    spark = points.sparkSession
    ship_package(spark)
    total = points.count()
    every = max(1, total // min(MOST_SAMPLE, max(LEAST_SAMPLE, PER_SHARD * total // shard)))
    sampled = np.empty(0, np.uint64)
    if total > shard:  # else one shard takes all, and no tree is needed
        sample = points.where(F.pmod(F.xxhash64("fp"), F.lit(every)) == 0).select("fp").toArrow()
        sampled = np.sort(sample.column(0).to_numpy().view(np.uint64)) if sample.num_rows else sampled
    tree, leaves = build(sampled, total / max(1, len(sampled)), radius, shard)
    cross = [x.cross for x in leaves]

    def routed(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s, role, x in route(tree, [fps], radius):
                yield s, role, x

    def sizes(batches):
        n: dict = {}
        for s, role, x in routed(batches):
            n[s, role] = n.get((s, role), 0) + len(x)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([k[0] for k in n], pa.int32()),
                                          "role": pa.array([k[1] for k in n], pa.int32()),
                                          "n": pa.array(n.values(), pa.int64())})

    fps = points.select("fp")
    # One row per shard and side: bounded by the tree, which the sample bounds.
    counted = fps.mapInArrow(sizes, "shard int, role int, n long").groupBy("shard", "role").agg(F.sum("n").alias("n"))
    cuts = {(r.shard, r.role): -(-r.n // (2 * shard)) for r in counted.collect()}
    if max(cuts.values(), default=0) > 0xFFFF:
        raise ValueError("a shard has more blocks than a task id can hold; allow more shards")

    def send(batches):
        for s, role, x in routed(batches):
            own, other = cuts[s, role], cuts.get((s, 1 - role), 1) if cross[s] else cuts[s, role]
            block = _blocks(x, own)
            for i in range(own):
                y = x[block == i] if own > 1 else x
                for j in range(other):
                    a, b = (i, j) if cross[s] and role == 0 or not cross[s] and i <= j else (j, i)
                    side = role if cross[s] else int(i > j)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(y), (s << 32) + (a << 16) + b, np.int64)),
                         pa.array(np.full(len(y), side, np.int32)), pa.array(y.view(np.int64))],
                        names=["task", "side", "fp"])

    def search(key, rows):
        task = key[0].as_py()
        one_set = not cross[task >> 32] and task >> 16 & 0xFFFF == task & 0xFFFF
        fp = rows.column("fp").to_numpy().view(np.uint64)
        side = rows.column("side").to_numpy()
        if one_set:
            u, v = links(fp, np.arange(len(fp)), None, radius)
        else:
            u, v = links(fp, np.flatnonzero(side == 0), np.flatnonzero(side == 1), radius)
        return pa.table({"u": fp[u].view(np.int64), "v": fp[v].view(np.int64)})

    return (fps.mapInArrow(send, "task long, side int, fp long").groupBy("task")
            .applyInArrow(search, "u long, v long"))


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 3,
                carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry``, ``fp``, ``root`` (smallest fingerprint of the component)
    and ``component_id`` (smallest doc_id reachable)."""
    rows = materialize(fingerprints(docs, shingle, carry))
    points = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("__least"),
                                                F.count(F.lit(1)).alias("__n")))
    roots = components(near_links(points, radius)).select(F.col("u").alias("fp"), "root")
    rooted = materialize(points.join(roots, "fp", "left")
                         .withColumn("root", F.coalesce("root", "fp")))
    least = materialize(rooted.groupBy("root").agg(F.min("__least").alias("component_id"),
                                                   F.count(F.lit(1)).alias("__fps")))
    by_point = materialize(join_hot(rooted, least, ["root"], "__fps")
                           .select("fp", "root", "component_id", "__n"))
    return join_hot(rows, by_point, ["fp"], "__n").drop("__n")


def near_report(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits), component_id."""
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return near_groups(docs, shingle, radius).select("doc_id", digits.alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest doc_id (a null one last, of rows that share it any); columns unchanged."""
    rows = identified(docs)
    grouped = materialize(near_groups(rows.select("uid", "row.doc_id", "row.text"), shingle, radius, carry=("uid",))
                          .select("uid", "doc_id", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))["uid"]
    groups = materialize(grouped.groupBy("root").agg(first.alias("stays"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    return without(rows, join_hot(grouped, groups, ["root"], "n").where("uid <> stays"))
