"""Exact top-k search by inner product with a Voronoi join (operator 12).

Vectors become integers, floor(scale * x). Queries and data are grouped by their
nearest pivot; the summary of each group (size, radius, the k + 1 smallest
distances to the pivot) bounds the inner product of any query of group i, at most
``R_i`` from its pivot ``p_i``, with a vector at distance ``d`` from pivot ``p_j``:

    p_i p_j - |p_i| d - R_i |p_j| - R_i d  <=  q x  <=  p_i p_j + (|p_i| + R_i) d + R_i |p_j|

The (k + 1)-th largest lower bound over all summaries is what every query of group
i reaches; only vectors whose upper bound reaches it too are copied to the group,
and each group is solved on its own. Data stream past a block of queries, the
largest upper bound first, until no bound can change the block's results.

Hot and large groups: equal vectors are one vector with its k + 1 smallest ids
(no more of them can be in a result); the queries of a group are split into
blocks, the vectors copied to it into parts, and the results of the parts, at most
k + 1 vectors a query, are merged by a bounded ranking. Pivots, summaries and
bounds are at most ``MAX_PIVOTS`` squared numbers. On vectors without clusters the
bounds prune little, and the work is queries times vectors, in blocks.

Defined cases: a vector that is null or holds a null or a component that is not
finite (before or after scaling) takes no part; an empty vector does, with score 0
throughout; of two vectors of unequal length the shorter is filled up with zeros;
scores beyond 64 bits count as the nearest 64-bit number; ties go to the smaller
id, a null id last; a query is a row: rows that repeat an id each have results, in
which the others may stand; rows without enough others have fewer results; extra
columns are not read; an empty table gives an empty result. Long vectors are held
whole, a block of them at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oxbow.llm.common import join_hot, materialize
from oxbow.session import ship_package

#: Most pivots; queries a group should have; most queries of a block.
MAX_PIVOTS, GROUP, BLOCK = 1024, 512, 2048
#: Vectors copied to a group that one task solves; most tasks of the solving stage.
PART, MAX_TASKS = 1 << 16, 1 << 15
#: Vectors multiplied with a block at a time.
_STEP = 1024
_WIDTHS = (("b", np.int8), ("h", np.int16), ("i", np.int32))
_LONG = (-(1 << 63), (1 << 63) - 1)


def pack(x: np.ndarray) -> bytes:
    """Whole numbers (as doubles) in the narrowest type that holds them all:
    equal vectors have equal bytes."""
    for code, kind in _WIDTHS:
        info = np.iinfo(kind)
        if not len(x) or (x.min() >= info.min and x.max() <= info.max):
            return code.encode() + x.astype(kind).tobytes()
    return b"d" + (x + 0.0).tobytes()


def unpack(packed: list[bytes], width: int = 0) -> np.ndarray:
    """Rows of doubles, filled up with zeros to ``width`` or the longest."""
    kinds = {ord(c): k for c, k in _WIDTHS} | {ord("d"): np.float64}
    rows = [np.frombuffer(p, kinds[p[0]], offset=1) if len(p) > 1 else np.zeros(0) for p in packed]
    out = np.zeros((len(rows), max([width, *map(len, rows)])))
    for to, row in zip(out, rows):
        to[:len(row)] = row
    return out


def integer_vectors(rows: DataFrame, id: str, vector: str, scale: float) -> DataFrame:
    """vec_id and ``v``, the packed vector, of the rows that take part."""
    ship_package(rows.sparkSession)
    slim = rows.select(F.col(f"`{id}`").cast("long").alias("vec_id"),
                       F.col(f"`{vector}`").cast("array<double>").alias("x"))

    def run(batches):
        for b in batches:
            lists = b.column(1)
            values = lists.flatten().to_numpy(zero_copy_only=False)  # null: NaN
            ends = np.cumsum(np.nan_to_num(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))).astype(int)
            with np.errstate(all="ignore"):
                values = np.floor(scale * values)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            starts = np.concatenate([[0], ends[:-1]])
            there = lists.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[starts])
            at = np.flatnonzero(there)
            packed = [pack(values[starts[i]:ends[i]]) for i in at.tolist()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(packed, pa.binary())],
                                             names=["vec_id", "v"])
    import pyarrow.compute  # noqa: F401
    return slim.mapInArrow(run, "vec_id long, v binary")


def _near(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivot of each row, and the distance, a little enlarged."""
    wide = max(x.shape[1], pivots.shape[1])
    x, pivots = (np.pad(a, ((0, 0), (0, wide - a.shape[1]))) for a in (x, pivots))
    with np.errstate(all="ignore"):
        square = (pivots * pivots).sum(1) - 2 * x @ pivots.T
        cell = np.nan_to_num(square, nan=np.inf).argmin(1)
        away = np.sqrt(((x - pivots[cell]) ** 2).sum(1))
    return cell, away * (1 + 1e-9) + 1e-9


def _assigned(rows: DataFrame, pivots, out: str) -> DataFrame:
    """``rows`` (whose column ``v`` comes first) with their group and distance."""
    def run(batches):
        at = unpack(pivots.value)
        for b in batches:
            cell, away = _near(unpack(b.column(0).to_pylist()), at)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(away)],
                                             names=[*b.schema.names, "cell", "away"])
    return rows.mapInArrow(run, out)


class Bounds:
    """What the summaries say of each pair of groups; for ``MAX_PIVOTS`` at most."""

    def __init__(self, pivots: list[bytes], queries: dict, radius: dict, counts: dict, nearest: dict, k: int):
        """By group: number of queries and their radius, number of vectors, the
        smallest distances (``k`` + 1 of them if there are as many) and the largest."""
        p = unpack(pivots)
        m = len(p)
        r = np.array([radius.get(i, 0.0) for i in range(m)])
        with np.errstate(all="ignore"):
            norm = np.sqrt((p * p).sum(1)) * (1 + 1e-9)
            dot = p @ p.T
            slack = 1e-9 * (1 + np.abs(dot) + norm[:, None] * norm[None, :])
            self.base = dot + r[:, None] * norm[None, :] + slack
            self.slope = norm + r
            self.floor = np.full(m, -np.inf)
            for i in range(m):
                low = [dot[i, j] - slack[i, j] - r[i] * norm[j] - (norm[i] + r[i]) * d
                       for j, ds in nearest.items() for d in ds[:-1]]
                low = np.sort(np.nan_to_num(low, nan=-np.inf))
                if len(low) > k:
                    self.floor[i] = low[-1 - k]
        self.blocks = np.array([-(-queries.get(i, 0) // BLOCK) for i in range(m)])
        some = np.array([sum(counts[j] for j, ds in nearest.items() if self.needs(i, j, ds[-1])) for i in range(m)])
        self.parts = np.maximum(1, -(-some // PART))
        self.first = np.concatenate([[0], np.cumsum(self.blocks * self.parts)])

    def upper(self, i, j, away):
        with np.errstate(all="ignore"):
            return np.nan_to_num(self.base[i, j] + self.slope[i] * away, nan=np.inf)

    def needs(self, i, j, away):
        """Whether a vector of group j at this distance may be in a result of group i."""
        return self.upper(i, j, away) >= self.floor[i]


def _pieces(v: pa.Array) -> np.ndarray:
    """A number from the vector, to deal equal groups into blocks and parts."""
    import xxhash
    return np.array([xxhash.xxh64_intdigest(x) for x in v.to_pylist()], np.uint64) >> np.uint64(1)


def _dealt(queries: DataFrame, data: DataFrame, bounds) -> DataFrame:
    """Queries and the vectors copied to them, by task: group, block and part."""
    out = "task long, kind int, up double, qid long, v binary, ids array<struct<none:boolean,vec_id:long,uid:long>>"

    def deal(batches, kind):
        b = bounds.value
        for rows in batches:
            cell, piece = rows.column("cell").to_numpy(), _pieces(rows.column("v"))
            if kind == 0:
                block = piece % b.blocks[cell].astype(np.uint64)
                times = b.parts[cell]
                at = np.repeat(np.arange(len(cell)), times)
                part = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
                task = b.first[cell[at]] + block[at].astype(int) * b.parts[cell[at]] + part
                yield _batch(rows, at, task, 0, np.zeros(len(at)))
                continue
            away = rows.column("away").to_numpy()
            for i in np.flatnonzero(b.blocks).tolist():
                up = b.upper(i, cell, away)
                at = np.flatnonzero(up >= b.floor[i])
                part = (piece[at] % np.uint64(b.parts[i])).astype(int)
                for block in range(int(b.blocks[i]) if len(at) else 0):
                    yield _batch(rows, at, b.first[i] + block * b.parts[i] + part, 1, up[at])

    def _batch(rows, at, task, kind, up):
        taken = rows.take(pa.array(at))
        return pa.RecordBatch.from_arrays(
            [pa.array(task, pa.int64()), pa.array(np.full(len(at), kind, np.int32)), pa.array(up),
             taken.column("qid"), taken.column("v"), taken.column("ids")], names=["task", "kind", "up", "qid", "v", "ids"])
    ids = "array<struct<none:boolean,vec_id:long,uid:long>>"
    q = queries.select("v", "qid", F.lit(None).cast(ids).alias("ids"), "cell", "away")
    d = data.select("v", F.lit(None).cast("long").alias("qid"), "ids", "cell", "away")
    return (q.mapInArrow(lambda batches: deal(batches, 0), out)
            .unionByName(d.mapInArrow(lambda batches: deal(batches, 1), out)))


def scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer inner products, clipped to 64 bits. Doubles are exact below
    2**53; rows that could pass it are multiplied as Python integers."""
    wide = max(queries.shape[1], data.shape[1])
    queries, data = (np.pad(a, ((0, 0), (0, wide - a.shape[1]))) for a in (queries, data))
    most = (2.0 ** 53 / max(1, wide)) ** 0.5
    big_q, big_d = (np.abs(a).max(1, initial=0) >= most for a in (queries, data))
    with np.errstate(all="ignore"):
        out = np.where(big_q[:, None], 0, queries) @ np.where(big_d[:, None], 0, data).T
    out = out.astype(np.int64)
    exact = [[int(x) for x in row] for row in (queries if big_q.any() or big_d.any() else ())]
    for j in np.flatnonzero(big_d).tolist():
        column = [int(x) for x in data[j]]
        for i, row in enumerate(exact):
            out[i, j] = min(max(sum(a * b for a, b in zip(row, column)), _LONG[0]), _LONG[1])
    for i in np.flatnonzero(big_q).tolist():
        for j in np.flatnonzero(~big_d).tolist():
            out[i, j] = min(max(sum(a * int(b) for a, b in zip(exact[i], data[j])), _LONG[0]), _LONG[1])
    return out


class _Block:
    """The queries of a task and their best vectors so far."""

    def __init__(self, rows: list[pa.RecordBatch], k: int):
        self.k = k + 1
        self.qid = np.concatenate([r.column("qid").to_numpy() for r in rows])
        self.x = unpack([v for r in rows for v in r.column("v").to_pylist()])
        none = np.zeros(0, np.int64)
        self.row, self.score, self.id, self.none, self.at = none, none, none, none.astype(bool), none
        self.ids: list[pa.Array] = []  # of the vectors that are or were among the best
        self.kept = 0
        self.least = np.full(len(self.qid), _LONG[0])
        self.full = np.zeros(len(self.qid), bool)

    def over(self, up: float) -> bool:
        """Whether no vector with an upper bound of at most ``up`` can matter."""
        return bool(self.full.all()) and up < self.least.min()

    def add(self, rows: pa.RecordBatch) -> None:
        ids = rows.column("ids")
        first = ids.flatten().take(pa.array(ids.offsets.to_numpy()[:-1] - ids.offsets.to_numpy()[0]))
        none = first.field("none").to_numpy(zero_copy_only=False)
        id = first.field("vec_id").fill_null(0).to_numpy()
        found = scores(self.x, unpack(rows.column("v").to_pylist()))
        if found.shape[1] > self.k:
            least = np.maximum(self.least, np.partition(found, -self.k, axis=1)[:, -self.k])
        else:
            least = self.least
        q, at = np.nonzero(found >= least[:, None])
        if not len(q):
            return
        used, place = np.unique(at, return_inverse=True)
        self.ids.append(ids.take(pa.array(used)))
        row = np.concatenate([self.row, q])
        score = np.concatenate([self.score, found[q, at]])
        none = np.concatenate([self.none, none[at]])
        id = np.concatenate([self.id, id[at]])
        at = np.concatenate([self.at, self.kept + place])
        self.kept += len(used)
        order = np.lexsort((id, none, -1 - score, row))  # -1 - x: descending, without overflow
        starts = np.searchsorted(row[order], np.arange(len(self.qid)))
        rank = np.arange(len(order)) - starts[row[order]]
        best = order[rank < self.k]
        self.row, self.score, self.id, self.none, self.at = row[best], score[best], id[best], none[best], at[best]
        last = order[rank == self.k - 1]
        self.least[row[last]], self.full[row[last]] = score[last], True
        if self.kept > 8 * len(self.qid) * self.k:
            self._compact()

    def _compact(self) -> None:
        used, self.at = np.unique(self.at, return_inverse=True)
        self.ids, self.kept = [pa.concat_arrays(self.ids).take(pa.array(used))], len(used)

    def results(self) -> Iterator[pa.RecordBatch]:
        if len(self.row):
            self._compact()
            yield pa.RecordBatch.from_arrays(
                [pa.array(self.qid[self.row]), pa.array(self.score), self.ids[0].take(pa.array(self.at))],
                names=["qid", "score", "ids"])


def _solved(dealt: DataFrame, k: int, tasks: int) -> DataFrame:
    """qid, score, ids: the best vectors of each query in each task."""
    def run(batches):
        now, queries, block, done = None, [], None, False
        for b in batches:
            task, kind = b.column("task").to_numpy(), b.column("kind").to_numpy()
            cuts = 1 + np.flatnonzero((np.diff(task) != 0) | (np.diff(kind) != 0))
            for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(task)]):
                if start == end:
                    continue
                rows = b.slice(start, end - start)
                if task[start] != now:
                    if block:
                        yield from block.results()
                    now, queries, block, done = task[start], [], None, False
                if kind[start] == 0:
                    queries.append(rows)
                    continue
                if not queries:  # no query fell into this block
                    continue
                block = block or _Block(queries, k)
                up = rows.column("up").to_numpy()
                for i in range(0, len(up), _STEP):
                    done = done or block.over(up[i])
                    if done:
                        break
                    block.add(rows.slice(i, _STEP))
        if block:
            yield from block.results()
    n = max(dealt.sparkSession.sparkContext.defaultParallelism, min(tasks, MAX_TASKS))
    ordered = dealt.repartition(n, "task").sortWithinPartitions("task", "kind", F.desc("up"))
    return ordered.mapInArrow(run, "qid long, score long, ids array<struct<none:boolean,vec_id:long,uid:long>>")


def top_k(rows: DataFrame, is_query: Column, k: int = 20, id: str = "vec_id", vector: str = "embedding",
          scale: float = 64.0, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query`` holds (a
    condition on ``vec_id``) the ``k`` other rows with the largest inner product."""
    sc = rows.sparkSession.sparkContext
    vectors = materialize(integer_vectors(rows, id, vector, scale).withColumn("uid", F.monotonically_increasing_id()))
    entry = F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "uid")
    # the rank filter is applied in each task before the shuffle too, so a hot vector does not pile up
    order = Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"), "uid")
    data = (vectors.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= k + 1)
            .groupBy("v").agg(F.sort_array(F.collect_list(entry)).alias("ids")))
    data = materialize(data)
    asked = vectors.where(is_query)
    distinct = materialize(asked.groupBy("v").agg(F.count(F.lit(1)).alias("asked"))
                           .withColumn("qid", F.monotonically_increasing_id()))
    m = min(MAX_PIVOTS, max(1, -(-distinct.count() // group)))
    pivots = [bytes(r["v"]) for r in data.orderBy(F.xxhash64("v"), "v").limit(m).select("v").collect()]
    shared = sc.broadcast(pivots or [pack(np.zeros(0))])
    ids = "array<struct<none:boolean,vec_id:long,uid:long>>"
    data = materialize(_assigned(data.select("v", "ids"), shared, f"v binary, ids {ids}, cell long, away double"))
    queries = materialize(_assigned(distinct.select("v", "qid"), shared, "v binary, qid long, cell long, away double"))

    near = data.withColumn("rn", F.row_number().over(Window.partitionBy("cell").orderBy("away"))).where(F.col("rn") <= k + 1)
    nearest: dict = {}
    for r in near.groupBy("cell").agg(F.sort_array(F.collect_list("away")).alias("away")).collect():
        nearest[r["cell"]] = list(r["away"])
    counts = {}
    for r in data.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("far")).collect():
        counts[r["cell"]] = r["n"]
        nearest[r["cell"]].append(r["far"])
    size, radius = {}, {}
    for r in queries.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("far")).collect():
        size[r["cell"]], radius[r["cell"]] = r["n"], r["far"]
    bounds = Bounds(shared.value, size, radius, counts, nearest, k)
    solved = _solved(_dealt(queries, data, sc.broadcast(bounds)), k, int(bounds.first[-1]))

    flat = solved.select("qid", "score", F.explode("ids").alias("e")).select("qid", "score", "e.*")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "none", "vec_id", "uid")
    packed = (flat.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= k + 1)
              .groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rn", "vec_id", "uid", "score"))).alias("best")))
    packed = materialize(packed.join(distinct, "qid").select("v", "asked", "best"))
    own = (join_hot(asked.withColumnRenamed("vec_id", "query_id"), packed, ["v"], "asked")
           .select("query_id", F.slice(F.filter("best", lambda e: e["uid"] != F.col("uid")), 1, k).alias("best")))
    return own.select("query_id", F.posexplode("best").alias("i", "e")).select(
        "query_id", (F.col("i") + 1).alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))
