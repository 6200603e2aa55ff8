"""Mixing sources to target weights by the cube method (operator 4).

``targets`` shares the words of all documents among the sources by weight, no
source above ``MOST`` times its own words. A document of source s is wanted
target_s / size_s times: the whole part is taken as copies, the fraction is its
inclusion probability. The flight phase moves the fractions along the null space
of two constraints, tokens and documents, until one more is settled, so both
totals keep their expectation; the largest documents settle first. Flights run
over blocks of a source; each leaves at most two fractions, which fly again in
blocks of blocks, until at most two per source are left. The landing settles
these so that the source's words come nearest their target.

All draws are seeded by source, block and round, and each block is sorted, so
reruns agree however the rows are partitioned.

Defined cases: a null or empty text has size 0 and counts as a document; texts of
any length are counted whole; the null source is a source of its own, the last in
order; a source without words has target 0; repeated rows are documents of their
own, numbered so that any number of them spreads over the blocks; ties in size are
ordered by id, then number; extra columns, whatever their names, are ignored by
``mixture`` and kept by ``mixed``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import WORD_RE, anti_hot, identified, join_hot, materialize, repeated
from oxbow.plans.ordering import with_ordinal
from oxbow.session import ship_package

#: Weights of the sources in order, and the most a source is repeated.
WEIGHTS, MOST = (5, 2, 1), 3
#: Documents of a block; the two fractions of so many half blocks fly together.
BLOCK = 2048
_EDGE = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add ``target`` to ``sources`` (source, source_size): shares by weight in
    source order, capped at ``most`` times the size, the excess shared again."""
    ranked = materialize(with_ordinal(sources, [F.asc_nulls_last("source")], "__rank"))
    cycle = F.array(*map(F.lit, weights))
    weighted = ranked.withColumn("__w", F.element_at(cycle, ((F.col("__rank") - 1) % len(weights) + 1).cast("int")))
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    total, free = weighted.agg(F.sum(whole("source_size")), F.sum(whole("__w"))).first()
    rest, capped = int(total or 0), 0
    free = int(free or 0)
    over = F.lit(False)
    while free:
        # level = rest / free; one scalar row per pass, as many passes as caps set off others
        over = whole("source_size") * most * free < whole("__w") * F.lit(rest).cast("decimal(38,0)")
        n, size, w = weighted.where(over).agg(F.count(F.lit(1)), F.sum(whole("source_size")), F.sum(whole("__w"))).first()
        if n == capped:
            break
        capped, rest = n, int(total) - most * int(size)
        free = int(weighted.agg(F.sum(whole("__w"))).first()[0]) - int(w)
    share = (F.col("__w") * F.lit(float(rest))) / F.lit(float(free or 1))
    target = F.when(over, (F.col("source_size") * most).cast("double")).otherwise(share)
    return weighted.withColumn("target", target).drop("__rank", "__w")


def _direction(size: np.ndarray) -> np.ndarray:
    """A vector of the null space of both constraints (sum u = sum u * size = 0)
    for at least three units, the largest first: it moves the first unit by 1
    and spreads the counterweight over all others, so large units settle first."""
    u = np.zeros(len(size))
    head, rest = size[0], size[1:]
    n, s1, s2 = len(rest), rest.sum(), (rest * rest).sum()
    det = n * s2 - s1 * s1
    if det > 1e-9 * max(n * s2, 1.0):
        u[0] = 1
        u[1:] = -((n * head - s1) * rest + (s2 - s1 * head)) / det
    elif head == rest[0]:
        u[0], u[1:] = 1, -1 / n
    else:
        u[1], u[2] = 1, -1
    return u


def flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the fractions of ``p`` (sizes descending) along the null space until
    at most two are left; sum(p) and sum(p * size) keep their values."""
    p = np.where((p > _EDGE) & (p < 1 - _EDGE), p, np.round(p))
    live = np.flatnonzero((p > 0) & (p < 1))
    q, s = p[live], size[live]
    while len(q) > 2:
        u = _direction(s)
        with np.errstate(divide="ignore", invalid="ignore"):
            ahead = np.where(u > 0, (1 - q) / u, np.where(u < 0, -q / u, np.inf)).min()
            back = np.where(u > 0, q / u, np.where(u < 0, (q - 1) / u, np.inf)).min()
        q = q + (ahead if rng.random() * (ahead + back) < back else -back) * u
        q = np.where((q > _EDGE) & (q < 1 - _EDGE), q, np.round(q))
        p[live] = q
        on = (q > 0) & (q < 1)
        live, q, s = live[on], q[on], s[on]
    return p


def landing(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Settle at most two fractions so that the words come nearest their
    expectation, then the documents."""
    p = p.copy()
    open_ = np.flatnonzero((p > 0) & (p < 1))
    ways = [tuple(n >> i & 1 for i in range(len(open_))) for n in range(1 << len(open_))]
    p[open_] = min(ways, key=lambda x: (abs(float(np.dot(size[open_], x - p[open_]))), abs(sum(x - p[open_])), x))
    return p


def cube(units: DataFrame, blocks: str, keys: list[str], size: str, p: str, unit: str) -> DataFrame:
    """``units`` with each fraction in ``p`` settled to 0 or 1.

    ``keys`` name the group (a source) and are not null; ``blocks`` holds its
    number of blocks. A unit's draw depends on ``unit`` (its id), size and, where
    rows share these, its ``__nth``; the other columns are carried along and only
    order rows that share all.
    """
    ship_package(units.sparkSession)
    rest = [c for c in units.columns if c not in (p, size, unit)]
    units = units.withColumn("__block", F.pmod(F.xxhash64(unit, size, "__nth"), F.col(blocks)))
    schema = units.schema
    most = units.agg(F.max(blocks)).first()[0] or 1
    names = units.columns
    together = BLOCK // 2
    rounds = 1 + max(0, math.ceil(math.log(most, together) - 1e-12))
    by = [(size, "descending"), *((c, "ascending") for c in [unit, *rest])]

    def flying(turn: int, last: bool):
        def fly(key, rows):
            rows = rows.sort_by(by)
            sizes = rows.column(size).to_numpy().astype(float)
            seed = zlib.crc32(repr([k.as_py() for k in key]).encode())
            moved = flight(sizes, rows.column(p).to_numpy(), np.random.default_rng([seed, turn]))
            if last:
                moved = landing(sizes, moved)
            return rows.set_column(names.index(p), p, pa.array(moved))
        return fly

    settled = None
    for turn in range(rounds):
        units = materialize(units.groupBy(*keys, "__block")
                            .applyInArrow(flying(turn, turn == rounds - 1), schema))
        open_ = (F.col(p) > 0) & (F.col(p) < 1)
        done = units.where(~open_)
        settled = done if settled is None else settled.unionByName(done)
        units = units.where(open_).withColumn("__block", F.floor(F.col("__block") / together))
    return settled.drop("__block")


def _numbered_repeats(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``__nth``: 0 for a row alone with its source, id and size; other rows are
    numbered through in that order, so that repeats go to different blocks. Which of
    the repeats has which number does not matter, so reruns agree."""
    kind = rows.schema["doc_id"].dataType
    same = ["__unit", "__unit_none", *keys, "size"]
    keyed = rows.withColumns({"__unit": F.coalesce(F.col("doc_id"), F.lit(0).cast(kind)),
                              "__unit_none": F.col("doc_id").isNull()})
    often = materialize(keyed.groupBy(*same).agg(F.count(F.lit(1)).alias("__same")).where("__same > 1"))
    if often.isEmpty():
        return rows.withColumn("__nth", F.lit(0).cast("long"))
    again = with_ordinal(join_hot(keyed, often, same, "__same").drop("__same"), [F.asc(c) for c in same], "__nth")
    alone = anti_hot(keyed, often, same, "__same").withColumn("__nth", F.lit(0).cast("long"))
    return materialize(alone.unionByName(again).drop("__unit", "__unit_none"))


def mixture(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
            carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry``, size, source_size, target and taken, one row per document."""
    keys = ["__source", "__none"]
    rows = materialize(docs.select(
        "doc_id", *carry, word_count(F.col("text")).alias("size"), "source",
        F.coalesce(F.col("source"), F.lit("")).alias("__source"), F.col("source").isNull().alias("__none")))
    sources = rows.groupBy("source", *keys).agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__docs"))
    wanted = targets(sources, weights, most).drop("source")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    wanted = materialize(wanted.withColumn("__whole", F.floor(times))
                         .withColumn("__p", times - F.floor(times))
                         .withColumn("__blocks", F.ceil(F.col("__docs") / BLOCK)))
    units = join_hot(_numbered_repeats(rows.drop("source"), keys), wanted, keys, "__docs").drop("__docs")
    chosen = cube(units, "__blocks", keys, "size", "__p", "doc_id")
    return chosen.select("doc_id", *carry, "size", "source_size", "target",
                         (F.col("size") * (F.col("__whole") + F.col("__p").cast("long"))).alias("taken"),
                         (F.col("__whole") + F.col("__p").cast("long")).alias("copies"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken."""
    rows = identified(docs)
    return repeated(rows, mixture(rows.select("uid", "row.doc_id", "row.text", "row.source"), weights, most, carry=("uid",)))
