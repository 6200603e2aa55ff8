"""Range minimum for many queries (JOB6; SC19, JN7, AG5).

A plain ``pos BETWEEN p AND q`` join plans as a Cartesian / nested-loop join.
Instead both sides meet on an equi-join over aligned blocks:

* cells: at level k = 0..L, cell c holds the minimum of positions [c*R^k,
  (c+1)*R^k) with radix R. Level 0 has the positions themselves. R neighbouring
  cells are a block, kept as one row; it is one cell of the next level, which is
  aggregated from these rows. So each position is shuffled in the aggregate of
  its block and once more, with its block, in the join.
* query pieces: [p, q] covers the cells lo_k = ceil(p / R^k) .. hi_k = floor((q+1)
  / R^k) - 1 of level k; those whose block is a covered cell of level k+1 are left
  out, which leaves one run of cells at either end, each within a block. A piece is
  a block with its first and last cell: two per level and query at most.
* pieces JOIN blocks ON (level, block), a sort-merge join at any size, then MIN
  per query together with one NULL row per query, which never takes part in the
  join.

L = floor(log_R(longest query)), measured with one aggregate. Every query gets a
row (NULL when its range holds no position, or when p > q); ``query_id`` must be
unique, since rows that share one are one query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Symbol -> impact factor of the nucleotide sequence task.
FACTORS = {"A": 1, "C": 2, "G": 3, "T": 4}


def symbol_factor(symbol: Column | str) -> Column:
    """Factor of a symbol; an unknown (or NULL) symbol is an error."""
    s = F.col(symbol) if isinstance(symbol, str) else symbol
    expr = None
    for k, v in FACTORS.items():
        expr = F.when(s == k, F.lit(v)) if expr is None else expr.when(s == k, F.lit(v))
    return expr.otherwise(F.raise_error(F.concat(F.lit("unknown symbol: "),
                                                 F.coalesce(s, F.lit("NULL")))))


# Cells of a level that make one cell of the next: a power of two.
RADIX_BITS = 4
RADIX = 1 << RADIX_BITS


def max_level(queries: DataFrame, lo: str = "p", hi: str = "q") -> int:
    """floor(log_RADIX(longest query length)); 0 when there is no proper range."""
    longest = queries.select(F.max(F.col(hi) - F.col(lo) + 1).alias("m")).first()["m"] or 0
    level = 0
    while RADIX ** (level + 1) <= longest:
        level += 1
    return level


def _down(c: Column, levels: int) -> Column:
    """floor(c / RADIX**levels), for any sign."""
    return F.shiftright(c, levels * RADIX_BITS)


def block_minima(positions: DataFrame, levels: int, pos: str = "pos",
                 value: str = "value") -> DataFrame:
    """(level, block, present, minima) for levels 0..``levels``: bit i of ``present``
    is set if the block's cell i has a value; ``minima`` has these cells' in order."""
    # Never NULL after the filter; a key known as such gets no filter of its own at
    # each level, so that all levels share one scan and shuffle of the positions.
    at = F.coalesce(F.col(pos).cast("long"), F.lit(0))
    cells = positions.where(F.col(pos).isNotNull()).select(at.alias("cell"), F.col(value).alias("cell_min"))
    out = None
    for level in range(levels + 1):
        slot = F.col("cell").bitwiseAND(RADIX - 1)
        mins = [F.min(F.when(slot == i, F.col("cell_min"))).alias(f"_{i}") for i in range(RADIX)]
        present = sum((F.when(F.col(f"_{i}").isNotNull(), F.lit(1 << i)).otherwise(0) for i in range(RADIX)), F.lit(0))
        blocks = cells.groupBy(_down(F.col("cell"), 1).alias("block")).agg(*mins).select(
            F.lit(level).alias("level"), "block", present.alias("present"),
            F.array_compact(F.array(*[f"_{i}" for i in range(RADIX)])).alias("minima"))
        out = blocks if out is None else out.unionByName(blocks)
        cells = blocks.select(F.col("block").alias("cell"), F.array_min("minima").alias("cell_min"))
    return out


def query_pieces(queries: DataFrame, levels: int, qid: str = "query_id", lo: str = "p",
                 hi: str = "q") -> DataFrame:
    """(query_id, level, block, first, last): the cells that make up each range, as
    the first and last of a block."""
    base = queries.select(F.col(qid).alias("query_id"), F.col(lo).cast("long").alias("_p"),
                          F.col(hi).cast("long").alias("_q")).where("_p <= _q")
    covered = [(_down(F.col("_p") + (RADIX ** k - 1), k), _down(F.col("_q") + 1, k) - 1)
               for k in range(levels + 1)]

    def run(level: int, a: Column, b: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), a.alias("_a"), b.alias("_b"))

    runs = []
    for k, (first, last) in enumerate(covered):
        if k == levels:
            runs.append(run(k, first, last))
            continue
        up_first, up_last = covered[k + 1]
        none = up_first > up_last
        runs.append(run(k, first, F.when(none, last).otherwise(up_first * RADIX - 1)))
        runs.append(run(k, F.when(none, last + 1).otherwise((up_last + 1) * RADIX), last))
    cells = base.select("query_id", F.inline(F.array(*runs))).where("_a <= _b")
    block, start = F.col("block"), F.col("block") * RADIX
    return (cells.select("*", F.explode(F.sequence(_down(F.col("_a"), 1), _down(F.col("_b"), 1))).alias("block"))
            .select("query_id", "level", block,
                    (F.greatest("_a", start) - start).cast("int").alias("first"),
                    (F.least("_b", start + (RADIX - 1)) - start).cast("int").alias("last")))


def _piece_min() -> Column:
    """Minimum of the cells ``first``..``last`` of a block; NULL if none has a value."""
    skipped = F.expr("bit_count(present & (shiftleft(1, first) - 1))")
    upto = F.expr("bit_count(present & (shiftleft(1, last + 1) - 1))")
    return F.array_min(F.slice("minima", skipped + 1, upto - skipped))


def range_min(positions: DataFrame, queries: DataFrame, *, pos: str = "pos", value: str = "value",
              qid: str = "query_id", lo: str = "p", hi: str = "q",
              levels: int | None = None) -> DataFrame:
    """(query_id, min_value): minimum of ``value`` over positions p..q inclusive."""
    if levels is None:
        levels = max_level(queries, lo, hi)
    minima = block_minima(positions, levels, pos, value)
    # The planner sizes the pieces by their queries and would broadcast them by that.
    found = query_pieces(queries, levels, qid, lo, hi).hint("merge").join(minima, ["level", "block"])
    kind = positions.schema[value].dataType
    every = queries.select(F.col(qid).alias("query_id"), F.lit(None).cast(kind).alias("piece_min"))
    return (found.select("query_id", _piece_min().alias("piece_min")).unionByName(every)
            .groupBy("query_id").agg(F.min("piece_min").alias("min_value")))


def symbol_positions(sequence: DataFrame, pos: str = "pos", symbol: str = "symbol") -> DataFrame:
    """SC19: (pos, value) of a symbol sequence; the value is the symbol's factor."""
    return sequence.select(F.col(pos).alias("pos"), symbol_factor(symbol).alias("value"))
