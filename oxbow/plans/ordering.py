"""Row numbers in a total order, without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row into
one task. ``with_ordinal`` does the same numbering at any size:

1. a tie id is attached as the last sort key, so even a group of identical rows
   has distinct keys and the range partitioner can split it. The id depends on
   the order of the input rows, so the input must give the same rows in the same
   order when a task runs again: a file scan does; anything behind a shuffle is
   checkpointed first (``stable_input=False``);
2. ``repartitionByRange(n, keys)`` + ``sortWithinPartitions``, with ``n`` from
   the row count (an explicit partition count keeps partition ids stable between
   the two readers of this shuffle);
3. ``monotonically_increasing_id`` after the sort packs (partition id, index
   within partition);
4. the tagged rows are checkpointed (shared ``spark.checkpoint.dir``), less the
   sort-only columns, so the per-partition counts and the numbering read one
   materialization: a range shuffle computed twice samples its bounds twice and
   may cut differently. Select the columns you need before the call;
5. per-partition counts (one number per partition, as ``zipWithIndex``
   gathers them) give prefix offsets, which are broadcast -- their size is
   bounded by the partition count.

Long sort keys: the range partitioner samples whole keys and brings them to the
driver. ``with_ordinal_by_text`` gives it only the first ``PREFIX`` characters of a
long text; the whole texts are compared within partitions. Rows that share a
prefix stay together, so a prefix with more rows than a partition should hold is
taken out: light stubs keep its place in the order, and its rows are ordered on
their own by the text behind their common beginning, which again is cut to a
prefix, until all parts are small or the texts are equal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oxbow.plans.joins import bounded_broadcast
from oxbow.session import shared_dir

_LOCAL_BITS = 33
# Rows a partition of the sorted table is meant to hold.
ROWS_PER_PARTITION = 1_000_000
# A table of at most this many rows is numbered by one plain window.
SMALL_ROWS = 10_000
# Characters of a long text that take part in range partitioning, and bytes of
# text that weigh as much as one more row.
PREFIX = 64
ROW_BYTES = 1024


def with_ordinal(df: DataFrame, order: list[Column], name: str = "ordinal", partitions: int | None = None,
                 stable_input: bool = False, drop: tuple[str, ...] = ()) -> DataFrame:
    """Add ``name``: the 1-based position of each row in ``order``.

    ``order`` is a list of sort columns (use ``asc_nulls_first`` etc. to fix
    the NULL position). Rows tied on every sort key are numbered in an
    arbitrary but consistent order. ``drop`` names columns needed only for
    sorting. ``stable_input`` says that ``df`` reads files without a shuffle.
    """
    spark = df.sparkSession
    shared_dir(spark)
    if not stable_input:
        df = df.checkpoint(eager=True)
    keyed = df.withColumn("_ord_tb", F.monotonically_increasing_id())
    n = partitions or _partitions(df, df.count())
    keys = list(order) + [F.col("_ord_tb").asc()]
    return _numbered(keyed.repartitionByRange(n, *keys).sortWithinPartitions(*keys), name, ("_ord_tb", *drop))


def _partitions(df: DataFrame, rows: int) -> int:
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PARTITION))


def _numbered(ordered: DataFrame, name: str, drop: tuple[str, ...]) -> DataFrame:
    """Number the rows of range partitions, each sorted (steps 3 to 5)."""
    spark = ordered.sparkSession
    tagged = (ordered.withColumn("_ord_mid", F.monotonically_increasing_id())
              .withColumn("_ord_pid", F.shiftright("_ord_mid", _LOCAL_BITS))
              .withColumn("_ord_local", F.col("_ord_mid").bitwiseAND((1 << _LOCAL_BITS) - 1))
              .drop("_ord_mid", *drop))
    tagged = tagged.checkpoint(eager=True)
    # One count per partition (at most ``n`` small rows, like zipWithIndex);
    # the prefix offsets are computed from them and broadcast back.
    counts = sorted((r["_ord_pid"], r["_ord_n"]) for r in
                    tagged.groupBy("_ord_pid").agg(F.count(F.lit(1)).alias("_ord_n")).collect())
    offsets, acc = [], 0
    for pid, cnt in counts:
        offsets.append((pid, acc))
        acc += cnt
    off_df = spark.createDataFrame(offsets or [(0, 0)], "_ord_pid long, _ord_off long")
    out = tagged.join(F.broadcast(off_df), "_ord_pid")
    return (out.withColumn(name, F.col("_ord_off") + F.col("_ord_local") + 1)
            .drop("_ord_pid", "_ord_local", "_ord_off"))


def text_key(first: Column, second: Column) -> Column:
    """One text that sorts as the pair (first, second): neither is null."""
    return F.concat(F.replace(first, F.lit("\0"), F.lit("\0\1")), F.lit("\0\0"), second)


def _common_length(a: Column, b: Column) -> Column:
    """Length of the common beginning of two texts, by halving steps."""
    def step(found: Column, i: Column) -> Column:
        longer = found + i
        ok = (longer <= F.length(a)) & (F.substring(a, F.lit(1), longer) == F.substring(b, F.lit(1), longer))
        return F.when(ok, longer).otherwise(found)
    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(30, -1, -1)]), F.lit(0), step)


def with_ordinal_by_text(df: DataFrame, short: list[str], text: str, name: str = "ordinal", stable_input: bool = False,
                         drop: tuple[str, ...] = (), heavy: int | None = None) -> DataFrame:
    """Add ``name``: the 1-based position of each row by the columns ``short``
    (ascending, nulls first; short values), then by ``text`` (nulls first), which
    may be long. Rows equal in all of these are numbered in an arbitrary but
    consistent order. ``heavy`` is the number of rows (plus their text in units of
    ``ROW_BYTES``) above which rows that share a prefix are split further.
    """
    shared_dir(df.sparkSession)
    if not stable_input:
        df = df.checkpoint(eager=True)
    own = [c for c in df.columns if c not in drop]
    heavy = heavy or ROWS_PER_PARTITION
    keys = [f"_ord_s{i}" for i in range(len(short) + 1)]
    slim = (df.withColumns({k: F.col(f"`{c}`") for k, c in zip(keys, short)})
            .withColumn(keys[-1], F.col(f"`{text}`").isNotNull())
            .withColumn("_ord_text", F.coalesce(F.col(f"`{text}`"), F.lit("")))
            .withColumn("_ord_tb", F.monotonically_increasing_id())
            .select(*own, *keys, "_ord_text", "_ord_tb"))
    return _by_prefix(slim, own, keys, name, heavy).select(*own, name)


def _by_prefix(rows: DataFrame, own: list[str], keys: list[str], name: str, heavy: int) -> DataFrame:
    """``rows``: columns ``own``, ``keys``, _ord_text, _ord_tb (unique)."""
    rows = rows.withColumn("_ord_prefix", F.substring("_ord_text", 1, PREFIX))
    group = [*keys, "_ord_prefix"]
    weight = F.sum(1 + F.octet_length("_ord_text") / ROW_BYTES)
    # found by a hash first: as a rule there is no heavy prefix, and only numbers are shuffled
    hashed = rows.withColumn("_ord_hash", F.xxhash64(*group))
    sizes = hashed.groupBy("_ord_hash").agg(F.count(F.lit(1)).alias("n"), weight.alias("w")).checkpoint(eager=True)
    total = int(sizes.agg(F.sum("n")).first()[0] or 0)
    n = _partitions(rows, total)
    suspects = sizes.where(F.col("w") > heavy).select("_ord_hash")  # at most (all weight / heavy)
    order = [F.col(k).asc_nulls_first() for k in group]
    if suspects.isEmpty():
        ranged = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "_ord_text")
        return _numbered(ranged, name, (*group, "_ord_text", "_ord_tb"))

    classes = (hashed.join(F.broadcast(suspects), "_ord_hash", "left_semi").groupBy(*group)
               .agg(weight.alias("w"), F.min("_ord_text").alias("low"), F.max("_ord_text").alias("high"))
               .where(F.col("w") > heavy)
               .select(*group, F.monotonically_increasing_id().alias("_ord_class"),
                       _common_length(F.col("low"), F.col("high")).alias("_ord_skip"),
                       (F.col("low") == F.col("high")).alias("_ord_equal"))
               .checkpoint(eager=True))  # no long text any more; as bounded as the suspects
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in group]
    tagged = (rows.alias("r").join(F.broadcast(classes).alias("c"), same, "left")
              .select("r.*", "c._ord_class", "c._ord_skip", "c._ord_equal"))
    within = F.coalesce(~F.col("_ord_equal"), F.lit(False))  # heavy, and the texts differ
    tie = F.when(F.col("_ord_class").isNull(), F.lit(0)).otherwise(F.col("_ord_tb") + 1)
    stub = lambda c: F.when(~within, F.col(f"`{c}`")).alias(c)
    placed = tagged.select(*map(stub, own), *group, stub("_ord_text"), tie.alias("_ord_tie"),
                           F.when(within, F.col("_ord_class")).alias("_ord_class"))
    by = [*order, F.asc("_ord_tie")]
    ranged = placed.repartitionByRange(n, *by).sortWithinPartitions(*order, F.asc_nulls_first("_ord_text"), "_ord_tie")
    numbered = _numbered(ranged, name, (*group, "_ord_text", "_ord_tie"))
    done = numbered.where(F.col("_ord_class").isNull()).select(*own, name)
    starts = numbered.where(F.col("_ord_class").isNotNull()).groupBy("_ord_class").agg(F.min(name).alias("_ord_start"))

    of = f"_ord_of{len(own)}"  # another name at each level
    rest = tagged.where(within).withColumn("_ord_text", F.expr("substring(_ord_text, _ord_skip + 1)"))
    inner = _by_prefix(rest.select(*own, F.col("_ord_class").alias("_ord_k"), F.col("_ord_class").alias(of),
                                   "_ord_text", "_ord_tb"), [*own, of], ["_ord_k"], name, heavy)
    first = inner.groupBy(of).agg(F.min(name).alias("_ord_first"))
    shift = (starts.join(first, F.col("_ord_class") == F.col(of))
             .select(of, (F.col("_ord_start") - F.col("_ord_first")).alias("_ord_shift")))
    moved = inner.join(F.broadcast(shift), of).withColumn(name, F.col(name) + F.col("_ord_shift"))
    return done.unionByName(moved.select(*own, name))


def with_rank(df: DataFrame, order: list[Column], name: str = "rn") -> DataFrame:
    """``with_ordinal`` for a table that is small as a rule (a report): it is
    checkpointed and counted, and a small one is numbered by one window."""
    shared_dir(df.sparkSession)
    df = df.checkpoint(eager=True)
    if df.count() <= SMALL_ROWS:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("long"))
    return with_ordinal(df, order, name, stable_input=True)


def with_ordinal_within(df: DataFrame, group: str, order: list[Column], name: str = "seq",
                        partitions: int | None = None, stable_input: bool = False,
                        drop: tuple[str, ...] = (), text: str | None = None) -> DataFrame:
    """Position of each row inside its ``group`` when groups are contiguous in
    ``order`` (``group`` ascending is the first sort key). With ``text``, a column of
    long texts that breaks ties, ``order`` names columns (``with_ordinal_by_text``).

    seq = global ordinal - (first global ordinal of the group) + 1; the group
    starts are one row per group, aggregated map-side.
    """
    if text:
        ranked = with_ordinal_by_text(df, [group, *order], text, "_ord_g", stable_input, drop)
    else:
        ranked = with_ordinal(df, [F.col(group).asc_nulls_first()] + list(order), "_ord_g", partitions,
                              stable_input, drop)
    # One row per group: broadcast behind a check of its size, so the ranked rows
    # are not shuffled by group (a hot group would land in one task). Above
    # the bound the inner join is left to the planner and AQE skew splitting.
    starts = bounded_broadcast(ranked.groupBy(F.col(group).alias("_ord_group"))
                               .agg(F.min("_ord_g").alias("_ord_start")))
    out = ranked.join(starts, F.col(group).eqNullSafe(F.col("_ord_group")))
    return (out.withColumn(name, F.col("_ord_g") - F.col("_ord_start") + 1)
            .drop("_ord_g", "_ord_group", "_ord_start"))
