"""Helpers shared by the training-data operators.

* ``map_texts``   -- Arrow-batched per-text work on executors (no shuffle)
* ``join_hot``    -- many-to-one join whose heavy keys cannot pile up in a task
* ``materialize`` -- cut lineage with a reliable checkpoint
* ``identified`` / ``without`` / ``repeated`` -- keep, drop or repeat whole rows by identity
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from oxbow.plans.joins import bounded_broadcast
from oxbow.session import shared_dir, ship_package
from oxbow.sources.tables import table

#: A word: a run of characters other than space, tab, LF, VT, FF, CR.
WORD_RE = r"[^\x20\x09-\x0D]+"
#: A key with at least 1/HOT_KEYS of all rows is hot; at most HOT_KEYS keys can be.
HOT_KEYS = 1000


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ascii_words(data: bytes) -> list[bytes]:
    """The ``WORD_RE`` words of UTF-8 bytes: ``bytes.split()`` splits on exactly
    the six ASCII white-space bytes, and no other character contains them."""
    return data.split()


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in ``spark.checkpoint.dir``: survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def map_texts(df: DataFrame, keep: list[str], make: Callable[[], Callable[[list], list]],
              out: str, text: str = "text") -> DataFrame:
    """``keep`` columns plus the columns of ``out`` (DDL), computed from ``text``.

    ``make()`` runs once per task and returns ``fn(texts) -> one sequence per
    column of out``; it sees one Arrow batch of whole texts (None for null) at
    a time. Rows stay in their partition.
    """
    ship_package(df.sparkSession)
    kept = [F.col(f"`{c}`") for c in keep]
    slim = df.select(*kept) if text in keep else df.select(*kept, F.col(text).alias(fresh("text", keep)))
    at = keep.index(text) if text in keep else len(keep)
    added = StructType.fromDDL(out)
    schema = StructType(slim.schema.fields[:len(keep)] + added.fields)
    types = [to_arrow_schema(added).field(i).type for i in range(len(added))]
    names = schema.names

    def run(batches):
        fn = make()
        for b in batches:
            cols = fn(b.column(at).to_pylist())
            arrays = [b.column(i) for i in range(len(keep))]
            arrays += [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return slim.mapInArrow(run, schema)


def _hot(right: DataFrame, count: str) -> Column:
    total = right.agg(F.sum(count)).first()[0] or 0
    return F.col(count) * HOT_KEYS >= F.lit(total)


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join of ``left`` to ``right`` (unique on ``keys``) without a hot task.

    ``right[count]`` is the number of ``left`` rows of the key. Keys with at
    least 1/HOT_KEYS of the counted rows -- at most HOT_KEYS of them, whatever
    the input size -- are broadcast; all others meet in a shuffle, where no key
    is large. Both inputs are read twice, so pass materialized or cheap ones.
    ``keys`` must not be null.
    """
    is_hot = _hot(right, count)
    hot = F.broadcast(right.where(is_hot))
    rest = left.join(F.broadcast(right.where(is_hot).select(*keys)), keys, "left_anti")
    return left.join(hot, keys, "inner").unionByName(rest.join(right.where(~is_hot), keys, "inner"))


def anti_hot(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """``left`` rows whose key is not in ``right``; inputs as for ``join_hot``."""
    is_hot = _hot(right, count)
    rest = left.join(F.broadcast(right.where(is_hot).select(*keys)), keys, "left_anti")
    return rest.join(right.where(~is_hot), keys, "left_anti")


#: Column of ``with_row_key``: with doc_id it tells apart rows that share a doc_id.
ROW_KEY = "__row_key"


def with_row_key(docs: DataFrame) -> DataFrame:
    return docs.withColumn(ROW_KEY, F.xxhash64("text"))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, made longer until no column of ``taken`` has it (case ignored)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name


def identified(docs: DataFrame) -> DataFrame:
    """``uid`` and ``row``: each row of ``docs`` as one struct, so that no column
    name matters, with an id of its own. The ids are those of a checkpoint, so they
    stay what they are when tasks run again."""
    return materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
                       .withColumn("uid", F.monotonically_increasing_id()))


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``identified`` that are not in ``gone`` (uid), as they were. Few
    ids are broadcast after a count; beyond the bound the rows are shuffled once."""
    return rows.join(bounded_broadcast(materialize(gone.select("uid"))), "uid", "left_anti").select("row.*")


def repeated(rows: DataFrame, copies: DataFrame) -> DataFrame:
    """Each row of ``identified`` as often as ``copies`` (uid, copies) says: rows
    that are not in it once. Joined as in ``without``."""
    other = bounded_broadcast(materialize(copies.select("uid", "copies").where("copies <> 1")))
    times = F.coalesce(F.col("copies"), F.lit(1)).cast("int")
    joined = rows.join(other, "uid", "left").select("row", times.alias("copies")).where("copies > 0")
    return joined.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
