"""Exact dedup by deterministic block naming (operator 7), built-in functions only.

Each text, less its white space, is cut into blocks of ``BLOCK`` code points.
The distinct blocks are sorted (by hash, then content) and numbered; then adjacent pairs of numbers are
sorted and numbered again, level by level, until one number is left for the
whole text. Equal numbers mean equal blocks at every level, so the last number
(with the block count) identifies the text without any collision.

Only texts that can have an equal are named: a text whose (length, 64-bit hash)
occurs once differs from every other text. The hash never decides that two
texts are equal.

Defined cases: null text counts as empty, and all empty texts are one group; a
null doc_id sorts last; texts of any length are read whole, in blocks; of rows that
tie in text, length and doc_id (repeated rows too) one stays, and which one does not
show in the output columns; extra columns, whatever their names, are ignored by
``exact_groups`` and kept by ``drop_copies``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import anti_hot, identified, join_hot, materialize, without
from oxbow.session import broadcast_row_bound

#: Code points in a block.
BLOCK = 4096
_SPACE = " \t\n\x0b\x0c\r"


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _SPACE, "")


def _small(keys: DataFrame) -> bool:
    """Whether ``keys`` may be broadcast: its rows are counted first."""
    return keys.count() <= broadcast_row_bound(keys.sparkSession)


def _repeated(keys: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose key is in ``keys`` (unique, with the count ``__n``)."""
    if _small(keys):
        return rows.join(F.broadcast(keys.select(*on)), on, "left_semi")
    return join_hot(rows, keys, on, "__n").drop("__n")


def _without(keys: DataFrame, rows: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` whose key is not in ``keys``. The hot keys are all in ``keys``,
    so beyond the broadcast bound they leave before the shuffle."""
    if _small(keys):
        return rows.join(F.broadcast(keys.select(*on)), on, "left_anti")
    return anti_hot(rows, keys, on, "__n")


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``keys`` replaced by an integer ``__name``: the place of the
    key among the distinct keys, sorted by their hash, then by themselves. Equal
    names mean equal keys. The range partitioner samples hashes, not texts; the
    keys are compared within the partitions."""
    distinct = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).withColumn("__h", F.xxhash64(*keys))
    ordered = distinct.repartitionByRange("__h").sortWithinPartitions("__h", *keys).drop("__h")
    names = materialize(ordered.withColumn("__name", F.monotonically_increasing_id()))
    return join_hot(rows, names, keys, "__n").drop(*keys, "__n")


def block_identities(rows: DataFrame, text: str, block: int = BLOCK) -> DataFrame:
    """Add ``__blocks`` and ``__name`` to ``rows``: equal pairs mean equal ``text``.

    ``text`` must not be null; it is dropped. A row id is materialized with the
    blocks, so repeated rows stay apart.
    """
    carried = [c for c in rows.columns if c != text]
    cut = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    blocks = materialize(
        rows.withColumn("__uid", F.monotonically_increasing_id())
        .withColumn("__cut", F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(cut))
        .select(*carried, "__uid", F.size("__cut").alias("__blocks"),
                F.posexplode("__cut").alias("__i", "__block")))
    slim = blocks.select("__uid", F.col("__blocks").alias("__left"), "__i", "__block")
    named = _named(slim, ["__block"])
    most = blocks.agg(F.max("__blocks")).first()[0] or 1
    done = []
    for _ in range(math.ceil(math.log2(most))):
        named = materialize(named)
        done.append(named.where(F.col("__left") == 1))
        half = ((F.col("__left") + 1) / 2).cast("int").alias("__left")
        odd = F.col("__i") % 2 == 1
        pairs = materialize(
            named.where(F.col("__left") > 1)
            .groupBy("__uid", half, (F.col("__i") / 2).cast("int").alias("__i"))
            .agg(F.max(F.when(~odd, F.col("__name"))).alias("__l"),
                 F.coalesce(F.max(F.when(odd, F.col("__name"))), F.lit(-1)).alias("__r")))
        named = _named(pairs, ["__l", "__r"])
    names = reduce(DataFrame.unionByName, [*done, named]).select("__uid", "__name")
    heads = blocks.where(F.col("__i") == 0).drop("__i", "__block")
    return heads.join(names, "__uid")


def exact_groups(docs: DataFrame, block: int = BLOCK, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (and ``carry``).

    Of equal texts the row with the most code points in its original text
    stays, then the one with the smallest doc_id.
    """
    norm = normalized(F.col("text"))
    rows = docs.select("doc_id", *carry, F.coalesce(F.char_length("text"), F.lit(0)).alias("__points"),
                       norm.alias("__norm"))
    signed = rows.select("*", F.char_length("__norm").alias("__len"),
                         F.xxhash64("__norm").alias("__sig"))
    on = ["__len", "__sig"]
    slim = materialize(signed.select("doc_id", *carry, *on,
                                     F.sha2("__norm", 256).alias("text_sha256")))
    repeated = materialize(slim.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
                           .where(F.col("__n") > 1))
    alone = (_without(repeated, slim, on)
             .select("doc_id", *carry, F.col("doc_id").alias("keep_id"),
                     F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
                     "text_sha256"))
    candidates = _repeated(repeated, signed, on)
    ident = materialize(block_identities(
        candidates.select("doc_id", *carry, "__points", F.sha2("__norm", 256).alias("text_sha256"),
                          "__norm"), "__norm", block))
    best = F.min(F.struct((-F.col("__points")).alias("__p"), F.col("doc_id").isNull().alias("__null"),
                          "doc_id", "__uid"))
    groups = materialize(ident.groupBy("__blocks", "__name")
                         .agg(best.alias("__best"), F.count(F.lit(1)).alias("group_size")))
    copies = (join_hot(ident, groups, ["__blocks", "__name"], "group_size")
              .select("doc_id", *carry, F.col("__best.doc_id").alias("keep_id"), "group_size",
                      (F.col("__uid") == F.col("__best.__uid")).alias("kept"), "text_sha256"))
    return alone.unionByName(copies)


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``."""
    rows = identified(docs)
    groups = exact_groups(rows.select("uid", "row.doc_id", "row.text"), carry=("uid",))
    return without(rows, groups.where("NOT kept"))
