"""Line dedup by winnowing over line hashes (operator 6), built-in functions only.

A document is its sequence of lines that are not blank. Every window of
``window`` lines selects its smallest line hash (the first such line). Windows in
a row that select the same line share one fingerprint: its place, and a digest of
each line around it as far as those windows reach. Only these are stored, about
one for two windows of three lines. Equal runs of at least ``window`` lines always
select the same lines, so a fingerprint that occurs at one place has no repeat
there. Those at two places or more are joined by position: each is extended to
both sides by the digests around it, window by window, and matched to the first
place, in (doc_id, line) order, with the same lines. Matched lines of all places
of a document together are its repeated runs, and all but the first of equal runs
are deleted.

So a line is deleted if and only if it lies in a run of at least ``window``
lines that occurs earlier, in another document or in the same one, or in a
document of fewer lines of which an earlier one has just the same lines.

With ``words``, shorter runs count too if their lines hold that many words. What
then stays are runs of fewer lines and fewer words within a document that has more.

Nothing is paired: a passage in a third of all documents is one row of first
occurrences, and is joined hot-safe. Texts move only if the decisions are too
many to broadcast (a counted bound), then once.

Defined cases: lines are compared without outer white space, by 16 bytes of their
SHA-256; blank lines are kept and skipped when matching; null text counts as empty,
texts of any length are read whole; of equal runs the first by (doc_id, place) stays,
of a tie in doc_id the one whose text hash is less; a null doc_id is last in order; rows
that repeat both doc_id and text count as one document and get the same result; extra
columns, whatever their names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oxbow.llm.common import ROW_KEY, join_hot, materialize, with_row_key
from oxbow.plans.joins import is_small, maybe_broadcast
from oxbow.session import broadcast_byte_bound

#: Lines of the shortest run that is deleted.
WINDOW = 3
#: Words of the shortest run that is deleted whatever its lines, where words count.
WORDS = 50
_SPACE = " \t\r\x0b\x0c"
#: Bytes of a line's digest.
_DIGEST = 16


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(_SPACE))


def _blank(line: Column) -> Column:
    return _trimmed(line) == ""


def _words(line: Column) -> Column:
    """Number of words of a line that is trimmed and not blank."""
    return F.size(F.split(line, r"[ \t\r\x0B\f]+"))


def fingerprints(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """One row per fingerprint: doc_id, ROW_KEY, ``print`` (smallest line hash of its
    windows, with their length), ``n`` (lines of a window), ``whole`` (whether it is a
    document of fewer lines than the window), ``at`` (places in the text of the lines
    around it, as far as its windows reach) and ``digests`` (of these lines, joined).
    With ``words``, also those of shorter windows of so many words."""
    placed = F.transform(_lines(F.col("text")), lambda x, i: F.struct(_trimmed(x).alias("x"), i.alias("i")))
    rows = (with_row_key(docs.select("doc_id", "text"))
            .select("doc_id", ROW_KEY, F.filter(placed, lambda l: l["x"] != "").alias("lines"))
            .where(F.size("lines") > 0))
    rows = rows.select(
        "doc_id", ROW_KEY, F.transform("lines", lambda l: l["i"]).alias("places"),
        F.transform("lines", lambda l: F.xxhash64(l["x"])).alias("hashes"),
        F.transform("lines", lambda l: F.unhex(F.left(F.sha2(l["x"], 256), F.lit(2 * _DIGEST)))).alias("digest"),
        (F.transform("lines", lambda l: _words(l["x"])) if words is not None else F.lit(None)).alias("words"),
        F.size("lines").alias("size"))

    def around(s: Column, count: Column, n: Column, whole: bool) -> Column:
        """A fingerprint: the windows of ``n`` lines from ``s`` on, ``count`` lines in all."""
        joined = F.aggregate(F.slice("digest", s, count), F.lit(b""), lambda a, x: F.concat(a, x))
        least = F.array_min(F.slice("hashes", s, n))
        return F.struct(F.xxhash64(F.lit(whole), n, least).alias("print"), n.alias("n"), F.lit(whole).alias("whole"),
                        F.slice("places", s, count).alias("at"), joined.alias("digests"))

    none = F.array().cast("array<int>")

    def shared(rows: DataFrame, n: int) -> tuple[DataFrame, Column]:
        """The fingerprints of windows of ``n`` lines, over columns that are added."""
        start, least, first = f"starts{n}", f"least{n}", f"first{n}"
        starts = F.when(F.col("size") >= n, F.sequence(F.lit(1), F.col("size") - (n - 1))).otherwise(none)
        if n < window:
            starts = F.filter(starts, lambda s: sum((F.element_at("words", s + i) for i in range(1, n)),
                                                    F.element_at("words", s)) >= words)
        # The first smallest line of a window never moves back, so windows that share it are neighbours.
        rows = rows.withColumn(start, starts).withColumn(least, F.transform(start, lambda s: s + F.array_position(
            F.slice("hashes", s, n), F.array_min(F.slice("hashes", s, n)))))
        fresh = lambda s, i: (i == 0) | (F.get(start, i - 1) < s - 1) | (F.get(least, i - 1) != F.get(least, i))
        rows = rows.withColumn(first, F.filter(
            F.transform(start, lambda s, i: F.when(fresh(s, i), i)), lambda i: i.isNotNull()))
        runs = F.transform(first, lambda i, j: F.struct(
            F.get(start, i).alias("s"), F.get(start, F.coalesce(F.get(first, j + 1), F.size(start)) - 1).alias("e")))
        return rows, F.transform(runs, lambda r: around(r["s"], r["e"] - r["s"] + n, F.lit(n), False))

    every = []
    for n in range(1 if words is not None else window, window + 1):
        rows, made = shared(rows, n)
        every.append(made)
    short = F.when(F.col("size") < window, F.array(F.lit(1))).otherwise(none)
    every.append(F.transform(short, lambda s: around(s, F.col("size"), F.col("size"), True)))
    return rows.select("doc_id", ROW_KEY, F.inline(F.concat(*every)))


def anchors(every: DataFrame) -> DataFrame:
    """The fingerprints that occur at two places or more."""
    prints = materialize(every.groupBy("print").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    return join_hot(every, prints, ["print"], "__n").drop("__n")


def extended(anchored: DataFrame) -> DataFrame:
    """The windows around fingerprints: doc_id, ROW_KEY, ``same`` (digests of the
    lines) and ``at`` (their places in the text)."""
    mark = F.when(F.col("whole"), F.lit(b"d")).otherwise(F.lit(b"w"))
    reach = F.sequence(F.lit(0), F.size("at") - F.col("n"))
    each = F.transform(reach, lambda j: F.struct(
        F.concat(mark, F.substr(F.col("digests"), j * _DIGEST + 1, F.col("n") * _DIGEST)).alias("same"),
        F.slice("at", j + 1, F.col("n")).alias("at")))
    return anchored.select("doc_id", ROW_KEY, F.inline(each))


def repeated_windows(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """doc_id, ROW_KEY and ``at`` (places in the text) of the windows that occur earlier."""
    candidates = materialize(extended(anchors(materialize(fingerprints(docs, window, words)))))
    place = F.struct(F.col("doc_id").isNull().alias("__null"), "doc_id", ROW_KEY, F.get("at", F.lit(0)).alias("a"))
    first = materialize(candidates.groupBy("same").agg(F.min(place).alias("__first"),
                                                       F.count(F.lit(1)).alias("__n")).where("__n > 1"))
    return (join_hot(candidates, first, ["same"], "__n")
            .where(place != F.col("__first")).select("doc_id", ROW_KEY, "at"))


def dedup_lines(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """doc_id, n_lines (not blank), n_removed and ``text`` without the later
    repeated runs, one row per document."""
    found = materialize(repeated_windows(docs, window, words).groupBy(
        F.col("doc_id").alias("__id"), F.col(ROW_KEY).alias("__key")).agg(
        F.array_distinct(F.flatten(F.collect_list("at"))).alias("__gone")))
    listed = found.agg(F.sum(F.size("__gone").cast("long"))).first()[0] or 0
    small = is_small(found) and 8 * listed <= broadcast_byte_bound(docs.sparkSession)
    rows = with_row_key(docs.select("doc_id", "text"))
    joined = rows.join(maybe_broadcast(found, small),
                       rows["doc_id"].eqNullSafe(F.col("__id")) & (rows[ROW_KEY] == F.col("__key")), "left")
    lines = joined.select("doc_id", "__gone", _lines(F.col("text")).alias("__lines"))
    left = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__gone"))
    kept = F.when(F.col("__gone").isNull(), F.col("__lines")).otherwise(
        F.transform(left, lambda i: F.get("__lines", i)))
    full = F.size(F.filter("__lines", lambda x: ~_blank(x))).cast("long")
    return lines.select("doc_id", full.alias("n_lines"),
                        F.coalesce(F.size("__gone"), F.lit(0)).cast("long").alias("n_removed"),
                        F.array_join(kept, "\n").alias("text"))
