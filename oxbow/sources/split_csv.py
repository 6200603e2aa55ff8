"""Quoted-newline CSV read by many tasks per file (SRC1 at size).

``multiLine`` CSV reads a file in one task, because a line end inside quotes
looks like one between records until all quotes before it have been counted.
Here the file is read as plain lines, which split anywhere:

1. each split (a chunk) reports the number of its quotes; a running sum per file
   tells of every chunk whether it begins inside quotes (one number per chunk);
2. each chunk joins its own lines into records: a record ends with the line that
   makes the count of quotes even. Lines pass in order within a chunk, and most
   records are one line, which passes unchanged;
3. a record that crosses a chunk's end leaves a piece in each chunk it touches;
   the pieces (at most two per chunk) are joined by (file, position);
4. records are parsed by ``from_csv``.

Quotes inside quotes are doubled (``escape='"'``) or escaped by a backslash
(``escape="\\\\"``). A quote within an unquoted field (``5" pipe``) is no CSV that
can be cut like this; a file whose quotes do not come out even fails, and
``files.read_csv`` reads such files in one task each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.session import shared_dir, ship_package
from oxbow.sources.files import CORRUPT, _parse_all, _schema

_WHOLE, _HEAD, _TAIL, _MIDDLE = range(4)


def quote_count(line, escape: str):
    """Quotes of a line that open or close: all of them where inner quotes are
    doubled, and those not escaped by a backslash otherwise."""
    bare = line if escape == '"' else F.regexp_replace(line, r"\\.", "")
    return F.length(bare) - F.length(F.translate(bare, '"', ""))


def _quotes(lines: pa.Array, escape: str) -> np.ndarray:
    bare = lines if escape == '"' else pc.replace_substring_regex(lines, r"\\.", "")
    return pc.count_substring(bare, '"').to_numpy(zero_copy_only=False)


class _Joiner:
    """Joins the lines of one chunk into records."""

    def __init__(self, chunk: int, odd: bool, at_start: bool, escape: str):
        self.chunk, self.odd, self.escape = chunk, odd, escape
        self.inside = odd           # the first record began in an earlier chunk
        self.first = at_start       # the next record is the file's first
        self.open: list[str] = []   # lines of the record that is not finished

    def add(self, lines: pa.Array):
        """(records, kinds, whether first of the file) of these lines."""
        parity = (np.cumsum(_quotes(lines, self.escape)) + self.odd) & 1
        ends = np.flatnonzero(parity == 0)
        self.odd = bool(parity[-1])
        if not len(ends):
            self.open += lines.to_pylist()
            return None
        head = pa.array([*self.open, *lines.slice(0, ends[0] + 1).to_pylist()], pa.string())
        starts = np.concatenate([ends[:-1] + 1, ends[-1:] + 1])
        rest = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), lines)
        records = pa.concat_arrays([pa.array(["\n".join(head.to_pylist())], pa.string()),
                                    pc.binary_join(rest, "\n")])
        kinds, first = np.full(len(records), _WHOLE, np.int32), np.zeros(len(records), bool)
        kinds[0] = _HEAD if self.inside else _WHOLE
        first[0], self.first = self.first, False
        self.inside, self.open = False, lines.slice(ends[-1] + 1).to_pylist()
        return records, kinds, first

    def end(self):
        if not self.open:
            return None
        kind = _MIDDLE if self.inside else _TAIL
        return pa.array(["\n".join(self.open)], pa.string()), np.array([kind], np.int32), np.array([self.first])


def _records(lines: DataFrame, ids: np.ndarray, flags: np.ndarray, escape: str) -> DataFrame:
    """record, kind, first, chunk. ``ids`` (sorted) and ``flags`` (1: begins inside
    quotes, 2: begins the file) hold one number per chunk."""
    shared = lines.sparkSession.sparkContext.broadcast((ids, flags))
    names = ["record", "kind", "first", "chunk"]

    def run(batches):
        known, flag = shared.value
        now = None

        def out(found):
            records, kinds, first = found
            return pa.RecordBatch.from_arrays(
                [records, pa.array(kinds), pa.array(first), pa.array(np.full(len(records), now.chunk))], names=names)
        for b in batches:
            chunk = b.column(1).to_numpy()
            cuts = [0, *(1 + np.flatnonzero(np.diff(chunk))).tolist(), len(chunk)]
            for start, end in zip(cuts[:-1], cuts[1:]):
                if start == end:
                    continue
                if now is None or now.chunk != chunk[start]:
                    if now and (found := now.end()):
                        yield out(found)
                    at = int(np.searchsorted(known, chunk[start]))
                    if at == len(known) or known[at] != chunk[start]:
                        raise RuntimeError("the file was split at other places than when its quotes were counted")
                    now = _Joiner(int(chunk[start]), bool(flag[at] & 1), bool(flag[at] & 2), escape)
                if found := now.add(b.column(0).slice(start, end - start)):
                    yield out(found)
        if now and (found := now.end()):
            yield out(found)
    return lines.mapInArrow(run, "record string, kind int, first boolean, chunk long")


def _crossing(pieces: DataFrame, chunks: DataFrame) -> DataFrame:
    """record, first: the records that cross chunks, put together."""
    pieces = pieces.join(F.broadcast(chunks), "chunk")  # at most two rows per chunk on the left
    begins = F.col("kind") == _TAIL
    order = Window.partitionBy("file").orderBy("start", (F.col("kind") != _HEAD).cast("int"))
    numbered = pieces.withColumn("record_no", F.sum(begins.cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("start", (F.col("kind") != _HEAD).cast("int").alias("later"), "record")))
    return numbered.groupBy("file", "record_no").agg(
        F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"), F.max("first").alias("first"))


def read_csv_split(spark: SparkSession, path: str | list[str], schema, *, escape: str = '"',
                   mode: str = "FAILFAST") -> DataFrame:
    """SRC1: declared schema bound by position, the header record of each file
    skipped, quoted newlines allowed, each file read by as many tasks as it has
    splits. ``mode="PERMISSIVE"`` adds ``_corrupt_record`` for malformed rows.

    Empty lines between records are skipped, as by the CSV reader. The driver holds
    one number per split. The quotes are counted in a pass of their own.
    """
    ship_package(spark)
    shared_dir(spark)
    text = spark.read.option("lineSep", "\n").text(path)
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    chunk = F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("chunk")
    totals = (text.select(*where, chunk, quote_count(F.col("value"), escape).alias("q"))
              .groupBy("file", "start", "chunk").agg(F.sum("q").alias("q")))
    before = F.sum("q").over(Window.partitionBy("file").orderBy("start")) - F.col("q")
    chunks = totals.select("file", "start", "chunk", "q", (before % 2).alias("odd")).checkpoint(eager=True)
    found = chunks.select("chunk", (F.col("odd") + F.when(F.col("start") == 0, 2).otherwise(0)).cast("int").alias("flag")).toArrow()
    order = np.argsort(found.column("chunk").to_numpy())
    ids, flags = found.column("chunk").to_numpy()[order], found.column("flag").to_numpy()[order]
    if (np.diff(ids) == 0).any():
        raise RuntimeError("two splits share an identifier")
    uneven = chunks.groupBy("file").agg(F.sum("q").alias("q")).where(F.col("q") % 2 == 1).first()
    if uneven:
        raise ValueError(f"a quote in {uneven['file']} is never closed")

    records = _records(text.select("value", chunk), ids, flags, escape)
    whole = records.where(F.col("kind") == _WHOLE).select("record", "first")
    if (flags & 1).any():
        pieces = records.where(F.col("kind") != _WHOLE).checkpoint(eager=True)
        whole = whole.unionByName(_crossing(pieces, chunks.select("chunk", "file", "start")).select("record", "first"))
    record = F.regexp_replace("record", r"\r\z", "")
    rows = whole.where(~F.col("first")).select(record.alias("record")).where(F.col("record") != "")

    st = _schema(schema)
    options = {"mode": mode, "quote": '"', "escape": escape, "multiLine": "true"}
    if mode.upper() == "PERMISSIVE":
        st = T.StructType(st.fields + [T.StructField(CORRUPT, T.StringType())])
        options["columnNameOfCorruptRecord"] = CORRUPT
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in st.fields)
    return _parse_all(rows.select(F.from_csv("record", ddl, options).alias("r")).select("r.*"))
