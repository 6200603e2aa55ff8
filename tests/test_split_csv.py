"""Quoted-newline CSV in many tasks per file against the reader of whole files."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from oxbow.sources import files
from oxbow.sources.split_csv import read_csv_split
from tests.conftest import write_text

FIELDS = [{"name": "id", "type": "INTEGER"}, {"name": "a", "type": "STRING"}, {"name": "b", "type": "STRING"},
          {"name": "price", "type": "NUMERIC"}]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v else spark.conf.unset(k)


def make_csv(seed, n, end="\r\n", long=0):
    rng = random.Random(seed)
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "a field,\nwith a \"line\"", "b", "price"])
    bits = ["plain", 'say "hi"', "two\nlines", "é\r\nü", ",", "\n\n", "'", '"', "x" * 50]
    for i in range(n):
        w.writerow([i, "".join(rng.choice(bits) for _ in range(rng.randint(1, 4))) + ("y\n" * long if i == n // 2 else ""),
                    rng.choice(["", "z", 'q"q']), f"{i}.25"])
    return out.getvalue()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("end,long", [("\r\n", 0), ("\n", 0), ("\n", 9000)])
def test_one_file_many_tasks(spark, workdir, small_splits, end, long):
    """Records cross splits, and one spans several of them."""
    write_text(workdir, "one.csv", make_csv(1, 600, end, long))
    got = read_csv_split(spark, workdir, FIELDS)
    parsed = list(csv.reader(io.StringIO(make_csv(1, 600, end, long), newline="")))[1:]
    want = sorted(((int(i), a, b or None, float(p)) for i, a, b, p in parsed), key=repr)
    assert [(i, a, b, float(p)) for i, a, b, p in rows(got)] == want
    tasks = spark.read.option("lineSep", "\n").text(workdir).select(F.spark_partition_id()).distinct().count()
    assert tasks > 5
    assert got.select(F.spark_partition_id()).distinct().count() > 5


def test_equals_the_whole_file_reader(spark, workdir, small_splits):
    for i in range(3):
        write_text(workdir, f"f{i}.csv", make_csv(i, 40 * i, "\n"))
    write_text(workdir, "only-header.csv", "id,a,b,price\n")
    write_text(workdir, "no-end.csv", 'h,h,h,h\n7,"a\nb",c,1')
    reader = (spark.read.option("header", True).option("enforceSchema", True).option("multiLine", True)
              .option("escape", '"').option("mode", "FAILFAST").schema(files._schema(FIELDS)))
    assert rows(read_csv_split(spark, workdir, FIELDS)) == rows(reader.csv(workdir))


def test_backslash_escapes(spark, workdir, small_splits):
    df = spark.range(500).select("id", F.lit('a "b"\nc\\').alias("a"), F.lit("x").alias("b"), F.lit("1.5").alias("price"))
    df.repartition(2).write.option("header", True).mode("overwrite").csv(f"{workdir}/t")
    got = read_csv_split(spark, f"{workdir}/t", FIELDS, escape="\\")
    assert rows(got) == rows(files.read_csv(spark, f"{workdir}/t", FIELDS))


def test_malformed_rows(spark, workdir, small_splits):
    write_text(workdir, "bad.csv", "id,a,b,price\n1,a,b,2\nx,a,b,2\n3,a\n\n4,\"p\nq\",b,1\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv_split(spark, workdir, FIELDS).collect()
    got = read_csv_split(spark, workdir, FIELDS, mode="PERMISSIVE")
    assert got.where(F.col(files.CORRUPT).isNotNull()).count() == 2
    assert got.where(F.col(files.CORRUPT).isNull()).count() == 2
    open_quote = write_text(workdir, "open.csv", 'id,a,b,price\n1,"a,b,2\n')
    with pytest.raises(ValueError, match="never closed"):
        read_csv_split(spark, open_quote, FIELDS)
