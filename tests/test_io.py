import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oxbow.functions import messages
from oxbow.sinks import messages as msg_sink
from oxbow.sinks import tables as sinks
from oxbow.sources import files, schema, tables
from tests.conftest import write_text


def test_schema_from_fields():
    st = schema.schema_from_fields(json.dumps({"fields": schema.BASE_CSV_FIELDS}))
    assert [f.dataType for f in st.fields] == [T.LongType(), T.LongType(), T.StringType(),
                                               T.StringType(), T.StringType(), T.DecimalType(28, 9)]
    nested = schema.schema_from_fields([{"name": "r", "type": "RECORD", "mode": "REPEATED",
                                         "fields": [{"name": "a", "type": "INTEGER", "mode": "REQUIRED"}]}])
    assert nested.fields[0].dataType == T.ArrayType(T.StructType([T.StructField("a", T.LongType(), False)]))
    with pytest.raises(ValueError):
        schema.schema_from_fields([{"name": "x", "type": "GEOGRAPHY"}])


def test_quoted_newline_and_lines(spark, workdir):
    p = write_text(workdir, "q.csv", 'Model,Code,Desc,Cost\r\nL405,XYZ,"two\r\nlines",1.5\r\nL1,"a,b",x,2\r\n')
    multi = files.read_csv(spark, p, schema.OPTIONS_CSV_FIELDS).collect()
    assert len(multi) == 2 and multi[0].Option_Desc.splitlines() == ["two", "lines"]
    assert multi[1].Option_Code == "a,b" and multi[1].Material_Cost == Decimal("2")
    p2 = write_text(workdir, "l.csv", 'Model,Code,Desc,Cost\nL1,"a,b",x,2\n')
    assert files.read_csv_lines(spark, p2, schema.OPTIONS_CSV_FIELDS).first().Option_Code == "a,b"


def test_malformed_rows(spark, workdir):
    p = write_text(workdir, "bad.csv", "Model,Code,Desc,Cost\nL1,A,x,1\nL2,B,x,notanumber\n")
    with pytest.raises(Exception):
        files.read_csv(spark, p, schema.OPTIONS_CSV_FIELDS).collect()
    q = files.read_csv(spark, p, schema.OPTIONS_CSV_FIELDS, mode="PERMISSIVE")
    bad = q.where(F.col(files.CORRUPT).isNotNull()).collect()
    assert len(bad) == 1 and bad[0].Model == "L2"


def test_inferred_csv(spark, sample_csvs):
    df = files.read_csv_inferred(spark, sample_csvs[1])
    assert df.columns == ["Model name", "Code", "Description", "Cost"]
    assert dict(df.dtypes)["Cost"] == "int"


def test_jsonl_decimals(spark, workdir):
    p = write_text(workdir, "items.jsonl",
                   '{"timestamp":"2019-10-23 00:00:05 UTC","x":1.10,"a":[1,2],"o":{"z":1.5}}\n'
                   '{"timestamp":"2019-10-23 00:00:05.5 UTC","x":2}\n')
    df = files.read_jsonl(spark, p)
    assert isinstance(df.schema["x"].dataType, T.DecimalType)
    assert df.orderBy("timestamp").first().x == Decimal("1.10")


def test_truncate_load_and_view(spark, workdir, sample_csvs):
    opts = files.read_csv(spark, sample_csvs[1], schema.OPTIONS_CSV_FIELDS)
    path = os.path.join(workdir, "t")
    sinks.truncate_load(opts, schema.OPTIONS_CSV_FIELDS, path=path)
    again = sinks.truncate_load(opts.limit(5), schema.OPTIONS_CSV_FIELDS, path=path)
    assert again.count() == 5
    v = sinks.create_or_replace_view(spark, "oxbow_test_view", "SELECT 1 AS a")
    assert v.first().a == 1


def test_bad_csv_number_under_pruning(spark, workdir):
    p = write_text(workdir, "bad.csv", "Model,Code,Desc,Cost\nL1,A,x,1\nL2,B,x,notanumber\n")
    df = files.read_csv(spark, p, schema.OPTIONS_CSV_FIELDS)
    for query in (df.select("Model").collect, df.count, df.where("Model = 'L2'").select("Model").collect):
        with pytest.raises(Exception):
            query()
    # The stated limit: a filter that the reader applies skips other rows unparsed.
    assert df.where("Model = 'L1'").count() == 1
    good = write_text(workdir, "good.csv", "Model,Code,Desc,Cost\nL1,A,x,1\n")
    assert files.read_csv(spark, good, schema.OPTIONS_CSV_FIELDS).count() == 1


@pytest.mark.parametrize("line", ['{"n":"a"', '{"n":"a","x":"text"}', '{"n":"a","x":12345678901234567890123456789012}'])
def test_malformed_json_lines(spark, workdir, line):
    fields = [{"name": "n", "type": "STRING"}, {"name": "x", "type": "NUMERIC"}]
    p = write_text(workdir, "bad.jsonl", '{"n":"ok","x":1.5}\n' + line + "\n")
    df = files.read_jsonl(spark, p, fields)
    for query in (df.collect, df.count, df.select("n").collect):
        with pytest.raises(Exception):
            query()
    bad = files.read_jsonl(spark, p, fields, mode="PERMISSIVE")
    assert [r[files.CORRUPT] for r in bad.collect() if r[files.CORRUPT]] == [line]
    with pytest.raises(Exception):
        spark.createDataFrame([(line,)], "v string").select(
            messages.decode("v", schema.schema_from_fields(fields)).alias("m")).select("m.*").collect()


def test_failed_load_keeps_the_table(spark, workdir):
    path = f"file:{workdir}/t"
    sinks.truncate_load(spark.range(5), path=path)
    broken = spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        sinks.truncate_load(broken, path=path)
    assert spark.read.parquet(path).count() == 5
    assert sinks.truncate_load(spark.range(2), path=path).count() == 2
    assert [f for f in os.listdir(workdir) if "_old-" in f] == []


def test_named_table_and_persistent_view(spark):
    name = f"oxbow_t_{os.getpid()}"
    try:
        sinks.truncate_load(spark.range(5), table=name)
        broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
        with pytest.raises(Exception):
            sinks.truncate_load(broken, table=name)
        assert tables.table(spark, "", name).count() == 5
        assert sinks.truncate_load(spark.range(2), table=name).count() == 2
        v = sinks.create_or_replace_view(spark, f"{name}_v", f"SELECT id * 2 AS x FROM {name}", persistent=True)
        assert sorted(r.x for r in v.collect()) == [0, 2]
        assert spark.catalog.getTable(f"{name}_v").tableType == "VIEW"
        assert spark.newSession().table(f"{name}_v").count() == 2
        with pytest.raises(ValueError):
            sinks.create_or_replace_view(spark, "v", spark.range(1), persistent=True)
    finally:
        spark.sql(f"DROP VIEW IF EXISTS {name}_v")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_scratch_needs_a_shared_folder_off_local():
    from oxbow import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_envelope_and_folder(spark, workdir):
    df = spark.createDataFrame([(1, "a", None), (2, None, 5)], "id int, k string, n int")
    env = messages.envelope(df, ["k", "n"])
    rows = env.collect()
    assert rows[0].attributes == {"k": "a"} and rows[1].attributes == {"n": "5"}
    assert json.loads(rows[0].value.decode()) == {"id": 1, "k": "a", "n": None}
    for target in (f"{workdir}/a", f"file:{workdir}/b"):
        for _ in range(2):      # a batch run again replaces itself
            msg_sink.publish(env, target, batch="00000001")
        back = {json.loads(r.data)["id"]: r.attributes for r in msg_sink.read_messages(spark, target).collect()}
        assert back == {1: {"k": "a"}, 2: {"n": "5"}}
    msg_sink.publish(env, fmt="noop")


def test_console_without_a_target(spark, capsys):
    """One JSON object per row and line, all of them (more than a table sink shows)."""
    rows = spark.range(50).select("id", F.concat(F.lit("a\nb "), F.col("id")).alias("t")).repartition(3)
    capsys.readouterr()
    msg_sink.publish(messages.envelope(rows, ["id"]))
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert sorted(x["id"] for x in lines) == list(range(50)) and all(x["t"] == f"a\nb {x['id']}" for x in lines)
    msg_sink.publish(messages.envelope(rows.limit(0), []))
    assert capsys.readouterr().out == ""
