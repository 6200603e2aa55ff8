"""Registered queries on the driver's tables, each with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` share
column names. Money is rounded to 4 places on both sides; each engine adds doubles
in its own order, so a nudge far below a place settles ties alike. Every query reads
whole tables; only a filter that is the query's own feature leaves rows out.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oxbow.functions import messages
from oxbow.functions.keys import first_token_ws, model_option_key, zero_cost_flag
from oxbow.functions.timefmt import format_ts, parse_ts
from oxbow.operators import costing, profit_view, quality, ranges, replay, reports
from oxbow.plans import mapping
from oxbow.plans.joins import bounded_broadcast
from oxbow.plans.partitioning import spread
from oxbow.session import scratch_path
from oxbow.sinks import delivery
from oxbow.sinks import messages as msg_sink
from oxbow.sinks import tables as sinks
from oxbow.sinks import versions
from oxbow.sources import files, schema, zones
from oxbow.sources.split_csv import read_csv_split
from oxbow.streaming import replay as streaming
from oxbow.sources.tables import table, time_slice

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


_NUDGE = 1e-9


def _money(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast("double") + F.lit(_NUDGE), 4).alias(c) if c in names else F.col(c)
                       for c in df.columns])


# --------------------------------------------------------------------------- SQL pieces

BASE_SQL = """
base AS (
  SELECT l.l_orderkey AS Vehicle_ID, l.l_quantity AS Option_Quantities,
         p.p_brand AS Options_Code, p.p_type AS Option_Desc, p.p_name AS Model_Text,
         CASE WHEN l.l_discount = 0 THEN 0.0 ELSE l.l_extendedprice END AS Sales_Price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

BASE_NULLS_SQL = """
base AS (
  SELECT l.l_orderkey AS Vehicle_ID, l.l_quantity AS Option_Quantities,
         p.p_brand AS Options_Code, p.p_type AS Option_Desc, p.p_name AS Model_Text,
         CASE WHEN l.l_discount = 0 THEN CAST(NULL AS DOUBLE)
              WHEN l.l_tax = 0 THEN 0.0 ELSE l.l_extendedprice END AS Sales_Price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey)"""

OPTIONS_SQL = """
options AS (
  SELECT split_part(p_name, ' ', 1) AS Model,
         CASE WHEN p_type = 'PROMO' AND p_size <= 15 AND p_brand NOT IN ('Brand#1', 'Brand#5')
              THEN p_brand ELSE p_brand || '/' || p_type END AS Option_Code,
         p_type AS Option_Desc, p_retailprice AS Material_Cost, p_partkey AS row_order
  FROM part)"""


def _profit_sql(base_sql: str, per_unit: bool = False) -> str:
    """Cost arms as rows: each line meets its candidates in order of preference,
    and the first that has a cost decides."""
    factor = "1" if per_unit else "Option_Quantities"
    return f"""
WITH {base_sql}, {OPTIONS_SQL},
line AS (SELECT row_number() OVER () AS line_no, split_part(Model_Text, ' ', 1) || '_' || Options_Code AS pair, *
         FROM base),
mean_cost AS (
  SELECT Model || '_' || Option_Code AS pair, Option_Code AS code, grouping(Option_Code) AS by_pair,
         avg(Material_Cost) AS cost
  FROM options GROUP BY GROUPING SETS ((Model || '_' || Option_Code), (Option_Code))),
candidate AS (
  SELECT line_no, 1 AS choice, 0.0 AS cost FROM line WHERE Sales_Price <= 0
  UNION ALL SELECT line_no, 2, {factor} * cost FROM line JOIN mean_cost m ON m.by_pair = 1 AND m.pair = line.pair
  UNION ALL SELECT line_no, 3, {factor} * cost FROM line JOIN mean_cost m ON m.by_pair = 0 AND m.code = Options_Code
  UNION ALL SELECT line_no, 4, Sales_Price * 0.45 FROM line),
chosen AS (SELECT line_no, arg_min(cost, choice) AS cost, min(choice) AS choice
           FROM candidate WHERE cost IS NOT NULL GROUP BY line_no)
SELECT Vehicle_ID, Option_Quantities, Options_Code, Option_Desc, Model_Text, Sales_Price,
       round(cost + {_NUDGE}, 4) AS Production_Cost,
       round(CASE choice WHEN 1 THEN 0 ELSE Sales_Price - cost END + {_NUDGE}, 4) AS Profit
FROM line LEFT JOIN chosen USING (line_no)"""


# --------------------------------------------------------------------------- costing (JOB1)

@register("option_profit", _profit_sql(BASE_SQL))
def q_option_profit(spark, sf):
    out = costing.option_profit(mapping.option_base(spark, sf), mapping.option_costs(spark, sf))
    return _money(out, "Production_Cost", "Profit")


@register("option_profit_unit", _profit_sql(BASE_SQL, per_unit=True))
def q_option_profit_unit(spark, sf):
    out = costing.option_profit(mapping.option_base(spark, sf), mapping.option_costs(spark, sf),
                                per_unit=True)
    return _money(out, "Production_Cost", "Profit")


@register("option_profit_nulls", _profit_sql(BASE_NULLS_SQL))
def q_option_profit_nulls(spark, sf):
    out = costing.option_profit(mapping.option_base(spark, sf, with_nulls=True),
                                mapping.option_costs(spark, sf))
    return _money(out, "Production_Cost", "Profit")


@register("zero_cost_flag", f"""
WITH {BASE_NULLS_SQL}
SELECT Vehicle_ID, Sales_Price, CASE WHEN Sales_Price <= 0 THEN 0 ELSE NULL END AS ZeroCost
FROM base""")
def q_zero_cost_flag(spark, sf):
    b = mapping.option_base(spark, sf, with_nulls=True)
    return b.select("Vehicle_ID", "Sales_Price", zero_cost_flag("Sales_Price").alias("ZeroCost"))


@register("model_option_key", f"""
WITH {BASE_SQL}
SELECT Vehicle_ID, Model_Text, Options_Code,
       split_part(Model_Text, ' ', 1) || '_' || Options_Code AS ModelOptionKey
FROM base""")
def q_model_option_key(spark, sf):
    b = mapping.option_base(spark, sf)
    return b.select("Vehicle_ID", "Model_Text", "Options_Code",
                    model_option_key("Model_Text", "Options_Code").alias("ModelOptionKey"))


@register("model_option_key_ws", f"""
WITH {BASE_SQL}
SELECT Vehicle_ID, Model_Text, Options_Code,
       regexp_extract(Model_Text, '^\\s*(\\S*)', 1) AS first_word,
       regexp_extract(Model_Text, '^\\s*(\\S*)', 1) || '_' || Options_Code AS ModelOptionKey
FROM base""")
def q_model_option_key_ws(spark, sf):
    b = mapping.option_base(spark, sf)
    return b.select("Vehicle_ID", "Model_Text", "Options_Code",
                    first_token_ws("Model_Text").alias("first_word"),
                    model_option_key("Model_Text", "Options_Code", whitespace=True)
                    .alias("ModelOptionKey"))


@register("avg_cost_by_key", f"""
WITH {OPTIONS_SQL}
SELECT Model || '_' || Option_Code AS ModelOptionKey, round(avg(Material_Cost) + {_NUDGE}, 4) AS Material_Cost,
       count(*) AS n_options
FROM options GROUP BY 1""")
def q_avg_cost_by_key(spark, sf):
    totals = costing.option_cost_totals(mapping.option_costs(spark, sf))
    return _money(costing.avg_cost_by_key(totals, counts="n_options"), "Material_Cost")


@register("avg_cost_by_code", f"""
WITH {OPTIONS_SQL}
SELECT Option_Code, round(avg(Material_Cost) + {_NUDGE}, 4) AS Average_Cost
FROM options GROUP BY Option_Code""")
def q_avg_cost_by_code(spark, sf):
    totals = costing.option_cost_totals(mapping.option_costs(spark, sf))
    return _money(costing.avg_cost_by_code(totals), "Average_Cost")


_LOOKUP_SELECT = """
SELECT b.Vehicle_ID, b.Option_Quantities, b.Options_Code, b.Option_Desc, b.Model_Text, b.Sales_Price,
       {cost} AS Production_Cost, CAST(NULL AS DOUBLE) AS Profit
FROM base b
LEFT JOIN m ON regexp_extract(b.Model_Text, '^\\s*(\\S*)', 1) || '_' || b.Options_Code = m.k"""


@register("cost_lookup_last", f"""
WITH {BASE_SQL}, {OPTIONS_SQL},
m AS (SELECT Model || '_' || Option_Code AS k, arg_max(Material_Cost, row_order) AS c
      FROM options GROUP BY 1)
{_LOOKUP_SELECT.format(cost="m.c")}""")
def q_cost_lookup_last(spark, sf):
    return costing.cost_lookup(mapping.option_base(spark, sf), mapping.option_costs(spark, sf),
                               order="row_order")


@register("cost_lookup_fallback", f"""
WITH {BASE_SQL}, {OPTIONS_SQL},
m AS (SELECT Model || '_' || Option_Code AS k, arg_max(Material_Cost, row_order) AS c
      FROM options GROUP BY 1),
oc AS (SELECT Option_Code, arg_max(Material_Cost, row_order) AS c FROM options GROUP BY 1)
{_LOOKUP_SELECT.format(cost="COALESCE(m.c, oc.c)")}
LEFT JOIN oc ON b.Options_Code = oc.Option_Code""")
def q_cost_lookup_fallback(spark, sf):
    return costing.cost_lookup(mapping.option_base(spark, sf), mapping.option_costs(spark, sf),
                               order="row_order", fallback=True)


# --------------------------------------------------------------------------- data quality

@register("dq_null_price", f"""
WITH {BASE_NULLS_SQL}
SELECT Vehicle_ID, Option_Quantities, Options_Code, Option_Desc, Model_Text, Sales_Price
FROM base WHERE Sales_Price IS NULL""")
def q_dq_null_price(spark, sf):
    return quality.null_price(mapping.option_base(spark, sf, with_nulls=True))


@register("dq_multi_cost", f"""
WITH {OPTIONS_SQL}
SELECT Model || '_' || Option_Code AS ModelOptionKey, count(DISTINCT Material_Cost) AS n_costs,
       count(*) AS n_rows
FROM options GROUP BY 1 HAVING count(DISTINCT Material_Cost) > 1""")
def q_dq_multi_cost(spark, sf):
    return quality.multi_cost_pairs(mapping.option_costs(spark, sf))


@register("dq_free_with_cost", f"""
WITH {BASE_NULLS_SQL}, {OPTIONS_SQL}
SELECT b.Vehicle_ID, b.Option_Quantities, b.Options_Code, b.Option_Desc, b.Model_Text, b.Sales_Price
FROM base b
WHERE b.Sales_Price = 0
  AND split_part(b.Model_Text, ' ', 1) || '_' || b.Options_Code IN (
      SELECT Model || '_' || Option_Code FROM options WHERE Material_Cost IS NOT NULL)""")
def q_dq_free_with_cost(spark, sf):
    return quality.free_with_cost(mapping.option_base(spark, sf, with_nulls=True),
                                  mapping.option_costs(spark, sf))


# --------------------------------------------------------------------------- test-group report (JOB5)

_CASES_SQL = f"""
cases AS (
  SELECT o.o_orderkey AS id,
         CASE WHEN n.n_name <> '{mapping.NULL_GROUP_NATION}' THEN n.n_name END AS group_name,
         CASE WHEN o.o_orderstatus = 'F' AND c.c_nationkey <> {mapping.NO_PASS_NATION_KEY}
              THEN 'OK' ELSE 'X' END AS status
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                JOIN nation n ON c.c_nationkey = n.n_nationkey),
tgroups AS (SELECT CASE n_nationkey WHEN {mapping.ABSENT_GROUP_NATION_KEY} THEN '{mapping.ABSENT_GROUP_NAME}'
                   ELSE n_name END AS name, n_regionkey + 1 AS test_value FROM nation)"""

# One pass over the cases: the passed ones are counted by filter, and a group
# without any (or without a name) has no count.
_REPORT_SQL = """
x AS (
  SELECT n.*, d.test_value, d.test_value * n.passed_test_cases AS total_value
  FROM (SELECT group_name, count(id) AS all_test_cases,
               CASE WHEN bool_or(status = 'OK') AND group_name IS NOT NULL
                    THEN count(id) FILTER (status = 'OK') END AS passed_test_cases
        FROM cases GROUP BY group_name) n
  LEFT JOIN tgroups d ON d.name = n.group_name)"""


def _group_report(spark, sf):
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    # Pre-aggregate the cases per customer: the big side shrinks before it is
    # shuffled, and the result is already partitioned on the join key.
    per_cust = reports.pass_counts(
        orders.select(F.col("o_orderkey").alias("id"), "o_custkey",
                      F.when(F.col("o_orderstatus") == "F", "OK").otherwise("X").alias("status")),
        ["o_custkey"])
    nat = bounded_broadcast(nation.select("n_nationkey", mapping.group_name().alias("group_name")))
    cust = customer.select("c_custkey", "c_nationkey").join(
        nat, F.col("c_nationkey") == F.col("n_nationkey"))
    j = per_cust.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    no_pass = F.col("c_nationkey") == mapping.NO_PASS_NATION_KEY
    counts = j.select("group_name", "all_ids",
                      F.when(no_pass, F.lit(0)).otherwise(F.col("ok_rows")).alias("ok_rows"),
                      F.when(no_pass, F.lit(0)).otherwise(F.col("ok_ids")).alias("ok_ids"))
    return reports.group_pass_totals(counts, mapping.test_groups(spark, sf))


@register("group_pass_totals", f"""
WITH {_CASES_SQL}, {_REPORT_SQL}
SELECT * FROM x""")
def q_group_pass_totals(spark, sf):
    return _group_report(spark, sf)


@register("group_pass_ordered", f"""
WITH {_CASES_SQL}, {_REPORT_SQL}
SELECT *, row_number() OVER (ORDER BY total_value NULLS FIRST, group_name NULLS FIRST,
       all_test_cases NULLS FIRST, passed_test_cases NULLS FIRST, test_value NULLS FIRST) AS rn
FROM x""")
def q_group_pass_ordered(spark, sf):
    return reports.ordered_report(_group_report(spark, sf))


# --------------------------------------------------------------------------- range minimum (JOB6)

@register("range_min", """
WITH qs AS (SELECT p_partkey AS query_id, p_partkey * 4 AS p, p_partkey * 4 + p_size AS q FROM part)
SELECT qs.query_id, min(e.value) AS min_value
FROM qs LEFT JOIN events e ON e.event_id BETWEEN qs.p AND qs.q
GROUP BY qs.query_id""")
def q_range_min(spark, sf):
    part = table(spark, sf, "part")
    qs = part.select(F.col("p_partkey").alias("query_id"), (F.col("p_partkey") * 4).alias("p"),
                     (F.col("p_partkey") * 4 + F.col("p_size")).alias("q"))
    ev = table(spark, sf, "events").select(F.col("event_id").alias("pos"), "value")
    return ranges.range_min(ev, qs)


@register("range_min_long", """
WITH qs AS (SELECT c_custkey AS query_id, c_custkey * 3 AS p,
                   c_custkey * 3 + CAST(floor(abs(c_acctbal)) AS BIGINT) AS q FROM customer)
SELECT qs.query_id, min(e.value) AS min_value
FROM qs LEFT JOIN events e ON e.event_id BETWEEN qs.p AND qs.q
GROUP BY qs.query_id""")
def q_range_min_long(spark, sf):
    cust = table(spark, sf, "customer")
    qs = cust.select(F.col("c_custkey").alias("query_id"), (F.col("c_custkey") * 3).alias("p"),
                     (F.col("c_custkey") * 3 + F.floor(F.abs("c_acctbal")).cast("long")).alias("q"))
    ev = table(spark, sf, "events").select(F.col("event_id").alias("pos"), "value")
    return ranges.range_min(ev, qs)


# Each event is a letter of a sequence: its user id picks one of the four.
@register("range_min_symbols", """
WITH qs AS (SELECT p_partkey AS query_id, p_partkey * 4 AS p, p_partkey * 4 + p_size * 3 AS q FROM part),
seq AS (SELECT event_id AS pos, 1 + user_id % 4 AS factor FROM events)
SELECT qs.query_id, CAST(min(seq.factor) AS INTEGER) AS min_value
FROM qs LEFT JOIN seq ON seq.pos BETWEEN qs.p AND qs.q
GROUP BY qs.query_id""")
def q_range_min_symbols(spark, sf):
    part = table(spark, sf, "part")
    qs = part.select(F.col("p_partkey").alias("query_id"), (F.col("p_partkey") * 4).alias("p"),
                     (F.col("p_partkey") * 4 + F.col("p_size") * 3).alias("q"))
    letters = F.array(*map(F.lit, ranges.FACTORS))
    seq = table(spark, sf, "events").select(
        F.col("event_id").alias("pos"), F.element_at(letters, (F.col("user_id") % 4 + 1).cast("int")).alias("symbol"))
    return ranges.range_min(ranges.symbol_positions(seq), qs)


# --------------------------------------------------------------------------- replay, batch side (JOB4)

# Fixed parameters of the replay over the events table (all of January 2024).
EVENTS_REPLAY = replay.Replay(start=datetime(2024, 1, 1), end=datetime(2024, 2, 1),
                              replay_start=datetime(2024, 6, 1), rate=0.1,
                              batch_seconds=7 * 24 * 3600, ts_field="ts")
EVENTS_REPLAY_SLOW = replay.Replay(start=datetime(2024, 1, 1), end=datetime(2024, 2, 1),
                                   replay_start=datetime(2024, 3, 1, 12, 0, 0), rate=2.5,
                                   batch_seconds=86400, ts_field="ts")
SLICE = ("2024-01-03 12:00:00", "2024-01-27 06:30:00")


def _us(r: replay.Replay) -> str:
    return str(r.batch_seconds * 1_000_000)


def _ts_sql(d: datetime) -> str:
    return f"TIMESTAMP '{d.strftime('%Y-%m-%d %H:%M:%S')}'"


def _replay_sql(r: replay.Replay) -> str:
    s = _ts_sql(r.start)
    return f"""
WITH x AS (
  SELECT event_id, ts, (epoch_us(ts) - epoch_us({s})) // {_us(r)} AS _batch_id,
         (epoch_us(ts) - epoch_us({s})) / 1e6 AS _offset
  FROM events WHERE ts >= {s} AND ts < {_ts_sql(r.end)}),
y AS (SELECT *, _offset * CAST({r.rate!r} AS DOUBLE) AS a FROM x)
SELECT event_id, ts, _batch_id, _offset,
       strftime({_ts_sql(r.replay_start)} + to_microseconds(
           CAST(floor(a) AS BIGINT) * 1000000 + CAST(round_even((a - floor(a)) * 1e6, 0) AS BIGINT)),
           '%Y-%m-%d %H:%M:%S.%f UTC') AS _replay_timestamp
FROM y"""


def _events(spark, sf):
    return table(spark, sf, "events")


@register("time_slice", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{SLICE[0]}' AND ts < TIMESTAMP '{SLICE[1]}'""")
def q_time_slice(spark, sf):
    return time_slice(_events(spark, sf), "ts", *SLICE)


@register("time_slice_zoned", f"""
SELECT * FROM events WHERE ts >= TIMESTAMP '{SLICE[0]}' AND ts < TIMESTAMP '{SLICE[1]}'""")
def q_time_slice_zoned(spark, sf):
    path = scratch_path(spark, "zoned-events")
    zones.write_zoned(_events(spark, sf), path, "ts")
    return zones.read_slice(spark, path, "ts", *SLICE)


@register("time_batches", f"""
WITH b AS (
  SELECT (epoch_us(ts) - epoch_us({_ts_sql(EVENTS_REPLAY.start)})) // {_us(EVENTS_REPLAY)} AS batch_id, ts
  FROM events WHERE ts >= {_ts_sql(EVENTS_REPLAY.start)} AND ts < {_ts_sql(EVENTS_REPLAY.end)})
SELECT batch_id,
       {_ts_sql(EVENTS_REPLAY.start)} + to_microseconds(batch_id * {_us(EVENTS_REPLAY)}) AS batch_start,
       least({_ts_sql(EVENTS_REPLAY.start)} + to_microseconds((batch_id + 1) * {_us(EVENTS_REPLAY)}),
             {_ts_sql(EVENTS_REPLAY.end)}) AS batch_end,
       count(*) AS n_rows, min(ts) AS first_ts, max(ts) AS last_ts
FROM b GROUP BY batch_id""")
def q_time_batches(spark, sf):
    return replay.batch_sizes(_events(spark, sf), EVENTS_REPLAY)


@register("replay_schedule", _replay_sql(EVENTS_REPLAY))
def q_replay_schedule(spark, sf):
    out = replay.replay_schedule(_events(spark, sf), EVENTS_REPLAY, publish=False)
    return out.select("event_id", "ts", "_batch_id", "_offset", "_replay_timestamp")


@register("replay_schedule_slow", _replay_sql(EVENTS_REPLAY_SLOW))
def q_replay_schedule_slow(spark, sf):
    out = replay.replay_schedule(_events(spark, sf), EVENTS_REPLAY_SLOW, publish=False)
    return out.select("event_id", "ts", "_batch_id", "_offset", "_replay_timestamp")


# No two events share a timestamp, so the JSON-text tie-break of the
# emission order never decides; the oracle orders by (ts, event_id).
@register("replay_order", f"""
WITH x AS (
  SELECT event_id, (epoch_us(ts) - epoch_us({_ts_sql(EVENTS_REPLAY.start)})) // {_us(EVENTS_REPLAY)} AS _batch_id, ts
  FROM events WHERE ts >= {_ts_sql(EVENTS_REPLAY.start)} AND ts < {_ts_sql(EVENTS_REPLAY.end)})
SELECT event_id, _batch_id, row_number() OVER (PARTITION BY _batch_id ORDER BY ts, event_id) AS _seq
FROM x""")
def q_replay_order(spark, sf):
    return replay.replay_order(_events(spark, sf), EVENTS_REPLAY, keep=["event_id", "_batch_id"],
                               stable_input=True).select("event_id", "_batch_id", "_seq")


def _events_ts_text(spark, sf):
    ev = _events(spark, sf)
    text = (F.when(F.col("event_type") == "error", F.lit(""))
            .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
            .when(F.col("event_type") == "purchase", F.concat(F.lit("at "), format_ts("ts")))
            .otherwise(format_ts("ts")))
    return ev.select("event_id", "event_type", text.alias("timestamp"))


@register("replay_bad_rows", """
SELECT event_id, event_type,
       CASE WHEN event_type = 'error' THEN '' WHEN event_type = 'signup' THEN NULL
            ELSE 'at ' || strftime(ts, '%Y-%m-%d %H:%M:%S.%f UTC') END AS "timestamp",
       CASE WHEN event_type IN ('error', 'signup') THEN 'missing timestamp'
            ELSE 'unparseable timestamp' END AS _error
FROM events WHERE event_type IN ('error', 'signup', 'purchase')""")
def q_replay_bad_rows(spark, sf):
    _, bad = replay.split_bad_rows(_events_ts_text(spark, sf), "timestamp")
    return bad


@register("replay_good_rows", """
SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f UTC') AS "timestamp", ts AS _ts
FROM events WHERE event_type NOT IN ('error', 'signup', 'purchase')""")
def q_replay_good_rows(spark, sf):
    good, _ = replay.split_bad_rows(_events_ts_text(spark, sf), "timestamp")
    return good


# Both sides of one pass, counted on the way and read back.
@register("replay_quarantine", """
SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'missing timestamp'
            WHEN event_type = 'purchase' THEN 'unparseable timestamp' END AS _error,
       count(*) AS n_rows, count(ts) FILTER (event_type NOT IN ('error', 'signup', 'purchase')) AS n_times,
       sum(count(*)) OVER (PARTITION BY event_type IN ('error', 'signup', 'purchase'))::BIGINT AS n_of_verdict
FROM (SELECT CASE WHEN event_type = 'signup' THEN 'error' ELSE event_type END AS kind, * FROM events)
GROUP BY 1, event_type IN ('error', 'signup', 'purchase')""")
def q_replay_quarantine(spark, sf):
    good, bad, counts = replay.quarantine(_events_ts_text(spark, sf), "timestamp", scratch_path(spark, "quarantine"))
    none = F.lit(None)
    both = (good.select(none.cast("string").alias("_error"), "_ts", F.lit(counts["good"]).alias("n_of_verdict"))
            .unionByName(bad.select("_error", none.cast("timestamp_ntz").alias("_ts"), F.lit(counts["bad"]).alias("n_of_verdict"))))
    return both.groupBy("_error", F.col("n_of_verdict").cast("long").alias("n_of_verdict")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_ts").alias("n_times"))


@register("ts_text_roundtrip", """
SELECT event_id, ts,
       strftime(ts, '%Y-%m-%d %H:%M:%S.%f UTC') AS ts_text,
       ts AS ts_back,
       strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS ts_text_seconds,
       date_trunc('second', ts) AS ts_back_seconds
FROM events""")
def q_ts_text_roundtrip(spark, sf):
    ev = _events(spark, sf).select("event_id", "ts")
    t = ev.select("event_id", "ts", format_ts("ts").alias("ts_text"),
                  format_ts("ts", seconds_only=True).alias("ts_text_seconds"))
    return t.select("event_id", "ts", "ts_text", parse_ts("ts_text").alias("ts_back"),
                    "ts_text_seconds", parse_ts("ts_text_seconds").alias("ts_back_seconds"))


def _events_attr_source(spark, sf):
    ev = _events(spark, sf)
    return ev.withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))


@register("message_attributes", """
SELECT event_id, event_type AS attr_event_type,
       CASE WHEN event_type <> 'error' THEN CAST(user_id AS VARCHAR) END AS attr_user_id,
       CASE WHEN event_type <> 'error' THEN 2 ELSE 1 END AS n_attributes
FROM events""")
def q_message_attributes(spark, sf):
    src = _events_attr_source(spark, sf)
    m = src.select("event_id", messages.attributes(["event_type", "user_id"]).alias("attributes"))
    return m.select("event_id", F.col("attributes")["event_type"].alias("attr_event_type"),
                    F.col("attributes")["user_id"].alias("attr_user_id"),
                    F.size("attributes").alias("n_attributes"))


@register("message_envelope", f"""
WITH r AS ({_replay_sql(EVENTS_REPLAY)})
SELECT e.event_id, e.ts, CASE WHEN e.event_type <> 'error' THEN e.user_id END AS user_id,
       e.event_type, e.value, e.props, r._offset, r._replay_timestamp,
       CASE WHEN e.event_type <> 'error' THEN 2 ELSE 1 END AS n_attributes
FROM events e JOIN r ON e.event_id = r.event_id""")
def q_message_envelope(spark, sf):
    src = _events_attr_source(spark, sf)
    enriched = replay.enrich(replay.assign_batches(src, EVENTS_REPLAY), EVENTS_REPLAY,
                             publish=False).drop("_batch_id", "_batch_start", "_batch_end")
    env = messages.envelope(enriched, ["event_type", "user_id"])
    decoded = env.select(messages.decode("value", enriched.schema).alias("m"),
                         F.size("attributes").alias("n_attributes"))
    return decoded.select("m.*", "n_attributes")


# --------------------------------------------------------------------------- sources and sinks (JOB1 load path)
# Each query writes data derived from the driver tables to a fresh path in the
# shared folder (``spark.checkpoint.dir``), then reads it back through the
# operator under test.

def _write_base_csv(spark, sf) -> str:
    """Options-sold CSV: header names differ from the schema (bound by
    position); Option_Desc holds a quoted newline."""
    b = mapping.option_base(spark, sf)
    out = b.select(F.col("Vehicle_ID").alias("Vehicle ID"),
                   F.col("Option_Quantities").cast("long").alias("Option_Quantities"),
                   F.col("Options_Code").alias("Option_Code"),
                   F.concat("Option_Desc", F.lit("\n"), "Options_Code").alias("Option_Desc"),
                   "Model_Text", "Sales_Price")
    path = scratch_path(spark, "base-csv")
    spread(out).write.option("header", True).csv(path)
    return path


def _write_options_csv(spark, sf) -> str:
    """Material-cost CSV; Option_Desc holds a quoted comma."""
    src = mapping.option_costs(spark, sf)
    out = src.select(F.col("Model"), F.col("Option_Code").alias("Option Code"),
                     F.concat("Option_Desc", F.lit(", "), "Option_Code").alias("Option_Desc"),
                     "Material_Cost")
    path = scratch_path(spark, "options-csv")
    out.write.option("header", True).csv(path)
    return path


_BASE_CSV_SQL = """
SELECT l.l_orderkey AS Vehicle_ID, CAST(l.l_quantity AS BIGINT) AS Option_Quantities,
       p.p_brand AS Options_Code, p.p_type || chr(10) || p.p_brand AS Option_Desc,
       p.p_name AS Model_Text,
       CAST(CASE WHEN l.l_discount = 0 THEN 0.0 ELSE l.l_extendedprice END AS DECIMAL(28,9)) AS Sales_Price
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""


@register("csv_load", _BASE_CSV_SQL)
def q_csv_load(spark, sf):
    return files.read_csv(spark, _write_base_csv(spark, sf), schema.BASE_CSV_FIELDS)


# Inner quotes are doubled; a description holds line ends and quotes.
@register("csv_load_split", _BASE_CSV_SQL.replace("p.p_type || chr(10) || p.p_brand",
                                                  "'\"' || p.p_type || '\",' || chr(10) || chr(10) || p.p_brand"))
def q_csv_load_split(spark, sf):
    b = mapping.option_base(spark, sf)
    desc = F.concat(F.lit('"'), "Option_Desc", F.lit('",\n\n'), "Options_Code")
    out = b.select(F.col("Vehicle_ID").alias("Vehicle ID"), F.col("Option_Quantities").cast("long").alias("Quantity"),
                   F.col("Options_Code").alias("Code"), desc.alias("Description"), "Model_Text", "Sales_Price")
    path = scratch_path(spark, "split-csv")
    spread(out).write.option("header", True).option("escape", '"').csv(path)
    return read_csv_split(spark, path, schema.BASE_CSV_FIELDS)


@register("csv_load_lines", f"""
WITH {OPTIONS_SQL}
SELECT Model, Option_Code, Option_Desc || ', ' || Option_Code AS Option_Desc,
       CAST(Material_Cost AS DECIMAL(28,9)) AS Material_Cost
FROM options""")
def q_csv_load_lines(spark, sf):
    return files.read_csv_lines(spark, _write_options_csv(spark, sf),
                                schema.OPTIONS_CSV_FIELDS)


@register("csv_infer", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
FROM part""")
def q_csv_infer(spark, sf):
    path = scratch_path(spark, "part-csv")
    table(spark, sf, "part").write.option("header", True).csv(path)
    return files.read_csv_inferred(spark, path)


_EVENTS_FIELDS = [
    {"name": "event_id", "type": "INTEGER"}, {"name": "ts", "type": "TIMESTAMP"},
    {"name": "user_id", "type": "INTEGER"}, {"name": "event_type", "type": "STRING"},
    {"name": "value", "type": "NUMERIC"}, {"name": "props", "type": "STRING"},
]


@register("jsonl_decimal", """
SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(28,9)) AS value, props FROM events""")
def q_jsonl_decimal(spark, sf):
    path = sinks.export_jsonl(_events(spark, sf), scratch_path(spark, "events-jsonl"))
    return files.read_jsonl(spark, path, _EVENTS_FIELDS)


# Some of the lines are broken: an unfinished object, text for a number, and a
# number of more digits than its column holds.
@register("jsonl_bad_rows", """
SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup', 'purchase')""")
def q_jsonl_bad_rows(spark, sf):
    n = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"event_type":"'), "event_type")
    line = F.concat(n, F.when(F.col("event_type") == "error", F.lit('","value":1'))
                    .when(F.col("event_type") == "signup", F.lit('","value":"text"}'))
                    .when(F.col("event_type") == "purchase", F.lit('","value":12345678901234567890123456789012}'))
                    .otherwise(F.lit('","value":1.5}')))
    path = scratch_path(spark, "bad-jsonl")
    spread(_events(spark, sf)).select(line.alias("value")).write.text(path)
    bad = files.read_jsonl(spark, path, [f for f in _EVENTS_FIELDS if f["name"] in ("event_id", "event_type", "value")],
                           mode="PERMISSIVE").where(F.col(files.CORRUPT).isNotNull())
    text = F.col(files.CORRUPT)
    return bad.select(F.regexp_extract(text, '"event_id":(\\d+)', 1).cast("long").alias("event_id"),
                      F.regexp_extract(text, '"event_type":"(\\w+)"', 1).alias("event_type"))


_EXPORT_SQL = """
SELECT event_type, count(*) AS n_events, round(sum(value), 4) AS total_value,
       min(ts) AS first_ts, max(ts) AS last_ts
FROM {t} GROUP BY event_type"""


@register("sql_export", _EXPORT_SQL.format(t="events"))
def q_sql_export(spark, sf):
    _events(spark, sf).createOrReplaceTempView("oxbow_events")
    try:
        path, st = sinks.sql_export(spark, _EXPORT_SQL.format(t="oxbow_events"),
                                    scratch_path(spark, "sql-export"))
    finally:
        spark.catalog.dropTempView("oxbow_events")
    return files.read_jsonl(spark, path, st)


@register("truncate_load", f"""
WITH {OPTIONS_SQL}
SELECT Model, Option_Code, Option_Desc, CAST(Material_Cost AS DECIMAL(28,9)) AS Material_Cost
FROM options""")
def q_truncate_load(spark, sf):
    path = scratch_path(spark, "options-table")
    part = table(spark, sf, "part")
    everything = part.select(F.split("p_name", " ").getItem(0).alias("Model"),
                             F.col("p_brand").alias("Option_Code"), F.col("p_type").alias("Option_Desc"),
                             F.col("p_retailprice").alias("Material_Cost"))
    sinks.truncate_load(everything, schema.OPTIONS_CSV_FIELDS, path=path)
    # The second load replaces the first one's rows.
    return sinks.truncate_load(mapping.option_costs(spark, sf), schema.OPTIONS_CSV_FIELDS, path=path)


@register("atomic_load", f"""
WITH {OPTIONS_SQL}
SELECT Model, Option_Code, Option_Desc, CAST(Material_Cost AS DECIMAL(28,9)) AS Material_Cost, CAST(2 AS BIGINT) AS version
FROM options""")
def q_atomic_load(spark, sf):
    path = scratch_path(spark, "versioned-options")
    options = mapping.option_costs(spark, sf)
    versions.atomic_load(options.withColumn("Option_Code", F.lit("old")), schema.OPTIONS_CSV_FIELDS, path)
    loaded = versions.atomic_load(options, schema.OPTIONS_CSV_FIELDS, path)
    versions.vacuum(spark, path, keep=1)
    return loaded.withColumn("version", F.lit(versions.current(spark, path)[0]).cast("long"))


# A third of the options arrive in two later deliveries; the kept view then equals
# the one computed from all of them.
@register("profit_view_incremental", _profit_sql(BASE_SQL))
def q_profit_view_incremental(spark, sf):
    path = scratch_path(spark, "kept-profit")
    options = mapping.option_costs(spark, sf)
    profit_view.create(mapping.option_base(spark, sf), options.where("row_order % 6 < 4"), path)
    profit_view.add_options(spark, path, options.where("row_order % 6 = 4"))
    return _money(profit_view.add_options(spark, path, options.where("row_order % 6 = 5")), "Production_Cost", "Profit")


@register("profit_view", f"""
SELECT Vehicle_ID, Option_Quantities, Options_Code, Option_Desc, Model_Text,
       CAST(Sales_Price AS DOUBLE) AS Sales_Price,
       CAST(Production_Cost AS DOUBLE) AS Production_Cost, CAST(Profit AS DOUBLE) AS Profit
FROM ({_profit_sql(BASE_SQL)})""")
def q_profit_view(spark, sf):
    base = files.read_csv(spark, _write_base_csv(spark, sf), schema.BASE_CSV_FIELDS)
    base = base.withColumn("Option_Desc", F.split("Option_Desc", "\n").getItem(0))
    options = files.read_csv(spark, _write_options_csv(spark, sf), schema.OPTIONS_CSV_FIELDS)
    profit = costing.option_profit(base, options)
    view = sinks.create_or_replace_view(spark, "vw_option_profit", profit)
    return _money(view.select(
        "Vehicle_ID", F.col("Option_Quantities").cast("double").alias("Option_Quantities"), "Options_Code",
        "Option_Desc", "Model_Text", F.col("Sales_Price").cast("double").alias("Sales_Price"), "Production_Cost",
        "Profit"), "Production_Cost", "Profit")


# --------------------------------------------------------------------------- replay as streams (JOB4)

_STREAM_SQL = f"""
SELECT event_id, ts, _offset, _replay_timestamp FROM ({_replay_sql(EVENTS_REPLAY)})"""


@register("stream_replay_files", _STREAM_SQL)
def q_stream_replay_files(spark, sf):
    ev = _events(spark, sf)
    work = scratch_path(spark, "replay-files")
    out = streaming.stream_replay_files(spark, ev, EVENTS_REPLAY, workdir=work)
    got = spark.read.option("recursiveFileLookup", True).parquet(out)
    return got.select("event_id", "ts", "_offset", "_replay_timestamp")


@register("stream_replay", _STREAM_SQL)
def q_stream_replay(spark, sf):
    # The replay start lies in the past, so every row is backlog: the first
    # clock batch with rows emits the whole slice (late rows are not dropped).
    ev = _events(spark, sf)
    work = scratch_path(spark, "replay-stream")
    streaming.stream_replay(spark, ev, EVENTS_REPLAY, checkpoint=f"{work}/checkpoint",
                            out=f"{work}/out", sink="parquet", trigger_seconds=0.5)
    got = spark.read.option("recursiveFileLookup", True).parquet(f"{work}/out")
    return got.select("event_id", "ts", "_offset", "_replay_timestamp")


@register("stream_replay_messages", f"""
WITH r AS ({_replay_sql(EVENTS_REPLAY)})
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, e.props, r._offset, r._replay_timestamp,
       e.event_type AS attr_event_type, true AS published_after_replay_time
FROM events e JOIN r ON e.event_id = r.event_id""")
def q_stream_replay_messages(spark, sf):
    ev = _events(spark, sf)
    work = scratch_path(spark, "replay-messages")
    streaming.stream_replay(spark, ev, EVENTS_REPLAY, checkpoint=f"{work}/checkpoint", out=f"{work}/out",
                            sink="messages", attributes=["event_type"], trigger_seconds=0.5)
    fields = ev.schema.add("_offset", "double").add("_replay_timestamp", "string").add("_publish_timestamp", "string")
    got = msg_sink.read_messages(spark, f"{work}/out").select(
        messages.decode("data", fields).alias("m"), F.col("attributes")["event_type"].alias("attr_event_type"))
    late = F.col("_publish_timestamp") >= F.col("_replay_timestamp")
    return got.select("m.*", "attr_event_type").withColumn("published_after_replay_time", late) \
        .drop("_publish_timestamp")


# Paced: the last day of the series is still ahead when the replay begins, at a
# rate that plays it in two seconds; no row may go out before its replay time.
@register("stream_replay_paced", """
SELECT event_id, ts, true AS published_after_replay_time FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'""")
def q_stream_replay_paced(spark, sf):
    ev = _events(spark, sf)
    work = scratch_path(spark, "replay-paced")
    rate = 2.0 / 86400
    r = replay.Replay(start=EVENTS_REPLAY.start, end=EVENTS_REPLAY.end, rate=rate, ts_field="ts",
                      replay_start=datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(seconds=30 * 86400 * rate))
    streaming.stream_replay(spark, ev, r, checkpoint=f"{work}/checkpoint", out=f"{work}/out", trigger_seconds=0.5)
    got = spark.read.option("recursiveFileLookup", True).parquet(f"{work}/out")
    return got.select("event_id", "ts", (F.col("_publish_timestamp") >= F.col("_replay_timestamp"))
                      .alias("published_after_replay_time"))


# The same, by state and timers.
@register("stream_replay_timers", """
SELECT event_id, ts, true AS published_after_replay_time FROM events
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'""")
def q_stream_replay_timers(spark, sf):
    rate = 4.0 / 86400
    r = replay.Replay(start=EVENTS_REPLAY.start, end=EVENTS_REPLAY.end, rate=rate, ts_field="ts", batch_seconds=7 * 86400,
                      replay_start=datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(seconds=30 * 86400 * rate))
    out = streaming.stream_replay_timers(spark, _events(spark, sf), r, workdir=scratch_path(spark, "replay-timers"),
                                         trigger_seconds=0.5)
    got = spark.read.option("recursiveFileLookup", True).parquet(out)
    return got.select("event_id", "ts", (F.col("_publish_timestamp") >= F.col("_replay_timestamp"))
                      .alias("published_after_replay_time"))


# Text order of the exported timestamp equals time order here (fixed-width
# text, no ties), so the oracle numbers rows by ts.
@register("jsonl_sort", """
SELECT event_id, row_number() OVER (ORDER BY ts) AS _line_no FROM events""")
def q_jsonl_sort(spark, sf):
    path = sinks.export_jsonl(_events(spark, sf), scratch_path(spark, "events-lines"))
    lines = spark.read.text(path)
    ordered = replay.sort_json_lines(lines, "ts", stable_input=True)
    return ordered.select(F.get_json_object("value", "$.event_id").cast("long").alias("event_id"),
                          "_line_no")


@register("message_publish", f"""
WITH r AS ({_replay_sql(EVENTS_REPLAY)})
SELECT e.event_id, e.ts, CASE WHEN e.event_type <> 'error' THEN e.user_id END AS user_id,
       e.event_type, e.value, e.props, r._offset, r._replay_timestamp,
       CASE WHEN e.event_type <> 'error' THEN 2 ELSE 1 END AS n_attributes
FROM events e JOIN r ON e.event_id = r.event_id""")
def q_message_publish(spark, sf):
    src = _events_attr_source(spark, sf)
    enriched = replay.enrich(replay.assign_batches(src, EVENTS_REPLAY), EVENTS_REPLAY,
                             publish=False).drop("_batch_id", "_batch_start", "_batch_end")
    target = scratch_path(spark, "messages")
    msg_sink.publish(messages.envelope(spread(enriched), ["event_type", "user_id"]), target)
    back = msg_sink.read_messages(spark, target)
    return back.select(messages.decode("data", enriched.schema).alias("m"),
                       F.size("attributes").alias("n_attributes")).select("m.*", "n_attributes")


# The lines that the console sink prints, read back from a text file of them.
@register("message_console", f"""
WITH r AS ({_replay_sql(EVENTS_REPLAY)})
SELECT e.event_id, e.ts, CASE WHEN e.event_type <> 'error' THEN e.user_id END AS user_id,
       e.event_type, e.value, e.props, r._offset, r._replay_timestamp
FROM events e JOIN r ON e.event_id = r.event_id""")
def q_message_console(spark, sf):
    src = _events_attr_source(spark, sf)
    enriched = replay.enrich(replay.assign_batches(src, EVENTS_REPLAY), EVENTS_REPLAY,
                             publish=False).drop("_batch_id", "_batch_start", "_batch_end")
    target = scratch_path(spark, "console")
    msg_sink.console_lines(messages.envelope(spread(enriched))).write.text(target)
    return spark.read.text(target).select(messages.decode("value", enriched.schema).alias("m")).select("m.*")


# Delivered in groups; the messages come back once each, and every group keeps its limits.
@register("message_delivery", f"""
WITH r AS ({_replay_sql(EVENTS_REPLAY)})
SELECT e.event_id, e.ts, CASE WHEN e.event_type <> 'error' THEN e.user_id END AS user_id,
       e.event_type, e.value, e.props, r._offset, r._replay_timestamp, true AS group_within_limits
FROM events e JOIN r ON e.event_id = r.event_id""")
def q_message_delivery(spark, sf):
    src = _events_attr_source(spark, sf)
    enriched = replay.enrich(replay.assign_batches(src, EVENTS_REPLAY), EVENTS_REPLAY,
                             publish=False).drop("_batch_id", "_batch_start", "_batch_end")
    target = scratch_path(spark, "delivered")
    delivery.deliver(messages.envelope(spread(enriched), ["event_type", "user_id"]), target)
    groups = delivery.read_groups(spark, target).select("file", (
        (F.col("messages") <= delivery.MAX_MESSAGES) & ((F.col("bytes") <= delivery.MAX_BYTES) | (F.col("messages") == 1))
    ).alias("group_within_limits"))
    back = delivery.read_delivered(spark, target).join(groups, "file")
    return back.select(messages.decode("data", enriched.schema).alias("m"), "group_within_limits").select("m.*", "group_within_limits")
