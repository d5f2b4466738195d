"""Registered queries of the library's own operators, each with the SQL that it is checked against.

The given tables stand in for the engine's: events for the load ledger and the covered keys (event type = extract,
user = app), lineitem by ship month for the destination, orders for job outcomes, customers for the app list, parts
for extract definitions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reportlake.cluster import shared_dir
from reportlake.functions import coerce, dates, maps
from reportlake.operators import ledger, rebuild
from reportlake.operators.execute import carry_out
from reportlake.operators.load import Landed, load_waves
from reportlake.operators.parse import Context, parse_report, parse_scan
from reportlake.operators.store import Destination
from reportlake.plans import checks, selection, summary, windows
from reportlake.schema import LEDGER, partition_id
from reportlake.sources import landing, scan
from reportlake.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

TODAY, START = date(2024, 1, 31), date(2024, 1, 1)
KEYS = ("date", "_extract", "app_id")


def query(sql: str) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: str) -> F.Column:
    """Exact sums: cents as decimals."""
    return F.col(c).cast("decimal(18,2)")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as keyed rows: date, _extract, app_id."""
    return read(spark, sf_dir, "events").select(F.to_date("ts").alias("date"), F.col("event_type").alias("_extract"), F.col("user_id").cast("string").alias("app_id"), "ts", "event_id", "value", "props")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as destination rows: ship date, return flag as extract, supplier as app."""
    day = F.to_date("l_shipdate")
    return read(spark, sf_dir, "lineitem").select(day.alias("date"), F.col("l_returnflag").alias("_extract"), F.col("l_suppkey").alias("app_id"), partition_id(day).alias("pid"), F.col("l_orderkey").alias("order_id"), money("l_quantity").alias("quantity"))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the lines of finished orders."""
    done = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_id"))
    return _lines(spark, sf_dir).join(done, "order_id", "left_semi").select(*KEYS).distinct()


def _loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a load ledger: errors failed, purchases are long calls, the key k of props is the number of calls."""
    status = F.when(F.col("_extract") == "error", "failed").when(F.col("_extract") == "view", "running").otherwise("success")
    calls = F.get_json_object("props", "$.k").cast("int")
    rows = _events(spark, sf_dir)
    return rows.select(F.col("_extract").alias("extract"), "app_id", F.col("date").alias("to_date"), status.alias("status"), (F.col("_extract") == "purchase").cast("int").alias("is_long"), calls.alias("api_calls"), F.col("ts").alias("started_at"), "event_id")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (extract, app_id) with its watermark; failed ones have none."""
    rows = _loads(spark, sf_dir)
    return rows.select("extract", "app_id").distinct().join(ledger.watermarks(rows), ["extract", "app_id"], "left")


def _jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = windows.with_windows(_pairs(spark, sf_dir), TODAY, START, lookback=5)
    return windows.with_chunks(planned, 4).withColumn("report_type", F.lit("daily"))


E_SQL = "e AS (SELECT CAST(ts AS DATE) AS date, event_type AS _extract, CAST(user_id AS VARCHAR) AS app_id, ts, event_id, value, props FROM events)"
L_SQL = "l AS (SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS _extract, l_suppkey AS app_id, CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS pid, l_orderkey AS order_id, CAST(l_quantity AS DECIMAL(18,2)) AS quantity FROM lineitem)"
C_SQL = "c AS (SELECT DISTINCT date, _extract, app_id FROM l WHERE order_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'))"
G_SQL = E_SQL + """,
g AS (SELECT _extract AS extract, app_id, date AS to_date, CASE _extract WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status,
  CAST(_extract = 'purchase' AS INTEGER) AS is_long, CAST(json_extract_string(props, '$.k') AS INTEGER) AS api_calls, ts AS started_at, event_id FROM e)"""
P_SQL = G_SQL + """,
p AS (SELECT extract, app_id, max(to_date) FILTER (status = 'success') AS watermark FROM g GROUP BY ALL)"""
J_SQL = P_SQL + """,
w AS (SELECT extract, app_id, greatest(DATE '2024-01-01', CASE WHEN watermark IS NULL THEN DATE '2024-01-01' ELSE least(DATE '2024-01-26', watermark - 4) END) AS a, DATE '2024-01-31' AS b FROM p),
k AS (SELECT extract, app_id, a, b, CAST(unnest(range((datediff('day', DATE '1970-01-01', a) + 719163) // 4, (datediff('day', DATE '1970-01-01', b) + 719163) // 4 + 1)) AS INTEGER) AS wave FROM w),
j AS (SELECT extract, app_id, wave, greatest(a, CAST(DATE '1970-01-01' + (wave * 4 - 719163) AS DATE)) AS from_date, least(b, CAST(DATE '1970-01-01' + (wave * 4 + 3 - 719163) AS DATE)) AS to_date FROM k)"""


@query(f"WITH {E_SQL} SELECT CAST((datediff('day', DATE '1970-01-01', date) + 719163) // 2 AS INTEGER) AS chunk, count(*) AS n, min(date) AS first_day, max(date) AS last_day FROM e GROUP BY 1")
def chunk_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunk = dates.chunk_index(F.col("date"), 2).alias("chunk")
    return _events(spark, sf_dir).groupBy(chunk).agg(F.count("*").alias("n"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


@query("""SELECT 'lineitem' AS src, CAST(strftime(l_shipdate, '%Y%m') AS INTEGER) AS pid, count(*) AS n FROM lineitem GROUP BY ALL
UNION ALL SELECT 'events', CAST(strftime(ts, '%Y%m%d') AS INTEGER), count(*) FROM events GROUP BY ALL""")
def partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(F.lit("lineitem").alias("src"), partition_id("l_shipdate").alias("pid"))
    events = read(spark, sf_dir, "events").select(F.lit("events").alias("src"), partition_id("ts", "day").alias("pid"))
    return lines.unionByName(events).groupBy("src", "pid").agg(F.count("*").alias("n"))


@query(f"WITH {G_SQL} SELECT extract, app_id, max(to_date) AS watermark FROM g WHERE status = 'success' GROUP BY ALL")
def pair_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.watermarks(_loads(spark, sf_dir))


@query(f"""WITH {G_SQL}, r AS (SELECT extract, app_id, to_date, lag(to_date) OVER (PARTITION BY extract, app_id ORDER BY to_date) AS prev FROM (SELECT DISTINCT extract, app_id, to_date FROM g WHERE status = 'success')),
h AS (SELECT *, sum(CASE WHEN coalesce(prev, DATE '2023-12-31') + 1 < to_date THEN 1 ELSE 0 END) OVER (PARTITION BY extract, app_id ORDER BY to_date) AS holes FROM r)
SELECT extract, app_id, max(to_date) AS watermark FROM h WHERE holes = 0 GROUP BY ALL""")
def gapless_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _loads(spark, sf_dir).select("extract", "app_id", F.col("to_date").alias("from_date"), "to_date", "status").distinct()
    return ledger.contiguous_watermarks(days, F.lit(START))


@query(f"WITH {E_SQL} SELECT app_id AS lock_key, arg_max(_extract, (ts, event_id)) AS status, max((ts, event_id)).event_id AS event_id FROM (SELECT app_id, _extract, ts, event_id FROM e) GROUP BY 1".replace("max((ts, event_id)).event_id", "arg_max(event_id, (ts, event_id))"))
def lock_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select(F.col("app_id").alias("lock_key"), F.col("_extract").alias("status"), "ts", "event_id")
    return ledger.latest(rows, "lock_key", "ts", "event_id").select("lock_key", "status", "event_id")


@query(f"WITH {L_SQL}, {C_SQL} SELECT pid, count(*) AS n, CAST(sum(quantity) AS DOUBLE) AS quantity FROM l ANTI JOIN c USING (date, _extract, app_id) GROUP BY pid")
def rebuild_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = rebuild.kept_rows(_lines(spark, sf_dir), _coverage(spark, sf_dir))
    return kept.groupBy("pid").agg(F.count("*").alias("n"), F.sum("quantity").cast("double").alias("quantity"))


def _fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new pull brings for the covered keys: their lines, one more of each, but nothing for flag R."""
    covered = _lines(spark, sf_dir).join(_coverage(spark, sf_dir), list(KEYS), "left_semi").where("_extract <> 'R'")
    return covered.withColumn("quantity", (F.col("quantity") + 1).cast("decimal(18,2)")).select(*_lines(spark, sf_dir).columns)


def _state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuild.rebuilt(_lines(spark, sf_dir), _coverage(spark, sf_dir), _fresh(spark, sf_dir))


S_SQL = f"""{L_SQL}, {C_SQL},
s AS (SELECT *, false AS is_fresh FROM l ANTI JOIN c USING (date, _extract, app_id) UNION ALL
  SELECT * REPLACE (CAST(quantity + 1 AS DECIMAL(18,2)) AS quantity), true FROM l SEMI JOIN c USING (date, _extract, app_id) WHERE _extract <> 'R')"""


@query(f"WITH {S_SQL} SELECT pid, _extract, is_fresh, count(*) AS n, CAST(sum(quantity) AS DOUBLE) AS quantity FROM s GROUP BY ALL")
def rebuild_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _state(spark, sf_dir).groupBy("pid", "_extract", "is_fresh").agg(F.count("*").alias("n"), F.sum("quantity").cast("double").alias("quantity"))


@query(f"""WITH {S_SQL}, o AS (SELECT pid, count(*) AS n_old FROM l GROUP BY pid), n AS (SELECT pid, count(*) FILTER (NOT is_fresh) AS kept, count(*) FILTER (is_fresh) AS fresh FROM s GROUP BY pid)
SELECT pid, coalesce(n_old, 0) AS n_old, coalesce(kept, 0) AS kept, coalesce(fresh, 0) AS fresh,
  CASE WHEN coalesce(kept, 0) + coalesce(fresh, 0) > 0 THEN 'replace' WHEN coalesce(n_old, 0) > 0 THEN 'drop' ELSE 'noop' END AS action FROM o FULL JOIN n USING (pid)""")
def rebuild_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuild.actions(_lines(spark, sf_dir), _state(spark, sf_dir))


def _pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-day jobs of every pair that has events in them."""
    chunk = dates.chunk_index(F.col("date"), 2)
    jobs = _events(spark, sf_dir).select("_extract", "app_id", chunk.alias("c")).distinct()
    return jobs.select("_extract", "app_id", dates.from_ordinal(F.col("c") * 2).alias("from_date"), dates.from_ordinal(F.col("c") * 2 + 1).alias("to_date"))


V_SQL = E_SQL + """,
b AS (SELECT DISTINCT _extract, app_id, (datediff('day', DATE '1970-01-01', date) + 719163) // 2 AS c FROM e),
v AS (SELECT _extract, app_id, c, CAST(DATE '1970-01-01' + CAST(c * 2 - 719163 + unnest([0, 1]) AS INTEGER) AS DATE) AS date FROM b)"""


@query(f"WITH {V_SQL} SELECT DISTINCT date, _extract, app_id FROM v")
def coverage_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rebuild.covered_days(_pulls(spark, sf_dir))


def _guard_sql(job: str) -> str:
    return f"""WITH {V_SQL}, x AS (SELECT date, _extract, app_id, count(*) AS n, count(*) FILTER (value > 60) AS f FROM e GROUP BY ALL),
d AS (SELECT v.*, coalesce(n, 0) AS n, coalesce(f, 0) AS f FROM v LEFT JOIN x USING (date, _extract, app_id)),
t AS (SELECT *, sum(f) OVER (PARTITION BY {job}) AS total FROM d)
SELECT _extract, count(*) AS covered, count(*) FILTER (n > 0 AND total = 0) AS guarded FROM t GROUP BY _extract"""


def _guard(spark: SparkSession, sf_dir: str, per_day: bool) -> DataFrame:
    rows, jobs = _events(spark, sf_dir), _pulls(spark, sf_dir)
    out = rebuild.guarded(rebuild.covered_days(jobs), rows, rows.where("value > 60"), jobs, per_day)
    return out.groupBy("_extract").agg(F.count("*").alias("covered"), F.count_if("guarded").alias("guarded"))


@query(_guard_sql("_extract, app_id, c"))
def empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guard(spark, sf_dir, per_day=False)


@query(_guard_sql("_extract, app_id, c, date"))
def empty_guard_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guard(spark, sf_dir, per_day=True)


# Amounts, rates, dates and words of the events as exports write them, a kind for every eighth.
_V = "CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR)"
_CELL_SQL = f"""CASE event_id % 8 WHEN 0 THEN '  $' || {_V} || ' ' WHEN 1 THEN {_V} || '%' WHEN 2 THEN CAST(event_id // 8 AS VARCHAR) || ',' || '007' WHEN 3 THEN ' N/A' WHEN 4 THEN '-' || {_V}
  WHEN 5 THEN ' ' || event_type || ' ' WHEN 6 THEN CAST(CAST(ts AS DATE) AS VARCHAR) ELSE {_V} || 'd' END"""
_TRIM = r"regexp_replace(cell, '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g')"
_NUM = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


@query(rf"""WITH c AS (SELECT *, {_TRIM} AS t FROM (SELECT event_id AS id, {_CELL_SQL} AS cell FROM events)), n AS (SELECT *, t IN ('', 'N/A', 'null', 'None', 'NULL', '-') AS nil, replace(t, ',', '') AS u, regexp_replace(t, '[,%$]', '', 'g') AS f FROM c)
SELECT id, CASE WHEN t IN ('', 'N/A') THEN '' ELSE t END AS as_text,
  CASE WHEN NOT nil AND regexp_matches(u, {_NUM}) AND CAST(u AS DOUBLE) >= 0 THEN CAST(trunc(CAST(u AS DOUBLE)) AS BIGINT) END AS as_count,
  CASE WHEN NOT nil AND regexp_matches(f, {_NUM}) THEN CAST(f AS DOUBLE) END AS as_number,
  CASE WHEN regexp_matches(t, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN TRY_CAST(t AS DATE) END AS as_day FROM n""")
def coerce_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    v, k = money("value").cast("string"), F.col("event_id") % 8
    kinds = [F.concat(F.lit("  $"), v, F.lit(" ")), F.concat(v, F.lit("%")), F.concat(F.floor(F.col("event_id") / 8).cast("string"), F.lit(",007")), F.lit(" N/A"), F.concat(F.lit("-"), v), F.concat(F.lit(" "), "event_type", F.lit(" ")), F.to_date("ts").cast("string"), F.concat(v, F.lit("d"))]
    c = F.coalesce(*[F.when(k == i, x) for i, x in enumerate(kinds)])
    cells = read(spark, sf_dir, "events").select(F.col("event_id").alias("id"), c.alias("cell"))
    c = F.col("cell")
    return cells.select("id", coerce.to_text(c).alias("as_text"), coerce.to_count(c).alias("as_count"), coerce.to_number(c).alias("as_number"), coerce.to_day(c).alias("as_day"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_sum, max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS k_max FROM events GROUP BY event_type")
def props_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = coerce.to_count(F.get_json_object("props", "$.k"))
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k_sum"), F.max(k).alias("k_max"))


@query("""WITH s AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS a, CAST(CAST(o_orderdate AS DATE) + CAST(o_custkey % 12 - 2 AS INTEGER) AS DATE) AS b FROM orders),
k AS (SELECT *, unnest(range((datediff('day', DATE '1970-01-01', a) + 719163) // 3, (datediff('day', DATE '1970-01-01', b) + 719163) // 3 + 1)) AS w FROM s WHERE a <= b)
SELECT id, CAST(w AS INTEGER) AS wave, greatest(a, CAST(DATE '1970-01-01' + CAST(w * 3 - 719163 AS INTEGER) AS DATE)) AS from_date, least(b, CAST(DATE '1970-01-01' + CAST(w * 3 + 2 - 719163 AS INTEGER) AS DATE)) AS to_date FROM k""")
def chunk_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of up to nine days from every order's day, some the wrong way round, in chunks of three."""
    day = F.to_date("o_orderdate")
    spans = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), day.alias("from_date"), F.date_add(day, (F.col("o_custkey") % 12 - 2).cast("int")).alias("to_date"))
    return windows.with_chunks(spans.where("from_date <= to_date"), 3).select("id", "wave", "from_date", "to_date")


@query(f"WITH {J_SQL} SELECT extract, app_id, a AS from_date, b AS to_date FROM w")
def window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.with_windows(_pairs(spark, sf_dir), TODAY, START, lookback=5).select("extract", "app_id", "from_date", "to_date")


@query(f"WITH {J_SQL} SELECT wave, count(*) AS jobs, count(*) FILTER (to_date - from_date + 1 >= 3) AS long_jobs, min(from_date) AS from_date, max(to_date) AS to_date FROM j GROUP BY wave")
def plan_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.waves(_jobs(spark, sf_dir))


@query(f"""WITH {J_SQL} SELECT extract, app_id, wave, CAST((row_number() OVER (PARTITION BY app_id ORDER BY wave, extract) - 1) * 65 AS INTEGER) AS not_before,
  to_date - from_date + 1 < 3 OR row_number() OVER (PARTITION BY app_id, to_date - from_date + 1 >= 3 ORDER BY wave, extract) <= 6 AS in_budget FROM j""")
def paced_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.paced(_jobs(spark, sf_dir), 65, 6).select("extract", "app_id", "wave", "not_before", "in_budget")


@query(f"""WITH {J_SQL} SELECT extract, app_id, wave, to_date - from_date + 1 < 3 OR (row_number() OVER (PARTITION BY app_id, to_date - from_date + 1 >= 3 ORDER BY wave, extract) <= 6
  AND row_number() OVER (PARTITION BY to_date - from_date + 1 >= 3 ORDER BY wave, extract, app_id) <= 110) AS in_budget FROM j""")
def paced_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both long budgets: of each app and, less a reserve, of the account."""
    return windows.paced(_jobs(spark, sf_dir), 65, 6, account_budget=120, reserve=10).select("extract", "app_id", "wave", "in_budget")


@query(f"WITH {J_SQL}, n AS (SELECT app_id, count(*) AS n FROM j GROUP BY app_id) SELECT CAST(sum(n) AS BIGINT) AS calls, max(n) AS busiest, CAST(greatest(max(n) * 65, sum(n) * 2) AS BIGINT) AS seconds FROM n")
def plan_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.estimate(_jobs(spark, sf_dir), 65)


@query(f"WITH {G_SQL} SELECT app_id, CAST(sum(api_calls) AS BIGINT) AS calls FROM g WHERE is_long = 1 AND status <> 'running' AND started_at >= TIMESTAMP '2024-01-15' GROUP BY ROLLUP (app_id)")
def long_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.long_calls(_loads(spark, sf_dir), F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz"))


@query(f"WITH {G_SQL} SELECT event_id, extract, app_id, status, started_at FROM g ORDER BY started_at DESC, event_id LIMIT 20")
def recent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.recent(_loads(spark, sf_dir), 20, "event_id").select("event_id", "extract", "app_id", "status", "started_at")


@query(f"""WITH {E_SQL}, r AS (SELECT app_id AS lock_key, arg_max(_extract, (ts, event_id)) AS s, max(ts) AS t FROM e GROUP BY 1)
SELECT lock_key, CAST(date_diff('microsecond', t, TIMESTAMP '2024-01-31') // 1000000 AS BIGINT) AS age_seconds, date_diff('microsecond', t, TIMESTAMP '2024-01-31') // 1000000 > 86400 AS stale FROM r WHERE s = 'click'""")
def active_locks(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("_extract") == "click", "running").otherwise("released")
    rows = _events(spark, sf_dir).select(F.col("app_id").alias("lock_key"), F.col("event_id").alias("run_id"), status.alias("status"), F.col("ts").alias("updated_at"), F.lit(86400).alias("timeout_seconds"))
    return ledger.active_locks(rows, F.lit(datetime(2024, 1, 31)).cast("timestamp_ntz")).select("lock_key", "age_seconds", "stale")


TYPES = ("click", "error", "purchase", "signup", "view")


def _event_maps(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """One row per key with the maps event -> count and event -> amount; events that a key lacks are left out."""
    rows = _events(spark, sf_dir).withColumn("amount", money("value"))
    mine = {t: F.col("_extract") == t for t in TYPES}
    counts = [F.nullif(F.count_if(m), F.lit(0)).alias(f"n_{t}") for t, m in mine.items()]
    wide = rows.groupBy(key).agg(*counts, *[F.sum(F.when(m, F.col("amount"))).alias(f"v_{t}") for t, m in mine.items()])
    return wide.select(key, maps.event_map([(t, F.col(f"n_{t}")) for t in TYPES], "bigint").alias("event_counter"), maps.event_map([(t, F.col(f"v_{t}")) for t in TYPES], "double").alias("event_sales"))


@query(f"WITH {E_SQL} SELECT app_id, _extract AS event, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM e GROUP BY ALL")
def event_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_maps(spark, sf_dir, "app_id").select("app_id", "event_sales", F.explode("event_counter").alias("event", "n"))
    return rows.select("app_id", "event", "n", F.try_element_at("event_sales", "event").alias("amount"))


@query(f"WITH {E_SQL} SELECT date, count(*) FILTER (_extract = 'purchase') AS purchases, CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (_extract = 'purchase'), 0) AS DOUBLE) AS amount, count(*) FILTER (_extract = 'refund') AS refunds FROM e GROUP BY date")
def map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _event_maps(spark, sf_dir, "date")
    look = maps.looked_up
    return rows.select("date", look(F.col("event_counter"), "purchase").alias("purchases"), look(F.col("event_sales"), "purchase", 0.0).alias("amount"), look(F.col("event_counter"), "refund").alias("refunds"))


def _wide_report(spark: SparkSession, sf_dir: str) -> tuple[list[str], DataFrame]:
    """events as a landed report: one text row per day and user, a triple of columns for every event type."""
    rows = _events(spark, sf_dir).withColumn("amount", money("value"))
    aggs = []
    for t in TYPES:
        mine = F.col("_extract") == t
        n = F.count_if(mine)
        aggs += [F.when(n > 0, F.count_distinct(F.when(mine, F.col("app_id"))).cast("string")).otherwise("N/A"), F.when(n > 0, n.cast("string")), F.when(n > 0, F.concat(F.lit("$"), F.sum(F.when(mine, F.col("amount"))).cast("string")))]
    wide = rows.groupBy("date", "app_id").agg(*[a.alias(f"c{i + 3}") for i, a in enumerate(aggs)])
    headers = ["Date", " Media Source (pid)", "Mystery", *(f"{t} ({leg})" for t in TYPES for leg in ("Unique users", "Event counter", "Sales in USD"))]
    return headers, wide.select(F.col("date").cast("string").alias("c0"), F.concat(F.lit(" user"), "app_id").alias("c1"), F.lit("?").alias("c2"), *[f"c{i + 3}" for i in range(len(aggs))])


CONTEXT = Context("app", "daily_report", "standard", False, "standard", "run", datetime(2024, 2, 1), "USD")


@query(f"""WITH {E_SQL} SELECT date, 'user' || app_id AS media_source, 'USD' AS currency, CAST(strftime(date, '%Y%m') AS INTEGER) AS pid, _extract AS event, count(*) AS n, CAST(1 AS BIGINT) AS users,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS sales FROM e WHERE date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AND app_id NOT IN ('1', '2') GROUP BY ALL""")
def parse_wide_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, raw = _wide_report(spark, sf_dir)
    parsed = parse_report(headers, raw, CONTEXT, (date(2024, 1, 3), date(2024, 1, 20)), ("user1", "user2"), keep_unknown=True)
    rows = parsed.rows.select("date", "media_source", "currency", partition_id("date").alias("pid"), "event_unique_users", "event_sales", F.explode("event_counter").alias("event", "n"))
    return rows.select("date", "media_source", "currency", "pid", "event", "n", F.try_element_at("event_unique_users", "event").alias("users"), F.try_element_at("event_sales", "event").alias("sales"))


@query(f"""WITH {E_SQL}, t AS (SELECT DISTINCT date, app_id FROM e), f AS (SELECT date BETWEEN DATE '2024-01-03' AND DATE '2024-01-20' AS inside, app_id IN ('1', '2') AS out FROM t)
SELECT count(*) FILTER (inside AND NOT out) AS kept, count(*) FILTER (NOT inside) AS dropped_out_of_range, count(*) FILTER (inside AND out) AS dropped_excluded FROM f""")
def exclude_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, raw = _wide_report(spark, sf_dir)
    parsed = parse_report(headers, raw, CONTEXT, (date(2024, 1, 3), date(2024, 1, 20)), ("user1", "user2"))
    inside, excluded = parsed._tests()
    return parsed.all_rows.agg(F.count_if(inside & ~excluded).alias("kept"), F.count_if(~inside).alias("dropped_out_of_range"), F.count_if(inside & excluded).alias("dropped_excluded"))


@query("SELECT p_name AS campaign, count(*) AS n, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1")
def campaign_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read(spark, sf_dir, "part").select(F.lit("2024-01-01").alias("c0"), F.col("p_name").alias("c1"), F.col("p_brand").alias("c2"))
    rows = parse_report(["Date", "Campaign Name", "Media Source (pid)"], raw, CONTEXT).rows
    return rows.groupBy("campaign").agg(F.count("*").alias("n"), F.count_distinct("media_source").alias("brands"))


@query("""SELECT CAST(l_shipdate AS DATE) AS date, n_name AS media_source, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS spend, count(*) AS n
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def spend_by_day_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").cast("string").alias("c0"), money("l_extendedprice").cast("string").alias("c2"))
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("c1"))
    joined = lines.join(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"), "l_suppkey").join(nations, "s_nationkey")
    rows = parse_report(["Date", "Media Source (pid)", "Total Cost"], joined.select("c0", "c1", "c2"), CONTEXT).rows
    return rows.groupBy("date", "media_source").agg(F.sum(money("total_cost")).cast("double").alias("spend"), F.count("*").alias("n"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def apps_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id"), "o_orderpriority")
    apps = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    return landing.pick_apps(apps, exclude=orders.where("o_orderpriority = '1-URGENT'"), only=orders).withColumnRenamed("id", "c_custkey")


@query("SELECT coalesce(n_name, '') AS currency, count(*) AS apps FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey GROUP BY 1")
def currency_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    apps = read(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("currency"))
    rows = landing.with_currency(read(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("app_id")), apps)
    return rows.groupBy("currency").agg(F.count("*").alias("apps"))


@query("""WITH n AS (SELECT DISTINCT p_brand AS n, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS p FROM part)
SELECT DISTINCT least(x.n, y.n) AS a, greatest(x.n, y.n) AS b FROM n x JOIN n y ON x.n <> y.n AND starts_with(y.p, x.p) AND x.p <> ''""")
def owner_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.owner_overlaps(read(spark, sf_dir, "part"), "p_brand")


@query("""SELECT p_name AS name, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS granularities FROM part GROUP BY p_name HAVING count(DISTINCT p_type) > 1""")
def granularity_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checks.granularity_conflicts(read(spark, sf_dir, "part").withColumnRenamed("p_name", "name"), "name", "p_type")
    return found.select("name", F.array_join("granularities", ",").alias("granularities"))


@query("""SELECT o_orderpriority AS extract, count(*) FILTER (o_orderstatus = 'F') AS success, count(*) FILTER (o_orderstatus = 'O') AS failed, count(*) FILTER (o_orderstatus = 'P') AS skipped,
  CAST(coalesce(sum(CAST(floor(o_totalprice) AS BIGINT)) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS rows FROM orders GROUP BY 1""")
def extract_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failed").otherwise("skipped")
    jobs = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("extract"), status.alias("status"), F.floor("o_totalprice").cast("long").alias("rows"))
    return checks.status_totals(jobs, "extract")


@query("SELECT p_partkey, p_name FROM part WHERE (p_name LIKE 'small %' OR p_type = 'PROMO') AND p_name NOT LIKE '% ring'")
def extract_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part").withColumn("tags", F.array("p_type"))
    return selection.selected(parts, "small*, tag:PROMO", "* ring".replace(" ", "?"), name="p_name", tags="tags").select("p_partkey", "p_name")


@query(f"""WITH {G_SQL} SELECT extract, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
  CAST(sum(event_id) AS BIGINT) AS rows, CAST(sum(api_calls) AS BIGINT) AS api_calls, min(to_date) AS from_date, max(to_date) AS to_date FROM g WHERE status <> 'running' GROUP BY ROLLUP (extract)""")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.totals(_loads(spark, sf_dir).withColumns({"rows": F.col("event_id"), "from_date": F.col("to_date")}))


def _folder(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"


THIRDS = [(1, 10), (11, 20), (21, 31)]
#: The views of the second third come without a readable date.
BROKEN = ("view", 1)


def _landed(spark: SparkSession, sf_dir: str) -> tuple[str, list[list[Landed]]]:
    """events as CSV files that have landed, one for every event type and third of the month; waves of them."""
    folder = _folder(spark)
    third = F.when(F.dayofmonth("date") <= 10, 0).when(F.dayofmonth("date") <= 20, 1).otherwise(2)
    rows = _events(spark, sf_dir).withColumns({"job": F.concat_ws("-", "_extract", third), "amount": money("value")})
    each = rows.groupBy("job", "date", "app_id").agg(F.count("*").alias("n"), F.sum("amount").alias("v"))
    day = F.when(F.col("job") == F.lit("-".join(map(str, BROKEN))), "soon").otherwise(F.col("date").cast("string"))
    # A header cell that holds a line break stands before others, as exports have them.
    cells = each.select("job", day.alias("Date"), F.concat(F.lit("user"), "app_id").alias("Media Source (pid)"), F.lit("x\ny").alias("My\nMetric"), F.format_number("n", 0).alias("Impressions"), F.concat(F.lit("$"), F.col("v").cast("string")).alias("Total Cost"))
    cells.repartition("job").write.partitionBy("job").option("header", True).csv(f"{folder}/reports")
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/reports/job=*/part-*")
    waves: list[list[Landed]] = [[] for _ in THIRDS]
    for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place):
        path = f.getPath().toString()
        extract, k = path.rsplit("/", 2)[1].removeprefix("job=").rsplit("-", 1)
        first, last = THIRDS[int(k)]
        waves[int(k)].append(Landed(path, extract, "app", "daily", date(2024, 1, first), date(2024, 1, last), chunk_days=10, is_long=True))
    return folder, [sorted(w, key=lambda j: j.extract) for w in waves]


def _kept(spark: SparkSession, table: Destination, *columns: str) -> DataFrame:
    """A table's rows (all columns, or those asked for), written as they are, and the table dropped from the catalog: its files stay until their folder goes."""
    path = f"{table.root}/result"
    table.rows().select(*columns or "*").write.parquet(path)
    spark.sql(f"DROP TABLE {table.name}")
    return spark.read.parquet(path)


#: What is asked of the rows loaded.
LOADED = ("_extract", "media_source", "date", "pid", "impressions", "total_cost")


def _loaded(spark: SparkSession, sf_dir: str, again: bool) -> tuple[Destination, str]:
    """The table into which the waves are loaded, and if asked for the first of them once more; and the ledger."""
    folder, waves = _landed(spark, sf_dir)
    table, now = Destination(spark, f"landed_{uuid.uuid4().hex}", f"{folder}/table"), datetime(2024, 2, 1)
    for k, part in enumerate([waves, waves[:1]] if again else [waves]):
        locks = None if again else ledger.Locks(spark, f"{folder}/locks", f"run{k}", "query")
        load_waves(spark, part, table, f"{folder}/ledger", f"run{k}", now, exclude=["user1"], locks=locks)
    return table, f"{folder}/ledger"


W_SQL = E_SQL + """,
w AS (SELECT _extract, app_id, date, CASE WHEN day(date) <= 10 THEN 0 WHEN day(date) <= 20 THEN 1 ELSE 2 END AS k, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS v FROM e GROUP BY ALL)"""


@query(f"""WITH {W_SQL} SELECT _extract, 'user' || app_id AS media_source, date, CAST(strftime(date, '%Y%m') AS INTEGER) AS pid, n AS impressions, CAST(v AS DOUBLE) AS total_cost
FROM w WHERE app_id <> '1' AND NOT (_extract = 'view' AND k > 0)""")
def landed_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files loaded in waves, one of them twice: broken reports and what follows them stay out, nothing comes double."""
    return _kept(spark, _loaded(spark, sf_dir, again=True)[0], *LOADED).select(*LOADED)


@query(f"""WITH {W_SQL}, j AS (SELECT _extract AS extract, k, count(*) FILTER (app_id <> '1') AS n FROM w GROUP BY ALL),
s AS (SELECT *, CASE WHEN extract = 'view' AND k = 1 THEN 'failed' WHEN extract = 'view' AND k = 2 THEN 'skipped' ELSE 'success' END AS status FROM j)
SELECT extract, make_date(2024, 1, CAST(k * 10 + 1 AS INTEGER)) AS from_date, status, CASE WHEN status = 'success' THEN n ELSE 0 END AS rows, CASE WHEN status = 'skipped' THEN 0 ELSE 1 END AS api_calls, true AS timed FROM s
UNION ALL SELECT extract, make_date(2024, 1, CAST(k * 10 + 1 AS INTEGER)), 'running', 0, 0, false FROM s WHERE status <> 'skipped'""")
def ledger_after_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of one load: a row of every job before and after."""
    table, loads = _loaded(spark, sf_dir, again=False)
    spark.sql(f"DROP TABLE {table.name}")  # its files stay until their folder goes; its rows are not asked for
    rows = ledger.read_loads(spark, loads)
    return rows.select("extract", "from_date", "status", "rows", "api_calls", (F.col("duration_ms") >= 0).alias("d"), "finished_at").select("extract", "from_date", "status", "rows", "api_calls", F.coalesce(F.col("d") & F.col("finished_at").isNotNull(), F.lit(False)).alias("timed"))


@query("SELECT p_name AS campaign, p_type, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS size FROM part GROUP BY ALL")
def unknown_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of no known header, kept as a map."""
    raw = read(spark, sf_dir, "part").select(F.lit("2024-01-01").alias("c0"), F.col("p_name").alias("c1"), F.col("p_type").alias("c2"), F.col("p_size").cast("string").alias("c3"))
    rows = parse_report(["Date", "Campaign (c)", "Part Type", "Size"], raw, CONTEXT, keep_unknown=True).rows
    extra = lambda n: maps.looked_up(F.col("extra"), n, "")
    return rows.groupBy("campaign", extra("Part Type").alias("p_type")).agg(F.count("*").alias("n"), F.sum(extra("Size").cast("long")).alias("size"))


PAGE = 100


def _write_pages(items: DataFrame, folder: str, total: int) -> None:
    """(c_custkey, item) as the JSON pages of an app list, which are told apart by their offsets."""
    pages = items.groupBy((F.floor(F.col("c_custkey") / PAGE) * PAGE).alias("offset")).agg(F.collect_list("item").alias("data"))
    body = F.to_json(F.struct("data", F.struct(F.lit(total).alias("total_items")).alias("meta")))
    pages.select("offset", body.alias("value")).write.partitionBy("offset").text(folder)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS platform, n_name AS currency, 'UTC' AS time_zone FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE lower(c_mktsegment) IN ('building', 'machinery') AND c_custkey <> 5""")
def app_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account's apps from pages of JSON."""
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("currency"))
    known = read(spark, sf_dir, "customer").join(nation, "c_nationkey")
    attributes = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("platform"), "currency", F.lit("UTC").alias("time_zone"))
    item = F.struct(F.col("c_custkey").cast("string").alias("id"), attributes.alias("attributes"))
    folder = _folder(spark)
    _write_pages(known.select("c_custkey", item.alias("item")), folder, known.count())
    return landing.pick_apps(landing.read_app_pages(spark, folder), ["Building", "MACHINERY"], exclude=["5"])


EXTRACTS = [
    ("click", None, None, None, True, date(2024, 1, 1), 5, 2),
    ("signup", ["Building", "MACHINERY"], None, ["3"], None, None, 3, 4),
    ("purchase", [], ["1", "2", "3", "4", "99"], ["4", "1"], True, date(2023, 12, 28), 8, 3),
    ("error", None, None, None, False, date(2024, 1, 1), 5, 2),
]
_EXTRACTS_SQL = "VALUES ('click', CAST(NULL AS VARCHAR[]), CAST(NULL AS VARCHAR[]), ['1'], DATE '2024-01-01', 5, 2), ('signup', ['building', 'machinery'], NULL, ['1', '3'], DATE '2023-12-01', 3, 4), ('purchase', NULL, ['1', '2', '3', '4', '99'], ['1', '4'], DATE '2023-12-28', 8, 3)"


@query(f"""WITH {P_SQL}, x(name, platforms, apps, barred, start, lookback, d) AS ({_EXTRACTS_SQL}),
a AS (SELECT CAST(c_custkey AS VARCHAR) AS id, lower(c_mktsegment) AS platform, coalesce(n_name, '') AS currency FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) n ON c_nationkey = n_nationkey),
y AS (SELECT x.*, a.id, a.currency, p.watermark AS m FROM x JOIN a ON (platforms IS NULL OR list_contains(platforms, platform)) AND (apps IS NULL OR list_contains(apps, id)) AND NOT list_contains(barred, id) LEFT JOIN p ON p.extract = x.name AND p.app_id = a.id),
w AS (SELECT *, greatest(start, CASE WHEN m IS NULL THEN start ELSE least(DATE '2024-01-31' - lookback, m - (lookback - 1)) END) AS f FROM y),
k AS (SELECT *, unnest(range((datediff('day', DATE '1970-01-01', f) + 719163) // d, (datediff('day', DATE '1970-01-01', DATE '2024-01-31') + 719163) // d + 1)) AS wave FROM w)
SELECT name, currency, CAST(wave AS INTEGER) AS wave, count(*) AS jobs, min(greatest(f, CAST(DATE '1970-01-01' + CAST(wave * d - 719163 AS INTEGER) AS DATE))) AS from_date,
  max(least(DATE '2024-01-31', CAST(DATE '1970-01-01' + CAST(wave * d + d - 1 - 719163 AS INTEGER) AS DATE))) AS to_date FROM k GROUP BY ALL""")
def planned_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts x apps x chunks, with the app's currency."""
    nation = read(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("currency"))
    apps = read(spark, sf_dir, "customer").join(nation, "c_nationkey", "left").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("platform"), "currency")
    extracts = spark.createDataFrame(EXTRACTS, "name string, platforms array<string>, apps array<string>, exclude_apps array<string>, enabled boolean, start date, lookback int, chunk_days int")
    jobs = windows.plan_jobs(extracts, apps, _loads(spark, sf_dir), TODAY, default_exclude=["1"])
    return jobs.groupBy("name", "currency", "wave").agg(F.count("*").alias("jobs"), F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date"))


@query("""WITH x AS (SELECT p_type AS t, p_partkey AS k, p_brand, p_size, regexp_replace(lower(p_brand), '[^a-z0-9]', '', 'g') AS s FROM part)
SELECT a.t AS "table", a.k AS base, b.k AS other, b.p_brand AS media_source FROM x a JOIN x b ON a.t = b.t AND a.p_size = 1 AND b.p_size <> 1
WHERE NOT (starts_with(a.s, b.s) OR starts_with(b.s, a.s) OR starts_with(b.s, 'brand1') OR starts_with('brand1', b.s))""")
def double_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as extracts, their type as table; size 1 pulls all sources but its own brand and brands of 1."""
    all_ = F.col("p_size") == 1
    extracts = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"), F.col("p_type").alias("table"), F.when(~all_, F.col("p_brand")).alias("media_source"), F.when(all_, F.array("p_brand", F.lit("BRAND 1"), F.lit("-"))).alias("exclude_media_sources"))
    return checks.double_owners(extracts)


#: Apps that users stand for, and days of the month at which reports begin.
APPS = 8


def _land(reports: DataFrame, root: str) -> None:
    """Writes rows with the five columns of a report and cells ``d`` (day), ``u`` (user), ``n``, ``v`` as landed CSV files."""
    cells = reports.select(*scan.LEVELS, F.col("d").cast("string").alias("Date"), F.concat(F.lit("user"), "u").alias("Media Source (pid)"), F.lit("x\ny").alias("My\nMetric"), F.format_number("n", 0).alias("Impressions"), F.concat(F.lit("$"), F.col("v").cast("string")).alias("Total Cost"))
    cells.repartition(*scan.LEVELS).write.partitionBy(*scan.LEVELS).option("header", True).csv(root)


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events by type, app, day and user: counts and amounts."""
    rows = _events(spark, sf_dir).select(F.col("_extract").alias("extract"), F.concat(F.lit("app"), F.col("app_id").cast("long") % APPS).alias("app_id"), F.lit("daily").alias("report_type"), F.col("date").alias("d"), F.col("app_id").alias("u"), money("value").alias("v"))
    return rows.groupBy("extract", "app_id", "report_type", "d", "u").agg(F.count("*").alias("n"), F.sum("v").alias("v"))


A_SQL = E_SQL + f""",
y AS (SELECT _extract AS extract, 'app' || CAST(app_id AS BIGINT) % {APPS} AS app_id, date AS d, app_id AS u, count(*) AS n, sum(CAST(value AS DECIMAL(18,2))) AS v FROM e GROUP BY ALL)"""


@query(f"""WITH {A_SQL}, t AS (SELECT *, CASE WHEN day(d) <= 10 THEN 0 WHEN day(d) <= 20 THEN 1 ELSE 2 END AS k FROM y)
SELECT extract, app_id, count(DISTINCT k) AS files, count(*) AS n, CAST(sum(n) AS BIGINT) AS impressions, CAST(sum(v) AS DOUBLE) AS cost, min(d) AS first_day, max(d) AS last_day
FROM t WHERE extract IN ('click', 'purchase') AND app_id <> 'app3' AND k >= 1 GROUP BY ALL""")
def report_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports of a type, app and third of the month, scanned with filters that only some of the files pass."""
    root, k = _folder(spark), F.when(F.dayofmonth("d") <= 10, 0).when(F.dayofmonth("d") <= 20, 1).otherwise(2)
    first, last = (F.array(*[F.lit(date(2024, 1, days[i])) for days in THIRDS])[k] for i in (0, 1))
    _land(_daily(spark, sf_dir).withColumns({"from_date": first, "to_date": last}), root)
    found = scan.landed_reports(spark, root).where("extract IN ('click', 'purchase') AND app_id <> 'app3' AND to_date >= DATE'2024-01-11'")
    context = Context(F.col("app_id"), F.col("report_type"), "standard", False, F.col("extract"), "run", datetime(2024, 2, 1))
    rows = parse_scan(found, context, F.lit("USD"), carry=["path"])
    return rows.groupBy(F.col("_extract").alias("extract"), "app_id").agg(F.count_distinct("path").alias("files"), F.count("*").alias("n"), F.sum("impressions").alias("impressions"), F.sum(money("total_cost")).cast("double").alias("cost"), F.min("date").alias("first_day"), F.max("date").alias("last_day"))


#: Extracts of a plan with unequal chunk lengths; the views are pulled by nobody.
PLAN = [("click", 10), ("purchase", 5), ("signup", 20), ("error", 5)]
_PLAN_SQL = "VALUES " + ", ".join(f"('{n}', {d})" for n, d in PLAN)
#: The report that has not landed: of signups, app 2, the chunk of this day.
GAP = ("purchase", "app2", date(2024, 1, 12))
_ORD = "(datediff('day', DATE '1970-01-01', {}) + 719163)"
K_SQL = f"""x(extract, c) AS ({_PLAN_SQL}), a AS (SELECT 'app' || i AS app_id, i FROM range({APPS}) r(i)),
k AS (SELECT extract, c, app_id, i, unnest(range({_ORD.format("DATE '2024-01-01'")} // c, {_ORD.format("DATE '2024-01-31'")} // c + 1)) AS w FROM x, a),
j AS (SELECT extract, c, app_id, i, (w * c + c - 1) // 20 AS wave, greatest(DATE '2024-01-01', CAST(DATE '1970-01-01' + CAST(w * c - 719163 AS INTEGER) AS DATE)) AS from_date,
  least(DATE '2024-01-31', CAST(DATE '1970-01-01' + CAST(w * c + c - 1 - 719163 AS INTEGER) AS DATE)) AS to_date FROM k)"""


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts x apps of the events x chunks, nothing loaded so far."""
    apps = _daily(spark, sf_dir).select(F.col("app_id").alias("id")).distinct().select("id", F.lit("web").alias("platform"), F.concat(F.lit("C"), F.substring("id", 4, 1)).alias("currency"))
    none = "CAST(NULL AS ARRAY<STRING>)"
    extracts = spark.createDataFrame([(n, START, 3, d) for n, d in PLAN], "name string, start date, lookback int, chunk_days int").selectExpr("*", f"{none} AS platforms", f"{none} AS apps", f"{none} AS exclude_apps", "true AS enabled")
    return windows.plan_jobs(extracts, apps, spark.createDataFrame([], LEDGER), TODAY)


def _by_day(rows: DataFrame) -> DataFrame:
    """A row a pair and day: a pair has many jobs, each of which meets all of these."""
    return rows.groupBy(F.col("_extract").alias("extract"), "app_id", "date").agg(F.sum("impressions").alias("impressions"), F.max("currency").alias("c"))


@query(f"""WITH {A_SQL}, {K_SQL}, l AS (SELECT DISTINCT extract, app_id, d FROM y),
s AS (SELECT j.*, CASE WHEN (extract, app_id) = ('{GAP[0]}', '{GAP[1]}') AND DATE '{GAP[2]}' BETWEEN from_date AND to_date THEN 'missing'
  WHEN EXISTS (SELECT 1 FROM l WHERE l.extract = j.extract AND l.app_id = j.app_id AND d BETWEEN from_date AND to_date) THEN 'landed' ELSE 'missing' END AS state FROM j WHERE app_id IN (SELECT app_id FROM y)),
h AS (SELECT *, min(CASE WHEN state = 'missing' THEN from_date END) OVER (PARTITION BY extract, app_id) AS hole FROM s),
o AS (SELECT *, CASE WHEN state = 'missing' AND NOT coalesce(EXISTS (SELECT 1 FROM h b WHERE b.extract = h.extract AND b.app_id = h.app_id AND b.state = 'missing' AND b.wave < h.wave), false) THEN 'failed'
  WHEN state = 'landed' AND (hole IS NULL OR from_date < hole) THEN 'success' ELSE 'skipped' END AS status FROM h)
SELECT o.extract, o.app_id, o.from_date, o.to_date, state, status, CASE WHEN status = 'success' THEN count(d) ELSE 0 END AS rows, CASE WHEN status = 'success' THEN CAST(coalesce(sum(n), 0) AS BIGINT) ELSE 0 END AS impressions,
  CASE WHEN status = 'success' THEN 'C' || i END AS currency FROM o LEFT JOIN y ON y.extract = o.extract AND y.app_id = o.app_id AND d BETWEEN from_date AND to_date GROUP BY o.extract, o.app_id, o.from_date, o.to_date, state, status, i
UNION ALL SELECT 'view', app_id, DATE '2024-01-01', DATE '2024-01-31', 'unasked', NULL, NULL, 0, NULL FROM y WHERE extract = 'view' GROUP BY app_id""")
def carried_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From plan to destination: planned jobs met with landed files, loaded in waves; a missing report holds its pair back."""
    root, plan = _folder(spark), _plan(spark, sf_dir)
    jobs = plan.select(F.col("name").alias("extract"), "app_id", "from_date", "to_date")
    daily = _daily(spark, sf_dir)
    there = daily.join(jobs, ["extract", "app_id"]).where(F.col("d").between(F.col("from_date"), F.col("to_date")))
    there = there.where(~((F.col("extract") == GAP[0]) & (F.col("app_id") == GAP[1]) & F.lit(GAP[2]).between(F.col("from_date"), F.col("to_date"))))
    views = daily.where("extract = 'view'").withColumns({"from_date": F.lit(START), "to_date": F.lit(TODAY)})
    _land(there.unionByName(views), f"{root}/landing")
    table = Destination(spark, f"carried_{uuid.uuid4().hex}", f"{root}/table")
    told = carry_out(spark, plan, f"{root}/landing", table, f"{root}/ledger", "run", datetime(2024, 2, 1), unasked=True)
    rows = _by_day(_kept(spark, table, "_extract", "app_id", "date", "impressions", "currency"))
    met = told.join(rows, ["extract", "app_id"], "left").groupBy("extract", "app_id", "from_date", "to_date", "state", "status", "rows")
    mine = F.col("date").between(F.col("from_date"), F.col("to_date"))
    return met.agg(F.coalesce(F.sum(F.when(mine, F.col("impressions"))), F.lit(0)).alias("impressions"), F.max(F.when(mine, F.col("c"))).alias("currency"))


@query(f"""WITH {K_SQL.replace(f"range({APPS})", "range(1)")}, b AS (SELECT k AS wave, k * 20 AS a, k * 20 + 19 AS b FROM range({_ORD.format("DATE '2024-01-01'")} // 20 - 1, {_ORD.format("DATE '2024-01-31'")} // 20 + 3) r(k)),
m AS (SELECT b.wave, j.extract, j.from_date, j.to_date FROM (SELECT *, {_ORD.format("from_date")} // c * c + c - 1 AS e FROM j) j JOIN b ON j.e BETWEEN b.a AND b.b)
SELECT CAST(wave AS INTEGER) AS wave, count(*) AS jobs, min(from_date) AS from_date, max(to_date) AS to_date, (SELECT count(*) FROM m x JOIN m z ON x.wave < z.wave AND x.from_date > z.to_date) AS inversions FROM m GROUP BY wave""")
def date_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waves of chunks of 5, 10 and 20 days, ordered by date: how many jobs run before one that lies wholly before them."""
    jobs = windows.aligned_waves(_plan(spark, sf_dir).where("app_id = 'app0'").select("name", "chunk_days", "from_date", "to_date"))
    waves = jobs.groupBy("wave").agg(F.count("*").alias("jobs"), F.min("from_date").alias("from_date"), F.max("to_date").alias("to_date"), F.max("from_date").alias("_last"))
    # The last day at which a job of an earlier wave begins; the window is over waves.
    before = waves.select("wave", F.max("_last").over(W.orderBy("wave").rowsBetween(W.unboundedPreceding, -1)).alias("_before"))
    wrong = jobs.join(before, "wave").where("_before > to_date").count()
    return waves.drop("_last").withColumn("inversions", F.lit(wrong).cast("long"))


@query(f"""WITH p AS (SELECT c_custkey // {PAGE} * {PAGE} AS "from", count(*) AS n FROM customer GROUP BY 1)
SELECT 'hole' AS kind, "from", "from" + {PAGE} AS "to" FROM p WHERE ("from" // {PAGE}) % 4 = 1 AND n = {PAGE} UNION ALL SELECT 'hole', "from", "from" + n FROM p WHERE ("from" // {PAGE}) % 4 = 1 AND n < {PAGE}""")
def page_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where an app list's pages do not follow each other: every fourth page has not landed, and one came twice."""
    known, folder = read(spark, sf_dir, "customer"), _folder(spark)
    items = known.select("c_custkey", F.struct(F.col("c_custkey").cast("string").alias("id")).alias("item"))
    _write_pages(items.where(F.floor(F.col("c_custkey") / PAGE) % 4 != 1), folder, known.count())
    _write_pages(items.where(F.col("c_custkey") < PAGE), f"{folder}/again", known.count())
    return landing.page_faults(landing.app_pages(spark, folder)).select("kind", F.col("from").cast("long").alias("from"), F.col("to").cast("long").alias("to"))


@query(f"""WITH {E_SQL}, r AS (SELECT date, _extract, app_id, value FROM e WHERE date < DATE '2024-01-15' UNION ALL SELECT date, _extract, app_id, value * 2 FROM e WHERE date >= DATE '2024-01-15')
SELECT date, _extract, app_id, CAST(strftime(date, '%Y%m') AS INTEGER) AS pid, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM r GROUP BY ALL""")
def stream_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that land twice as a stream, stopped and restarted from its checkpoint, its last batch replayed: the last pull of a day holds, once."""
    root, rows = _folder(spark), _events(spark, sf_dir).select(*KEYS, "event_id", "value")
    schema = rows.schema
    table = Destination(spark, f"stream_{uuid.uuid4().hex}", f"{root}/table", schema=schema, sort=("app_id", "date"))
    table.ensure()

    def land(part: DataFrame) -> None:
        part.write.mode("append").parquet(f"{root}/landing")

    def run() -> None:
        incremental.rebuild_from_stream(incremental.landed(spark, f"{root}/landing", schema), table, f"{root}/checkpoint").awaitTermination()

    land(rows.where("date <= DATE'2024-01-20'"))
    run()
    land(rows.where("date >= DATE'2024-01-15'").withColumn("value", F.col("value") * 2))
    run()
    incremental.forget_last_commit(spark, f"{root}/checkpoint")
    run()
    out = _kept(spark, table)
    return out.groupBy(*KEYS, "pid").agg(F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("amount"))


@query(f"WITH {G_SQL} SELECT extract, app_id, status, count(*) AS n, CAST(sum(api_calls) AS BIGINT) AS calls, max(to_date) AS last FROM g GROUP BY ALL")
def ledger_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger of many small files merged into one, with rows added before, between and after two merges and a sweep."""
    path, rows = f"{_folder(spark)}/ledger", _loads(spark, sf_dir)
    schema = rows.schema
    parts = [rows.where(F.dayofmonth("to_date") % 3 == k) for k in range(3)]
    parts[0].repartition(40).write.parquet(path)
    ledger.compact(spark, path, schema)
    parts[1].repartition(40).write.mode("append").parquet(path)
    ledger.compact(spark, path, schema)
    ledger.sweep(spark, path)
    parts[2].write.mode("append").parquet(path)
    return ledger.read_loads(spark, path, schema).groupBy("extract", "app_id", "status").agg(F.count("*").alias("n"), F.sum("api_calls").cast("long").alias("calls"), F.max("to_date").alias("last"))


@query(f"""WITH {J_SQL}, u AS (SELECT app_id, CAST(sum(api_calls) AS BIGINT) AS calls FROM g WHERE is_long = 1 AND status <> 'running' AND started_at >= TIMESTAMP '2024-01-15' GROUP BY ROLLUP (app_id)),
n AS (SELECT app_id, count(*) AS n, grouping(app_id) AS a FROM j WHERE to_date - from_date + 1 >= 3 GROUP BY ROLLUP (app_id))
SELECT n.app_id, n + coalesce(calls, 0) AS calls, CASE WHEN a = 1 THEN 115 ELSE 19 END AS budget, n + coalesce(calls, 0) > CASE WHEN a = 1 THEN 115 ELSE 19 END AS exceeds FROM n LEFT JOIN u ON n.app_id IS NOT DISTINCT FROM u.app_id""")
def plan_budgets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long calls of a plan and of the ledger against the budgets of each app and of the account."""
    used = ledger.long_calls(_loads(spark, sf_dir), F.lit(datetime(2024, 1, 15)).cast("timestamp_ntz"))
    return windows.budget_flags(_jobs(spark, sf_dir), used, 24, 120, reserve=5)


_GONE = "strftime(date, '%m') IN ('02', '07')"


@query(f"""WITH {L_SQL}, m AS (SELECT pid, count(*) AS n, count(*) FILTER (_extract = 'R') AS returned, CAST(sum(quantity) AS DOUBLE) AS quantity FROM l WHERE NOT ({_GONE}) AND NOT (_extract = 'N' AND pid % 100 = 12) GROUP BY pid)
SELECT pid, n, returned, quantity, true AS there FROM m UNION ALL SELECT DISTINCT pid, 0, 0, NULL, false FROM l WHERE pid NOT IN (SELECT pid FROM m)""")
def store_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table in a database of its own: filled, keys of December emptied, partitions dropped, then counted."""
    rows = _lines(spark, sf_dir).select("date", "_extract", F.col("app_id").cast("string").alias("app_id"), "quantity")
    name = f"d{uuid.uuid4().hex}"
    table = Destination(spark, f"{name}.lines", f"{_folder(spark)}/table", schema=rows.schema, sort=("app_id", "date"))
    table.ensure()
    table.ensure()  # checks its columns and granularity
    table.rebuild(rows.select(*KEYS).distinct(), rows)
    every = sorted(table.partitions())
    table.rebuild(rows.where("_extract = 'N' AND month(date) = 12").select(*KEYS).distinct(), rows.where("false"))
    table.rebuild(rows.where("false").select(*KEYS), rows.where("false"))  # nothing covered: nothing changes
    for pid in every:
        if pid % 100 in (2, 7):
            table.drop_partition(pid)
    there, left = table.partitions(), table.count()
    out = _kept(spark, table)
    spark.sql(f"DROP DATABASE {name}")
    sums = out.groupBy("pid").agg(F.count("*").alias("n"), F.count_if(F.col("_extract") == "R").alias("returned"), F.sum("quantity").cast("double").alias("quantity"))
    found = sums.collect()  # a row a partition; what is stored is read once, for them and for the check
    if (stored := sum(r["n"] for r in found)) != left:
        raise RuntimeError(f"{left} rows counted, {stored} stored")
    pids = spark.createDataFrame([(p, p in there) for p in every], "pid int, there boolean")
    sums = spark.createDataFrame(found, sums.schema)
    return pids.join(sums, "pid", "left").select("pid", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("returned", F.lit(0)).alias("returned"), "quantity", "there")


#: Days whose rows come with an unreadable date.
_BAD = (9, 17)


@query(f"""WITH {A_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY extract, app_id ORDER BY d, u) + 1 AS line, day(d) IN {_BAD} AS bad FROM y)
SELECT extract, app_id, CASE WHEN count(*) FILTER (bad) > 0 THEN 'failed' ELSE 'success' END AS status, CASE WHEN count(*) FILTER (bad) > 0 THEN 0 ELSE count(*) END AS rows,
  CASE WHEN count(*) FILTER (bad) > 0 THEN substr('row ' || min(line) FILTER (bad) || ': ' || chr(39) || strftime(arg_min(d, line) FILTER (bad), '%d') || repeat('?', 400), 1, 300) END AS error
FROM r GROUP BY ALL""")
def bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports with unreadable dates: the ledger names the first of their rows, in at most 300 characters."""
    root = _folder(spark)
    bad = F.dayofmonth("d").isin(*_BAD)
    day = F.when(bad, F.concat(F.date_format("d", "dd"), F.lit("?" * 400))).otherwise(F.col("d").cast("string"))
    rows = _daily(spark, sf_dir).withColumns({"from_date": F.lit(START), "to_date": F.lit(TODAY)})
    cells = rows.select(*scan.LEVELS, day.alias("Date"), F.concat(F.lit("user"), "u").alias("Media Source (pid)"), F.col("n").cast("string").alias("Impressions"), "d", "u")
    cells = cells.repartition(*scan.LEVELS).sortWithinPartitions(*scan.LEVELS, "d", "u").drop("d", "u")
    cells.write.partitionBy(*scan.LEVELS).option("header", True).csv(f"{root}/landing")
    jobs = [Landed(r["path"], r["extract"], r["app_id"], r["report_type"], r["from_date"], r["to_date"]) for r in scan.landed_files(spark, f"{root}/landing").collect()]
    table = Destination(spark, f"bad_{uuid.uuid4().hex}", f"{root}/table")
    load_waves(spark, [jobs], table, f"{root}/ledger", "run", datetime(2024, 2, 1))
    spark.sql(f"DROP TABLE {table.name}")
    return ledger.read_loads(spark, f"{root}/ledger").where("status <> 'running'").select("extract", "app_id", "status", "rows", "error")


@query("SELECT p_partkey AS name, p_size AS chunk_days FROM part WHERE p_size >= 3")
def long_chunk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as extracts, their size as the length of chunks: those whose calls are long."""
    return checks.long_chunks(read(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"), F.col("p_size").alias("chunk_days")), 3)


@query(f"""WITH {G_SQL}, t AS (SELECT extract, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, CAST(sum(api_calls) AS BIGINT) AS api_calls, min(to_date) AS from_date FROM g WHERE status <> 'running' GROUP BY ROLLUP (extract))
SELECT coalesce(extract, '') AS extract, success, failed, api_calls, CAST(from_date AS VARCHAR) AS from_date, (SELECT count(*) = 0 FROM g WHERE status = 'failed') AS ok, (SELECT least(10, count(*)) FROM g WHERE status = 'failed') AS failures FROM t""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run's summary as JSON, and read back."""
    loads = _loads(spark, sf_dir).withColumns({"run_id": F.lit("run"), "rows": F.col("event_id"), "from_date": F.col("to_date"), "error": F.lit("no answer")})
    doc = summary.to_json(loads, "run")
    each = "struct<extract:string,success:bigint,failed:bigint,api_calls:bigint,from_date:string>"
    told = spark.createDataFrame([(doc,)], "j string").select(F.from_json("j", f"ok boolean, total {each}, extracts array<{each}>, failures array<struct<extract:string>>").alias("d")).select("d.*")
    rows = told.select("ok", F.size("failures").cast("long").alias("failures"), F.explode(F.concat("extracts", F.array("total"))).alias("r"))
    return rows.select(F.coalesce("r.extract", F.lit("")).alias("extract"), "r.success", "r.failed", "r.api_calls", "r.from_date", "ok", "failures")


@query("""WITH u AS (SELECT event_type, list_sort(list(DISTINCT user_id)) AS us FROM events GROUP BY event_type)
SELECT event_type AS lock_key, 'user' || us[2] AS run_id, 60 AS age_seconds, false AS stale FROM u WHERE event_type < 'purchase'
UNION ALL SELECT event_type, 'user' || us[-1], 3660, true FROM u WHERE event_type > 'purchase'""")
def lock_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locks of the event types as their users take them: refused, given back, taken over and forced; then listed."""
    root, now = f"{_folder(spark)}/locks", datetime(2024, 2, 1)
    users = read(spark, sf_dir, "events").groupBy("event_type").agg(F.min("user_id").alias("a"), F.max("user_id").alias("z"))
    second = read(spark, sf_dir, "events").join(users, "event_type").where("user_id > a").groupBy("event_type", "a", "z").agg(F.min("user_id").alias("b"))
    for r in second.collect():  # one row an event type
        a, b, z = (ledger.Locks(spark, root, f"user{r[c]}", "query") for c in "abz")
        key, hour = r["event_type"], timedelta(hours=1)
        if not a.acquire(key, now - 2 * hour, 600) or b.acquire(key, now - 2 * hour, 600) or b.release(key, now - 2 * hour):
            raise RuntimeError(f"{key}: a lock that is held was given away")
        if key < "purchase":
            b.acquire(key, now - timedelta(minutes=1), 600)  # the holder's own time is over
        elif key > "purchase":
            z.acquire(key, now - timedelta(seconds=3660), 600, force=True)
        else:
            a.release(key, now - hour)
    return ledger.Locks(spark, root, "reader", "query").active(now).select("lock_key", "run_id", F.col("age_seconds").cast("int").alias("age_seconds"), "stale")
