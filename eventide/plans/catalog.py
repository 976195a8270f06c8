"""Query registry: every reference job bound to the test tables.

Each entry is ``f(spark, sf_dir) -> DataFrame``.  ``ORACLE`` holds, per
query, an independent DuckDB formulation over the same parquet tables, used
as the correctness gate.  Column names and types match between the two.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.time import epoch_micros, floor_div, from_micros, ts_text
from eventide.operators.distinct import sliding_distinct, window_distinct
from eventide.operators.ratelimit import BLACKLIST_MSG, rate_limit
from eventide.operators.report import ranked_report, region_report
from eventide.operators.reconcile import reconcile, reconcile_one_to_one, window_join
from eventide.operators.sequence import failure_bursts, followed_by, repeat_match
from eventide.operators.topn import top_n
from eventide.operators.windows import tumbling_count, window_count
from eventide.plans import bindings as B
from eventide.streaming import jobs as SJ
from eventide.streaming.bloom import distinct_bloom_stream
from eventide.streaming.upsert import UpsertTable
from eventide.session import scratch_path
from eventide.sources.files import WEBLOG_TIME_FORMAT, parse_delimited, parse_weblog, read_lines
from eventide.streaming.sinks import side_output_writer

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


# --------------------------------------------------------------------------
# J1 hot items: page views per item, 1 h window sliding 5 min, top 3.

HOT_ITEMS_SQL = """
WITH v AS (
  SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         epoch_us(ts) // 300000000 AS pane
  FROM events WHERE event_type = 'view'),
w AS (SELECT item_id, pane - j AS s FROM v, range(12) t(j)),
c AS (SELECT item_id, s, count(*) AS views FROM w GROUP BY item_id, s),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY views DESC, item_id) AS rk FROM c)
SELECT make_timestamp(s * 300000000) AS window_start,
       make_timestamp(s * 300000000 + 3600000000) AS window_end,
       CAST(rk AS INTEGER) AS rank, item_id, views
FROM r WHERE rk <= 3
"""


@register("hot_items_topn", HOT_ITEMS_SQL)
def hot_items_topn(spark: SparkSession, sf_dir: str, n: int = 3) -> DataFrame:
    ev = B.behavior_events(spark, sf_dir).filter(F.col("behavior") == "view")
    counts = window_count(ev, "item_id", "ts", "1 hour", "5 minutes", name="views")
    return top_n(counts, "item_id", n, count_col="views").select(
        "window_start", "window_end", "rank", "item_id", "views")


def _sliding_sql(base: str, keys: list[str], slide_us: int, n: int, name: str,
                 where: str = "") -> str:
    """DuckDB: expand every row of ``base`` (needs ``us``) into its n windows."""
    k = ", ".join(keys)
    kc = (k + ", ") if keys else ""
    return f"""
b AS ({base}),
x AS (SELECT {kc}us // {slide_us} - j AS s FROM b, range({n}) t(j) {where}),
c AS (SELECT {kc}s, count(*) AS {name} FROM x GROUP BY {kc}s)"""


def _bounds_sql(slide_us: int, size_us: int) -> str:
    return (f"make_timestamp(s * {slide_us}) AS window_start, "
            f"make_timestamp(s * {slide_us} + {size_us}) AS window_end")


H = 3_600_000_000
MIN5 = 300_000_000
MIN10 = 600_000_000
SEC5 = 5_000_000
SEC10 = 10_000_000

# --------------------------------------------------------------------------
# J2 hot URLs: 10 min window sliding 5 s, top 5; one URL substring dropped.

URL_EXCLUDE = "/signup/"

HOT_URLS_SQL = f"""
WITH {_sliding_sql(
    "SELECT '/' || event_type || '/' || json_extract_string(props, '$.k') AS url, "
    "epoch_us(ts) AS us FROM events", ["url"], SEC5, 120, "views",
    f"WHERE NOT contains(url, '{URL_EXCLUDE}')")},
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY views DESC, url) AS rk FROM c)
SELECT {_bounds_sql(SEC5, MIN10)}, CAST(rk AS INTEGER) AS rank, url, views
FROM r WHERE rk <= 5
"""


@register("hot_urls_topn", HOT_URLS_SQL)
def hot_urls_topn(spark: SparkSession, sf_dir: str, n: int = 5) -> DataFrame:
    logs = B.weblog_events(spark, sf_dir).filter(~F.col("url").contains(URL_EXCLUDE))
    counts = window_count(logs, "url", "ts", "10 minutes", "5 seconds", name="views")
    return top_n(counts, "url", n, count_col="views").select(
        "window_start", "window_end", "rank", "url", "views")


# --------------------------------------------------------------------------
# J3 page views per tumbling hour.

PAGE_VIEWS_SQL = f"""
WITH c AS (SELECT epoch_us(ts) // {H} AS s, count(*) AS pv
           FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT {_bounds_sql(H, H)}, pv FROM c
"""


@register("page_views_hourly", PAGE_VIEWS_SQL)
def page_views_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = B.behavior_events(spark, sf_dir).filter(F.col("behavior") == "view")
    return tumbling_count(ev, [], "ts", "1 hour", name="pv")


# --------------------------------------------------------------------------
# J4 / J5 unique visitors per tumbling hour.

def _uv_sql(expr: str) -> str:
    return f"""
WITH c AS (SELECT epoch_us(ts) // {H} AS s, count(DISTINCT {expr}) AS uv
           FROM events WHERE event_type = 'view' GROUP BY 1)
SELECT {_bounds_sql(H, H)}, uv FROM c
"""


POLY_HASH_SQL = ("list_reduce(str_split(CAST(user_id AS VARCHAR), ''), "
                 "lambda acc, ch: (acc * 97 + ascii(ch)) & 536870911, CAST(0 AS BIGINT))")


def _uv(spark, sf_dir, method):
    ev = B.behavior_events(spark, sf_dir).filter(F.col("behavior") == "view")
    return window_distinct(ev, "user_id", "ts", "1 hour", method=method, name="uv")


@register("unique_visitors_hourly", _uv_sql("user_id"))
def unique_visitors_hourly(spark, sf_dir):
    return _uv(spark, sf_dir, "exact")


@register("unique_visitors_bitmap", _uv_sql(POLY_HASH_SQL))
def unique_visitors_bitmap(spark, sf_dir):
    return _uv(spark, sf_dir, "onehash")


@register("unique_visitors_bitmap_exact", _uv_sql("user_id"))
def unique_visitors_bitmap_exact(spark, sf_dir):
    return _uv(spark, sf_dir, "bitmap")


# The HLL sketch (lg_k 12) stays in its exact list mode for the few dozen
# users per hour of the test tables, so the exact count is its oracle there;
# at large cardinalities it is an estimate.
@register("unique_visitors_hll", _uv_sql("user_id"))
def unique_visitors_hll(spark, sf_dir):
    return _uv(spark, sf_dir, "hll")


# Visitors of the last hour, every 5 minutes, from parts per pane.
M5 = 300_000_000
SLIDING_UV_SQL = f"""
WITH w AS (SELECT DISTINCT user_id, epoch_us(ts) // {M5} - j AS s
           FROM events, range({H // M5}) t(j) WHERE event_type = 'view'),
c AS (SELECT s, count(user_id) AS uv FROM w GROUP BY s)
SELECT {_bounds_sql(M5, H)}, uv FROM c
"""


def _sliding_uv(spark, sf_dir, method):
    ev = B.behavior_events(spark, sf_dir).filter(F.col("behavior") == "view")
    return sliding_distinct(ev, "user_id", "ts", "1 hour", "5 minutes", method=method)


@register("unique_visitors_sliding", SLIDING_UV_SQL)
def unique_visitors_sliding(spark, sf_dir):
    return _sliding_uv(spark, sf_dir, "bitmap")


# As for unique_visitors_hll: exact at the test tables' counts, an estimate at large ones.
@register("unique_visitors_sliding_hll", SLIDING_UV_SQL)
def unique_visitors_sliding_hll(spark, sf_dir):
    return _sliding_uv(spark, sf_dir, "hll")


# --------------------------------------------------------------------------
# J6 click cap: per (user, type, day) the first 2 events pass, the third
# raises a blacklist row; then counts per type of the passed rows, 1 h / 5 s.

CAP = 2

_RANKED_SQL = f"""
ranked AS (
  SELECT event_id AS seq, ts, user_id, json_extract_string(props, '$.k')::BIGINT AS item_id,
         event_type AS behavior, date_trunc('day', ts) AS day,
         row_number() OVER (PARTITION BY user_id, event_type, date_trunc('day', ts)
                            ORDER BY ts, event_id) AS rn
  FROM events)"""

RATE_PASS_SQL = f"""
WITH {_RANKED_SQL}
SELECT seq, ts, user_id, item_id, behavior FROM ranked WHERE rn <= {CAP}
"""

RATE_BLACKLIST_SQL = f"""
WITH {_RANKED_SQL}
SELECT user_id, behavior, day, ts, '{BLACKLIST_MSG}' AS msg FROM ranked WHERE rn = {CAP + 1}
"""


def _capped(spark, sf_dir):
    ev = B.behavior_events(spark, sf_dir)
    return rate_limit(ev, ["user_id", "behavior"], "ts", "seq", cap=CAP)


@register("rate_limit_pass", RATE_PASS_SQL)
def rate_limit_pass(spark, sf_dir):
    return _capped(spark, sf_dir)[0]


@register("rate_limit_blacklist", RATE_BLACKLIST_SQL)
def rate_limit_blacklist(spark, sf_dir):
    return _capped(spark, sf_dir)[1]


RATE_COUNTS_SQL = f"""
WITH {_RANKED_SQL},
{_sliding_sql(f"SELECT behavior, epoch_us(ts) AS us FROM ranked WHERE rn <= {CAP}",
              ["behavior"], SEC5, 720, "clicks")}
SELECT behavior, {_bounds_sql(SEC5, H)}, clicks FROM c
"""


@register("rate_limited_counts", RATE_COUNTS_SQL)
def rate_limited_counts(spark, sf_dir):
    passed = _capped(spark, sf_dir)[0]
    return window_count(passed, "behavior", "ts", "1 hour", "5 seconds", name="clicks")


# --------------------------------------------------------------------------
# J7 / J8 marketing counts, 1 h sliding 10 s; 'signup' stands for UNINSTALL.

DROPPED_BEHAVIOR = "signup"
_CHANNEL_SQL = ("list_extract(['" + "', '".join(B.CHANNELS) + "'], "
                f"(user_id % {len(B.CHANNELS)})::INTEGER + 1)")


def _text_bounds_sql(slide_us, size_us):
    return (f"strftime(make_timestamp(s * {slide_us}), '%Y-%m-%d %H:%M:%S') || '.0' AS start_text, "
            f"strftime(make_timestamp(s * {slide_us} + {size_us}), '%Y-%m-%d %H:%M:%S') || '.0' AS end_text")


CHANNEL_COUNTS_SQL = f"""
WITH {_sliding_sql(
    f"SELECT {_CHANNEL_SQL} AS channel, event_type AS behavior, epoch_us(ts) AS us "
    f"FROM events WHERE event_type <> '{DROPPED_BEHAVIOR}'",
    ["channel", "behavior"], SEC10, 360, "count")}
SELECT channel, behavior, {_bounds_sql(SEC10, H)}, {_text_bounds_sql(SEC10, H)}, "count" FROM c
"""

TOTAL_COUNTS_SQL = f"""
WITH {_sliding_sql(
    f"SELECT epoch_us(ts) AS us FROM events WHERE event_type <> '{DROPPED_BEHAVIOR}'",
    [], SEC10, 360, "count")}
SELECT '{SJ.TOTAL_LABELS[0]}' AS channel, '{SJ.TOTAL_LABELS[1]}' AS behavior, {_bounds_sql(SEC10, H)},
       {_text_bounds_sql(SEC10, H)}, "count" FROM c
"""


def _with_text_bounds(df):
    return df.withColumn("start_text", ts_text(F.col("window_start"))) \
             .withColumn("end_text", ts_text(F.col("window_end")))


@register("channel_behavior_counts", CHANNEL_COUNTS_SQL)
def channel_behavior_counts(spark, sf_dir):
    ev = B.marketing_events(spark, sf_dir).filter(
        ~F.col("behavior").eqNullSafe(DROPPED_BEHAVIOR))
    return _with_text_bounds(
        window_count(ev, ["channel", "behavior"], "ts", "1 hour", "10 seconds"))


@register("behavior_total_counts", TOTAL_COUNTS_SQL)
def behavior_total_counts(spark, sf_dir):
    ev = B.marketing_events(spark, sf_dir).filter(
        ~F.col("behavior").eqNullSafe(DROPPED_BEHAVIOR))
    counts = window_count(ev, [], "ts", "1 hour", "10 seconds")
    return _with_text_bounds(counts.select(
        F.lit(SJ.TOTAL_LABELS[0]).alias("channel"), F.lit(SJ.TOTAL_LABELS[1]).alias("behavior"), "*"))


# --------------------------------------------------------------------------
# J11 order timeout: click followed by purchase within 4 h, per user.

FUNNEL_WITHIN = "4 hours"

FUNNEL_SQL = """
WITH e AS (SELECT user_id, ts, event_id AS seq, event_type FROM events),
c AS (SELECT * FROM e WHERE event_type = 'click'),
p AS (SELECT * FROM e WHERE event_type = 'purchase'),
m AS (
  SELECT c.user_id, c.ts AS begin_ts, c.seq AS begin_seq,
         (SELECT min(p.ts) FROM p
          WHERE p.user_id = c.user_id
            AND (p.ts > c.ts OR (p.ts = c.ts AND p.seq > c.seq))) AS first_pay
  FROM c),
r AS (
  SELECT user_id, begin_ts, begin_seq,
         CASE WHEN first_pay < begin_ts + INTERVAL 4 HOUR THEN first_pay END AS follow_ts,
         CASE WHEN first_pay < begin_ts + INTERVAL 4 HOUR THEN 'success' ELSE 'timeout' END AS status
  FROM m)
SELECT * FROM r WHERE status = '{status}'
"""


def _funnel(spark, sf_dir):
    ev = B.behavior_events(spark, sf_dir)
    return followed_by(ev, "user_id", "ts", "seq", F.col("behavior") == "click",
                       F.col("behavior") == "purchase", within=FUNNEL_WITHIN)


@register("funnel_success", FUNNEL_SQL.replace("{status}", "success"))
def funnel_success(spark, sf_dir):
    return _funnel(spark, sf_dir).filter(F.col("status") == "success")


@register("funnel_timeout", FUNNEL_SQL.replace("{status}", "timeout"))
def funnel_timeout(spark, sf_dir):
    return _funnel(spark, sf_dir).filter(F.col("status") == "timeout")


# --------------------------------------------------------------------------
# J10 consecutive failures: begin(error).next(error).within(12 h).times(2, 4).

CONSECUTIVE_SQL = """
WITH e AS (
  SELECT user_id, ts, event_id AS seq, event_type,
         lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
  FROM events),
b AS (SELECT * FROM e WHERE event_type = 'error' AND next_type = 'error'),
m AS (
  SELECT b.user_id, b.ts, b.next_ts, count(*) AS later_fails
  FROM b JOIN events x
    ON x.user_id = b.user_id AND x.event_type = 'error'
   AND (x.ts > b.ts OR (x.ts = b.ts AND x.event_id > b.seq))
   AND x.ts < b.ts + INTERVAL 12 HOUR
  GROUP BY b.user_id, b.ts, b.seq, b.next_ts)
SELECT user_id, ts AS begin_ts, next_ts, CAST(k AS INTEGER) AS k
FROM m, range(2, 5) t(k) WHERE k <= later_fails
"""


@register("consecutive_failures", CONSECUTIVE_SQL)
def consecutive_failures(spark, sf_dir):
    ev = B.behavior_events(spark, sf_dir)
    return repeat_match(ev, "user_id", "ts", "seq", F.col("behavior") == "error",
                        times=(2, 4), within="12 hours")


# --------------------------------------------------------------------------
# J9 failure bursts: >= 2 errors, timer 1 h after the first, cleared by any
# other event.  Oracle: the reference's per-event state machine, folded over
# each user's events by a recursive CTE.

BURSTS_SQL = """
WITH RECURSIVE e AS (
  SELECT user_id, ts, event_type = 'error' AS f,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
st AS (
  SELECT user_id, CAST(0 AS BIGINT) AS rn, CAST(NULL AS TIMESTAMP) AS a,
         CAST(NULL AS TIMESTAMP) AS l, CAST(0 AS BIGINT) AS n,
         CAST(NULL AS TIMESTAMP) AS oa, CAST(NULL AS TIMESTAMP) AS ol, CAST(NULL AS BIGINT) AS onum
  FROM (SELECT DISTINCT user_id FROM e) u
  UNION ALL
  SELECT s.user_id, e.rn,
         CASE WHEN e.f THEN CASE WHEN s.a IS NULL OR e.ts > s.a + INTERVAL 1 HOUR
                                 THEN e.ts ELSE s.a END END,
         CASE WHEN e.f THEN e.ts END,
         CASE WHEN e.f THEN CASE WHEN s.a IS NULL OR e.ts > s.a + INTERVAL 1 HOUR
                                 THEN 1 ELSE s.n + 1 END ELSE 0 END,
         CASE WHEN s.a IS NOT NULL AND e.ts > s.a + INTERVAL 1 HOUR THEN s.a END,
         CASE WHEN s.a IS NOT NULL AND e.ts > s.a + INTERVAL 1 HOUR THEN s.l END,
         CASE WHEN s.a IS NOT NULL AND e.ts > s.a + INTERVAL 1 HOUR THEN s.n END
  FROM st s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1),
fin AS (
  SELECT user_id, a, l, n,
         row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) AS back
  FROM st)
SELECT user_id, oa AS start_ts, ol AS end_ts, onum AS fails FROM st
WHERE oa IS NOT NULL AND onum >= 2
UNION ALL
SELECT user_id, a, l, n FROM fin WHERE back = 1 AND a IS NOT NULL AND n >= 2
"""


@register("failure_bursts", BURSTS_SQL)
def failure_bursts_q(spark, sf_dir):
    ev = B.behavior_events(spark, sf_dir)
    return failure_bursts(ev, "user_id", "ts", "seq", F.col("behavior") == "error",
                          min_fails=2, span="1 hour")


# --------------------------------------------------------------------------
# J12 / J13 reconciliation: payments (orders) against receipts (first ship
# date per order).

_PR_SQL = """
WITH p AS (SELECT o_orderkey AS tx_id, o_orderdate AS pay_ts FROM orders),
r AS (SELECT l_orderkey AS tx_id, min(l_shipdate) AS receipt_ts FROM lineitem GROUP BY l_orderkey)"""

RECONCILE_SQL = _PR_SQL + """
SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.pay_ts, r.receipt_ts,
       CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
            WHEN r.tx_id IS NULL THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS status
FROM p FULL OUTER JOIN r ON p.tx_id = r.tx_id {cond}
"""

RECONCILE_TOLERANCE = "30 days"


@register("reconcile_full", RECONCILE_SQL.replace("{cond}", ""))
def reconcile_full(spark, sf_dir):
    return reconcile(B.payments(spark, sf_dir), B.receipts(spark, sf_dir),
                     "tx_id", "pay_ts", "receipt_ts")


@register("reconcile_interval", RECONCILE_SQL.replace(
    "{cond}", "AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 30 DAY AND p.pay_ts + INTERVAL 30 DAY"))
def reconcile_interval(spark, sf_dir):
    return reconcile(B.payments(spark, sf_dir), B.receipts(spark, sf_dir),
                     "tx_id", "pay_ts", "receipt_ts", tolerance=RECONCILE_TOLERANCE)


# The events of an order, one by one: a state machine over (time, side, line).
ONE_TO_ONE_SQL = """
WITH RECURSIVE e AS (
  SELECT o_orderkey AS k, o_orderdate AS ts, 0 AS side, 0 AS seq FROM orders
  UNION ALL SELECT l_orderkey, l_shipdate, 1, l_linenumber FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, side, seq) AS i FROM e),
m(k, i, p_side, p_ts, out_status, out_pay, out_receipt) AS (
  SELECT k, i, side, ts, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM n WHERE i = 1
  UNION ALL
  SELECT n.k, n.i,
    CASE WHEN m.p_side IS NOT NULL AND m.p_side <> n.side THEN NULL ELSE n.side END,
    CASE WHEN m.p_side IS NOT NULL AND m.p_side <> n.side THEN NULL ELSE n.ts END,
    CASE WHEN m.p_side IS NULL THEN NULL WHEN m.p_side <> n.side THEN 'matched'
         WHEN n.side = 0 THEN 'superseded_pay' ELSE 'superseded_receipt' END,
    CASE WHEN m.p_side = 0 THEN m.p_ts WHEN m.p_side = 1 AND n.side = 0 THEN n.ts END,
    CASE WHEN m.p_side = 1 THEN m.p_ts WHEN m.p_side = 0 AND n.side = 1 THEN n.ts END
  FROM m JOIN n ON n.k = m.k AND n.i = m.i + 1)
SELECT k AS tx_id, out_pay AS pay_ts, out_receipt AS receipt_ts, out_status AS status
FROM m WHERE out_status IS NOT NULL
UNION ALL
SELECT k, CASE WHEN p_side = 0 THEN p_ts END, CASE WHEN p_side = 1 THEN p_ts END,
       CASE WHEN p_side = 0 THEN 'unmatched_pay' ELSE 'unmatched_receipt' END
FROM m JOIN (SELECT k, max(i) AS i FROM n GROUP BY k) z USING (k, i) WHERE p_side IS NOT NULL
"""


@register("reconcile_one_to_one", ONE_TO_ONE_SQL)
def reconcile_one_to_one_q(spark, sf_dir):
    lines = B.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("receipt_ts"), F.col("l_linenumber").alias("line"))
    return reconcile_one_to_one(B.payments(spark, sf_dir), lines, "tx_id", "pay_ts", "receipt_ts",
                                right_seq="line")


D30 = 30 * 86_400_000_000

WINDOW_JOIN_SQL = _PR_SQL + f"""
SELECT p.tx_id, make_timestamp(epoch_us(p.pay_ts) // {D30} * {D30}) AS window_start,
       make_timestamp(epoch_us(p.pay_ts) // {D30} * {D30} + {D30}) AS window_end,
       p.pay_ts, r.receipt_ts
FROM p JOIN r ON p.tx_id = r.tx_id
 AND epoch_us(p.pay_ts) // {D30} = epoch_us(r.receipt_ts) // {D30}
"""


@register("reconcile_window_inner", WINDOW_JOIN_SQL)
def reconcile_window_inner(spark, sf_dir):
    return window_join(B.payments(spark, sf_dir), B.receipts(spark, sf_dir),
                       "tx_id", "pay_ts", "receipt_ts", "30 days")


# --------------------------------------------------------------------------
# P13 / P12 text reports.

_TS_TEXT = "strftime({c}, '%Y-%m-%d %H:%M:%S') || '.0'"

RANKED_REPORT_SQL = f"""
SELECT window_end,
       'window end: ' || {_TS_TEXT.format(c='window_end')} || chr(10) ||
       string_agg('No' || rank || ': item=' || item_id || ' views=' || views, chr(10) ORDER BY rank)
       AS report
FROM ({HOT_ITEMS_SQL}) q GROUP BY window_end
"""


@register("ranked_report", RANKED_REPORT_SQL)
def ranked_report_q(spark, sf_dir):
    return ranked_report(hot_items_topn(spark, sf_dir), "item_id", "views",
                         key_label="item", count_label="views")


REGION_REPORT_SQL = f"""
SELECT behavior, window_end,
       {_TS_TEXT.format(c='window_end')} || ' ' || behavior || ' ' || clicks AS report
FROM ({RATE_COUNTS_SQL}) q
"""


@register("region_report", REGION_REPORT_SQL)
def region_report_q(spark, sf_dir):
    return region_report(rate_limited_counts(spark, sf_dir), "behavior", "clicks")


# --------------------------------------------------------------------------
# Lines rendered from events, parsed back.

def _behavior_lines(spark, sf_dir):
    ev = B.behavior_events(spark, sf_dir)
    sec = floor_div(epoch_micros(ev, "ts"), 1_000_000)
    # userId, itemId, categoryId, behavior, seconds -- padded to test trim
    return ev.select(F.concat(
        F.lit(" "), F.col("user_id").cast("string"), F.lit(", "),
        F.col("item_id").cast("string"), F.lit(","),
        F.pmod(F.col("item_id"), F.lit(7)).cast("string"), F.lit(" ,"),
        F.col("behavior"), F.lit(", "), sec.cast("string")).alias("value"))


BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts_seconds", T.LongType()),
])

PARSE_CSV_SQL = """
SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
       CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS INTEGER) AS category_id,
       event_type AS behavior, make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS ts
FROM events
"""


@register("parse_csv_line", PARSE_CSV_SQL)
def parse_csv_line(spark, sf_dir):
    rows = parse_delimited(_behavior_lines(spark, sf_dir), BEHAVIOR_SCHEMA, ",")
    return rows.select("user_id", "item_id", "category_id", "behavior",
                       from_micros(F.col("ts_seconds") * 1_000_000).alias("ts"))


def _weblog_lines(spark, sf_dir):
    ev = B.weblog_events(spark, sf_dir)
    ip = F.concat_ws(".", F.lit("10"), F.pmod("user_id", F.lit(256)).cast("string"),
                     F.pmod("seq", F.lit(256)).cast("string"), F.lit("1"))
    method = F.when(F.col("url").startswith("/purchase/"), "POST").otherwise("GET")
    return ev.select(F.concat_ws(
        " ", ip, F.col("user_id").cast("string"), F.lit("-"),
        F.date_format("ts", WEBLOG_TIME_FORMAT), F.lit("+0000"), method, "url").alias("value"))


PARSE_WEBLOG_SQL = """
SELECT '10.' || (user_id % 256) || '.' || (event_id % 256) || '.1' AS ip,
       CAST(user_id AS VARCHAR) AS user_id,
       date_trunc('second', ts) AS event_time,
       CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
       '/' || event_type || '/' || json_extract_string(props, '$.k') AS url
FROM events
"""


@register("parse_weblog_line", PARSE_WEBLOG_SQL)
def parse_weblog_line(spark, sf_dir):
    return parse_weblog(_weblog_lines(spark, sf_dir))


# --------------------------------------------------------------------------
# Streaming forms: events read as a file stream, availableNow, file sink.
# Oracles are the batch queries restricted to what the final watermark has
# closed (max event time, lag 0).

_MAX_VIEW = "(SELECT max(ts) FROM events WHERE event_type = 'view')"
_MAX_ALL = "(SELECT max(ts) FROM events)"


@register("stream_page_views",
          f"SELECT * FROM ({PAGE_VIEWS_SQL}) q WHERE window_end <= {_MAX_VIEW}")
def stream_page_views(spark, sf_dir):
    return SJ.run_to_files(SJ.page_views_stream(B.behavior_stream(spark, sf_dir)),
                           "page_views")


@register("stream_unique_visitors",
          f"SELECT * FROM ({_uv_sql('user_id')}) q WHERE window_end <= {_MAX_VIEW}")
def stream_unique_visitors(spark, sf_dir):
    return SJ.run_to_files(SJ.unique_visitors_stream(B.behavior_stream(spark, sf_dir)),
                           "unique_visitors")


# A5, A6 on a stream in bounded memory; at the test tables' counts no id is taken for another.
@register("stream_unique_visitors_bloom",
          f"SELECT * FROM ({_uv_sql('user_id')}) q WHERE window_end <= {_MAX_VIEW}")
def stream_unique_visitors_bloom(spark, sf_dir):
    views = B.behavior_stream(spark, sf_dir).filter(F.col("behavior") == "view")
    return SJ.run_to_files(distinct_bloom_stream(SJ.event_time(views, "ts"), "user_id", fpp=1e-6), "uv_bloom")


@register("stream_hot_items",
          f"SELECT * FROM ({HOT_ITEMS_SQL}) q WHERE window_end <= {_MAX_VIEW}")
def stream_hot_items(spark, sf_dir):
    return SJ.run_to_files(SJ.hot_items_stream(B.behavior_stream(spark, sf_dir)), "hot_items")


STREAM_RATE_SQL = f"""
WITH {_RANKED_SQL}
SELECT seq, ts, user_id, behavior,
       CASE WHEN rn <= {CAP} THEN 'pass' ELSE 'blacklist' END AS tag
FROM ranked WHERE rn <= {CAP + 1}
"""


# A row is judged once the watermark (whole milliseconds) has passed it.
STREAM_RATE_SQL = STREAM_RATE_SQL + f" AND ts <= date_trunc('millisecond', {_MAX_ALL})"


@register("stream_rate_limit", STREAM_RATE_SQL)
def stream_rate_limit(spark, sf_dir):
    return SJ.run_to_files(SJ.rate_limit_stream(B.behavior_stream(spark, sf_dir), CAP,
                                                buckets=SJ.buckets_for(spark, sf_dir, "events")), "rate_limit")


# A burst is final when its span (start + 1 h) or the event that closed it is under the final watermark.
STREAM_BURSTS_SQL = BURSTS_SQL.replace(
    "SELECT user_id, a, l, n FROM fin WHERE back = 1 AND a IS NOT NULL AND n >= 2",
    f"SELECT user_id, a, l, n FROM fin WHERE back = 1 AND a IS NOT NULL AND n >= 2 "
    f"AND a + INTERVAL 1 HOUR <= {_MAX_ALL} - INTERVAL 5 SECOND").replace(
    "WHERE oa IS NOT NULL AND onum >= 2", "WHERE oa IS NOT NULL AND onum >= 2 "
    f"AND oa + INTERVAL 1 HOUR <= {_MAX_ALL} - INTERVAL 5 SECOND")


@register("stream_failure_bursts", STREAM_BURSTS_SQL)
def stream_failure_bursts(spark, sf_dir):
    return SJ.run_to_files(
        SJ.failure_bursts_stream(B.behavior_stream(spark, sf_dir), "1 hour", 2,
                                 buckets=SJ.buckets_for(spark, sf_dir, "events")),
        "failure_bursts")


# Timeouts without any later purchase wait for their timer (begin + 4 h)
# to pass the final watermark (max time of click/purchase rows).
STREAM_FUNNEL_SQL = FUNNEL_SQL.replace(
    "SELECT * FROM r WHERE status = '{status}'",
    "SELECT r.user_id, r.begin_ts, r.begin_seq, r.follow_ts, r.status FROM r JOIN m "
    "ON r.user_id = m.user_id AND r.begin_seq = m.begin_seq "
    "WHERE m.first_pay IS NOT NULL OR r.begin_ts + INTERVAL 4 HOUR <= "
    "(SELECT max(ts) FROM events WHERE event_type IN ('click', 'purchase'))")


@register("stream_funnel", STREAM_FUNNEL_SQL)
def stream_funnel(spark, sf_dir):
    return SJ.run_to_files(SJ.funnel_stream(B.behavior_stream(spark, sf_dir), FUNNEL_WITHIN),
                           "funnel")


# Matched pairs appear at once; an unmatched row once even its latest
# possible partner (ts + tolerance) is strictly below the global watermark,
# the minimum of both inputs' max event time (lag 0).
STREAM_RECONCILE_SQL = """
WITH p AS (SELECT o_orderkey AS tx_id, o_orderdate AS pay_ts FROM orders),
r AS (SELECT l_orderkey AS tx_id, l_shipdate AS receipt_ts FROM lineitem),
wm AS (SELECT least((SELECT max(pay_ts) FROM p), (SELECT max(receipt_ts) FROM r)) AS w),
j AS (
  SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.pay_ts, r.receipt_ts,
         CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'matched'
              WHEN r.tx_id IS NULL THEN 'unmatched_pay' ELSE 'unmatched_receipt' END AS status
  FROM p FULL OUTER JOIN r ON p.tx_id = r.tx_id
   AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 30 DAY AND p.pay_ts + INTERVAL 30 DAY)
SELECT tx_id, pay_ts, receipt_ts, status FROM j, wm
WHERE status = 'matched'
   OR (status = 'unmatched_pay' AND pay_ts + INTERVAL 30 DAY < w)
   OR (status = 'unmatched_receipt' AND receipt_ts + INTERVAL 30 DAY < w)
"""


@register("stream_reconcile", STREAM_RECONCILE_SQL)
def stream_reconcile(spark, sf_dir):
    pays = SJ.stream_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"))
    # every shipped line is a receipt
    rec = SJ.stream_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("receipt_ts"))
    return SJ.run_to_files(SJ.reconcile_stream(pays, rec, "tx_id", "pay_ts", "receipt_ts",
                                               RECONCILE_TOLERANCE), "reconcile")


# J-a on streams: the state machine of reconcile_one_to_one with a timeout; an event acts when it is
# under the watermark, a pending one is unmatched when the watermark is a timeout behind it.
_WM = "(SELECT least((SELECT max(o_orderdate) FROM orders), (SELECT max(l_shipdate) FROM lineitem)))"
_EXPIRED = "m.p_side IS NOT NULL AND n.ts > m.p_ts + INTERVAL 30 DAY"
STREAM_ONE_TO_ONE_SQL = f"""
WITH RECURSIVE e AS (
  SELECT o_orderkey AS k, o_orderdate AS ts, 0 AS side, 0 AS seq FROM orders
  UNION ALL SELECT l_orderkey, l_shipdate, 1, l_linenumber FROM lineitem),
n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, side, seq) AS i FROM e WHERE ts <= {_WM}),
m(k, i, p_side, p_ts, out_status, out_pay, out_receipt) AS (
  SELECT k, i, side, ts, CAST(NULL AS VARCHAR), CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP) FROM n WHERE i = 1
  UNION ALL
  SELECT n.k, n.i,
    CASE WHEN {_EXPIRED} THEN n.side WHEN m.p_side IS NOT NULL AND m.p_side <> n.side THEN NULL ELSE n.side END,
    CASE WHEN {_EXPIRED} THEN n.ts WHEN m.p_side IS NOT NULL AND m.p_side <> n.side THEN NULL ELSE n.ts END,
    CASE WHEN m.p_side IS NULL THEN NULL
         WHEN {_EXPIRED} THEN CASE m.p_side WHEN 0 THEN 'unmatched_pay' ELSE 'unmatched_receipt' END
         WHEN m.p_side <> n.side THEN 'matched'
         WHEN n.side = 0 THEN 'superseded_pay' ELSE 'superseded_receipt' END,
    CASE WHEN m.p_side = 0 THEN m.p_ts WHEN m.p_side = 1 AND n.side = 0 AND NOT ({_EXPIRED}) THEN n.ts END,
    CASE WHEN m.p_side = 1 THEN m.p_ts WHEN m.p_side = 0 AND n.side = 1 AND NOT ({_EXPIRED}) THEN n.ts END
  FROM m JOIN n ON n.k = m.k AND n.i = m.i + 1)
SELECT k AS tx_id, out_pay AS pay_ts, out_receipt AS receipt_ts, out_status AS status
FROM m WHERE out_status IS NOT NULL
UNION ALL
SELECT k, CASE WHEN p_side = 0 THEN p_ts END, CASE WHEN p_side = 1 THEN p_ts END,
       CASE WHEN p_side = 0 THEN 'unmatched_pay' ELSE 'unmatched_receipt' END
FROM m JOIN (SELECT k, max(i) AS i FROM n GROUP BY k) z USING (k, i)
WHERE p_side IS NOT NULL AND p_ts + INTERVAL 30 DAY <= {_WM}
"""


def _pay_and_receipt_streams(spark, sf_dir):
    pays = SJ.stream_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"))
    lines = SJ.stream_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_shipdate").alias("receipt_ts"),
        F.col("l_linenumber").alias("line"))
    return pays, lines


@register("stream_reconcile_one_to_one", STREAM_ONE_TO_ONE_SQL)
def stream_reconcile_one_to_one(spark, sf_dir):
    pays, lines = _pay_and_receipt_streams(spark, sf_dir)
    return SJ.run_to_files(SJ.reconcile_one_to_one_stream(
        pays, lines, "tx_id", "pay_ts", "receipt_ts", RECONCILE_TOLERANCE, right_seq="line",
        buckets=SJ.buckets_for(spark, sf_dir, "orders", "lineitem")), "one_to_one")


# J-c on streams: every shipped line is a receipt.
@register("stream_window_join", f"""
SELECT o_orderkey AS tx_id, make_timestamp(epoch_us(o_orderdate) // {D30} * {D30}) AS window_start,
       make_timestamp(epoch_us(o_orderdate) // {D30} * {D30} + {D30}) AS window_end,
       o_orderdate AS pay_ts, l_shipdate AS receipt_ts
FROM orders JOIN lineitem ON o_orderkey = l_orderkey
 AND epoch_us(o_orderdate) // {D30} = epoch_us(l_shipdate) // {D30}
""")
def stream_window_join(spark, sf_dir):
    pays, lines = _pay_and_receipt_streams(spark, sf_dir)
    return SJ.run_to_files(SJ.window_join_stream(pays, lines.drop("line"), "tx_id", "pay_ts", "receipt_ts", "30 days"),
                           "window_join")


def _upserted(spark, updates, name, keys):
    """Merge an update-mode stream into a compacted table and read it."""
    def merge(batch, batch_id, base):
        UpsertTable(f"{base}/table", keys, updates.schema).upsert(batch, batch_id)

    base = SJ.run_foreach_batch(updates, name, merge, "update")
    return UpsertTable(f"{base}/table", keys, updates.schema).read(spark)


def _upserted_uv(spark, sf_dir, name, one_hash):
    updates = SJ.uv_bitmap_updates(B.behavior_stream(spark, sf_dir), one_hash)
    latest = _upserted(spark, updates, name, ["window_start", "bucket"])
    return (latest.groupBy("window_start", "window_end")
            .agg(F.sum(F.bitmap_count("bm")).alias("uv")))


@register("upsert_uv_counts", _uv_sql("user_id"))
def upsert_uv_counts(spark, sf_dir):
    return _upserted_uv(spark, sf_dir, "uv_upsert", False)


@register("upsert_uv_one_hash", _uv_sql(POLY_HASH_SQL))
def upsert_uv_one_hash(spark, sf_dir):
    return _upserted_uv(spark, sf_dir, "uv_one_hash", True)


# Strict repeats: a start is reported once 12 h (its reach) lie under the watermark, 5 s behind the last event.
@register("stream_consecutive_failures",
          f"SELECT * FROM ({CONSECUTIVE_SQL}) q WHERE begin_ts + INTERVAL 12 HOUR <= {_MAX_ALL} - INTERVAL 5 SECOND")
def stream_consecutive_failures(spark, sf_dir):
    return SJ.run_to_files(SJ.repeats_stream(B.behavior_stream(spark, sf_dir), "12 hours"), "repeats")


@register("stream_total_counts",
          'SELECT channel, behavior, window_start, window_end, "count" '
          f"FROM ({TOTAL_COUNTS_SQL}) q WHERE window_end <= "
          f"(SELECT max(ts) FROM events WHERE event_type <> '{DROPPED_BEHAVIOR}')")
def stream_total_counts(spark, sf_dir):
    ev = B.marketing_view(B.behavior_stream(spark, sf_dir))
    return SJ.run_to_files(SJ.total_counts_stream(ev, DROPPED_BEHAVIOR), "total_counts")


# Successes and timeouts of the funnel in tables of their own, read back and labelled again.
@register("stream_funnel_side_outputs", STREAM_FUNNEL_SQL)
def stream_funnel_side_outputs(spark, sf_dir):
    funnel = SJ.funnel_stream(B.behavior_stream(spark, sf_dir), FUNNEL_WITHIN)

    def write(batch, batch_id, base):
        side_output_writer("status", {t: f"{base}/{t}" for t in ("success", "timeout")})(batch, batch_id)

    base = SJ.run_foreach_batch(funnel, "funnel_sides", write, "append")
    fields = T.StructType([f for f in SJ.FUNNEL_OUT.fields if f.name != "status"] + [T.StructField("batch_id", T.LongType())])
    parts = [spark.read.schema(fields).parquet(f"{base}/{t}").drop("batch_id").withColumn("status", F.lit(t))
             for t in ("success", "timeout")]
    return parts[0].unionByName(parts[1])


# The lines as text files in the shared folder, read line by line.
def _text_lines(spark, sf_dir, stream):
    path = scratch_path(spark, f"lines-{uuid.uuid4().hex}")
    _behavior_lines(spark, sf_dir).write.text(path)
    return parse_delimited(read_lines(spark, path, stream), BEHAVIOR_SCHEMA, ",")


def _timed(rows):
    return rows.select("user_id", "item_id", "category_id", "behavior",
                       from_micros(F.col("ts_seconds") * 1_000_000).alias("ts"))


@register("text_csv_lines", PARSE_CSV_SQL)
def text_csv_lines(spark, sf_dir):
    return _timed(_text_lines(spark, sf_dir, False))


@register("stream_text_csv_lines", PARSE_CSV_SQL)
def stream_text_csv_lines(spark, sf_dir):
    return SJ.run_to_files(_timed(_text_lines(spark, sf_dir, True)), "text_lines")


# J2 on a stream: watermark 61 s (1 s out-of-orderness + 1 min lateness).
@register("stream_hot_urls",
          f"SELECT * FROM ({HOT_URLS_SQL}) q WHERE window_end <= "
          f"(SELECT max(ts) FROM events WHERE event_type <> 'signup') - INTERVAL 61 SECOND")
def stream_hot_urls(spark, sf_dir):
    logs = B.weblog_view(B.behavior_stream(spark, sf_dir)).filter(
        ~F.col("url").contains(URL_EXCLUDE))
    return SJ.run_to_files(SJ.hot_urls_stream(logs), "hot_urls")


# Ranked 1 s behind the newest row, from pane counts that late rows correct for a minute.
@register("stream_hot_urls_corrected",
          f"SELECT * FROM ({HOT_URLS_SQL}) q WHERE window_end <= "
          f"(SELECT max(ts) FROM events WHERE event_type <> 'signup') - INTERVAL 1 SECOND")
def stream_hot_urls_corrected(spark, sf_dir):
    logs = B.weblog_view(B.behavior_stream(spark, sf_dir)).filter(~F.col("url").contains(URL_EXCLUDE))
    updates, _ = SJ.hot_urls_table(logs, "")
    return SJ.rank_hot_urls(_upserted(spark, updates, "hot_urls_corrected", ["url", "pane"]))


@register("stream_rate_limited_counts",
          f"SELECT * FROM ({RATE_COUNTS_SQL}) q WHERE window_end <= {_MAX_ALL}")
def stream_rate_limited_counts(spark, sf_dir):
    return SJ.run_to_files(
        SJ.rate_limited_counts_stream(
            B.behavior_stream(spark, sf_dir), CAP, buckets=SJ.buckets_for(spark, sf_dir, "events")), "rate_counts")


@register("stream_channel_counts",
          'SELECT channel, behavior, window_start, window_end, "count" '
          
          f"FROM ({CHANNEL_COUNTS_SQL}) q WHERE window_end <= "
          f"(SELECT max(ts) FROM events WHERE event_type <> '{DROPPED_BEHAVIOR}')")
def stream_channel_counts(spark, sf_dir):
    ev = B.marketing_view(B.behavior_stream(spark, sf_dir))
    return SJ.run_to_files(SJ.channel_counts_stream(ev, DROPPED_BEHAVIOR), "channel_counts")
