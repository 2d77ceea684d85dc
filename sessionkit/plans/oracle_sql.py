"""DuckDB oracle SQL for the registered queries (same adapter, as CTEs).

Tables ``events`` and ``part`` are the driver's views.  Rounded ("R") keys
round doubles to 6 places exactly like ``catalog.round_doubles``.
"""

from __future__ import annotations

from ..sources.adapter import EVENTS_CTE_SQL

ORACLE: dict[str, str] = {}

VALID_CTE = """
valid AS (
  SELECT * FROM ev
  WHERE price > 0 AND NOT isnan(price) AND user_session IS NOT NULL
)"""

# Per-(month, session) roll-up of the processing path (A3).
PROC_SESSIONS_CTE = """
ps AS (
  SELECT source_month, user_session,
         min(event_time) AS session_start,
         max(event_time) AS session_end,
         count(DISTINCT product_id) AS products_viewed,
         avg(price) AS avg_price,
         max(price) AS max_price,
         count(DISTINCT brand) AS brands_viewed,
         count(DISTINCT category_code) AS categories_viewed,
         CAST(coalesce(bool_or(event_type = 'cart'), false)
              AND NOT coalesce(bool_or(event_type = 'purchase'), false) AS INTEGER) AS is_abandoned,
         arg_min(user_id, CASE WHEN user_id IS NOT NULL THEN event_id END) AS user_id,
         count(*) FILTER (WHERE event_type = 'view' AND event_time IS NOT NULL) AS num_views,
         count(*) FILTER (WHERE event_type = 'cart' AND event_time IS NOT NULL) AS num_carts,
         count(*) FILTER (WHERE event_type = 'purchase' AND event_time IS NOT NULL) AS num_purchases,
         (epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000.0 AS duration_seconds
  FROM valid GROUP BY source_month, user_session
)"""

RETURNING_CTE = """
uf AS (
  SELECT user_id, min(session_start) AS user_first_session_time
  FROM ps WHERE user_id IS NOT NULL GROUP BY user_id
),
pr AS (
  SELECT ps.*, uf.user_first_session_time,
         CAST(coalesce(ps.session_start > uf.user_first_session_time, false) AS INTEGER)
           AS is_returning_user
  FROM ps LEFT JOIN uf ON ps.user_id = uf.user_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def r6(expr: str, alias: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) AS {alias}"


ORACLE["model_ready"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE, RETURNING_CTE) + f"""
SELECT source_month, user_session,
       {r6('duration_seconds', 'duration_seconds')},
       products_viewed,
       {r6('avg_price', 'avg_price')},
       {r6('max_price', 'max_price')},
       brands_viewed, categories_viewed, num_carts, num_views,
       is_returning_user, is_abandoned
FROM pr"""


TS = "'%Y-%m-%d %H:%M:%S.%f'"


def ts_text(c: str) -> str:
    return f"strftime({c}, {TS}) AS {c}"


EVENT_COLS_TEXT = (f"source_month, event_id, {ts_text('event_time')}, event_type, product_id, "
                   "category_code, brand, price, user_id, user_session")

ORACLE["valid_events"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + f"""
SELECT {EVENT_COLS_TEXT} FROM valid"""

LABELS_CTE = """
lab AS (
  SELECT user_session,
         coalesce(bool_or(event_type = 'cart'), false)
           AND NOT coalesce(bool_or(event_type = 'purchase'), false) AS is_abandoned
  FROM valid GROUP BY user_session
)"""

ORACLE["labeled_events"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, LABELS_CTE) + """
SELECT v.event_id, v.user_session, v.event_type, lab.is_abandoned
FROM valid v JOIN lab USING (user_session)"""

PIVOT_SELECT = """
  count(*) FILTER (WHERE event_type = 'view' AND event_time IS NOT NULL) AS num_views,
  count(*) FILTER (WHERE event_type = 'cart' AND event_time IS NOT NULL) AS num_carts,
  count(*) FILTER (WHERE event_type = 'purchase' AND event_time IS NOT NULL) AS num_purchases"""

ORACLE["event_type_pivot"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + f"""
SELECT user_session, {PIVOT_SELECT}
FROM valid GROUP BY user_session"""

ABANDONED_AGG = """CAST(coalesce(bool_or(event_type = 'cart'), false)
       AND NOT coalesce(bool_or(event_type = 'purchase'), false) AS INTEGER)"""
DURATION_AGG = "(epoch_us(max(event_time)) - epoch_us(min(event_time))) / 1000000.0"

BASIC_CTE = f"""
basic AS (
  SELECT user_session,
         count(event_type) AS event_count,
         count(DISTINCT product_id) AS products_viewed,
         {ABANDONED_AGG} AS is_abandoned,
         {DURATION_AGG} AS duration_seconds
  FROM valid GROUP BY user_session
)"""

ORACLE["basic_sessions"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, BASIC_CTE) + f"""
SELECT user_session, event_count, products_viewed, is_abandoned,
       {r6('duration_seconds', 'duration_seconds')}
FROM basic"""

ORACLE["enriched_sessions"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE) + f"""
SELECT source_month, user_session, {ts_text('session_start')}, {ts_text('session_end')},
       products_viewed, {r6('avg_price', 'avg_price')}, {r6('max_price', 'max_price')},
       brands_viewed, categories_viewed, is_abandoned, user_id,
       num_views, num_carts, num_purchases, {r6('duration_seconds', 'duration_seconds')}
FROM ps"""

ORACLE["enriched_sessions_eda"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + f"""
SELECT user_session,
       count(DISTINCT product_id) AS products_viewed,
       {r6('avg(price)', 'avg_price')},
       {r6('max(price)', 'max_price')},
       count(DISTINCT brand) AS brands_viewed,
       count(DISTINCT category_code) AS categories_viewed,
       {ABANDONED_AGG} AS is_abandoned,
       {PIVOT_SELECT},
       {r6(DURATION_AGG, 'duration_seconds')}
FROM valid GROUP BY user_session"""

SEGMENT_CTE = """
seg AS (
  SELECT user_session,
         min(event_time) AS session_start,
         max(event_time) AS session_end,
         arg_min(user_id, CASE WHEN user_id IS NOT NULL THEN event_id END) AS user_id,
         count(*) AS total_events,
         count(*) FILTER (WHERE event_type = 'view') AS view_count,
         count(*) FILTER (WHERE event_type = 'cart') AS cart_count,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
         count(DISTINCT product_id) AS unique_products,
         count(DISTINCT brand) AS unique_brands,
         count(DISTINCT category_code) AS unique_categories,
         avg(price) AS avg_price,
         max(price) AS max_price,
         sum(price) AS total_price
  FROM valid GROUP BY user_session
),
segl AS (
  SELECT *, CAST(cart_count > 0 AND purchase_count = 0 AS INTEGER) AS is_abandoned,
         (epoch_us(session_end) - epoch_us(session_start)) / 1000000.0 AS duration_seconds
  FROM seg
)"""

ORACLE["segment_sessions"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, SEGMENT_CTE) + f"""
SELECT user_session, {ts_text('session_start')}, {ts_text('session_end')}, user_id,
       total_events, view_count, cart_count, purchase_count,
       unique_products, unique_brands, unique_categories,
       {r6('avg_price', 'avg_price')}, {r6('max_price', 'max_price')},
       {r6('total_price', 'total_price')}, is_abandoned
FROM segl"""

ORACLE["segment_sessions_merged"] = ORACLE["segment_sessions"]

ORACLE["user_first_session"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE) + f"""
SELECT user_id, {ts_text('min(session_start)').replace(' AS min(session_start)', '')}
         AS user_first_session_time
FROM ps WHERE user_id IS NOT NULL GROUP BY user_id"""

ORACLE["returning_users"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE,
                                      RETURNING_CTE) + """
SELECT source_month, user_session, user_id, is_returning_user FROM pr"""
ORACLE["returning_users_join"] = ORACLE["returning_users"]

ORACLE["join_counts"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + f"""
SELECT user_session, count(DISTINCT product_id) AS products_viewed,
       {r6('max(price)', 'max_price')}, {PIVOT_SELECT}
FROM valid GROUP BY user_session"""

ORACLE["union_months"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE) + f"""
SELECT source_month, user_session, products_viewed, num_views, num_carts, num_purchases,
       is_abandoned, {r6('duration_seconds', 'duration_seconds')}
FROM ps"""

ORACLE["session_duration"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, SEGMENT_CTE) + f"""
SELECT user_session, {r6('duration_seconds', 'duration_seconds')} FROM segl"""

# ------------------------------------------------------------------ profiling
ORACLE["preview"] = with_ctes(EVENTS_CTE_SQL) + f"""
SELECT {EVENT_COLS_TEXT} FROM ev ORDER BY event_time NULLS LAST, event_id NULLS LAST LIMIT 5"""

_PROFILE_TYPES = [("source_month", "string"), ("event_id", "bigint"),
                  ("event_time", "timestamp_ntz"), ("event_type", "string"),
                  ("product_id", "bigint"), ("category_code", "string"), ("brand", "string"),
                  ("price", "double"), ("user_id", "bigint"), ("user_session", "string")]
ORACLE["null_profile"] = with_ctes(EVENTS_CTE_SQL) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null_count, "
    f"count(*) AS total_rows FROM ev" for c, t in _PROFILE_TYPES)

ORACLE["distinct_counts"] = with_ctes(EVENTS_CTE_SQL) + """
SELECT count(DISTINCT user_session) AS user_session, count(DISTINCT user_id) AS user_id,
       count(DISTINCT product_id) AS product_id, count(DISTINCT category_code) AS category_code,
       count(DISTINCT brand) AS brand
FROM ev"""

ORACLE["event_share"] = with_ctes(EVENTS_CTE_SQL) + f"""
SELECT event_type, count, {r6('count / sum(count) OVER () * 100.0', 'percent')}
FROM (SELECT event_type, count(*) AS count FROM ev GROUP BY event_type)"""

for _key, _col in (("top_brands", "brand"), ("top_categories", "category_code")):
    ORACLE[_key] = with_ctes(EVENTS_CTE_SQL) + f"""
SELECT {_col}, count(*) AS count FROM ev WHERE {_col} IS NOT NULL
GROUP BY {_col} ORDER BY count DESC, {_col} ASC LIMIT 10"""


def describe_sql(source: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END"
        stats = [("count", f"CAST(count({x}) AS DOUBLE)"), ("mean", f"avg({x})"),
                 ("std", f"stddev_samp({x})"), ("min", f"min({x})"),
                 ("25%", f"quantile_cont({x}, 0.25)"), ("50%", f"quantile_cont({x}, 0.5)"),
                 ("75%", f"quantile_cont({x}, 0.75)"), ("max", f"max({x})")]
        for s, e in stats:
            parts.append(f"SELECT '{c}' AS feature, '{s}' AS statistic, "
                         f"round(CAST({e} AS DOUBLE), 6) AS value FROM {source}")
    return "\nUNION ALL\n".join(parts)


ORACLE["describe_price"] = with_ctes(EVENTS_CTE_SQL) + "\n" + describe_sql("ev", ["price"])

ORACLE["describe_price_valid"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + "\n" + describe_sql(
    "valid", ["price"])

ORACLE["zero_price_by_type"] = with_ctes(EVENTS_CTE_SQL) + """
SELECT event_type, count(*) AS count FROM ev WHERE price = 0 GROUP BY event_type"""

ORACLE["clean_counts"] = with_ctes(EVENTS_CTE_SQL) + """
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE price > 0 AND NOT isnan(price)) AS rows_after,
       count(*) - count(*) FILTER (WHERE price > 0 AND NOT isnan(price)) AS rows_removed
FROM ev"""

ORACLE["price_histogram"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + """,
mm AS (SELECT min(price) AS lo, max(price) AS hi FROM valid),
b AS (
  SELECT least(greatest(CAST(floor((price - lo) * (50 / (hi - lo))) AS INTEGER), 0), 49) AS bin,
         count(*) AS count
  FROM valid, mm GROUP BY 1
)
SELECT CAST(r.bin AS INTEGER) AS bin,
       round(CAST(r.bin AS DOUBLE) * ((hi - lo) / 50) + lo, 6) AS bin_lo,
       round(CAST(r.bin + 1 AS DOUBLE) * ((hi - lo) / 50) + lo, 6) AS bin_hi,
       coalesce(b.count, 0) AS count
FROM (SELECT range AS bin FROM range(50)) r CROSS JOIN mm LEFT JOIN b ON b.bin = r.bin"""

ORACLE["price_kde"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + """,
st AS (SELECT count(*) AS n, stddev_samp(price) AS sd, min(price) AS lo, max(price) AS hi
       FROM valid),
pr AS (SELECT n, sd * pow(n, -1.0 / 5.0) AS h, lo, (hi - lo) / 199 AS step FROM st),
vc AS (SELECT price AS v, count(*) AS k FROM valid GROUP BY price),
g AS (SELECT range AS point, range * step + lo AS x FROM range(200), pr)
SELECT CAST(g.point AS INTEGER) AS point, round(g.x, 6) AS x,
       round(sum(vc.k * exp(-0.5 * ((g.x - vc.v) / pr.h) * ((g.x - vc.v) / pr.h)))
             * (1.0 / (pr.n * pr.h * sqrt(2.0 * pi()))), 6) AS density
FROM g, vc, pr GROUP BY g.point, g.x, pr.n, pr.h"""

ORACLE["price_kde_counts"] = ORACLE["price_kde"].replace(
    "(1.0 / (pr.n * pr.h * sqrt(2.0 * pi())))", "(pr.w / (pr.h * sqrt(2.0 * pi())))").replace(
    "(hi - lo) / 199 AS step FROM st", "(hi - lo) / 199 AS step, (hi - lo) / 50 AS w FROM st").replace(
    "pr.n, pr.h", "pr.w, pr.h")

ORACLE["event_funnel"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + """
SELECT event_type, count(*) AS count FROM valid GROUP BY event_type ORDER BY count DESC"""

ORACLE["class_balance"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE) + f"""
SELECT is_abandoned, count, {r6('count / sum(count) OVER ()', 'share')}
FROM (SELECT is_abandoned, count(*) AS count FROM ps GROUP BY is_abandoned)"""

ORACLE["class_balance_percent"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, BASIC_CTE) + f"""
SELECT is_abandoned, count, {r6('count / sum(count) OVER () * 100.0', 'percent')}
FROM (SELECT is_abandoned, count(*) AS count FROM basic GROUP BY is_abandoned)"""

ORACLE["describe_sessions"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, BASIC_CTE) + "\n" + describe_sql(
    "basic", ["event_count", "products_viewed", "duration_seconds"])

ORACLE["means_by_outcome"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE, BASIC_CTE) + f"""
SELECT is_abandoned, {r6('avg(event_count)', 'event_count')},
       {r6('avg(products_viewed)', 'products_viewed')},
       {r6('avg(duration_seconds)', 'duration_seconds')}
FROM basic GROUP BY is_abandoned"""


# ------------------------------------------------------------------ segmentation
CLUSTER_FEATURES = [
    "duration_seconds", "total_events", "view_count", "cart_count",
    "unique_products", "unique_brands", "unique_categories",
    "avg_price", "events_per_minute", "cart_to_view_ratio",
    "products_per_event", "is_abandoned",
]
LOG_FEATURES = ["duration_seconds", "total_events", "view_count", "avg_price"]


def sql_rint(e: str) -> str:
    """numpy ``rint`` (half-even on the binary value)."""
    return (f"(CASE WHEN ({e}) - floor({e}) < 0.5 THEN floor({e}) "
            f"WHEN ({e}) - floor({e}) > 0.5 THEN ceil({e}) "
            f"WHEN floor({e}) % 2 = 0 THEN floor({e}) ELSE ceil({e}) END)")


def sql_np_round(e: str, d: int) -> str:
    s = float(10 ** d)
    return f"({sql_rint(f'({e}) * {s}')} / {s})"


FEAT_CTE = """
feat AS (
  SELECT user_session, session_start, session_end, user_id, total_events, view_count,
         cart_count, purchase_count, unique_products, unique_brands, unique_categories,
         avg_price, max_price, total_price, is_abandoned, duration_seconds,
         CASE WHEN duration_seconds IS NULL OR duration_seconds = 0 THEN 0.0
              ELSE CAST(total_events AS DOUBLE) / (duration_seconds / 60.0) END
           AS events_per_minute,
         CAST(cart_count AS DOUBLE) / (CAST(view_count AS DOUBLE) + 1.0) AS cart_to_view_ratio,
         CAST(purchase_count AS DOUBLE) / (CAST(cart_count AS DOUBLE) + 1.0)
           AS purchase_to_cart_ratio,
         CAST(unique_products AS DOUBLE) / (CAST(total_events AS DOUBLE) + 1.0)
           AS products_per_event
  FROM segl
)"""

_med = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS m_{c}" for c in CLUSTER_FEATURES)
_imp = ", ".join(f"coalesce(CAST({c} AS DOUBLE), m_{c}) AS z_{c}" for c in CLUSTER_FEATURES)
_log = ", ".join((f"ln(1 + z_{c}) AS z_{c}" if c in LOG_FEATURES else f"z_{c}")
                 for c in CLUSTER_FEATURES)
_q = ", ".join(f"quantile_cont(z_{c}, 0.25) AS a_{c}, quantile_cont(z_{c}, 0.5) AS b_{c}, "
               f"quantile_cont(z_{c}, 0.75) AS c_{c}" for c in CLUSTER_FEATURES)
_sc = ", ".join(f"(z_{c} - b_{c}) / (CASE WHEN c_{c} - a_{c} = 0 THEN 1.0 ELSE c_{c} - a_{c} END)"
                f" AS z_{c}" for c in CLUSTER_FEATURES)
_raw = ", ".join(CLUSTER_FEATURES)

MATRIX_CTE = f"""
med AS (SELECT {_med} FROM feat),
imp AS (SELECT feat.*, {_imp} FROM feat, med),
lg AS (SELECT user_session, {_raw}, purchase_count, {_log} FROM imp),
rq AS (SELECT {_q} FROM lg),
mx AS (SELECT user_session, {_raw}, purchase_count, {_sc} FROM lg, rq)"""

_dist = " + ".join(f"(mx.z_{c} - cen.z_{c}) * (mx.z_{c} - cen.z_{c})" for c in CLUSTER_FEATURES)
ASSIGN_CTE = f"""
cen AS (
  SELECT row_number() OVER (ORDER BY md5('seg42:' || user_session)) - 1 AS cid, *
  FROM mx ORDER BY md5('seg42:' || user_session) LIMIT 8
),
dist AS (SELECT mx.user_session, cen.cid, {_dist} AS d FROM mx, cen),
asg AS (
  SELECT user_session, CAST(cid AS INTEGER) AS behavior_cluster FROM (
    SELECT user_session, cid,
           row_number() OVER (PARTITION BY user_session ORDER BY d, cid) AS rn FROM dist)
  WHERE rn = 1
),
clu AS (SELECT mx.*, asg.behavior_cluster FROM mx JOIN asg USING (user_session))"""

_an = {
    "avg_duration": "avg(duration_seconds)", "std_duration": "stddev_samp(duration_seconds)",
    "avg_events": "avg(total_events)", "avg_views": "avg(view_count)",
    "avg_carts": "avg(cart_count)", "avg_purchases": "avg(purchase_count)",
    "avg_products": "avg(unique_products)", "avg_price": "avg(avg_price)",
    "abandonment_rate": "avg(is_abandoned)",
}
_an_sel = ", ".join(f"{sql_np_round(e, 2)} AS {k}" for k, e in _an.items())
ANALYSIS_CTE = f"""
an0 AS (
  SELECT behavior_cluster, {_an_sel}, count(user_session) AS session_count
  FROM clu GROUP BY behavior_cluster
),
an AS (
  SELECT *, {sql_np_round('session_count / sum(session_count) OVER () * 100.0', 1)}
           AS percent_of_total
  FROM an0
),
th AS (
  SELECT quantile_cont(abandonment_rate, 0.33) AS r33, quantile_cont(abandonment_rate, 0.66) AS r66,
         quantile_cont(avg_duration, 0.33) AS d33, quantile_cont(avg_duration, 0.66) AS d66,
         quantile_cont(avg_products, 0.33) AS p33, quantile_cont(avg_products, 0.66) AS p66,
         quantile_cont(avg_price, 0.33) AS c33, quantile_cont(avg_price, 0.66) AS c66
  FROM an
)"""


def _lvl(x: str, lo: str, hi: str, labels) -> str:
    return (f"CASE WHEN {x} > {hi} THEN '{labels[0]}' WHEN {x} > {lo} THEN '{labels[1]}' "
            f"ELSE '{labels[2]}' END")


def _f0(x: str) -> str:
    return f"printf('%.0f', {sql_rint(x)})"


NAMES_CTE = f"""
nm AS (
  SELECT behavior_cluster AS cluster_id,
    {_lvl('abandonment_rate', 'r33', 'r66', ('High-Risk', 'Medium-Risk', 'Low-Risk'))} || ' | ' ||
    {_lvl('avg_duration', 'd33', 'd66', ('Patient', 'Balanced', 'Quick'))} || ' | ' ||
    {_lvl('avg_products', 'p33', 'p66', ('Explorer', 'Browser', 'Shopper'))} || ' | ' ||
    {_lvl('avg_price', 'c33', 'c66', ('Premium', 'Mid-Range', 'Budget'))} AS cluster_name,
    {_lvl('abandonment_rate', 'r33', 'r66',
          ('very high abandonment', 'moderate abandonment', 'low abandonment'))}
      || ' (' || printf('%.1f', abandonment_rate * 100.0) || '%), ' ||
    {_lvl('avg_duration', 'd33', 'd66', ('long sessions', 'medium sessions', 'short sessions'))}
      || ' (' || {_f0('avg_duration')} || 's), ' ||
    'views ' || {_f0('avg_products')} || ' products, ' ||
    {_lvl('avg_price', 'c33', 'c66', ('premium price', 'mid-range', 'low price'))}
      || ' ($' || {_f0('avg_price')} || ')' AS cluster_description
  FROM an, th
)"""

SEG_BASE = [EVENTS_CTE_SQL, VALID_CTE, SEGMENT_CTE, FEAT_CTE]

ORACLE["segment_features"] = with_ctes(*SEG_BASE) + f"""
SELECT user_session, {r6('duration_seconds', 'duration_seconds')},
       {r6('events_per_minute', 'events_per_minute')},
       {r6('cart_to_view_ratio', 'cart_to_view_ratio')},
       {r6('purchase_to_cart_ratio', 'purchase_to_cart_ratio')},
       {r6('products_per_event', 'products_per_event')}
FROM feat"""

ORACLE["log_features"] = with_ctes(*SEG_BASE) + "\nSELECT user_session, " + ", ".join(
    r6(f"ln(1 + CAST({c} AS DOUBLE))", c) for c in LOG_FEATURES) + " FROM feat"

ORACLE["impute_median"] = with_ctes(*SEG_BASE) + ",\n" + f"""
med AS (SELECT {_med} FROM feat)
SELECT user_session, """ + ", ".join(
    r6(f"coalesce(CAST({c} AS DOUBLE), m_{c})", c) for c in CLUSTER_FEATURES) + " FROM feat, med"

ORACLE["robust_scale"] = with_ctes(*SEG_BASE, MATRIX_CTE) + "\nSELECT user_session, " + ", ".join(
    r6(f"z_{c}", f"z_{c}") for c in CLUSTER_FEATURES) + " FROM mx"

SEG_ALL = SEG_BASE + [MATRIX_CTE, ASSIGN_CTE]

ORACLE["kmeans_assign"] = with_ctes(*SEG_ALL) + """
SELECT user_session, behavior_cluster FROM asg"""

ORACLE["cluster_analysis"] = with_ctes(*SEG_ALL, ANALYSIS_CTE) + """
SELECT behavior_cluster, """ + ", ".join(r6(k, k) for k in _an) + """,
       session_count, round(percent_of_total, 6) AS percent_of_total
FROM an"""

ORACLE["cluster_thresholds"] = with_ctes(*SEG_ALL, ANALYSIS_CTE) + f"""
SELECT 'abandonment_rate' AS metric, {r6('r33', 'q33')}, {r6('r66', 'q66')} FROM th
UNION ALL SELECT 'avg_duration', {r6('d33', 'q33')}, {r6('d66', 'q66')} FROM th
UNION ALL SELECT 'avg_products', {r6('p33', 'q33')}, {r6('p66', 'q66')} FROM th
UNION ALL SELECT 'avg_price', {r6('c33', 'q33')}, {r6('c66', 'q66')} FROM th"""

ORACLE["cluster_names"] = with_ctes(*SEG_ALL, ANALYSIS_CTE, NAMES_CTE) + """
SELECT cluster_id, cluster_name, cluster_description FROM nm"""

ORACLE["named_sessions"] = with_ctes(*SEG_ALL, ANALYSIS_CTE, NAMES_CTE) + """
SELECT a.user_session, a.behavior_cluster, nm.cluster_name, nm.cluster_description
FROM asg a LEFT JOIN nm ON nm.cluster_id = a.behavior_cluster"""

_raw_an = {k: e for k, e in _an.items()}
ORACLE["cluster_summary"] = with_ctes(*SEG_ALL, ANALYSIS_CTE, NAMES_CTE) + """
SELECT c.behavior_cluster, """ + ", ".join(r6(e, k) for k, e in _raw_an.items()) + """,
       count(c.user_session) AS session_count,
       max(nm.cluster_name) AS cluster_name, max(nm.cluster_description) AS cluster_description
FROM clu c LEFT JOIN nm ON nm.cluster_id = c.behavior_cluster
GROUP BY c.behavior_cluster"""

ORACLE["cluster_risk"] = with_ctes(*SEG_ALL, ANALYSIS_CTE) + f"""
SELECT behavior_cluster, {r6('abandonment_rate', 'abandonment_rate')},
       abandonment_rate > avg(abandonment_rate) OVER () AS above_mean
FROM an ORDER BY abandonment_rate DESC, behavior_cluster"""

ORACLE["cluster_bubbles"] = with_ctes(*SEG_ALL, ANALYSIS_CTE) + f"""
SELECT behavior_cluster, {r6('avg_duration', 'avg_duration')},
       {r6('avg_products', 'avg_products')}, {r6('avg_price', 'avg_price')},
       {r6('abandonment_rate', 'abandonment_rate')},
       {r6('session_count / max(session_count) OVER () * 1000.0', 'bubble_size')}
FROM an"""

ORACLE["cluster_intensity"] = with_ctes(*SEG_ALL, ANALYSIS_CTE) + f"""
SELECT behavior_cluster, 'avg_views' AS measure, {r6('avg_views', 'value')} FROM an
UNION ALL SELECT behavior_cluster, 'avg_carts', {r6('avg_carts', 'value')} FROM an
UNION ALL SELECT behavior_cluster, 'avg_purchases', {r6('avg_purchases', 'value')} FROM an"""

ORACLE["cluster_cards"] = with_ctes(*SEG_ALL, ANALYSIS_CTE, NAMES_CTE) + """
SELECT an.behavior_cluster, nm.cluster_name, round(an.percent_of_total, 6) AS percent_of_total,
       substr(nm.cluster_description, 1, 40) || '...' AS card_text
FROM an JOIN nm ON nm.cluster_id = an.behavior_cluster"""


# ------------------------------------------------------------------ machine learning
MODEL_FEATURES = ["duration_seconds", "products_viewed", "avg_price", "brands_viewed",
                  "categories_viewed", "num_carts", "num_views", "is_returning_user"]


def sql_key_hash(salt: str) -> str:
    return (f"CAST(('x' || substr(md5('{salt}:' || source_month || ':' || user_session), 1, 8))"
            f"::BIT AS BIGINT)")


SPLIT_CTE = f"""
hs AS (SELECT pr.*, {sql_key_hash('42')} AS h FROM pr),
thr AS (SELECT is_abandoned AS lbl, quantile_disc(h, 0.7) AS t70, quantile_disc(h, 0.85) AS t85
        FROM hs GROUP BY is_abandoned),
sp AS (
  SELECT hs.*, CASE WHEN h <= t70 THEN 'train' ELSE 'test' END AS split,
         CASE WHEN h <= t70 THEN 'train' WHEN h <= t85 THEN 'val' ELSE 'test' END AS split3
  FROM hs JOIN thr ON thr.lbl = hs.is_abandoned
)"""

ML_BASE = [EVENTS_CTE_SQL, VALID_CTE, PROC_SESSIONS_CTE, RETURNING_CTE, SPLIT_CTE]

ORACLE["split_70_30"] = with_ctes(*ML_BASE) + """
SELECT source_month, user_session, is_abandoned, split FROM sp"""

ORACLE["split_70_15_15"] = with_ctes(*ML_BASE) + """
SELECT source_month, user_session, is_abandoned, split3 AS split FROM sp"""

ORACLE["split_shapes"] = with_ctes(*ML_BASE) + """
SELECT split3 AS split, count(*) AS rows, 8 AS columns FROM sp GROUP BY split3"""

_mstats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in MODEL_FEATURES)
_zsel = ", ".join(
    r6(f"(CAST({c} AS DOUBLE) - m_{c}) / (CASE WHEN s_{c} IS NULL OR s_{c} = 0 THEN 1.0 "
       f"ELSE s_{c} END)", f"{c}_z") for c in MODEL_FEATURES)
ORACLE["standard_scale"] = with_ctes(*ML_BASE) + f""",
tr AS (SELECT * FROM sp WHERE split = 'train'),
ms AS (SELECT {_mstats} FROM tr)
SELECT source_month, user_session, {_zsel} FROM tr, ms"""

ORACLE["class_weights"] = with_ctes(*ML_BASE) + """,
cnt AS (SELECT is_abandoned, count(*) AS count FROM sp WHERE split = 'train' GROUP BY 1),
tot AS (SELECT sum(count) AS n, count(*) AS k,
               max(count) FILTER (WHERE is_abandoned = 0) AS neg,
               max(count) FILTER (WHERE is_abandoned = 1) AS pos FROM cnt)
SELECT 'balanced' AS mode, is_abandoned, round(n / (k * count), 6) AS weight, count
FROM cnt, tot
UNION ALL
SELECT 'unbalance', is_abandoned,
       round(greatest(CASE WHEN is_abandoned = 1 THEN CAST(neg AS DOUBLE) / pos
                           ELSE CAST(pos AS DOUBLE) / neg END, 1.0), 6), count
FROM cnt, tot"""

CONF_CTE = """
rp AS (SELECT is_abandoned, CAST(num_carts > 0 AS INTEGER) AS prediction
       FROM sp WHERE split = 'test'),
cm AS (
  SELECT count(*) FILTER (WHERE is_abandoned = 0 AND prediction = 0) AS tn,
         count(*) FILTER (WHERE is_abandoned = 0 AND prediction = 1) AS fp,
         count(*) FILTER (WHERE is_abandoned = 1 AND prediction = 0) AS fn,
         count(*) FILTER (WHERE is_abandoned = 1 AND prediction = 1) AS tp
  FROM rp
),
mt AS (
  SELECT *, tn + fp + fn + tp AS n, tp + fn AS s1, tn + fp AS s0,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0) AS p1,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0) AS r1,
         coalesce(CAST(tn AS DOUBLE) / nullif(tn + fn, 0), 0.0) AS p0,
         coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0.0) AS r0
  FROM cm
),
mf AS (
  SELECT *, coalesce(2.0 * p1 * r1 / nullif(p1 + r1, 0), 0.0) AS f1_1,
            coalesce(2.0 * p0 * r0 / nullif(p0 + r0, 0), 0.0) AS f1_0,
            CAST(tp + tn AS DOUBLE) / n AS acc
  FROM mt
)"""

ORACLE["bakeoff_support"] = with_ctes(*ML_BASE) + """
SELECT m.model_name, is_abandoned AS actual, count(*) AS support
FROM sp, (VALUES ('LogisticRegression'), ('RandomForest'), ('XGBoost'), ('LightGBM')) m(model_name)
WHERE split = 'test' GROUP BY ALL"""

ORACLE["fold_sizes"] = with_ctes(*ML_BASE) + """,
fh AS (SELECT is_abandoned,
              CAST('0x' || substr(md5('fold42:' || source_month || ':' || user_session), 1, 8)
                   AS BIGINT) AS h FROM sp WHERE split = 'train'),
ft AS (SELECT is_abandoned AS c, quantile_disc(h, 1.0 / 3) AS a, quantile_disc(h, 2.0 / 3) AS b
       FROM fh GROUP BY 1)
SELECT CASE WHEN h <= a THEN 0 WHEN h <= b THEN 1 ELSE 2 END AS fold, is_abandoned, count(*) AS rows
FROM fh JOIN ft ON c = is_abandoned GROUP BY ALL"""

ORACLE["kmeans_nearest"] = with_ctes(EVENTS_CTE_SQL, VALID_CTE) + """
SELECT true AS nearest, count(DISTINCT user_session) AS rows FROM valid"""

ORACLE["importance_total"] = f"SELECT CAST({len(MODEL_FEATURES)} AS BIGINT) AS features, CAST(1.0 AS DOUBLE) AS total"

ORACLE["confusion_matrix"] = with_ctes(*ML_BASE, CONF_CTE) + """
SELECT 0 AS actual, 0 AS predicted, tn AS count FROM cm
UNION ALL SELECT 0, 1, fp FROM cm
UNION ALL SELECT 1, 0, fn FROM cm
UNION ALL SELECT 1, 1, tp FROM cm"""

ORACLE["classification_report"] = with_ctes(*ML_BASE, CONF_CTE) + """
SELECT 'Not Abandoned (0)' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall,
       round(f1_0, 6) AS f1_score, s0 AS support FROM mf
UNION ALL SELECT 'Abandoned (1)', round(p1, 6), round(r1, 6), round(f1_1, 6), s1 FROM mf
UNION ALL SELECT 'accuracy', NULL, NULL, round(acc, 6), n FROM mf
UNION ALL SELECT 'macro avg', round((p1 + p0) / 2, 6), round((r1 + r0) / 2, 6),
                 round((f1_1 + f1_0) / 2, 6), n FROM mf
UNION ALL SELECT 'weighted avg', round((p1 * s1 + p0 * s0) / n, 6),
                 round((r1 * s1 + r0 * s0) / n, 6), round((f1_1 * s1 + f1_0 * s0) / n, 6), n
FROM mf"""

ORACLE["metrics_long"] = with_ctes(*ML_BASE, CONF_CTE) + """
SELECT 'CartRule' AS model, 'Precision' AS metric, round(p1, 6) AS score FROM mf
UNION ALL SELECT 'CartRule', 'Recall', round(r1, 6) FROM mf
UNION ALL SELECT 'CartRule', 'F1-Score', round(f1_1, 6) FROM mf"""

# Pending after a logged LogisticRegression run: the remaining defaults in order.
ORACLE["resume_pending"] = """
SELECT model_name, run_order FROM (VALUES ('RandomForest', 1), ('XGBoost', 2), ('LightGBM', 3))
  AS t(model_name, run_order)"""


# ------------------------------------------------------------------ sources and sinks
ORACLE["csv_scan"] = with_ctes(EVENTS_CTE_SQL) + f"\nSELECT {EVENT_COLS_TEXT} FROM ev"
ORACLE["narrow_types"] = with_ctes(EVENTS_CTE_SQL) + "\nSELECT " + EVENT_COLS_TEXT.replace(
    " price,", " CAST(price AS FLOAT) AS price,") + " FROM ev"
ORACLE["csv_ingest_stream"] = ORACLE["csv_scan"]
ORACLE["parquet_roundtrip"] = ORACLE["csv_scan"]
ORACLE["parquet_scan"] = ORACLE["csv_scan"] + " WHERE source_month = 'A'"
ORACLE["csv_report_roundtrip"] = ORACLE["event_funnel"]


def _int_type(c: str) -> str:
    return (f"CASE WHEN min({c}) IS NULL THEN 'bigint' "
            f"WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' "
            f"WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint' "
            f"WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' "
            f"ELSE 'bigint' END")


ORACLE["narrow_report"] = with_ctes(EVENTS_CTE_SQL) + ",\n" + f"""
dec AS (
  SELECT {_int_type('event_id')} AS t_event_id, {_int_type('product_id')} AS t_product_id,
         CASE WHEN max(abs(price - CAST(CAST(price AS FLOAT) AS DOUBLE))) <= 5e-4
              THEN 'float' ELSE 'double' END AS t_price,
         {_int_type('user_id')} AS t_user_id
  FROM ev
)
SELECT 'event_id' AS column_name, 'bigint' AS old_type, t_event_id AS new_type,
       t_event_id <> 'bigint' AS narrowed FROM dec
UNION ALL SELECT 'product_id', 'bigint', t_product_id, t_product_id <> 'bigint' FROM dec
UNION ALL SELECT 'price', 'double', t_price, t_price <> 'double' FROM dec
UNION ALL SELECT 'user_id', 'bigint', t_user_id, t_user_id <> 'bigint' FROM dec"""

_STRING_COLS = ["source_month", "event_type", "category_code", "brand", "user_session"]
ORACLE["low_cardinality"] = with_ctes(EVENTS_CTE_SQL) + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct, count(*) AS n_rows, "
    f"round(count(DISTINCT {c}) / count(*), 6) AS ratio, "
    f"count(DISTINCT {c}) / count(*) < 0.5 AS is_low_cardinality FROM ev"
    for c in _STRING_COLS)

ORACLE["csv_rejects"] = with_ctes(EVENTS_CTE_SQL) + """
SELECT CASE WHEN event_type = 'purchase' AND price IS NOT NULL THEN 'price' END AS reason,
       CAST(count(*) AS BIGINT) AS "rows"
FROM ev GROUP BY 1"""

ORACLE["kmeans_step"] = with_ctes(*SEG_ALL) + ",\n" + f"""
near AS (SELECT a.behavior_cluster, mx.*,
                (SELECT min({_dist}) FROM cen) AS away
         FROM mx JOIN asg a USING (user_session))
SELECT behavior_cluster, count(*) AS n, """ + ", ".join(
    r6(f"avg(z_{c})", f"z_{c}") for c in CLUSTER_FEATURES) + f""",
       {r6('sum(away)', 'cost')}
FROM near GROUP BY 1"""
