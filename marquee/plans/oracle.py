"""DuckDB oracle SQL, one string per registered key.

Every statement starts with the fixture views (``with_views``) because the
checker registers only the base tables.  Doubles are rounded to 6 places
and decimals cast to double, matching ``catalog.finish``.
"""

from __future__ import annotations

from ..sources.fixtures import with_views
from . import params as P

ORACLE: dict[str, str] = {}


def sql(name: str, views: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> None:
    ORACLE[name] = with_views(views, body, extra)


RD = f"DATE '{P.RUN_DATE}'"
CD = f"DATE '{P.COHORT_DATE}'"
RS = f"TIMESTAMP '{P.RANGE_START}'"
RE = f"TIMESTAMP '{P.RANGE_END}'"
ME = ["movie_events"]

# ------------------------------------------------------------------ metrics

sql("dau_state_merge", ME, """
SELECT event_date, count(DISTINCT user_id) AS dau FROM movie_events GROUP BY event_date""")

sql("dau_for_date", ME, f"""
SELECT {RD} AS event_date, count(DISTINCT user_id) AS dau FROM movie_events WHERE event_date = {RD}""")

sql("movie_views_state", ME, """
SELECT event_date, movie_id, count(*) AS views FROM movie_events
WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id""")

sql("top_movies_daily", ME, f"""
SELECT {RD} AS metric_date, movie_id,
       CAST(row_number() OVER (ORDER BY views DESC, movie_id) AS INTEGER) AS rank, views
FROM (SELECT movie_id, count(*) AS views FROM movie_events
      WHERE event_type = 'VIEW_STARTED' AND event_date = {RD}
      GROUP BY movie_id ORDER BY views DESC, movie_id LIMIT {P.TOP_N}) t""")

sql("watch_time_state", ME, """
SELECT event_date, sum(progress_seconds) AS sum_sec, count(progress_seconds) AS n FROM movie_events
WHERE event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL GROUP BY event_date""")

sql("avg_watch_time_for_date", ME, f"""
SELECT {RD} AS metric_date, round(coalesce(avg(progress_seconds), 0.0), 6) AS avg_watch_time_sec
FROM movie_events
WHERE event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL AND event_date = {RD}""")

sql("conversion_for_date", ME, f"""
SELECT {RD} AS metric_date, started, finished,
       round(CASE WHEN started > 0 THEN finished / started ELSE 0.0 END, 6) AS conversion
FROM (SELECT count(*) FILTER (WHERE event_type = 'VIEW_STARTED') AS started,
             count(*) FILTER (WHERE event_type = 'VIEW_FINISHED') AS finished
      FROM movie_events WHERE event_date = {RD}) t""")

sql("conversion_series", ME, f"""
SELECT event_date,
       round(count(*) FILTER (WHERE event_type = 'VIEW_FINISHED')
             / nullif(count(*) FILTER (WHERE event_type = 'VIEW_STARTED'), 0), 6) AS value
FROM movie_events WHERE event_time >= {RS} AND event_time <= {RE} GROUP BY event_date""")

sql("dau_series", ME, f"""
SELECT event_date, count(DISTINCT user_id) AS value FROM movie_events
WHERE CAST(event_date AS TIMESTAMP) >= {RS} AND CAST(event_date AS TIMESTAMP) <= {RE} GROUP BY event_date""")

sql("watch_time_series", ME, f"""
SELECT event_date, round(avg(progress_seconds), 6) AS value FROM movie_events
WHERE event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL
  AND CAST(event_date AS TIMESTAMP) >= {RS} AND CAST(event_date AS TIMESTAMP) <= {RE}
GROUP BY event_date""")

sql("top_movies_range", ME, f"""
SELECT movie_id, count(*) AS views FROM movie_events
WHERE event_type = 'VIEW_STARTED' AND event_time >= {RS} AND event_time <= {RE}
GROUP BY movie_id ORDER BY views DESC, movie_id LIMIT {P.TOP_N}""")

sql("device_share", ME, f"""
SELECT device_type, events, round(events / sum(events) OVER (), 6) AS share
FROM (SELECT device_type, count(*) AS events FROM movie_events
      WHERE event_time >= {RS} AND event_time <= {RE} GROUP BY device_type) t""")

sql("events_by_type", ME, """
SELECT event_type, count(*) AS n FROM movie_events GROUP BY event_type ORDER BY event_type""")

sql("conversion_last", ME, f"""
SELECT event_date, round(value, 6) AS conversion,
       CASE WHEN value >= 0.5 THEN 'green' WHEN value >= 0.3 THEN 'yellow' ELSE 'red' END AS band
FROM (SELECT event_date,
             count(*) FILTER (WHERE event_type = 'VIEW_FINISHED')
             / nullif(count(*) FILTER (WHERE event_type = 'VIEW_STARTED'), 0) AS value
      FROM movie_events WHERE event_time >= {RS} AND event_time <= {RE} GROUP BY event_date) s
WHERE value IS NOT NULL ORDER BY event_date DESC LIMIT 1""")

METRICS_LONG_BODY = f"""
SELECT {RD} AS metric_date, 'dau' AS metric_name, CAST(count(DISTINCT user_id) AS DOUBLE) AS metric_value,
       '{{}}' AS dimensions
FROM movie_events WHERE event_date = {RD}
UNION ALL
SELECT {RD}, 'avg_watch_time_sec', round(coalesce(avg(progress_seconds), 0.0), 6), '{{}}'
FROM movie_events WHERE event_date = {RD} AND event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL
UNION ALL
SELECT {RD}, 'view_conversion', round(CASE WHEN started > 0 THEN finished / started ELSE 0.0 END, 6),
       '{{"finished":' || CAST(finished AS VARCHAR) || ',"started":' || CAST(started AS VARCHAR) || '}}'
FROM (SELECT count(*) FILTER (WHERE event_type = 'VIEW_STARTED') AS started,
             count(*) FILTER (WHERE event_type = 'VIEW_FINISHED') AS finished
      FROM movie_events WHERE event_date = {RD}) c"""

sql("metrics_long", ME, METRICS_LONG_BODY)

# ---------------------------------------------------------------- retention

USER_DAYS = ("user_days", """
SELECT DISTINCT user_id, event_date AS seen_on,
       min(event_date) OVER (PARTITION BY user_id) AS joined_on
FROM movie_events""")
DAY_COUNTS = ("day_counts", f"""
SELECT joined_on AS cohort_date, CAST(seen_on - joined_on AS INTEGER) AS day_offset, count(*) AS returned
FROM user_days WHERE seen_on - joined_on <= {P.MAX_DAY_OFFSET} GROUP BY ALL""")
RET_ALL = ("ret_all", """
SELECT c.cohort_date, c.day_offset, CAST(z.returned AS INTEGER) AS cohort_size, CAST(c.returned AS INTEGER) AS returned,
       round(c.returned / z.returned, 6) AS retention_pct
FROM day_counts c, day_counts z WHERE z.cohort_date = c.cohort_date AND z.day_offset = 0""")
RET = [USER_DAYS, DAY_COUNTS, RET_ALL]

sql("first_activity", ME, "SELECT DISTINCT user_id, joined_on AS cohort_date FROM user_days", [USER_DAYS])

sql("retention_cohort", ME, f"SELECT * FROM ret_all WHERE cohort_date = {CD}", RET)

sql("retention_for_run", ME, f"""
SELECT * FROM ret_all WHERE cohort_date IN ({RD} - INTERVAL 1 DAY, {RD} - INTERVAL 7 DAY)""", RET)

sql("retention_bands", ME, """
SELECT *, CASE WHEN retention_pct * 100 >= 60 THEN 'green' WHEN retention_pct * 100 >= 40 THEN 'yellow'
               WHEN retention_pct * 100 >= 25 THEN 'orange' WHEN retention_pct * 100 >= 10 THEN 'red'
               ELSE 'dark-red' END AS band
FROM ret_all""", RET)

HEAT_COLS = ",\n".join(
    f"round(100 * coalesce(max(returned) FILTER (WHERE day_offset = {k}), 0) / max(cohort_size), 0) AS day_{k}"
    for k in range(P.MAX_DAY_OFFSET + 1))
sql("retention_heatmap", ME, f"""
SELECT strftime(cohort_date, '%Y-%m-%d') AS cohort_date,
{HEAT_COLS}
FROM ret_all GROUP BY ret_all.cohort_date ORDER BY ret_all.cohort_date DESC LIMIT {P.HEATMAP_LIMIT}""", RET)

# ------------------------------------------------------- ingest and storage

TYPED = """
SELECT lower(event_id) AS event_id, user_id, movie_id, event_type,
       date_trunc('millisecond', event_time) AS event_time, device_type, session_id, progress_seconds
FROM movie_events"""

sql("ingest_typed", ME, TYPED)

sql("raw_roundtrip", ME, """
SELECT lower(event_id) AS event_id, user_id, movie_id, event_type,
       date_trunc('millisecond', event_time) AS event_time, event_date, device_type, session_id, progress_seconds
FROM movie_events""")
sql("raw_append_two_batches", ME, """
SELECT lower(event_id) AS event_id, user_id, movie_id, event_type,
       date_trunc('millisecond', event_time) AS event_time, event_date, device_type, session_id, progress_seconds
FROM movie_events""")

sql("raw_ttl_filter", ME, f"""
SELECT * FROM movie_events WHERE event_date > DATE '{P.TTL_AS_OF}' - INTERVAL {P.TTL_DAYS} DAY""")

CA = f"TIMESTAMP '{P.COMPUTED_AT}'"
EARLY = ("early", f"SELECT * FROM movie_events WHERE hour(event_time) < {P.PARTIAL_CUTOFF_HOUR}")
EARLY_STAMP = f"CAST(metric_date AS TIMESTAMP) + INTERVAL {P.PARTIAL_CUTOFF_HOUR} HOUR"


def _day_aggs_sql(src: str, where: str = "", group: bool = True) -> str:
    fin = "event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL"
    return f"""
SELECT {'event_date' if group else RD} AS metric_date, count(DISTINCT user_id) AS dau,
       CAST(sum(progress_seconds) FILTER (WHERE {fin}) AS DOUBLE) AS sum_sec,
       count(*) FILTER (WHERE {fin}) AS n_fin,
       count(*) FILTER (WHERE event_type = 'VIEW_STARTED') AS started,
       count(*) FILTER (WHERE event_type = 'VIEW_FINISHED') AS finished
FROM {src} {where} {'GROUP BY event_date' if group else ''}"""


def _long_sql(aggs: str, stamp: str) -> str:
    return f"""
SELECT metric_date, 'dau' AS metric_name, CAST(dau AS DOUBLE) AS metric_value, '{{}}' AS dimensions,
       {stamp} AS computed_at FROM {aggs}
UNION ALL
SELECT metric_date, 'avg_watch_time_sec', round(coalesce(sum_sec / nullif(n_fin, 0), 0.0), 6), '{{}}', {stamp}
FROM {aggs}
UNION ALL
SELECT metric_date, 'view_conversion', round(CASE WHEN started > 0 THEN finished / started ELSE 0.0 END, 6),
       '{{"finished":' || CAST(finished AS VARCHAR) || ',"started":' || CAST(started AS VARCHAR) || '}}', {stamp}
FROM {aggs}"""


def _top_sql(src: str, where: str, stamp: str) -> str:
    return f"""
SELECT metric_date, movie_id, rank, views, {stamp} AS computed_at FROM (
  SELECT event_date AS metric_date, movie_id, count(*) AS views,
         CAST(row_number() OVER (PARTITION BY event_date ORDER BY count(*) DESC, movie_id) AS INTEGER) AS rank
  FROM {src} WHERE event_type = 'VIEW_STARTED' {where} GROUP BY event_date, movie_id) t
WHERE rank <= {P.TOP_N}"""


def _retention_ctes(src: str, p: str) -> list[tuple[str, str]]:
    return [
        (f"{p}_first", f"SELECT user_id, min(event_date) AS cohort_date FROM {src} GROUP BY user_id"),
        (f"{p}_act", f"""
SELECT DISTINCT f.cohort_date, e.user_id, CAST(date_diff('day', f.cohort_date, e.event_date) AS INTEGER) AS day_offset
FROM {src} e JOIN {p}_first f USING (user_id)
WHERE date_diff('day', f.cohort_date, e.event_date) BETWEEN 0 AND {P.MAX_DAY_OFFSET}"""),
        (f"{p}_sizes", f"SELECT cohort_date, count(*) AS total FROM {p}_first GROUP BY cohort_date"),
        (f"{p}_ret", f"""
SELECT a.cohort_date, a.day_offset, CAST(s.total AS INTEGER) AS cohort_size,
       CAST(count(DISTINCT a.user_id) AS INTEGER) AS returned,
       round(count(DISTINCT a.user_id) / s.total, 6) AS retention_pct
FROM {p}_act a JOIN {p}_sizes s USING (cohort_date) GROUP BY a.cohort_date, a.day_offset, s.total"""),
    ]


CYCLE = [
    EARLY,
    ("early_aggs", _day_aggs_sql("early")),
    ("m_exist", _long_sql("early_aggs", EARLY_STAMP)),
    ("new_aggs", _day_aggs_sql("movie_events", f"WHERE event_date = {RD}", group=False)),
    ("m_new", _long_sql("new_aggs", CA)),
    ("t_exist", _top_sql("early", "", EARLY_STAMP)),
    ("t_new", _top_sql("movie_events", f"AND event_date = {RD}", CA)),
    *_retention_ctes("early", "re"),
    ("r_exist", f"""SELECT *, CAST(cohort_date AS TIMESTAMP) + INTERVAL {P.PARTIAL_CUTOFF_HOUR} HOUR AS computed_at
FROM re_ret"""),
    *_retention_ctes("movie_events", "rn"),
    ("r_new", f"""SELECT *, {CA} AS computed_at FROM rn_ret
WHERE cohort_date IN ({RD} - INTERVAL 1 DAY, {RD} - INTERVAL 7 DAY)"""),
    ("m_merged", """
SELECT * FROM m_exist e WHERE NOT EXISTS (
  SELECT 1 FROM m_new n WHERE n.metric_date = e.metric_date AND n.metric_name = e.metric_name
                          AND n.dimensions = e.dimensions)
UNION ALL SELECT * FROM m_new"""),
    ("t_merged", f"SELECT * FROM t_exist WHERE metric_date <> {RD} UNION ALL SELECT * FROM t_new"),
    ("r_merged", """
SELECT * FROM r_exist e WHERE NOT EXISTS (
  SELECT 1 FROM r_new n WHERE n.cohort_date = e.cohort_date AND n.day_offset = e.day_offset)
UNION ALL SELECT * FROM r_new"""),
]

sql("upsert_metrics", ME, "SELECT * FROM m_merged", CYCLE)

sql("upsert_metrics_by_name", ME, """
SELECT * FROM m_exist e WHERE NOT EXISTS (
  SELECT 1 FROM m_new n WHERE n.metric_date = e.metric_date AND n.metric_name = e.metric_name)
UNION ALL SELECT * FROM m_new""", CYCLE)

sql("replace_top_day", ME, "SELECT * FROM t_merged", CYCLE)

sql("upsert_retention", ME, "SELECT * FROM r_merged", CYCLE)

sql("replace_top_day_empty", ME, f"SELECT * FROM t_exist WHERE metric_date <> {RD}", CYCLE)

sql("daily_cycle", ME, f"""
SELECT 'metrics' AS section, metric_name AS name, metric_value AS value, CAST(NULL AS BIGINT) AS place,
       CAST(NULL AS BIGINT) AS n, CAST(NULL AS BIGINT) AS size, dimensions
FROM m_merged WHERE metric_date = {RD}
UNION ALL
SELECT 'top', movie_id, NULL, rank, views, NULL, NULL FROM t_merged WHERE metric_date = {RD}
UNION ALL
SELECT 'retention', strftime(cohort_date, '%Y-%m-%d'), retention_pct, day_offset, returned, cohort_size, NULL
FROM r_merged WHERE cohort_date IN ({RD} - INTERVAL 1 DAY, {RD} - INTERVAL 7 DAY)""", CYCLE)

sql("metrics_for_date", ME, f"""
SELECT 'metrics' AS section, metric_name AS name, metric_value AS value, CAST(NULL AS INTEGER) AS rank_or_offset
FROM m_merged WHERE metric_date = {RD}
UNION ALL
SELECT 'top_movies', movie_id, CAST(views AS DOUBLE), rank FROM t_merged WHERE metric_date = {RD}
UNION ALL
SELECT 'retention', strftime(cohort_date, '%Y-%m-%d'), retention_pct, day_offset FROM r_merged
WHERE cohort_date = {RD}""", CYCLE)


def _export_sql(day: str) -> str:
    return f"""
SELECT 'metrics' AS "table", metric_date, metric_name, metric_value, dimensions, computed_at,
       CAST(NULL AS VARCHAR) AS movie_id, CAST(NULL AS INTEGER) AS rank, CAST(NULL AS BIGINT) AS views,
       CAST(NULL AS DATE) AS cohort_date, CAST(NULL AS INTEGER) AS day_offset, CAST(NULL AS INTEGER) AS cohort_size,
       CAST(NULL AS INTEGER) AS returned, CAST(NULL AS DOUBLE) AS retention_pct
FROM m_merged WHERE metric_date = {day}
UNION ALL
SELECT 'top_movies', metric_date, NULL, NULL, NULL, computed_at, movie_id, rank, views, NULL, NULL, NULL, NULL, NULL
FROM t_merged WHERE metric_date = {day}
UNION ALL
SELECT 'retention', NULL, NULL, NULL, NULL, computed_at, NULL, NULL, NULL, cohort_date, day_offset, cohort_size,
       returned, retention_pct
FROM r_merged WHERE cohort_date = {day}"""


sql("export_document", ME, f"""
SELECT CAST({CD} AS VARCHAR) AS export_date, strftime(max(computed_at), '%Y-%m-%d %H:%M:%S') AS computed_at,
       coalesce(string_agg(metric_name || '|' || dimensions, ';' ORDER BY metric_name) FILTER (WHERE "table" = 'metrics'), '')
           AS metrics,
       coalesce(string_agg(rank || '|' || movie_id || '|' || views, ';' ORDER BY rank) FILTER (WHERE "table" = 'top_movies'), '')
           AS top_movies,
       coalesce(string_agg(day_offset || '|' || returned || '|' || cohort_size, ';' ORDER BY day_offset)
                FILTER (WHERE "table" = 'retention'), '') AS retention
FROM ({_export_sql(CD)}) u""", CYCLE)

sql("json_ingest", ME, f"""
SELECT event_id, user_id, movie_id, event_type,
       CASE WHEN CAST(event_id AS BIGINT) % 5 = 0 OR CAST(event_id AS BIGINT) % 7 = 0
            THEN epoch_ms(TIMESTAMP '{P.COMPUTED_AT}') ELSE epoch_ms(date_trunc('millisecond', event_time)) END AS "timestamp",
       device_type, session_id, progress_seconds
FROM movie_events""")

sql("request_log_stats", ME, """
SELECT CASE WHEN event_id % 3 = 0 THEN 'POST' ELSE 'GET' END AS method, '/' || event_type AS endpoint,
       CAST(CASE WHEN event_id % 11 = 0 THEN 500 ELSE 200 END AS INTEGER) AS status_code, count(*) AS n,
       max(CAST(floor(value * 10) AS BIGINT)) AS slowest_ms, count(*) FILTER (WHERE event_id % 3 = 0) AS masked,
       min(date_trunc('second', CAST(ts AS TIMESTAMP))) AS first_at
FROM events GROUP BY ALL""")

sql("export_files", ME, f"""
SELECT format, "table", count(*) AS n FROM ({_export_sql(CD)}) u, (VALUES ('csv'), ('json'), ('parquet')) f(format) GROUP BY ALL""", CYCLE)

sql("export_union", ME, _export_sql(RD), CYCLE)
sql("export_union_cohort", ME, _export_sql(CD), CYCLE)

# ------------------------------------------------------- validation, audits


def _reasons_sql(rules: list[tuple[str, str]]) -> str:
    items = ", ".join(f"CASE WHEN {cond} THEN '{name}' END" for cond, name in sorted(rules, key=lambda r: r[1]))
    return f"concat_ws(',', {items})"


UUID_SQL = ("regexp_full_match(regexp_replace(regexp_replace(regexp_replace(regexp_replace(event_id, 'urn:', '', 'g'),"
            " 'uuid:', '', 'g'), '^\\{|\\}$', '', 'g'), '-', '', 'g'), '[0-9a-fA-F]{32}')")
EVENT_TYPES_SQL = "('VIEW_STARTED','VIEW_FINISHED','VIEW_PAUSED','VIEW_RESUMED','LIKED','SEARCHED')"
DEVICES_SQL = "('MOBILE','DESKTOP','TV','TABLET')"

EVENT_RULES = [
    (f"event_id IS NOT NULL AND NOT {UUID_SQL}", "event_id:not_uuid"),
    ("user_id IS NULL OR length(user_id) < 1", "user_id:empty"),
    ("movie_id IS NULL OR length(movie_id) < 1", "movie_id:empty"),
    ("session_id IS NULL OR length(session_id) < 1", "session_id:empty"),
    (f"event_type IS NULL OR event_type NOT IN {EVENT_TYPES_SQL}", "event_type:unknown"),
    (f"device_type IS NULL OR device_type NOT IN {DEVICES_SQL}", "device_type:unknown"),
    ("progress_seconds < 0", "progress_seconds:negative"),
]
sql("event_contract_rejects", ["event_candidates"], f"""
SELECT row_id, reasons FROM (SELECT row_id, {_reasons_sql(EVENT_RULES)} AS reasons FROM event_candidates) t
WHERE reasons <> ''""")

sql("stream_rejects", ["event_candidates"], f"""
SELECT * FROM (SELECT * EXCLUDE (row_id), {_reasons_sql(EVENT_RULES)} AS reasons FROM event_candidates) t
WHERE reasons <> ''""")

sql("stream_accepts", ["event_candidates"], f"""
SELECT lower(event_id) AS event_id, user_id, movie_id, event_type, make_timestamp("timestamp" * 1000) AS event_time,
       CAST(make_timestamp("timestamp" * 1000) AS DATE) AS event_date, device_type, session_id, progress_seconds
FROM (SELECT *, {_reasons_sql(EVENT_RULES)} AS reasons FROM event_candidates) t WHERE reasons = ''""")

PRODUCT_RULES = [
    ("name IS NULL OR length(name) < 1 OR length(name) > 255", "name:length"),
    ("length(description) > 4000", "description:length"),
    ("price IS NULL OR price < 0.01", "price:min"),
    ("stock IS NULL OR stock < 0", "stock:min"),
    ("category IS NULL OR length(category) < 1 OR length(category) > 100", "category:length"),
    ("status IS NULL OR status NOT IN ('ACTIVE','INACTIVE','ARCHIVED')", "status:unknown"),
]
sql("product_contract_rejects", ["product_payloads"], f"""
SELECT id, reasons FROM (SELECT id, {_reasons_sql(PRODUCT_RULES)} AS reasons FROM product_payloads) t
WHERE reasons <> ''""")

ORDER_RULES = [
    ("len(items) < 1", "items:empty"),
    ("len(items) > 50", "items:too_many"),
    ("NOT list_bool_and([it.quantity BETWEEN 1 AND 999 FOR it IN items])", "items:quantity"),
    ("promo_code IS NOT NULL AND NOT regexp_full_match(promo_code, '[A-Z0-9_]{4,20}')", "promo_code:pattern"),
]
sql("order_contract_rejects", ["order_payloads"], f"""
SELECT order_id, reasons FROM (SELECT order_id, {_reasons_sql(ORDER_RULES)} AS reasons FROM order_payloads) t
WHERE reasons <> ''""")

LOGIN_RULES = [
    ("username IS NULL OR length(username) < 1", "username:empty"),
    ("password IS NULL OR length(password) < 8 OR length(password) > 72", "password:length"),
]
sql("login_contract_rejects", ["login_payloads"], f"""
SELECT id, reasons FROM (SELECT id, {_reasons_sql(LOGIN_RULES)} AS reasons FROM login_payloads) t
WHERE reasons <> ''""")


def _chk(table: str, rule: str, key: str, cond: str) -> str:
    return f"SELECT '{rule}' AS rule, CAST({key} AS VARCHAR) AS key, CAST(1 AS BIGINT) AS n FROM {table} WHERE {cond}"


def _uniq(table: str, rule: str, cols: list[str]) -> str:
    k = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in cols) if len(cols) > 1 \
        else f"CAST({cols[0]} AS VARCHAR)"
    return f"SELECT '{rule}', k, count(*) FROM (SELECT {k} AS k FROM {table}) u GROUP BY k HAVING count(*) > 1"


def _fk(child: str, col: str, parent: str, pcol: str, rule: str) -> str:
    return (f"SELECT '{rule}', CAST({col} AS VARCHAR), count(*) FROM {child} c WHERE {col} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col}) GROUP BY {col}")


AUDIT = "\nUNION ALL\n".join([
    _chk("products", "products.price_positive", "id", "price <= 0"),
    _chk("products", "products.stock_nonnegative", "id", "stock < 0"),
    _uniq("promo_codes", "promo_codes.code_unique", ["code"]),
    _uniq("users", "users.username_unique", ["username"]),
    _chk("flights", "flights.total_seats_positive", "id", "total_seats <= 0"),
    _chk("flights", "flights.available_nonnegative", "id", "available_seats < 0"),
    _chk("flights", "flights.price_positive", "id", "price <= 0"),
    _chk("flights", "flights.available_within_total", "id", "available_seats > total_seats"),
    _uniq("flights", "flights.number_date_unique", ["flight_number", "CAST(departure_time AS DATE)"]),
    _uniq("seat_requests", "seat_reservations.booking_unique", ["booking_id"]),
    _chk("seat_requests", "seat_reservations.seat_count_positive", "booking_id", "seats <= 0"),
    _chk("bookings", "bookings.seat_count_positive", "booking_id", "seat_count <= 0"),
    _chk("bookings", "bookings.total_price_positive", "booking_id", "total_price <= 0"),
    _uniq("bookings", "bookings.booking_unique", ["booking_id"]),
    _fk("order_items", "product_id", "products", "id", "order_items.product_fk"),
    _fk("order_items", "order_id", "m_orders", "id", "order_items.order_fk"),
    _fk("m_orders", "promo_code", "promo_codes", "code", "orders.promo_fk"),
    _fk("bookings", "flight_id", "flights", "id", "bookings.flight_fk"),
    _fk("seat_requests", "flight_id", "flights", "id", "seat_reservations.flight_fk"),
])
sql("constraint_audit", ["products", "promo_codes", "users", "flights", "seat_requests", "bookings",
                         "order_items", "m_orders"], AUDIT)

sql("session_sequence_audit", ME, """
SELECT s.session_id, s.events, s.starts_ok, coalesce(f.progress_falls, false) AS progress_falls, s.after_finish
FROM (SELECT session_id, count(*) AS events,
             bool_or(rn = 1 AND event_type = 'VIEW_STARTED') AS starts_ok,
             coalesce(max(rn) > min(rn) FILTER (WHERE event_type = 'VIEW_FINISHED'), false) AS after_finish
      FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY event_time, event_id) AS rn
            FROM movie_events) o
      GROUP BY session_id) s
LEFT JOIN (SELECT session_id, bool_or(coalesce(progress_seconds < prior_max, false)) AS progress_falls
           FROM (SELECT session_id, progress_seconds,
                        max(progress_seconds) OVER (PARTITION BY session_id ORDER BY event_time, event_id
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_max
                 FROM movie_events WHERE progress_seconds IS NOT NULL) p
           GROUP BY session_id) f USING (session_id)""")

sql("event_dedup", ["movie_events", "redelivered_events"], """
SELECT event_id, delivery, user_id, movie_id, event_type, event_time, event_date, device_type, session_id,
       progress_seconds
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY delivery, user_id, movie_id, event_type,
                                   event_time, event_date, device_type, session_id, progress_seconds) AS rn
      FROM redelivered_events) t
WHERE rn = 1""")

sql("session_rollup", ME, """
SELECT session_id, min(event_time) AS started_at, max(event_time) AS ended_at,
       max(progress_seconds) FILTER (WHERE lp = 1) AS last_progress,
       count(*) FILTER (WHERE event_type = 'VIEW_FINISHED') > 0 AS finished
FROM (SELECT *, CASE WHEN progress_seconds IS NOT NULL THEN
                  row_number() OVER (PARTITION BY session_id, progress_seconds IS NOT NULL
                                     ORDER BY event_time DESC, event_id DESC) END AS lp
      FROM movie_events) t
GROUP BY session_id""")

# ------------------------------------------------------------------ orders

TOTALS = ("totals", """
SELECT order_id, CAST(sum(price_at_order * quantity) AS DECIMAL(14,2)) AS total FROM order_items GROUP BY order_id""")
def _promo_eval(reaches: str) -> tuple[str, str]:
    """Orders one after the other per code: an order that passes every other
    check uses the code up by one, until nothing is left of it."""
    return ("promo_eval", f"""
SELECT order_id, total, reason,
       CASE WHEN promo_code IS NOT NULL AND reason IS NULL THEN raw ELSE 0 END AS discount,
       total - CASE WHEN promo_code IS NOT NULL AND reason IS NULL THEN raw ELSE 0 END AS net
FROM (SELECT order_id, total, promo_code, raw,
             CASE WHEN promo_code IS NULL THEN NULL
                  WHEN NOT usable OR NOT in_time OR current_uses + earlier >= max_uses THEN 'PROMO_CODE_INVALID'
                  WHEN total < min_order_amount THEN 'PROMO_CODE_MIN_AMOUNT' END AS reason
      FROM (SELECT *, coalesce(sum(CASE WHEN usable AND in_time AND total >= min_order_amount AND {reaches} THEN 1 ELSE 0 END)
                      OVER (PARTITION BY promo_code ORDER BY created_at, order_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
            FROM (SELECT o.id AS order_id, t.total, o.promo_code, o.created_at, p.current_uses, p.max_uses,
                         p.min_order_amount, p.code IS NOT NULL AND p.active AS usable,
                         coalesce(o.created_at >= p.valid_from AND o.created_at <= p.valid_until, false) AS in_time,
                         CASE WHEN p.discount_type <> 'PERCENTAGE' THEN least(p.discount_value, t.total)
                              WHEN p.discount_value > 70 THEN 0 ELSE t.total * p.discount_value / 100 END AS raw
                  FROM m_orders o JOIN totals t ON o.id = t.order_id
                  LEFT JOIN promo_codes p ON o.promo_code = p.code) w) y) x""")


PROMO_EVAL = _promo_eval("true")
ORD_VIEWS = ["m_orders", "order_items", "promo_codes"]

sql("order_totals", ["order_items"], "SELECT * FROM totals", [TOTALS])

sql("promo_discounts", ORD_VIEWS, """
SELECT order_id, CAST(total AS DOUBLE) AS total, reason, round(CAST(discount AS DOUBLE), 6) AS discount,
       round(CAST(net AS DOUBLE), 6) AS net FROM promo_eval""", [TOTALS, PROMO_EVAL])

sql("active_order_conflicts", ["m_orders"], """
SELECT user_id, count(*) AS n FROM m_orders WHERE status IN ('CREATED', 'PAYMENT_PENDING')
GROUP BY user_id HAVING count(*) > 1""")

sql("rate_limit_hits", ["user_operations"], f"""
SELECT user_id, op_id, prev_at FROM (
  SELECT user_id, op_id, created_at,
         max(created_at) OVER (PARTITION BY user_id ORDER BY created_at, op_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_at
  FROM user_operations WHERE operation_type = 'CREATE_ORDER') t
WHERE prev_at >= created_at - INTERVAL {P.RATE_LIMIT_SECONDS} SECOND""")

# the checks before the promo code; a line sees the stock less what its order took on earlier lines
EARLIER = ("earlier_checks", f"""
SELECT o.id AS order_id,
       CASE WHEN pl.n IS NULL THEN 'VALIDATION_ERROR'
            WHEN EXISTS (SELECT 1 FROM user_operations u WHERE u.user_id = o.user_id
                           AND u.operation_type = 'CREATE_ORDER' AND u.created_at < o.created_at
                           AND u.created_at >= o.created_at - INTERVAL {P.RATE_LIMIT_SECONDS} SECOND)
                 THEN 'ORDER_LIMIT_EXCEEDED'
            WHEN EXISTS (SELECT 1 FROM m_orders a WHERE a.user_id = o.user_id
                           AND a.status IN ('CREATED', 'PAYMENT_PENDING')
                           AND (a.created_at < o.created_at OR (a.created_at = o.created_at AND a.id < o.id)))
                 THEN 'ORDER_HAS_ACTIVE'
            ELSE pl.r END AS reason
FROM m_orders o
LEFT JOIN (SELECT order_id, count(*) AS n, arg_min(r, (line_no, r)) FILTER (WHERE r IS NOT NULL) AS r
           FROM (SELECT i.order_id, i.line_no,
                        CASE WHEN p.id IS NULL THEN 'PRODUCT_NOT_FOUND'
                             WHEN p.status <> 'ACTIVE' THEN 'PRODUCT_INACTIVE'
                             WHEN p.stock - coalesce(sum(i.quantity) OVER (
                                      PARTITION BY i.order_id, i.product_id ORDER BY i.line_no, i.quantity, i.price_at_order
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < i.quantity
                                  THEN 'INSUFFICIENT_STOCK' END AS r
                 FROM order_items i LEFT JOIN products p ON i.product_id = p.id) q
           GROUP BY order_id) pl ON pl.order_id = o.id""")
sql("order_admission", ORD_VIEWS + ["products", "user_operations"], """
SELECT e.order_id, coalesce(e.reason, p.reason) AS reason
FROM earlier_checks e LEFT JOIN promo_eval p ON p.order_id = e.order_id""",
    [TOTALS, EARLIER, _promo_eval("(SELECT any_value(e.reason) FROM earlier_checks e WHERE e.order_id = w.order_id) IS NULL")])

sql("stock_oversell", ["m_orders", "order_items", "products"], """
SELECT product_id, order_id, line_no, CAST(demand AS BIGINT) AS demand, CAST(stock AS BIGINT) AS stock,
       demand > stock AS oversold, demand > stock AND demand - quantity <= stock AS first_oversell
FROM (SELECT i.product_id, i.order_id, i.line_no, i.quantity, p.stock,
             sum(i.quantity) OVER (PARTITION BY i.product_id ORDER BY o.created_at, i.order_id, i.line_no,
                                   i.quantity, i.price_at_order ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 AS demand
      FROM order_items i JOIN m_orders o ON i.order_id = o.id JOIN products p ON p.id = i.product_id) t""")

OWN = ("own", """
SELECT r.order_id AS id, r.caller_id AS caller,
       coalesce(c.role = 'ADMIN' OR r.caller_id = o.user_id, false) AS allowed
FROM cancel_requests r JOIN m_orders o ON r.order_id = o.id LEFT JOIN callers c ON c.user_id = r.caller_id""")

sql("ownership_violations", ["m_orders", "cancel_requests", "callers"], "SELECT * FROM own", [OWN])

sql("cancel_effects", ["m_orders", "order_items", "promo_codes", "cancel_requests", "callers"], """
SELECT 'product' AS kind, CAST(i.product_id AS VARCHAR) AS key, CAST(sum(i.quantity) AS BIGINT) AS delta
FROM order_items i JOIN legal l ON i.order_id = l.id GROUP BY i.product_id
UNION ALL
SELECT 'promo', l.promo_code, CAST(-count(*) AS BIGINT) FROM legal l JOIN promo_codes p ON p.code = l.promo_code
GROUP BY l.promo_code""", [OWN, ("legal", """
SELECT * FROM m_orders WHERE status IN ('CREATED', 'PAYMENT_PENDING')
AND id IN (SELECT id FROM own WHERE allowed)""")])

sql("promo_usage", ORD_VIEWS, """
SELECT p.code, CAST(p.current_uses + coalesce(u.uses, 0) AS BIGINT) AS uses, CAST(p.max_uses AS BIGINT) AS max_uses,
       p.current_uses + coalesce(u.uses, 0) >= p.max_uses AS exhausted
FROM promo_codes p LEFT JOIN (
  SELECT o.promo_code, count(*) AS uses FROM promo_eval e JOIN m_orders o ON o.id = e.order_id
  WHERE e.reason IS NULL AND o.promo_code IS NOT NULL GROUP BY o.promo_code) u ON u.promo_code = p.code""",
    [TOTALS, PROMO_EVAL])

sql("product_page", ["products"], f"""
SELECT id, name, CAST(price AS DOUBLE) AS price, stock, category, status,
       (SELECT count(*) FROM products WHERE status = '{P.PAGE_STATUS}') AS total_elements
FROM products WHERE status = '{P.PAGE_STATUS}' ORDER BY id LIMIT {P.PAGE_SIZE} OFFSET {P.PAGE * P.PAGE_SIZE}""")

sql("lookup_missing_keys", ["order_items", "products", "seat_requests", "flights", "cancel_requests", "callers"], """
SELECT DISTINCT 'product' AS lookup, CAST(product_id AS VARCHAR) AS key FROM order_items
WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT id FROM products)
UNION ALL
SELECT DISTINCT 'flight', CAST(flight_id AS VARCHAR) FROM seat_requests
WHERE flight_id IS NOT NULL AND flight_id NOT IN (SELECT id FROM flights)
UNION ALL
SELECT DISTINCT 'caller', CAST(caller_id AS VARCHAR) FROM cancel_requests
WHERE caller_id IS NOT NULL AND caller_id NOT IN (SELECT user_id FROM callers)""")

sql("apply_product_changes", ["products", "product_changes"], """
SELECT p.id, coalesce(u.name, p.name) AS name, coalesce(u.description, p.description) AS description,
       CAST(coalesce(u.price, p.price) AS DOUBLE) AS price, CAST(coalesce(u.stock, p.stock) AS INTEGER) AS stock,
       coalesce(u.category, p.category) AS category,
       CASE l.op WHEN 'DELETE' THEN 'ARCHIVED' WHEN 'UPDATE' THEN l.status ELSE p.status END AS status,
       l.changed_at AS updated_at
FROM products p
LEFT JOIN (SELECT * FROM feed WHERE place = 1) l ON l.id = p.id
LEFT JOIN (SELECT * FROM feed WHERE op = 'UPDATE' AND place_of_op = 1) u ON u.id = p.id""", [("feed", """
SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed_at DESC, price DESC, stock DESC, name DESC, description DESC,
                             category DESC, status DESC, src_order DESC, src_line DESC, src_price DESC, op DESC) AS place,
       row_number() OVER (PARTITION BY id, op ORDER BY changed_at DESC, price DESC, stock DESC, name DESC, description DESC,
                             category DESC, status DESC, src_order DESC, src_line DESC, src_price DESC) AS place_of_op
FROM product_changes""")])

# ----------------------------------------------------------------- flights

sql("flight_search", ["flights"], f"""
SELECT id, flight_number, airline, origin_code, destination_code, departure_time, arrival_time, total_seats,
       available_seats, CAST(price AS DOUBLE) AS price, status
FROM flights WHERE origin_code = '{P.SEARCH_ORIGIN}' AND destination_code = '{P.SEARCH_DESTINATION}'
  AND status = 'SCHEDULED' AND CAST(departure_time AS DATE) = DATE '{P.SEARCH_DATE}'""")

sql("user_bookings", ["bookings"], f"""
SELECT * FROM bookings WHERE user_id = '{P.BOOKING_USER}' ORDER BY created_at DESC, booking_id DESC""")

sql("booking_pricing", ["bookings", "flights"], """
SELECT b.booking_id, b.seat_count, CAST(f.price AS DOUBLE) AS price,
       CAST(CAST(b.seat_count * f.price AS DECIMAL(12,2)) AS DOUBLE) AS total_price
FROM bookings b JOIN flights f ON f.id = b.flight_id""")

# The calls one by one, in order of arrival.  Bookings of the fixture stay inside a block of four
# flights, so blocks are folded side by side: seats left of its flights, and the reservations made.
SEAT_FOLD = [("calls", """
SELECT *, row_number() OVER (PARTITION BY block ORDER BY seq) AS i FROM seat_calls"""),
    ("caps", """
SELECT b.block, list_transform([0, 1, 2, 3], lambda k: b.caps[b.block * 4 + k]) AS seats_left
FROM (SELECT block, (SELECT MAP(list(id), list(CAST(available_seats AS BIGINT))) FROM flights) AS caps FROM (SELECT DISTINCT block FROM calls) x) b"""),
    ("fold", """
SELECT block, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, seats_left,
       CAST([] AS STRUCT(b VARCHAR, f BIGINT, s BIGINT, live BOOLEAN)[]) AS made,
       CAST(NULL AS VARCHAR) AS status, CAST(NULL AS BIGINT) AS flight_id, CAST(NULL AS BIGINT) AS seats FROM caps
UNION ALL
SELECT block, i, seq,
       CASE status WHEN 'ACTIVE' THEN list_transform([0, 1, 2, 3], lambda k: seats_left[k + 1] - CASE WHEN k = flight_id % 4 THEN seats ELSE 0 END)
                   WHEN 'RELEASED' THEN list_transform([0, 1, 2, 3], lambda k: seats_left[k + 1] + CASE WHEN k = own.f % 4 THEN own.s ELSE 0 END)
                   ELSE seats_left END,
       CASE status WHEN 'ACTIVE' THEN list_append(made, {'b': booking_id, 'f': flight_id, 's': seats, 'live': true})
                   WHEN 'RELEASED' THEN list_transform(made, lambda x: CASE WHEN x.b = booking_id THEN {'b': x.b, 'f': x.f, 's': x.s, 'live': false} ELSE x END)
                   ELSE made END,
       status, CASE op WHEN 'RESERVE' THEN flight_id WHEN 'RELEASE' THEN CASE WHEN status = 'RELEASED' THEN own.f END END,
       CASE op WHEN 'RESERVE' THEN seats WHEN 'RELEASE' THEN CASE WHEN status = 'RELEASED' THEN own.s END END
FROM (SELECT *, CASE WHEN op = 'RELEASE' THEN CASE WHEN coalesce(own.live, false) THEN 'RELEASED' ELSE 'NOT_FOUND' END
                     WHEN own.b IS NOT NULL THEN 'EXISTING'
                     WHEN flight_id >= 1000000000 OR seats_left[flight_id % 4 + 1] IS NULL THEN 'NOT_FOUND'
                     WHEN seats_left[flight_id % 4 + 1] >= seats THEN 'ACTIVE' ELSE 'RESOURCE_EXHAUSTED' END AS status
      FROM (SELECT f.block, c.i, c.seq, f.seats_left, f.made, c.op, c.booking_id, c.flight_id, CAST(c.seats AS BIGINT) AS seats,
                   list_filter(f.made, lambda x: x.b = c.booking_id)[1] AS own
            FROM fold f JOIN calls c ON c.block = f.block AND c.i = f.i + 1) y) z"""),
    ("ledger", """
SELECT f.seq, c.op, c.booking_id, f.flight_id, f.seats, f.status,
       CASE WHEN f.flight_id < 1000000000 THEN f.seats_left[f.flight_id % 4 + 1] END AS remaining
FROM fold f JOIN calls c USING (seq)""")]


def _recursive(views: list[str], body: str, extra) -> str:
    q = with_views(views, body, extra)
    return "WITH RECURSIVE " + q[len("WITH "):]


ORACLE["seat_reservation"] = _recursive(["flights", "seat_calls"], "SELECT * EXCLUDE (op) FROM ledger WHERE op = 'RESERVE'", SEAT_FOLD)

ORACLE["seat_release"] = _recursive(["flights", "seat_calls"], "SELECT * EXCLUDE (op) FROM ledger WHERE op = 'RELEASE'", SEAT_FOLD)

ORACLE["seat_reconciliation"] = _recursive(["flights", "flights_after", "seat_calls"], """
SELECT f.id AS flight_id, CAST(f.total_seats AS BIGINT) AS total_seats, CAST(coalesce(h.held, 0) AS BIGINT) AS held,
       CAST(f.available_seats AS BIGINT) AS available,
       CAST(f.available_seats - (f.total_seats - coalesce(h.held, 0)) AS BIGINT) AS drift
FROM flights_after f LEFT JOIN (
  SELECT flight_id, sum(seats) AS held FROM ledger a WHERE status = 'ACTIVE'
    AND booking_id NOT IN (SELECT booking_id FROM ledger WHERE status = 'RELEASED') GROUP BY flight_id) h ON h.flight_id = f.id""", SEAT_FOLD)

sql("booking_transitions", ["booking_events"], """
SELECT booking_id, action, event_at, from_status,
       CASE WHEN legal AND action = 'CREATE' THEN 'CONFIRMED' WHEN legal AND action = 'CANCEL' THEN 'CANCELLED'
            ELSE from_status END AS to_status, legal
FROM (SELECT *, (action = 'CREATE' AND from_status IS NULL) OR (action = 'CANCEL' AND from_status IS NOT DISTINCT FROM 'CONFIRMED')
                AS legal
      FROM (SELECT e.*, CASE WHEN c.c_at IS NULL OR e.event_at < c.c_at OR (e.event_at = c.c_at AND e.action = 'CREATE') THEN NULL
                             WHEN x.x_at IS NULL OR e.event_at <= x.x_at THEN 'CONFIRMED' ELSE 'CANCELLED' END AS from_status
            FROM booking_events e
            LEFT JOIN (SELECT booking_id, min(event_at) AS c_at FROM booking_events WHERE action = 'CREATE'
                       GROUP BY booking_id) c USING (booking_id)
            LEFT JOIN (SELECT e2.booking_id, min(e2.event_at) AS x_at FROM booking_events e2
                       JOIN (SELECT booking_id, min(event_at) AS c_at FROM booking_events WHERE action = 'CREATE'
                             GROUP BY booking_id) c2 USING (booking_id)
                       WHERE e2.action = 'CANCEL' AND e2.event_at > c2.c_at GROUP BY e2.booking_id) x USING (booking_id)) s) t""")

sql("provider_failure_window", ["call_log"], f"""
SELECT provider, seq, failures, seq >= {P.FAILURE_WINDOW} AND failures >= {P.FAILURE_THRESHOLD} AS window_bad,
       seq >= {P.FAILURE_WINDOW} AND failures >= {P.FAILURE_THRESHOLD} AND failed = 1 AS trips
FROM (SELECT provider, failed,
             row_number() OVER w AS seq,
             CAST(sum(failed) OVER (w ROWS BETWEEN {P.FAILURE_WINDOW - 1} PRECEDING AND CURRENT ROW) AS INTEGER)
                 AS failures
      FROM (SELECT *, CASE WHEN code IN ('OK', 'NOT_FOUND', 'RESOURCE_EXHAUSTED', 'INVALID_ARGUMENT') THEN 0 ELSE 1 END
                      AS failed FROM call_log) c
      WINDOW w AS (PARTITION BY provider ORDER BY ts, call_id)) t""")

# ----------------------------------------------------------- notifications

IDEM = "sha256(concat_ws('|', source_service, CAST(notification_id AS VARCHAR), user_id))"

sql("notif_keys", ["attempts"], f"SELECT attempt_id, {IDEM} AS idem_key FROM attempts")

ROUTABLE = ("routable", """
SELECT n.notification_id, n.user_key, n.type, p.preferred_channel FROM notifications n
LEFT JOIN preferences p USING (user_key)
WHERE n.type = 'TRANSACTIONAL' OR NOT coalesce(list_contains(p.opted_out_types, n.type), false)""")

sql("notif_routable", ["notifications", "preferences"], "SELECT * FROM routable", [ROUTABLE])

sql("notif_channel_plan", ["notifications", "preferences"], """
SELECT notification_id,
       CASE WHEN preferred_channel IS NULL THEN 'push,sms,email'
            ELSE preferred_channel || ',' ||
                 array_to_string([x FOR x IN ['push', 'sms', 'email'] IF x <> preferred_channel], ',') END AS channels
FROM routable""", [ROUTABLE])

ACK_AT = "a.ts + to_milliseconds(CAST(a.latency_ms AS BIGINT))"
# a user's chain: the preferred channel, then the others in the configured order
CHAINS = ("chains", """
SELECT 'user_' || CAST(user_key AS VARCHAR) AS user_id,
       [preferred_channel] || list_filter(['push', 'sms', 'email'], lambda x: x <> preferred_channel) AS chain
FROM preferences""")
sql("notif_failover", ["attempts", "preferences"], f"""
SELECT a.notification_id, a.channel AS failed_channel,
       coalesce(u.chain, ['push', 'sms', 'email'])[list_position(coalesce(u.chain, ['push', 'sms', 'email']), a.channel) + 1]
           AS next_channel,
       CASE WHEN a.outcome = 'FAILED' THEN 'FAILED' ELSE 'ACK_TIMEOUT' END AS reason, a.attempt_id
FROM attempts a LEFT JOIN chains u ON u.user_id = a.user_id
WHERE a.outcome = 'FAILED' OR NOT EXISTS (
  SELECT 1 FROM (SELECT notification_id, channel, {ACK_AT} AS ack_at FROM attempts a WHERE outcome = 'DELIVERED') k
  WHERE k.notification_id = a.notification_id AND k.channel = a.channel
    AND k.ack_at >= a.ts AND k.ack_at <= a.ts + INTERVAL 5 SECOND)""", [CHAINS])

ALLOWED_SQL = " OR ".join(f"(state = '{a}' AND event = '{b}')" for a, b in [
    ("", "PENDING"), ("PENDING", "IN_FLIGHT"), ("IN_FLIGHT", "DELIVERED"), ("IN_FLIGHT", "FAILED"),
    ("FAILED", "FAILOVER"), ("FAILOVER", "IN_FLIGHT"), ("FAILED", "EXHAUSTED")])
NOTIF_STATE = [CHAINS, ("ev", f"""
SELECT *, row_number() OVER (PARTITION BY notification_id ORDER BY event_at, attempt_id, step) AS i
FROM (SELECT notification_id, min_by(attempt_id, (ts, attempt_id)) AS attempt_id, 0 AS step, 'PENDING' AS event, min(ts) AS event_at
      FROM attempts GROUP BY notification_id
      UNION ALL SELECT notification_id, attempt_id, 1, 'IN_FLIGHT', ts FROM attempts
      UNION ALL SELECT notification_id, attempt_id, 2, outcome, {ACK_AT} FROM attempts a
      UNION ALL SELECT notification_id, attempt_id, 3,
                       CASE WHEN list_position(coalesce(u.chain, ['push', 'sms', 'email']), a.channel) < len(coalesce(u.chain, ['push', 'sms', 'email']))
                            THEN 'FAILOVER' ELSE 'EXHAUSTED' END, {ACK_AT}
                FROM attempts a LEFT JOIN chains u ON u.user_id = a.user_id WHERE outcome = 'FAILED') e"""),
    ("machine", f"""
SELECT notification_id, CAST(0 AS BIGINT) AS i, '' AS state, CAST(NULL AS TIMESTAMP) AS since, CAST(0 AS BIGINT) AS legal_moves, CAST(0 AS BIGINT) AS illegal_moves
FROM (SELECT DISTINCT notification_id FROM ev) n
UNION ALL
SELECT notification_id, i, CASE WHEN ok THEN event ELSE state END, CASE WHEN ok THEN event_at ELSE since END,
       legal_moves + CAST(ok AS BIGINT), illegal_moves + CAST(NOT ok AS BIGINT)
FROM (SELECT m.*  EXCLUDE (i), e.i, e.event, e.event_at, ({ALLOWED_SQL}) AS ok
      FROM machine m JOIN ev e ON e.notification_id = m.notification_id AND e.i = m.i + 1) s""")]

sql("notif_lanes", ["notifications"], """
SELECT CASE type WHEN 'TRANSACTIONAL' THEN 'transactional' WHEN 'SERVICE' THEN 'service'
                 WHEN 'MARKETING' THEN 'marketing' END AS lane, count(*) AS n
FROM notifications GROUP BY 1""")

sql("notif_dlq", ["attempts", "preferences"], """
SELECT a.notification_id, count(DISTINCT a.channel) AS tried
FROM attempts a LEFT JOIN chains u ON u.user_id = a.user_id GROUP BY a.notification_id
HAVING NOT bool_or(a.outcome = 'DELIVERED') AND count(DISTINCT a.channel) = len(coalesce(any_value(u.chain), ['push', 'sms', 'email']))""",
    [CHAINS])

sql("notif_kpis", ["attempts"], """
SELECT c.channel, c.type, c.n, round(c.p99_ms, 6) AS p99_ms, round(t.reached, 6) AS success_rate, round(t.sms, 6) AS sms_share,
       CAST(t.again AS BIGINT) AS duplicates, c.p99_ms <= 5000 AS p99_ok, t.reached >= 0.995 AS success_ok, t.sms <= 0.15 AS sms_ok
FROM (SELECT channel, type, count(*) AS n, quantile_cont(CAST(latency_ms AS DOUBLE), 0.99) AS p99_ms
      FROM attempts GROUP BY channel, type) c
JOIN (SELECT type, avg(CASE WHEN ok > 0 THEN 1.0 ELSE 0.0 END) AS reached, avg(CASE WHEN any_sms THEN 1.0 ELSE 0.0 END) AS sms,
             sum(CASE WHEN ok > 1 THEN ok - 1 ELSE 0 END) AS again
      FROM (SELECT type, notification_id, sum(CASE WHEN outcome = 'DELIVERED' THEN 1 ELSE 0 END) AS ok,
                   bool_or(channel = 'sms') AS any_sms
            FROM attempts GROUP BY type, notification_id) n GROUP BY type) t USING (type)""")

sql("notif_success_24h", ["attempts"], """
SELECT channel, type, make_timestamp((hour_no + 1) * 3600 * 1000000) AS window_end, attempts, delivered,
       round(delivered / attempts, 6) AS success_rate, delivered / attempts >= 0.995 AS success_ok
FROM (SELECT channel, type, hour_no,
             sum(n_h) OVER w AS attempts, sum(ok_h) OVER w AS delivered
      FROM (SELECT channel, type, CAST(floor(epoch(ts) / 3600) AS BIGINT) AS hour_no, count(*) AS n_h,
                   count(*) FILTER (WHERE outcome = 'DELIVERED') AS ok_h
            FROM attempts GROUP BY ALL) h
      WINDOW w AS (PARTITION BY channel, type ORDER BY hour_no RANGE BETWEEN 23 PRECEDING AND CURRENT ROW)) t""")

sql("campaign_batches", ["campaign_recipients"], f"""
SELECT user_key, CAST(floor((rn - 1) / {P.CAMPAIGN_RATE}) AS BIGINT) AS slot,
       CAST(floor((rn - 1) / 1000) AS BIGINT) AS batch_no
FROM (SELECT user_key, row_number() OVER (ORDER BY user_key) AS rn FROM campaign_recipients) t""")

sql("outbox_events", ["outbox"], """
SELECT aggregate_id, state, written_at, amount,
       '{"aggregate_id":' || CAST(aggregate_id AS VARCHAR) || ',"state":"' || state || '","amount":'
       || CAST(amount AS VARCHAR) || '}' AS payload
FROM (SELECT *, row_number() OVER (PARTITION BY aggregate_id ORDER BY written_at DESC, state DESC, amount DESC) AS rn
      FROM outbox) t WHERE rn = 1""")

sql("outbox_feed", ["outbox_changes"], """
SELECT *, '{"aggregate_id":' || CAST(aggregate_id AS VARCHAR) || ',"state":"' || state || '","amount":' || CAST(amount AS VARCHAR) || '}' AS payload
FROM outbox_changes""")

sql("published_counts", ME, """
SELECT event_type, count(*) AS observed, count(*) AS written FROM movie_events GROUP BY event_type""")

RETRY_DEDUP = [("ra", f"""
SELECT *, {IDEM} AS idem_key,
       row_number() OVER (PARTITION BY {IDEM}, channel ORDER BY ts, attempt_id) AS rn
FROM retried_attempts"""),
    ("chain", """
SELECT idem_key, channel, rn, ts AS last_kept, true AS kept FROM ra WHERE rn = 1
UNION ALL
SELECT r.idem_key, r.channel, r.rn,
       CASE WHEN r.ts >= c.last_kept + INTERVAL 24 HOUR THEN r.ts ELSE c.last_kept END,
       r.ts >= c.last_kept + INTERVAL 24 HOUR
FROM chain c JOIN ra r ON r.idem_key = c.idem_key AND r.channel = c.channel AND r.rn = c.rn + 1""")]
ORACLE["notif_dedup"] = _recursive(["retried_attempts"], """
SELECT r.attempt_id, r.notification_id, r.user_id, r.source_service, r.type, r.channel, r.outcome, r.ts,
       r.latency_ms, r.idem_key
FROM ra r JOIN chain c USING (idem_key, channel, rn) WHERE c.kept""", RETRY_DEDUP)

ORACLE["notif_state"] = _recursive(["attempts", "preferences"], """
SELECT notification_id, CASE WHEN state <> '' THEN state END AS state, since, legal_moves, illegal_moves
FROM machine QUALIFY row_number() OVER (PARTITION BY notification_id ORDER BY i DESC) = 1""", NOTIF_STATE)

# --------------------------------------------------------------- streaming

sql("stream_ingest", ME, """
SELECT '00000000-0000-4000-8000-' || lpad(event_id, 12, '0') AS event_id, user_id, movie_id, event_type, date_trunc('millisecond', event_time) AS event_time, event_date,
       device_type, session_id, progress_seconds
FROM movie_events""")

sql("incremental_equals_full", ME, """
SELECT event_date, movie_id, count(*) AS views FROM movie_events
WHERE event_type = 'VIEW_STARTED' GROUP BY event_date, movie_id""")

sql("incremental_watch_time", ME, """
SELECT event_date, sum(progress_seconds) AS sum_sec, count(progress_seconds) AS n FROM movie_events
WHERE event_type = 'VIEW_FINISHED' AND progress_seconds IS NOT NULL GROUP BY event_date""")

sql("incremental_dau", ME, """
SELECT event_date, count(DISTINCT user_id) AS dau FROM movie_events GROUP BY event_date""")

sql("tumbling_counts", ME, """
SELECT time_bucket(INTERVAL 1 DAY, event_time) AS window_start, event_type, count(*) AS n
FROM movie_events GROUP BY 1, 2""")

sql("latest_metrics", ME, """
SELECT * FROM m_merged ORDER BY metric_date DESC, metric_name, dimensions, computed_at LIMIT 20""", CYCLE)
