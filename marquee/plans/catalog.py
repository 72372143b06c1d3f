"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

Each query reads the driver's tables through the fixture views and runs an
operator over all of their rows.  ``finish`` normalises numeric output the
way the oracle does (decimals as doubles, doubles rounded to 6 places).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources import fixtures as fx
from ..operators import metrics as m
from ..operators import retention as r
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def finish(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c, 6)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def register(name: str):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


def _day_after(day: str) -> str:
    import datetime as dt
    return (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()


# ------------------------------------------------------------------ metrics

@register("dau_state_merge")
def q_dau_state_merge(spark, sf):
    """A1/A2: the users of each day and device, united per day."""
    return m.user_days_merge(m.user_days(fx.movie_events(spark, sf), "device_type"))


@register("dau_for_date")
def q_dau_for_date(spark, sf):
    me = fx.movie_events(spark, sf, P.RUN_DATE, _day_after(P.RUN_DATE))
    return m.dau_for_date(me, P.RUN_DATE)


@register("movie_views_state")
def q_movie_views_state(spark, sf):
    return m.movie_views_state(fx.movie_events(spark, sf))


@register("top_movies_daily")
def q_top_movies_daily(spark, sf):
    me = fx.movie_events(spark, sf, P.RUN_DATE, _day_after(P.RUN_DATE))
    return m.top_movies_daily(m.movie_views_state(me), P.RUN_DATE, P.TOP_N)


@register("watch_time_state")
def q_watch_time_state(spark, sf):
    return m.watch_time_state(fx.movie_events(spark, sf))


@register("avg_watch_time_for_date")
def q_avg_watch_time_for_date(spark, sf):
    me = fx.movie_events(spark, sf, P.RUN_DATE, _day_after(P.RUN_DATE))
    return m.avg_watch_time_for_date(m.watch_time_state(me), P.RUN_DATE)


@register("conversion_for_date")
def q_conversion_for_date(spark, sf):
    me = fx.movie_events(spark, sf, P.RUN_DATE, _day_after(P.RUN_DATE))
    return m.conversion_for_date(me, P.RUN_DATE)


@register("conversion_series")
def q_conversion_series(spark, sf):
    return m.conversion_series(fx.movie_events(spark, sf), P.RANGE_START, P.RANGE_END)


@register("dau_series")
def q_dau_series(spark, sf):
    return m.dau_series(fx.movie_events(spark, sf), P.RANGE_START, P.RANGE_END)


@register("watch_time_series")
def q_watch_time_series(spark, sf):
    return m.watch_time_series(m.watch_time_state(fx.movie_events(spark, sf)), P.RANGE_START, P.RANGE_END)


@register("top_movies_range")
def q_top_movies_range(spark, sf):
    return m.top_movies_range(fx.movie_events(spark, sf), P.RANGE_START, P.RANGE_END, P.TOP_N)


@register("device_share")
def q_device_share(spark, sf):
    return m.device_share(fx.movie_events(spark, sf), P.RANGE_START, P.RANGE_END)


@register("events_by_type")
def q_events_by_type(spark, sf):
    return m.events_by_type(fx.movie_events(spark, sf))


@register("conversion_last")
def q_conversion_last(spark, sf):
    return m.conversion_last(m.conversion_series(fx.movie_events(spark, sf), P.RANGE_START, P.RANGE_END))


@register("metrics_long")
def q_metrics_long(spark, sf):
    me = fx.movie_events(spark, sf, P.RUN_DATE, _day_after(P.RUN_DATE))
    return m.metrics_long(me, P.RUN_DATE)


# ---------------------------------------------------------------- retention

@register("first_activity")
def q_first_activity(spark, sf):
    return r.first_activity(fx.movie_events(spark, sf))


@register("retention_cohort")
def q_retention_cohort(spark, sf):
    return r.retention_cohort(fx.movie_events(spark, sf), P.COHORT_DATE, P.MAX_DAY_OFFSET)


@register("retention_heatmap")
def q_retention_heatmap(spark, sf):
    return r.retention_heatmap(fx.movie_events(spark, sf), P.HEATMAP_LIMIT, P.MAX_DAY_OFFSET)


@register("retention_for_run")
def q_retention_for_run(spark, sf):
    return r.retention_for_run(fx.movie_events(spark, sf), P.RUN_DATE, P.MAX_DAY_OFFSET)


@register("retention_bands")
def q_retention_bands(spark, sf):
    return r.retention_bands(r.retention_all_cohorts(fx.movie_events(spark, sf), P.MAX_DAY_OFFSET))


# ------------------------------------------------------- ingest and storage

from ..sources import events as ev  # noqa: E402
from ..operators import store as st  # noqa: E402
from ..operators import export as ex  # noqa: E402
from . import daily_cycle as dc  # noqa: E402
from ..session import scratch_path  # noqa: E402


@register("ingest_typed")
def q_ingest_typed(spark, sf):
    return ev.type_events(fx.raw_event_rows(spark, sf))


@register("raw_roundtrip")
def q_raw_roundtrip(spark, sf):
    """S3: typed events written to the day-partitioned store and read back."""
    path = scratch_path(spark, "raw-store")
    stored = ev.with_store_columns(ev.type_events(fx.raw_event_rows(spark, sf)))
    st.append_raw_events(stored, path)
    back = st.read_raw_events(spark, path)
    return back.select(*ev.STORED_COLUMNS)


@register("raw_append_two_batches")
def q_raw_append_two_batches(spark, sf):
    """S3: two batches that share their days, appended one after the other;
    then one day rewritten from its own rows.  Nothing may be lost."""
    path = scratch_path(spark, "raw-store")
    stored = ev.with_store_columns(ev.type_events(fx.raw_event_rows(spark, sf)))
    early = F.coalesce(F.hour("event_time") < P.PARTIAL_CUTOFF_HOUR, F.lit(True))
    st.append_raw_events(stored.where(early), path)
    st.append_raw_events(stored.where(~early), path)
    st.rewrite_raw_days(stored.where(F.col("event_date") == F.lit(P.RUN_DATE).cast("date")), path)
    return st.read_raw_events(spark, path).select(*ev.STORED_COLUMNS)


@register("raw_ttl_filter")
def q_raw_ttl_filter(spark, sf):
    return st.ttl_filter(fx.movie_events(spark, sf), P.TTL_AS_OF, P.TTL_DAYS)


def _earlier_run(me):
    """What a run during each day saw: events before PARTIAL_CUTOFF_HOUR."""
    return me.where(F.hour("event_time") < P.PARTIAL_CUTOFF_HOUR)


def _earlier_stamp():
    return (F.col("metric_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(P.PARTIAL_CUTOFF_HOUR)))


def _existing_tables(me):
    early = _earlier_run(me)
    metrics = m.metrics_long_by_day(early).withColumn("computed_at", _earlier_stamp())
    top = m.top_movies_by_day(m.movie_views_state(early), P.TOP_N).withColumn("computed_at", _earlier_stamp())
    ret = (r.retention_all_cohorts(early, P.MAX_DAY_OFFSET)
           .withColumn("computed_at", F.col("cohort_date").cast("timestamp")
                       + F.make_dt_interval(hours=F.lit(P.PARTIAL_CUTOFF_HOUR))))
    return metrics, top, ret


@register("upsert_metrics")
def q_upsert_metrics(spark, sf):
    me = fx.movie_events(spark, sf)
    existing, _, _ = _existing_tables(me)
    new, _, _ = dc.cycle_frames_for_date(me, P.RUN_DATE, P.COMPUTED_AT, P.TOP_N)
    return st.key_merge(existing, new, dc.METRIC_KEY_DEFAULT)


@register("upsert_metrics_by_name")
def q_upsert_metrics_by_name(spark, sf):
    me = fx.movie_events(spark, sf)
    existing, _, _ = _existing_tables(me)
    new, _, _ = dc.cycle_frames_for_date(me, P.RUN_DATE, P.COMPUTED_AT, P.TOP_N)
    return st.key_merge(existing, new, dc.METRIC_KEY_BY_NAME)


@register("replace_top_day")
def q_replace_top_day(spark, sf):
    me = fx.movie_events(spark, sf)
    _, existing, _ = _existing_tables(me)
    _, new, _ = dc.cycle_frames_for_date(me, P.RUN_DATE, P.COMPUTED_AT, P.TOP_N)
    return st.replace_partition(existing, new, "metric_date", [P.RUN_DATE])


@register("replace_top_day_empty")
def q_replace_top_day_empty(spark, sf):
    """A re-run that finds no rows for its day leaves none there."""
    _, existing, _ = _existing_tables(fx.movie_events(spark, sf))
    path = scratch_path(spark, "top-movies")
    st.upsert_table(spark, path, existing, ["metric_date"], "metric_date")
    return st.upsert_table(spark, path, existing.limit(0), ["metric_date"], "metric_date", replace=[P.RUN_DATE])


@register("upsert_retention")
def q_upsert_retention(spark, sf):
    me = fx.movie_events(spark, sf)
    _, _, existing = _existing_tables(me)
    _, _, new = dc.cycle_frames_for_date(me, P.RUN_DATE, P.COMPUTED_AT, P.TOP_N)
    return st.key_merge(existing, new, ["cohort_date", "day_offset"])


@register("daily_cycle")
def q_daily_cycle(spark, sf):
    """U4 end to end: seed the three tables with the earlier runs, run the
    cycle for RUN_DATE (three partition upserts), return the rows it left."""
    me = fx.movie_events(spark, sf)
    root = scratch_path(spark, "metric-tables")
    em, et, er = _existing_tables(me)
    st.upsert_table(spark, f"{root}/metrics_daily", em, dc.METRIC_KEY_DEFAULT, "metric_date")
    st.upsert_table(spark, f"{root}/top_movies_daily", et, ["metric_date"], "metric_date")
    st.upsert_table(spark, f"{root}/retention_cohort", er, ["cohort_date", "day_offset"], "cohort_date")
    run = dc.daily_cycle(spark, me, root, P.RUN_DATE, F.lit(P.COMPUTED_AT).cast("timestamp"))
    return dc.cycle_rows(run["tables"], P.RUN_DATE)


def _cycle_tables(spark, sf):
    me = fx.movie_events(spark, sf)
    em, et, er = _existing_tables(me)
    nm, nt, nr = dc.cycle_frames_for_date(me, P.RUN_DATE, P.COMPUTED_AT, P.TOP_N)
    return (st.key_merge(em, nm, dc.METRIC_KEY_DEFAULT),
            st.replace_partition(et, nt, "metric_date", [P.RUN_DATE]),
            st.key_merge(er, nr, ["cohort_date", "day_offset"]))


@register("metrics_for_date")
def q_metrics_for_date(spark, sf):
    return ex.metrics_for_date(*_cycle_tables(spark, sf), P.RUN_DATE)


@register("export_union")
def q_export_union(spark, sf):
    return ex.export_union(*_cycle_tables(spark, sf), P.RUN_DATE)


@register("export_document")
def q_export_document(spark, sf):
    """The JSON document of a day, as text."""
    doc = ex.export_document(*_cycle_tables(spark, sf), P.COHORT_DATE)
    item = lambda c, cols: F.transform(c, lambda x: F.concat_ws("|", *[x[k].cast("string") for k in cols]))
    return doc.select("export_date", F.date_format("computed_at", "yyyy-MM-dd HH:mm:ss").alias("computed_at"),
                      F.array_join(item("metrics", ["metric_name", "dimensions"]), ";").alias("metrics"),
                      F.array_join(item("top_movies", ["rank", "movie_id", "views"]), ";").alias("top_movies"),
                      F.array_join(item("retention", ["day_offset", "returned", "cohort_size"]), ";").alias("retention"))


@register("export_files")
def q_export_files(spark, sf):
    """The files of a day in three formats, each written twice; their rows by section."""
    tables, root = _cycle_tables(spark, sf), scratch_path(spark, "export")
    paths = {}
    for fmt in 2 * ex.FORMATS:
        paths[fmt] = ex.write_export(*tables, P.COHORT_DATE, fmt, root)
    flat = [spark.read.option("header", True).csv(paths["csv"]), spark.read.parquet(paths["parquet"])]
    counts = [df.groupBy(F.lit(fmt).alias("format"), "table").agg(F.count(F.lit(1)).alias("n")) for fmt, df in zip(("csv", "parquet"), flat, strict=True)]
    document = spark.read.json(paths["json"])
    sections = F.explode(F.array(*[F.struct(F.lit(s).alias("table"), F.size(s).cast("long").alias("n")) for s in ("metrics", "top_movies", "retention")])).alias("s")
    counts.append(document.select(F.lit("json").alias("format"), sections).select("format", "s.table", "s.n").where("n > 0"))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@register("json_ingest")
def q_json_ingest(spark, sf):
    """Event bodies as JSON lines; every fifth lacks its timestamp, every seventh has 0."""
    raw = fx.raw_event_rows(spark, sf)
    n = F.col("event_id").cast("long")
    body = raw.withColumn("timestamp", F.when(n % 5 == 0, F.lit(None)).when(n % 7 == 0, F.lit(0)).otherwise(F.col("timestamp")))
    lines = body.select(F.to_json(F.struct(*[F.col(c) for c in body.columns])).alias("value"))
    stamp = F.lit(P.COMPUTED_AT).cast("timestamp")
    return ev.ingest_json(lines, F.unix_millis(stamp))


@register("request_log_stats")
def q_request_log_stats(spark, sf):
    """Request log lines made of the events, parsed, masked and counted."""
    log = ev.parse_request_log(fx.request_log_lines(spark, sf))
    masked = F.count_if(F.col("body_masked")["password"] == "***").alias("masked")
    return log.groupBy("method", "endpoint", "status_code").agg(
        F.count(F.lit(1)).alias("n"), F.max("duration_ms").alias("slowest_ms"), masked, F.min("ts").alias("first_at"))


@register("export_union_cohort")
def q_export_union_cohort(spark, sf):
    """Export of a date whose cohort is stored (the day after a cycle that
    refreshed it), so the retention section is not empty."""
    return ex.export_union(*_cycle_tables(spark, sf), P.COHORT_DATE)


# ------------------------------------------------------- validation, audits

from ..operators import quality as qa  # noqa: E402


@register("event_contract_rejects")
def q_event_contract_rejects(spark, sf):
    return qa.event_contract_rejects(fx.event_candidates(spark, sf))


@register("product_contract_rejects")
def q_product_contract_rejects(spark, sf):
    return qa.product_contract_rejects(fx.product_payloads(spark, sf))


@register("order_contract_rejects")
def q_order_contract_rejects(spark, sf):
    return qa.order_rows_contract_rejects(fx.order_headers(spark, sf), fx.order_payload_items(spark, sf))


@register("login_contract_rejects")
def q_login_contract_rejects(spark, sf):
    return qa.login_contract_rejects(fx.login_payloads(spark, sf))


def audit_tables(spark, sf):
    return {"products": fx.products(spark, sf), "promo_codes": fx.promo_codes(spark, sf),
            "users": fx.users(spark, sf), "flights": fx.flights(spark, sf),
            "seat_requests": fx.seat_requests(spark, sf), "bookings": fx.bookings(spark, sf),
            "order_items": fx.order_items(spark, sf), "orders": fx.orders(spark, sf)}


@register("constraint_audit")
def q_constraint_audit(spark, sf):
    return qa.constraint_audit(audit_tables(spark, sf))


@register("session_sequence_audit")
def q_session_sequence_audit(spark, sf):
    return qa.session_sequence_audit(fx.movie_events(spark, sf))


@register("event_dedup")
def q_event_dedup(spark, sf):
    return qa.dedup_events(fx.redelivered_events(spark, sf), "event_id", ["delivery"])


@register("session_rollup")
def q_session_rollup(spark, sf):
    return qa.session_rollup(fx.movie_events(spark, sf))


# ------------------------------------------------------------------ orders

from ..operators import orders as od  # noqa: E402


@register("order_totals")
def q_order_totals(spark, sf):
    return od.order_totals(fx.order_items(spark, sf))


@register("promo_discounts")
def q_promo_discounts(spark, sf):
    return od.promo_evaluation(fx.orders(spark, sf), od.order_totals(fx.order_items(spark, sf)),
                               fx.promo_codes(spark, sf))


@register("order_admission")
def q_order_admission(spark, sf):
    return od.order_admission(fx.orders(spark, sf), fx.order_items(spark, sf), fx.products(spark, sf),
                              fx.promo_codes(spark, sf), fx.user_operations(spark, sf))


@register("stock_oversell")
def q_stock_oversell(spark, sf):
    return od.stock_oversell(fx.order_items(spark, sf), fx.orders(spark, sf), fx.products(spark, sf))


@register("cancel_effects")
def q_cancel_effects(spark, sf):
    return od.cancel_effects(fx.orders(spark, sf), fx.order_items(spark, sf), fx.promo_codes(spark, sf),
                             fx.cancel_requests(spark, sf), fx.callers(spark, sf))


@register("promo_usage")
def q_promo_usage(spark, sf):
    return od.promo_usage(fx.orders(spark, sf), fx.order_items(spark, sf), fx.promo_codes(spark, sf))


@register("active_order_conflicts")
def q_active_order_conflicts(spark, sf):
    return od.active_order_conflicts(fx.orders(spark, sf))


@register("rate_limit_hits")
def q_rate_limit_hits(spark, sf):
    return od.rate_limit_hits(fx.user_operations(spark, sf), P.RATE_LIMIT_SECONDS)


@register("product_page")
def q_product_page(spark, sf):
    return od.product_page(fx.products(spark, sf), P.PAGE_STATUS, None, P.PAGE, P.PAGE_SIZE)


@register("lookup_missing_keys")
def q_lookup_missing_keys(spark, sf):
    return od.lookup_missing_keys([
        ("product", fx.order_items(spark, sf), "product_id", fx.products(spark, sf), "id"),
        ("flight", fx.seat_requests(spark, sf), "flight_id", fx.flights(spark, sf), "id"),
        ("caller", fx.cancel_requests(spark, sf), "caller_id", fx.callers(spark, sf), "user_id"),
    ])


@register("ownership_violations")
def q_ownership_violations(spark, sf):
    return od.ownership(fx.orders(spark, sf), fx.cancel_requests(spark, sf), fx.callers(spark, sf))


@register("apply_product_changes")
def q_apply_product_changes(spark, sf):
    return od.apply_product_changes(fx.products(spark, sf), fx.product_changes(spark, sf))


# ----------------------------------------------------------------- flights

from ..operators import flights as fl  # noqa: E402
from ..operators import seats as se  # noqa: E402


@register("flight_search")
def q_flight_search(spark, sf):
    return fl.flight_search(fx.flights(spark, sf), P.SEARCH_ORIGIN, P.SEARCH_DESTINATION, P.SEARCH_DATE)


@register("user_bookings")
def q_user_bookings(spark, sf):
    return fl.user_bookings(fx.bookings(spark, sf), P.BOOKING_USER)


@register("booking_pricing")
def q_booking_pricing(spark, sf):
    return fl.booking_pricing(fx.bookings(spark, sf), fx.flights(spark, sf))


@register("seat_reservation")
def q_seat_reservation(spark, sf):
    """the answer to every reserve; a booking is one reservation over all flights."""
    return se.seat_ledger(fx.seat_calls(spark, sf), fx.flights(spark, sf)).where("op = 'RESERVE'").drop("op")


@register("seat_release")
def q_seat_release(spark, sf):
    """the answer to every release, with the flight and the seats it freed."""
    return se.seat_ledger(fx.seat_calls(spark, sf), fx.flights(spark, sf)).where("op = 'RELEASE'").drop("op")


@register("seat_reconciliation")
def q_seat_reconciliation(spark, sf):
    """the stored flight table against the reservations that the ledger left."""
    ledger = se.seat_ledger(fx.seat_calls(spark, sf), fx.flights(spark, sf))
    return se.seat_reconciliation(fx.flights_after(spark, sf), se.reservations(ledger))


@register("booking_transitions")
def q_booking_transitions(spark, sf):
    return fl.booking_transitions(fx.booking_events(spark, sf))


@register("provider_failure_window")
def q_provider_failure_window(spark, sf):
    return fl.provider_failure_window(fx.call_log(spark, sf), P.FAILURE_WINDOW, P.FAILURE_THRESHOLD)


# ----------------------------------------------------------- notifications

from ..operators import notify as nt  # noqa: E402


@register("notif_keys")
def q_notif_keys(spark, sf):
    return nt.notif_keys(fx.attempts(spark, sf))


@register("notif_dedup")
def q_notif_dedup(spark, sf):
    return nt.dedup_ttl(fx.retried_attempts(spark, sf))


@register("notif_routable")
def q_notif_routable(spark, sf):
    return nt.routable(fx.notifications(spark, sf), fx.preferences(spark, sf))


@register("notif_channel_plan")
def q_notif_channel_plan(spark, sf):
    return nt.channel_plan(nt.routable(fx.notifications(spark, sf), fx.preferences(spark, sf)))


@register("notif_failover")
def q_notif_failover(spark, sf):
    a = fx.attempts(spark, sf)
    return nt.failover(a, nt.acks_of(a), fx.user_channels(spark, sf))


@register("notif_state")
def q_notif_state(spark, sf):
    return nt.delivery_state(nt.state_events(fx.attempts(spark, sf), fx.user_channels(spark, sf)))


@register("notif_lanes")
def q_notif_lanes(spark, sf):
    return nt.lanes(fx.notifications(spark, sf))


@register("notif_dlq")
def q_notif_dlq(spark, sf):
    return nt.dead_letters(fx.attempts(spark, sf), fx.user_channels(spark, sf))


@register("notif_kpis")
def q_notif_kpis(spark, sf):
    return nt.delivery_kpis(fx.attempts(spark, sf))


@register("notif_success_24h")
def q_notif_success_24h(spark, sf):
    return nt.success_rolling(fx.attempts(spark, sf))


@register("campaign_batches")
def q_campaign_batches(spark, sf):
    return nt.campaign_batches(fx.campaign_recipients(spark, sf), P.CAMPAIGN_RATE)


@register("outbox_events")
def q_outbox_events(spark, sf):
    return nt.outbox_events(fx.outbox(spark, sf))


@register("published_counts")
def q_published_counts(spark, sf):
    """Messages per event type as the publish job observed them, beside what it wrote."""
    path = scratch_path(spark, "published")
    observed = ev.publish_counted(fx.raw_event_rows(spark, sf), path, qa.EVENT_TYPES)
    rows = spark.createDataFrame([(t, n) for t, n in observed.items() if n], "event_type string, observed long")
    kind = F.decode(F.filter("headers", lambda h: h["key"] == "event_type")[0]["value"], "UTF-8").alias("event_type")
    written = spark.read.parquet(path).groupBy(kind).agg(F.count(F.lit(1)).alias("written"))
    return rows.join(written, "event_type", "full_outer")


# --------------------------------------------------------------- streaming

from ..streaming import jobs as sj  # noqa: E402
from ..streaming import states as ss  # noqa: E402
from ..streaming import feed  # noqa: E402


@register("outbox_feed")
def q_outbox_feed(spark, sf):
    """The outbox published in two runs, the table growing in between."""
    root = scratch_path(spark, "outbox")
    rows = fx.outbox_changes(spark, sf)
    for part in (rows.where("state = 'NEW'"), rows.where("state <> 'NEW'")):
        part.write.mode("append").parquet(f"{root}/outbox")
        feed.publish_outbox(spark, f"{root}/outbox", f"{root}/messages", f"{root}/ckpt")
    return feed.published(spark, f"{root}/messages")


def _streamed_store(spark, sf):
    rows = fx.raw_event_rows(spark, sf)  # the contract asks for UUIDs on the wire
    uuid = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad("event_id", 12, "0"))
    return _streamed(spark, rows.withColumn("event_id", uuid))


def _streamed(spark, wire):
    """Wire rows as files, streamed through the ingest: the scratch root of its store and rejects."""
    root = scratch_path(spark, "stream-ingest")
    wire.select(*ev.RAW_EVENT_SCHEMA.fieldNames()).write.parquet(f"{root}/wire")
    sj.ingest_stream(ev.stream_events(spark, f"{root}/wire"), f"{root}/store", f"{root}/rejects", f"{root}/ckpt")
    return root


@register("stream_rejects")
def q_stream_rejects(spark, sf):
    """Wire rows with contract breaks; what the stream quarantined, with reasons."""
    root = _streamed(spark, fx.event_candidates(spark, sf))
    return spark.read.parquet(f"{root}/rejects").select(*ev.RAW_EVENT_SCHEMA.fieldNames(), "reasons")


@register("stream_accepts")
def q_stream_accepts(spark, sf):
    """The rows of the same wire that reached the store."""
    root = _streamed(spark, fx.event_candidates(spark, sf))
    return spark.read.parquet(f"{root}/store").select(*ev.STORED_COLUMNS)


@register("stream_ingest")
def q_stream_ingest(spark, sf):
    """The event stream written to the day-partitioned store, read back."""
    root = _streamed_store(spark, sf)
    return spark.read.parquet(f"{root}/store").select(*ev.STORED_COLUMNS)


def _streamed_states(spark, sf):
    root = _streamed_store(spark, sf)
    ss.incremental_states(spark, f"{root}/store", f"{root}/states", f"{root}/states-ckpt")
    return f"{root}/states"


@register("incremental_equals_full")
def q_incremental_equals_full(spark, sf):
    """Views per (day, movie) merged from the partial states, folded batches and open ones."""
    return ss.merged_movie_views(spark, _streamed_states(spark, sf))


@register("incremental_watch_time")
def q_incremental_watch_time(spark, sf):
    return ss.merged_watch_time(spark, _streamed_states(spark, sf))


@register("incremental_dau")
def q_incremental_dau(spark, sf):
    """Users per day merged from the batches' states, folded batches and open ones."""
    return ss.merged_user_days(spark, _streamed_states(spark, sf))


@register("tumbling_counts")
def q_tumbling_counts(spark, sf):
    return sj.tumbling_counts(fx.movie_events(spark, sf), "1 day")


@register("latest_metrics")
def q_latest_metrics(spark, sf):
    """Last 20 metric rows of the metric table after the cycle."""
    metrics, _, _ = _cycle_tables(spark, sf)
    return m.latest_metrics(metrics, 20)
