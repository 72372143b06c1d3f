"""Deterministic views of the domain tables over the driver's parquet tables.

Each view is defined twice, side by side: once as a DataFrame (what the jobs
read) and once as a SQL common-table expression (what the DuckDB oracle
reads).  Both must stay expression-for-expression equal; README lists the
mapping.  Views never cap or sample rows: their size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

# Fixed values of the event contract.
EVENT_TYPES = ["VIEW_STARTED", "VIEW_FINISHED", "VIEW_PAUSED", "VIEW_RESUMED", "LIKED", "SEARCHED"]
DEVICE_TYPES = ["MOBILE", "DESKTOP", "TV", "TABLET"]
CHANNELS = ["push", "sms", "email"]
NOTIFICATION_TYPES = ["TRANSACTIONAL", "SERVICE", "MARKETING"]
# Call outcome codes; the first three classes count as success for the
# failure window, everything else is a failure.
SUCCESS_CODES = ["OK", "NOT_FOUND", "RESOURCE_EXHAUSTED", "INVALID_ARGUMENT"]

# Flight departures of the fixture start here (UTC).
FLIGHT_EPOCH = "2026-04-01 00:00:00"


def _k(col: str = "props"):
    """Small integer 0..99 carried in the events' props JSON."""
    return F.regexp_extract(col, "[0-9]+", 0).cast("int")


def _pick(index_col, values):
    """values[index] for a 0-based integer column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), index_col + 1)


# --------------------------------------------------------------------- events

def movie_events(spark: SparkSession, sf_dir: str, start: str | None = None,
                 end: str | None = None) -> DataFrame:
    """Stored-form movie events.  ``start``/``end`` (dates, end exclusive)
    restrict the scan on the raw ``ts`` column so the range reaches Parquet."""
    e = read_table(spark, sf_dir, "events")
    if start is not None:
        e = e.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        e = e.where(F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return movie_events_from(e)


def movie_events_from(e: DataFrame) -> DataFrame:
    """The movie-event mapping over an events frame (batch or stream)."""
    k = _k()
    et = F.col("event_type")
    t = F.col("ts").cast("timestamp")
    uid = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        uid.alias("user_id"),
        F.concat(F.lit("movie_"), (k % 50).cast("string")).alias("movie_id"),
        F.when(et == "view", "VIEW_STARTED").when(et == "purchase", "VIEW_FINISHED")
        .when(et == "click", "VIEW_PAUSED").when(et == "signup", "LIKED")
        .otherwise("SEARCHED").alias("event_type"),
        t.alias("event_time"),
        F.to_date(t).alias("event_date"),
        _pick(k % 4, DEVICE_TYPES).alias("device_type"),
        F.concat_ws("-", uid, F.date_format(t, "yyyy-MM-dd")).alias("session_id"),
        F.when(et.isin("view", "purchase", "click"), F.floor("value").cast("int")).alias("progress_seconds"),
    )


def raw_event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer-side input rows (before typing): ``timestamp`` in epoch ms."""
    me = movie_events(spark, sf_dir)
    return me.select(
        "event_id", "user_id", "movie_id", "event_type",
        F.unix_millis("event_time").alias("timestamp"),
        "device_type", "session_id", "progress_seconds",
    )


def event_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Producer-side rows before validation (V1): the movie-event mapping,
    with contract breaks placed by the props number ``k``."""
    e = read_table(spark, sf_dir, "events")
    k = _k()
    et = F.col("event_type")
    t = F.col("ts").cast("timestamp")
    uid = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    eid = F.col("event_id").cast("string")
    return e.select(
        F.col("event_id").alias("row_id"),
        F.when(k % 10 == 0, F.lit(None).cast("string"))
        .when(k % 10 == 1, F.concat(F.lit("evt-"), eid))
        .otherwise(F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(eid, 12, "0"))).alias("event_id"),
        F.when(k == 2, F.lit("")).otherwise(uid).alias("user_id"),
        F.concat(F.lit("movie_"), (k % 50).cast("string")).alias("movie_id"),
        F.when(et == "view", "VIEW_STARTED").when(et == "purchase", "VIEW_FINISHED")
        .when(et == "click", "VIEW_PAUSED").when(et == "signup", "LIKED")
        .when(k % 2 == 0, "WATCH_SOMETHING").otherwise("SEARCHED").alias("event_type"),
        F.unix_millis(t).alias("timestamp"),
        F.when(k == 3, F.lit("FRIDGE")).otherwise(_pick(k % 4, DEVICE_TYPES)).alias("device_type"),
        F.when(k == 4, F.lit("")).otherwise(F.concat_ws("-", uid, F.date_format(t, "yyyy-MM-dd"))).alias("session_id"),
        F.when(k == 5, F.lit(-1))
        .when(et.isin("view", "purchase", "click"), F.floor("value").cast("int")).alias("progress_seconds"),
    )


def redelivered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events as the store sees them after at-least-once delivery:
    every event once (delivery 1), events with k < 20 a second time."""
    e = read_table(spark, sf_dir, "events").select("event_id", "props")
    k = _k()
    again = e.where(k < 20).select("event_id")
    me = movie_events(spark, sf_dir)
    first = me.withColumn("delivery", F.lit(1))
    second = (me.join(again.select(F.col("event_id").cast("string").alias("event_id")), "event_id")
              .withColumn("delivery", F.lit(2)))
    return first.unionByName(second)


def product_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product create payloads (V2), breaks placed by the part key."""
    p = read_table(spark, sf_dir, "part")
    pid = F.col("p_partkey")
    return p.select(
        pid.alias("id"),
        F.when(pid % 97 == 0, F.lit("")).otherwise(F.col("p_name")).alias("name"),
        F.when(pid % 89 == 0, F.repeat(F.col("p_type"), 200)).otherwise(F.col("p_brand")).alias("description"),
        F.when(pid % 83 == 0, F.lit(0.0)).otherwise(F.col("p_retailprice")).alias("price"),
        F.when(pid % 79 == 0, F.lit(-1)).otherwise(F.col("p_size") * 10).alias("stock"),
        F.when(pid % 73 == 0, F.lit("")).otherwise(F.col("p_type")).alias("category"),
        F.when(pid % 71 == 0, F.lit("SOLD")).when(pid % 10 == 0, F.lit("INACTIVE"))
        .otherwise(F.lit("ACTIVE")).alias("status"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order create payloads without their items (V2): the promo code,
    lower-cased for every 13th order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    oid = F.col("o_orderkey")
    code = F.when(oid % 7 < 6, F.concat(F.lit("PROMO"), (oid % 7).cast("string")))
    return o.select(oid.alias("order_id"), F.when(oid % 13 == 0, F.lower(code)).otherwise(code).alias("promo_code"))


def order_payload_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload items as rows (order_id, line_no, product_id, quantity)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
                     F.col("l_partkey").alias("product_id"),
                     (F.col("l_quantity").cast("int") * F.when(F.col("l_linenumber") == 7, 20).otherwise(1))
                     .alias("quantity"))


def order_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order create payloads (V2): the order's line items as an array, the
    promo code lower-cased for every 13th order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    li = read_table(spark, sf_dir, "lineitem")
    items = (li.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_quantity").cast("int") * F.when(F.col("l_linenumber") == 7, 20).otherwise(1)).alias("quantity"),
    )).alias("items")))
    oid = F.col("o_orderkey")
    code = F.when(oid % 7 < 6, F.concat(F.lit("PROMO"), (oid % 7).cast("string")))
    return (o.join(items, o["o_orderkey"] == items["l_orderkey"], "left")
            .select(oid.alias("order_id"),
                    F.coalesce(F.col("items"), F.array().cast(
                        "array<struct<line_no:int,product_id:bigint,quantity:int>>")).alias("items"),
                    F.when(oid % 13 == 0, F.lower(code)).otherwise(code).alias("promo_code")))


def login_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    pw = F.concat_ws("-", F.col("c_mktsegment"), F.col("c_acctbal").cast("string"))
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
                    F.when(F.col("c_custkey") % 17 == 0, F.substring(pw, 1, 5))
                    .when(F.col("c_custkey") % 19 == 0, F.repeat(pw, 5)).otherwise(pw).alias("password"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("username"),
                    F.when(F.col("c_custkey") % 50 == 0, "ADMIN").otherwise("USER").alias("role"))


# ---------------------------------------------------------------- marketplace

def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    pid = F.col("p_partkey")
    return p.select(
        pid.alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("description"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
        (F.col("p_size") * 10).alias("stock"),
        F.col("p_type").alias("category"),
        F.when(pid % 10 == 0, "INACTIVE").when(pid % 10 == 1, "ARCHIVED").otherwise("ACTIVE").alias("status"),
        (pid % 100).alias("seller_id"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    oid = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    return o.select(
        oid.alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.when(st == "O", "CREATED").when(st == "P", "PAYMENT_PENDING").otherwise("COMPLETED").alias("status"),
        F.when(oid % 7 < 6, F.concat(F.lit("PROMO"), (oid % 7).cast("string"))).alias("promo_code"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(12,2)").alias("price_at_order"),
    )


def promo_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = read_table(spark, sf_dir, "region")
    key = F.col("r_regionkey")
    return r.select(
        F.concat(F.lit("PROMO"), key.cast("string")).alias("code"),
        F.when(key % 2 == 0, "PERCENTAGE").otherwise("FIXED_AMOUNT").alias("discount_type"),
        F.when(key == 0, 10).when(key == 1, 50).when(key == 2, 80).when(key == 3, 100000)
        .otherwise(50).cast("decimal(12,2)").alias("discount_value"),
        (key * 20000).cast("decimal(12,2)").alias("min_order_amount"),
        (key * 150 + 40).cast("int").alias("max_uses"),
        (key * 3).cast("int").alias("current_uses"),
        F.lit("1995-01-01 00:00:00").cast("timestamp").alias("valid_from"),
        F.lit("1999-12-31 00:00:00").cast("timestamp").alias("valid_until"),
        (key != 4).alias("active"),
    )


def callers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.when(F.col("c_custkey") % 50 == 0, "ADMIN").otherwise("USER").alias("role"),
    )


def cancel_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cancel request per order; every fourth comes from the next customer."""
    o = read_table(spark, sf_dir, "orders")
    oid = F.col("o_orderkey")
    return o.select(
        oid.alias("order_id"),
        F.when(oid % 4 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("caller_id"),
    )


def user_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("op_id"),
        F.col("user_id"),
        F.when(F.col("event_type").isin("view", "purchase", "click"), "CREATE_ORDER")
        .otherwise("LOGIN").alias("operation_type"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def product_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed: one change per line item on its product, at ship time."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("id"),
        F.when(F.col("l_returnflag") == "R", "DELETE").otherwise("UPDATE").alias("op"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity")).cast("decimal(12,2)").alias("price"),
        (F.col("l_quantity").cast("int") * 10).alias("stock"),
        F.concat(F.lit("name "), F.col("l_orderkey").cast("string")).alias("name"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string")).alias("description"),
        F.concat(F.lit("category "), (F.col("l_orderkey") % 25).cast("string")).alias("category"),
        F.when(F.col("l_linenumber") % 3 == 0, "INACTIVE").otherwise("ACTIVE").alias("status"),
        F.col("l_shipdate").cast("timestamp").alias("changed_at"),
        F.col("l_orderkey").alias("src_order"),
        F.col("l_linenumber").alias("src_line"),
        F.col("l_extendedprice").alias("src_price"),
    )


# -------------------------------------------------------------------- flights

def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    pid = F.col("p_partkey")
    dep = (F.lit(FLIGHT_EPOCH).cast("timestamp")
           + F.make_dt_interval(days=(pid % 30).cast("int"), hours=(pid % 24).cast("int")))
    seats = (F.lit(50) + F.col("p_size")).cast("int")
    return p.select(
        pid.alias("id"),
        F.concat(F.lit("FL"), pid.cast("string")).alias("flight_number"),
        F.col("p_brand").alias("airline"),
        _pick((pid % 3).cast("int"), ["SVO", "VKO", "LED"]).alias("origin_code"),
        _pick((pid % 2).cast("int"), ["AER", "KZN"]).alias("destination_code"),
        dep.alias("departure_time"),
        (dep + F.make_dt_interval(hours=F.lit(2))).alias("arrival_time"),
        seats.alias("total_seats"),
        seats.alias("available_seats"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.when(pid % 11 == 0, "CANCELLED").otherwise("SCHEDULED").alias("status"),
    )


def seat_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seat requests in arrival order per flight.  ``seq`` is the position
    within the flight by (shipdate, orderkey, linenumber, quantity,
    extendedprice), numbered by the chunked scan so a hot flight is not
    numbered in one task (tied rows are identical in every output column)."""
    from ..functions.scan import keyed_position
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    numbered = keyed_position(li, ["l_partkey"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity",
                                                  "l_extendedprice"], "seq")
    return numbered.select(
        F.col("l_partkey").alias("flight_id"),
        F.col("seq"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("booking_id"),
        F.col("l_quantity").cast("int").alias("seats"),
        F.col("l_shipdate").cast("timestamp").alias("requested_at"),
    )


def seat_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls on the seat ledger: every line item asks for seats on its part's
    flight; by line number and return flag its booking also asks on a
    neighbouring flight, on an unknown one, or again later, is released, is
    released twice; some releases name no booking.  ``seq`` is the place in
    order of arrival over all flights (tied calls are equal in every column)."""
    from ..functions.scan import global_position
    li = read_table(spark, sf_dir, "lineitem")
    p, n, q, flag = F.col("l_partkey"), F.col("l_linenumber"), F.col("l_quantity").cast("int"), F.col("l_returnflag")
    block = F.floor(p / 4)
    own = F.concat_ws("-", F.col("l_orderkey").cast("string"), n.cast("string"), block.cast("string"))
    none = F.lit(None).cast("long")
    reserve, release = F.lit("RESERVE"), F.lit("RELEASE")
    half, nobody = F.floor(q / 2).cast("int") + 1, F.lit(None).cast("int")
    kinds = [
        (F.lit(True), reserve, p, own, q, 0),
        (n % 3 == 1, reserve, block * 4 + (p + 1) % 4, own, half, 3),
        (flag == "R", release, none, own, nobody, 5),
        ((flag == "R") & (n == 2), release, none, own, nobody, 9),
        (n == 5, reserve, p, own, q, 12),
        ((flag == "A") & (n == 6), release, none, F.concat(F.lit("none-"), F.col("l_orderkey").cast("string")), nobody, 1),
        ((flag == "N") & (n == 7), reserve, F.lit(10 ** 9) + block, own, q, 2),
    ]
    calls = F.array(*[F.when(cond, F.struct(F.lit(kind).alias("kind"), (F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(days=F.lit(later))).alias("called_at")))
                      for kind, (cond, *_, later) in enumerate(kinds)])
    order = ["called_at", "l_orderkey", "l_linenumber", "kind", "l_partkey", "l_quantity"]
    # a call follows from its kind and its line's numbers, so only these are sorted
    rows = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.inline(F.array_compact(calls)))
    of_kind = lambda i: F.coalesce(*[F.when(F.col("kind") == kind, of[i]) for kind, of in enumerate(kinds)])
    return global_position(rows, order, "seq").select(of_kind(2).cast("long").alias("flight_id"), "seq", of_kind(3).alias("booking_id"), of_kind(4).alias("seats"),
                                                      of_kind(1).alias("op"))


def flights_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flight table as stored after the calls: what it says is left need
    not agree with the reservations."""
    return flights(spark, sf_dir).withColumn("available_seats", F.least("total_seats", (F.col("id") % 8).cast("int")))


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    oid = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("B"), oid.cast("string")).alias("booking_id"),
        F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
        F.col("o_custkey").alias("flight_id"),
        (oid % 4 + 1).cast("int").alias("seat_count"),
        F.when(F.col("o_orderstatus") == "F", "CANCELLED").otherwise("CONFIRMED").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.when(oid % 977 == 1, F.lit(0)).otherwise(F.col("o_totalprice")).cast("decimal(12,2)").alias("total_price"),
    )


def booking_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle events: a create for every order, a cancel for F and P
    orders, and a second cancel for every fifth P order."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    bid = F.concat(F.lit("B"), F.col("o_orderkey").cast("string"))
    t0 = F.col("o_orderdate").cast("timestamp")
    create = o.select(bid.alias("booking_id"), F.lit("CREATE").alias("action"), t0.alias("event_at"))
    cancel = o.where(F.col("o_orderstatus").isin("F", "P")).select(
        bid.alias("booking_id"), F.lit("CANCEL").alias("action"),
        (t0 + F.expr("INTERVAL 1 DAY")).alias("event_at"))
    again = o.where((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 5 == 0)).select(
        bid.alias("booking_id"), F.lit("CANCEL").alias("action"),
        (t0 + F.expr("INTERVAL 2 DAYS")).alias("event_at"))
    return create.unionByName(cancel).unionByName(again)


def call_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = _k()
    code = (F.when(k < 20, "UNAVAILABLE").when(k < 30, "DEADLINE_EXCEEDED").when(k < 40, "INTERNAL")
            .when(k < 50, "NOT_FOUND").when(k < 55, "RESOURCE_EXHAUSTED").when(k < 60, "INVALID_ARGUMENT")
            .otherwise("OK"))
    return e.select(
        F.concat(F.lit("provider_"), (F.col("user_id") % 3).cast("string")).alias("provider"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("call_id"),
        code.alias("code"),
    )


# -------------------------------------------------------------- notifications

def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    k = _k()
    nid = F.col("event_id") % 4000
    ntype = (F.when(F.col("event_type") == "purchase", "TRANSACTIONAL")
             .when(F.col("event_type") == "signup", "SERVICE").otherwise("MARKETING"))
    return e.select(
        F.col("event_id").alias("attempt_id"),
        nid.alias("notification_id"),
        F.concat(F.lit("user_"), (nid % 150).cast("string")).alias("user_id"),
        F.when(ntype == "TRANSACTIONAL", "billing").when(ntype == "SERVICE", "accounts")
        .otherwise("campaigns").alias("source_service"),
        ntype.alias("type"),
        _pick(k % 3, CHANNELS).alias("channel"),
        F.when(k < 60, "DELIVERED").otherwise("FAILED").alias("outcome"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.floor(F.col("value") * 100).cast("long").alias("latency_ms"),
    )


def retried_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of a retry storm: one notification per user, so every
    (notification, channel) sees many attempts over the month (N2)."""
    a = attempts(spark, sf_dir)
    e = read_table(spark, sf_dir, "events").select(F.col("event_id").alias("attempt_id"), F.col("user_id").alias("uid"))
    return (a.join(e, "attempt_id")
            .withColumn("notification_id", F.col("uid"))
            .withColumn("user_id", F.concat(F.lit("user_"), F.col("uid").cast("string")))
            .drop("uid").select(*a.columns))


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notifications_from(read_table(spark, sf_dir, "events"))


def notifications_from(e: DataFrame) -> DataFrame:
    """The notification mapping over an events frame (batch or stream)."""
    return e.select(
        F.col("event_id").alias("notification_id"),
        F.col("user_id").alias("user_key"),
        F.when(F.col("event_type") == "purchase", "TRANSACTIONAL")
        .when(F.col("event_type") == "signup", "SERVICE").otherwise("MARKETING").alias("type"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    seg = F.col("c_mktsegment")
    return c.select(
        F.col("c_custkey").alias("user_key"),
        _pick((F.col("c_custkey") % 3).cast("int"), ["sms", "email", "push"]).alias("preferred_channel"),
        F.when(seg == "BUILDING", F.array(F.lit("MARKETING")))
        .when(seg == "MACHINERY", F.array(F.lit("SERVICE"), F.lit("MARKETING")))
        .when(seg == "AUTOMOBILE", F.array(F.lit("TRANSACTIONAL")))
        .otherwise(F.array().cast("array<string>")).alias("opted_out_types"),
    )


def request_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON log line per event (S10); logins carry a password in the body."""
    e = read_table(spark, sf_dir, "events")
    n = F.col("event_id")
    body = F.when(n % 3 == 0, F.create_map(F.lit("username"), F.concat(F.lit("u"), F.col("user_id").cast("string")), F.lit("password"), F.lit("secret")))
    return e.select(F.to_json(F.struct(
        n.cast("string").alias("request_id"), F.when(n % 3 == 0, "POST").otherwise("GET").alias("method"),
        F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"), F.when(n % 11 == 0, 500).otherwise(200).alias("status_code"),
        F.floor(F.col("value") * 10).cast("long").alias("duration_ms"), F.col("user_id").cast("string").alias("user_id"),
        F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), body.alias("body"))).alias("value"))


def user_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preferred channel by the user id that attempts carry."""
    return preferences(spark, sf_dir).select(
        F.concat(F.lit("user_"), F.col("user_key").cast("string")).alias("user_id"), "preferred_channel")


def campaign_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("user_key"), F.col("c_nationkey").alias("segment"))


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox rows of a source service: each order's state changes."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("aggregate_id"),
        F.col("o_orderstatus").alias("state"),
        F.col("o_orderdate").cast("timestamp").alias("written_at"),
        F.col("o_totalprice").alias("amount"),
    )


def outbox_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbox rows of a service that writes each order when it comes in and
    again, three days later, with its final state."""
    final = outbox(spark, sf_dir)
    return final.withColumn("state", F.lit("NEW")).unionByName(final.withColumn("written_at", F.col("written_at") + F.expr("INTERVAL 3 DAYS")))


# ------------------------------------------------------- oracle CTE fragments
# The same mappings in SQL for DuckDB.  Keys are view names.

K_SQL = "CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER)"

FIXTURE_SQL: dict[str, str] = {
    "movie_events": f"""
SELECT CAST(event_id AS VARCHAR) AS event_id,
       'user_' || CAST(user_id AS VARCHAR) AS user_id,
       'movie_' || CAST({K_SQL} % 50 AS VARCHAR) AS movie_id,
       CASE event_type WHEN 'view' THEN 'VIEW_STARTED' WHEN 'purchase' THEN 'VIEW_FINISHED'
            WHEN 'click' THEN 'VIEW_PAUSED' WHEN 'signup' THEN 'LIKED' ELSE 'SEARCHED' END AS event_type,
       CAST(ts AS TIMESTAMP) AS event_time,
       CAST(ts AS DATE) AS event_date,
       CASE {K_SQL} % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'TV' ELSE 'TABLET' END AS device_type,
       'user_' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
       CASE WHEN event_type IN ('view', 'purchase', 'click') THEN CAST(floor(value) AS INTEGER) END AS progress_seconds
FROM events""",
    "event_candidates": f"""
SELECT event_id AS row_id,
       CASE WHEN {K_SQL} % 10 = 0 THEN NULL
            WHEN {K_SQL} % 10 = 1 THEN 'evt-' || CAST(event_id AS VARCHAR)
            ELSE '00000000-0000-4000-8000-' || lpad(CAST(event_id AS VARCHAR), 12, '0') END AS event_id,
       CASE WHEN {K_SQL} = 2 THEN '' ELSE 'user_' || CAST(user_id AS VARCHAR) END AS user_id,
       'movie_' || CAST({K_SQL} % 50 AS VARCHAR) AS movie_id,
       CASE event_type WHEN 'view' THEN 'VIEW_STARTED' WHEN 'purchase' THEN 'VIEW_FINISHED'
            WHEN 'click' THEN 'VIEW_PAUSED' WHEN 'signup' THEN 'LIKED'
            ELSE CASE WHEN {K_SQL} % 2 = 0 THEN 'WATCH_SOMETHING' ELSE 'SEARCHED' END END AS event_type,
       epoch_ms(date_trunc('millisecond', CAST(ts AS TIMESTAMP))) AS timestamp,
       CASE WHEN {K_SQL} = 3 THEN 'FRIDGE' ELSE
            CASE {K_SQL} % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'TV' ELSE 'TABLET' END
       END AS device_type,
       CASE WHEN {K_SQL} = 4 THEN '' ELSE 'user_' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d')
       END AS session_id,
       CASE WHEN {K_SQL} = 5 THEN -1
            WHEN event_type IN ('view', 'purchase', 'click') THEN CAST(floor(value) AS INTEGER) END AS progress_seconds
FROM events""",
    "product_payloads": """
SELECT p_partkey AS id,
       CASE WHEN p_partkey % 97 = 0 THEN '' ELSE p_name END AS name,
       CASE WHEN p_partkey % 89 = 0 THEN repeat(p_type, 200) ELSE p_brand END AS description,
       CASE WHEN p_partkey % 83 = 0 THEN 0.0 ELSE p_retailprice END AS price,
       CASE WHEN p_partkey % 79 = 0 THEN -1 ELSE p_size * 10 END AS stock,
       CASE WHEN p_partkey % 73 = 0 THEN '' ELSE p_type END AS category,
       CASE WHEN p_partkey % 71 = 0 THEN 'SOLD' WHEN p_partkey % 10 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM part""",
    "order_payloads": """
SELECT o.o_orderkey AS order_id,
       coalesce(i.items, []) AS items,
       CASE WHEN o.o_orderkey % 13 = 0 THEN lower(CASE WHEN o.o_orderkey % 7 < 6
                                                 THEN 'PROMO' || CAST(o.o_orderkey % 7 AS VARCHAR) END)
            ELSE CASE WHEN o.o_orderkey % 7 < 6 THEN 'PROMO' || CAST(o.o_orderkey % 7 AS VARCHAR) END
       END AS promo_code
FROM orders o LEFT JOIN (
  SELECT l_orderkey, list({'line_no': l_linenumber, 'product_id': l_partkey,
                           'quantity': CAST(l_quantity AS INTEGER) * CASE WHEN l_linenumber = 7 THEN 20 ELSE 1 END})
         AS items
  FROM lineitem GROUP BY l_orderkey) i ON o.o_orderkey = i.l_orderkey""",
    "login_payloads": """
SELECT c_custkey AS id, c_name AS username,
       CASE WHEN c_custkey % 17 = 0 THEN substring(pw, 1, 5) WHEN c_custkey % 19 = 0 THEN repeat(pw, 5) ELSE pw END
           AS password
FROM (SELECT *, c_mktsegment || '-' || CAST(c_acctbal AS VARCHAR) AS pw FROM customer) c""",
    "users": """
SELECT c_custkey AS id, c_name AS username, CASE WHEN c_custkey % 50 = 0 THEN 'ADMIN' ELSE 'USER' END AS role
FROM customer""",
    "redelivered_events": f"""
SELECT *, 1 AS delivery FROM movie_events
UNION ALL
SELECT m.*, 2 AS delivery FROM movie_events m
JOIN (SELECT CAST(event_id AS VARCHAR) AS event_id FROM events WHERE {K_SQL} < 20) a USING (event_id)""",
    "products": """
SELECT p_partkey AS id, p_name AS name, p_brand AS description,
       CAST(p_retailprice AS DECIMAL(12,2)) AS price, p_size * 10 AS stock, p_type AS category,
       CASE p_partkey % 10 WHEN 0 THEN 'INACTIVE' WHEN 1 THEN 'ARCHIVED' ELSE 'ACTIVE' END AS status,
       p_partkey % 100 AS seller_id
FROM part""",
    "m_orders": """
SELECT o_orderkey AS id, o_custkey AS user_id,
       CASE o_orderstatus WHEN 'O' THEN 'CREATED' WHEN 'P' THEN 'PAYMENT_PENDING' ELSE 'COMPLETED' END AS status,
       CASE WHEN o_orderkey % 7 < 6 THEN 'PROMO' || CAST(o_orderkey % 7 AS VARCHAR) END AS promo_code,
       CAST(o_orderdate AS TIMESTAMP) AS created_at
FROM orders""",
    "order_items": """
SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity,
       CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(12,2)) AS price_at_order
FROM lineitem""",
    "promo_codes": """
SELECT 'PROMO' || CAST(r_regionkey AS VARCHAR) AS code,
       CASE WHEN r_regionkey % 2 = 0 THEN 'PERCENTAGE' ELSE 'FIXED_AMOUNT' END AS discount_type,
       CAST(CASE r_regionkey WHEN 0 THEN 10 WHEN 1 THEN 50 WHEN 2 THEN 80 WHEN 3 THEN 100000 ELSE 50 END
            AS DECIMAL(12,2)) AS discount_value,
       CAST(r_regionkey * 20000 AS DECIMAL(12,2)) AS min_order_amount,
       CAST(r_regionkey * 150 + 40 AS INTEGER) AS max_uses, CAST(r_regionkey * 3 AS INTEGER) AS current_uses,
       TIMESTAMP '1995-01-01 00:00:00' AS valid_from, TIMESTAMP '1999-12-31 00:00:00' AS valid_until,
       r_regionkey <> 4 AS active
FROM region""",
    "callers": """
SELECT c_custkey AS user_id, CASE WHEN c_custkey % 50 = 0 THEN 'ADMIN' ELSE 'USER' END AS role
FROM customer""",
    "cancel_requests": """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 4 = 0 THEN o_custkey + 1 ELSE o_custkey END AS caller_id
FROM orders""",
    "user_operations": """
SELECT event_id AS op_id, user_id,
       CASE WHEN event_type IN ('view', 'purchase', 'click') THEN 'CREATE_ORDER' ELSE 'LOGIN' END AS operation_type,
       CAST(ts AS TIMESTAMP) AS created_at
FROM events""",
    "product_changes": """
SELECT l_partkey AS id, CASE WHEN l_returnflag = 'R' THEN 'DELETE' ELSE 'UPDATE' END AS op,
       CAST(floor(l_extendedprice / l_quantity) AS DECIMAL(12,2)) AS price,
       CAST(l_quantity AS INTEGER) * 10 AS stock,
       'name ' || CAST(l_orderkey AS VARCHAR) AS name, 'line ' || CAST(l_linenumber AS VARCHAR) AS description,
       'category ' || CAST(l_orderkey % 25 AS VARCHAR) AS category,
       CASE WHEN l_linenumber % 3 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
       CAST(l_shipdate AS TIMESTAMP) AS changed_at,
       l_orderkey AS src_order, l_linenumber AS src_line, l_extendedprice AS src_price
FROM lineitem""",
    "flights": f"""
SELECT p_partkey AS id, 'FL' || CAST(p_partkey AS VARCHAR) AS flight_number, p_brand AS airline,
       CASE p_partkey % 3 WHEN 0 THEN 'SVO' WHEN 1 THEN 'VKO' ELSE 'LED' END AS origin_code,
       CASE p_partkey % 2 WHEN 0 THEN 'AER' ELSE 'KZN' END AS destination_code,
       TIMESTAMP '{FLIGHT_EPOCH}' + to_days(CAST(p_partkey % 30 AS INTEGER))
           + to_hours(CAST(p_partkey % 24 AS INTEGER)) AS departure_time,
       TIMESTAMP '{FLIGHT_EPOCH}' + to_days(CAST(p_partkey % 30 AS INTEGER))
           + to_hours(CAST(p_partkey % 24 AS INTEGER)) + INTERVAL 2 HOUR AS arrival_time,
       CAST(50 + p_size AS INTEGER) AS total_seats, CAST(50 + p_size AS INTEGER) AS available_seats,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price,
       CASE WHEN p_partkey % 11 = 0 THEN 'CANCELLED' ELSE 'SCHEDULED' END AS status
FROM part""",
    "seat_requests": """
SELECT l_partkey AS flight_id,
       row_number() OVER (PARTITION BY l_partkey
                          ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS seq,
       CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS booking_id,
       CAST(l_quantity AS INTEGER) AS seats,
       CAST(l_shipdate AS TIMESTAMP) AS requested_at
FROM lineitem""",
    "seat_calls": """
SELECT flight_id, booking_id, seats, op, block,
       row_number() OVER (ORDER BY called_at, l_orderkey, l_linenumber, kind, l_partkey, l_quantity) AS seq
FROM (SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_days(later) AS called_at
      FROM (SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_quantity, l_partkey // 4 AS block, k.kind, k.later,
                   CASE WHEN k.kind IN (2, 3, 5) THEN 'RELEASE' ELSE 'RESERVE' END AS op,
                   CASE k.kind WHEN 0 THEN l_partkey WHEN 4 THEN l_partkey WHEN 1 THEN l_partkey // 4 * 4 + (l_partkey + 1) % 4
                               WHEN 6 THEN 1000000000 + l_partkey // 4 END AS flight_id,
                   CASE k.kind WHEN 5 THEN 'none-' || CAST(l_orderkey AS VARCHAR)
                        ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_partkey // 4 AS VARCHAR) END AS booking_id,
                   CASE WHEN k.kind IN (0, 4, 6) THEN CAST(l_quantity AS INTEGER) WHEN k.kind = 1 THEN CAST(floor(CAST(l_quantity AS INTEGER) / 2) AS INTEGER) + 1 END AS seats
            FROM lineitem, (VALUES (0, 0), (1, 3), (2, 5), (3, 9), (4, 12), (5, 1), (6, 2)) k(kind, later)
            WHERE CASE k.kind WHEN 0 THEN true WHEN 1 THEN l_linenumber % 3 = 1 WHEN 2 THEN l_returnflag = 'R'
                              WHEN 3 THEN l_returnflag = 'R' AND l_linenumber = 2 WHEN 4 THEN l_linenumber = 5
                              WHEN 5 THEN l_returnflag = 'A' AND l_linenumber = 6 ELSE l_returnflag = 'N' AND l_linenumber = 7 END) x) y""",
    "flights_after": """
SELECT * REPLACE (least(total_seats, CAST(id % 8 AS INTEGER)) AS available_seats) FROM flights""",
    "bookings": """
SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS booking_id, 'user_' || CAST(o_custkey AS VARCHAR) AS user_id,
       o_custkey AS flight_id, CAST(o_orderkey % 4 + 1 AS INTEGER) AS seat_count,
       CASE WHEN o_orderstatus = 'F' THEN 'CANCELLED' ELSE 'CONFIRMED' END AS status,
       CAST(o_orderdate AS TIMESTAMP) AS created_at,
       CAST(CASE WHEN o_orderkey % 977 = 1 THEN 0 ELSE o_totalprice END AS DECIMAL(12,2)) AS total_price
FROM orders""",
    "booking_events": """
SELECT 'B' || CAST(o_orderkey AS VARCHAR) AS booking_id, 'CREATE' AS action, CAST(o_orderdate AS TIMESTAMP) AS event_at
FROM orders
UNION ALL
SELECT 'B' || CAST(o_orderkey AS VARCHAR), 'CANCEL', CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY
FROM orders WHERE o_orderstatus IN ('F', 'P')
UNION ALL
SELECT 'B' || CAST(o_orderkey AS VARCHAR), 'CANCEL', CAST(o_orderdate AS TIMESTAMP) + INTERVAL 2 DAY
FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 5 = 0""",
    "call_log": f"""
SELECT 'provider_' || CAST(user_id % 3 AS VARCHAR) AS provider, CAST(ts AS TIMESTAMP) AS ts, event_id AS call_id,
       CASE WHEN {K_SQL} < 20 THEN 'UNAVAILABLE' WHEN {K_SQL} < 30 THEN 'DEADLINE_EXCEEDED'
            WHEN {K_SQL} < 40 THEN 'INTERNAL' WHEN {K_SQL} < 50 THEN 'NOT_FOUND'
            WHEN {K_SQL} < 55 THEN 'RESOURCE_EXHAUSTED' WHEN {K_SQL} < 60 THEN 'INVALID_ARGUMENT'
            ELSE 'OK' END AS code
FROM events""",
    "attempts": f"""
SELECT event_id AS attempt_id, event_id % 4000 AS notification_id,
       'user_' || CAST(event_id % 4000 % 150 AS VARCHAR) AS user_id,
       CASE event_type WHEN 'purchase' THEN 'billing' WHEN 'signup' THEN 'accounts' ELSE 'campaigns' END
           AS source_service,
       CASE event_type WHEN 'purchase' THEN 'TRANSACTIONAL' WHEN 'signup' THEN 'SERVICE' ELSE 'MARKETING' END AS type,
       CASE {K_SQL} % 3 WHEN 0 THEN 'push' WHEN 1 THEN 'sms' ELSE 'email' END AS channel,
       CASE WHEN {K_SQL} < 60 THEN 'DELIVERED' ELSE 'FAILED' END AS outcome,
       CAST(ts AS TIMESTAMP) AS ts,
       CAST(floor(value * 100) AS BIGINT) AS latency_ms
FROM events""",
    "retried_attempts": f"""
SELECT event_id AS attempt_id, user_id AS notification_id, 'user_' || CAST(user_id AS VARCHAR) AS user_id,
       CASE event_type WHEN 'purchase' THEN 'billing' WHEN 'signup' THEN 'accounts' ELSE 'campaigns' END
           AS source_service,
       CASE event_type WHEN 'purchase' THEN 'TRANSACTIONAL' WHEN 'signup' THEN 'SERVICE' ELSE 'MARKETING' END AS type,
       CASE {K_SQL} % 3 WHEN 0 THEN 'push' WHEN 1 THEN 'sms' ELSE 'email' END AS channel,
       CASE WHEN {K_SQL} < 60 THEN 'DELIVERED' ELSE 'FAILED' END AS outcome,
       CAST(ts AS TIMESTAMP) AS ts,
       CAST(floor(value * 100) AS BIGINT) AS latency_ms
FROM events""",
    "notifications": """
SELECT event_id AS notification_id, user_id AS user_key,
       CASE event_type WHEN 'purchase' THEN 'TRANSACTIONAL' WHEN 'signup' THEN 'SERVICE' ELSE 'MARKETING' END AS type,
       CAST(ts AS TIMESTAMP) AS created_at
FROM events""",
    "preferences": """
SELECT c_custkey AS user_key,
       CASE c_custkey % 3 WHEN 0 THEN 'sms' WHEN 1 THEN 'email' ELSE 'push' END AS preferred_channel,
       CASE c_mktsegment WHEN 'BUILDING' THEN ['MARKETING'] WHEN 'MACHINERY' THEN ['SERVICE', 'MARKETING']
            WHEN 'AUTOMOBILE' THEN ['TRANSACTIONAL'] ELSE CAST([] AS VARCHAR[]) END AS opted_out_types
FROM customer""",
    "campaign_recipients": """
SELECT c_custkey AS user_key, c_nationkey AS segment FROM customer""",
    "outbox": """
SELECT o_orderkey AS aggregate_id, o_orderstatus AS state, CAST(o_orderdate AS TIMESTAMP) AS written_at,
       o_totalprice AS amount
FROM orders""",
    "outbox_changes": """
SELECT o_orderkey AS aggregate_id, s.state, CAST(o_orderdate AS TIMESTAMP) + s.days * INTERVAL 1 DAY AS written_at, o_totalprice AS amount
FROM orders, LATERAL (SELECT 'NEW' AS state, 0 AS days UNION ALL SELECT o_orderstatus, 3) s""",
}


def with_views(names: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <fixture views>, <extra ctes> <body>`` for the DuckDB oracle."""
    parts = [f"{n} AS ({FIXTURE_SQL[n].strip()})" for n in names]
    parts += [f"{n} AS ({q.strip()})" for n, q in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
