"""Validation and audits: event contract (V1), payload rules (V2), table
constraints (V3), session sequences (V4), de-duplication (T3), session
rollup (T5).

Rule checks are column expressions: every failed rule adds its reason to
an array in one projection, so a row is checked in a single pass with no
shuffle.  Uniqueness and foreign keys are grouped aggregates and anti joins, dealt to
tasks by their number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scan import keyed_running

# Fixed values of the contracts.
EVENT_TYPES = ["VIEW_STARTED", "VIEW_FINISHED", "VIEW_PAUSED", "VIEW_RESUMED", "LIKED", "SEARCHED"]
DEVICE_TYPES = ["MOBILE", "DESKTOP", "TV", "TABLET"]
PRODUCT_STATUSES = ["ACTIVE", "INACTIVE", "ARCHIVED"]
PROMO_CODE_PATTERN = "^[A-Z0-9_]{4,20}$"
HEX32_PATTERN = "^[0-9a-fA-F]{32}$"


def reasons(rules: list[tuple[Column, str]]) -> Column:
    """Sorted, comma-joined names of the failed rules ('' when none)."""
    ordered = sorted(rules, key=lambda r: r[1])
    return F.concat_ws(",", *[F.when(bad, F.lit(name)) for bad, name in ordered])


def is_uuid(c: Column) -> Column:
    """UUID text as the producer accepts it: optional urn:/uuid: prefixes and
    braces, hyphens anywhere, 32 hex digits."""
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "urn:", ""), "uuid:", ""), "^\\{|\\}$", "")
    return F.regexp_replace(bare, "-", "").rlike(HEX32_PATTERN)


def _blank(c: Column) -> Column:
    return c.isNull() | (F.length(c) < 1)


def event_contract(raw: DataFrame) -> DataFrame:
    """V1: each raw row with its failed-rule reasons ('' = valid)."""
    rules = [
        (F.col("event_id").isNotNull() & ~is_uuid(F.col("event_id")), "event_id:not_uuid"),
        (_blank(F.col("user_id")), "user_id:empty"),
        (_blank(F.col("movie_id")), "movie_id:empty"),
        (_blank(F.col("session_id")), "session_id:empty"),
        (F.col("event_type").isNull() | ~F.col("event_type").isin(EVENT_TYPES), "event_type:unknown"),
        (F.col("device_type").isNull() | ~F.col("device_type").isin(DEVICE_TYPES), "device_type:unknown"),
        (F.col("progress_seconds") < 0, "progress_seconds:negative"),
    ]
    return raw.withColumn("reasons", reasons(rules))


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with reasons) of a checked frame."""
    ok = F.col("reasons") == ""
    return checked.where(ok).drop("reasons"), checked.where(~ok)


def event_contract_rejects(raw: DataFrame, key: str = "row_id") -> DataFrame:
    return split_valid(event_contract(raw))[1].select(key, "reasons")


def product_contract_rejects(p: DataFrame) -> DataFrame:
    """V2 for product payloads."""
    n = F.length("name")
    rules = [
        (F.col("name").isNull() | (n < 1) | (n > 255), "name:length"),
        (F.length("description") > 4000, "description:length"),
        (F.col("price").isNull() | (F.col("price") < 0.01), "price:min"),
        (F.col("stock").isNull() | (F.col("stock") < 0), "stock:min"),
        (F.col("category").isNull() | (F.length("category") < 1) | (F.length("category") > 100), "category:length"),
        (F.col("status").isNull() | ~F.col("status").isin(PRODUCT_STATUSES), "status:unknown"),
    ]
    return p.select("id", reasons(rules).alias("reasons")).where(F.col("reasons") != "")


def order_contract_rejects(o: DataFrame) -> DataFrame:
    """V2 for order payloads: 1..50 items, each quantity 1..999, promo code
    pattern when a code is given."""
    items = F.col("items")
    rules = [
        (F.size(items) < 1, "items:empty"),
        (F.size(items) > 50, "items:too_many"),
        (~F.forall(items, lambda it: it["quantity"].between(1, 999)), "items:quantity"),
        (F.col("promo_code").isNotNull() & ~F.col("promo_code").rlike(PROMO_CODE_PATTERN), "promo_code:pattern"),
    ]
    return o.select("order_id", reasons(rules).alias("reasons")).where(F.col("reasons") != "")


def order_rows_contract_rejects(headers: DataFrame, items: DataFrame) -> DataFrame:
    """V2 for order payloads whose items arrive as rows: the same rules as
    ``order_contract_rejects`` from per-order counts (partial aggregates,
    so an order with a huge item list never becomes one array)."""
    per = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count_if(~F.col("quantity").between(1, 999) | F.col("quantity").isNull()).alias("bad_qty"))
    j = headers.join(per, "order_id", "left")
    n = F.coalesce(F.col("n_items"), F.lit(0))
    rules = [
        (n < 1, "items:empty"),
        (n > 50, "items:too_many"),
        (F.coalesce(F.col("bad_qty"), F.lit(0)) > 0, "items:quantity"),
        (F.col("promo_code").isNotNull() & ~F.col("promo_code").rlike(PROMO_CODE_PATTERN), "promo_code:pattern"),
    ]
    return j.select("order_id", reasons(rules).alias("reasons")).where(F.col("reasons") != "")


def login_contract_rejects(u: DataFrame) -> DataFrame:
    """V2 for login payloads: password 8..72 characters."""
    n = F.length("password")
    rules = [(_blank(F.col("username")), "username:empty"),
             (F.col("password").isNull() | (n < 8) | (n > 72), "password:length")]
    return u.select("id", reasons(rules).alias("reasons")).where(F.col("reasons") != "")


# ------------------------------------------------------- constraint audit

#: Rows of a table that one task groups by keys which hardly repeat.
TASK_ROWS = 1 << 20


def _tasks(rows: int, task_rows: int) -> int:
    """Tasks to deal rows to by keys which hardly repeat.  Grouping such keys
    before the exchange only fills a map with a whole file split, and exchanges
    merged by their compressed size hold many more rows than they look; a
    number of tasks that follows the rows bounds both."""
    return max(1, -(-rows // task_rows))

def _checks(df: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """All CHECK rules of one table in a single pass: one output row per
    (row, failed rule)."""
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(rule)) for rule, bad in rules]))
    return (df.select(F.col(key).cast("string").alias("key"), F.explode(failed).alias("rule"))
            .select("rule", "key", F.lit(1).cast("long").alias("n")))


def _unique(df: DataFrame, rule: str, cols: list[Column], task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys held by more than one row; a null in any column is no break, as in SQL."""
    keys = [c.cast("string").alias(f"k{i}") for i, c in enumerate(cols)]
    names = [f"k{i}" for i in range(len(cols))]
    return (df.select(*keys).dropna(subset=names).repartition(_tasks(df.count(), task_rows), *names).groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select(F.lit(rule).alias("rule"), F.concat_ws("|", *names).alias("key"), "n"))


def _foreign(child: DataFrame, col: str, parent: DataFrame, pcol: str, rule: str, task_rows: int = TASK_ROWS) -> DataFrame:
    """Values that no row of the parent has.  Those of a parent with many rows
    are dealt to tasks; of a small one they are counted where they are read."""
    refs, keys = child.select(col).where(F.col(col).isNotNull()), parent.select(F.col(pcol).alias(col))
    held = parent.count()
    if held > task_rows:
        n = _tasks(max(held, child.count()), task_rows)
        refs, keys = refs.repartition(n, col), keys.repartition(n, col)
    missing = refs.groupBy(col).agg(F.count(F.lit(1)).alias("n")).join(keys.distinct(), col, "left_anti")
    return missing.select(F.lit(rule).alias("rule"), F.col(col).cast("string").alias("key"), "n")


def constraint_audit(t: dict[str, DataFrame]) -> DataFrame:
    """V3: (rule, key, n) for every CHECK, uniqueness and foreign-key break.
    ``t`` holds products, promo_codes, users, flights, seat_requests,
    bookings, order_items, orders."""
    p, f, sr, b = t["products"], t["flights"], t["seat_requests"], t["bookings"]
    parts = [
        _checks(p, "id", [("products.price_positive", F.col("price") <= 0),
                          ("products.stock_nonnegative", F.col("stock") < 0)]),
        _unique(t["promo_codes"], "promo_codes.code_unique", [F.col("code")]),
        _unique(t["users"], "users.username_unique", [F.col("username")]),
        _checks(f, "id", [("flights.total_seats_positive", F.col("total_seats") <= 0),
                          ("flights.available_nonnegative", F.col("available_seats") < 0),
                          ("flights.price_positive", F.col("price") <= 0),
                          ("flights.available_within_total", F.col("available_seats") > F.col("total_seats"))]),
        _unique(f, "flights.number_date_unique", [F.col("flight_number"), F.to_date("departure_time")]),
        _unique(sr, "seat_reservations.booking_unique", [F.col("booking_id")]),
        _checks(sr, "booking_id", [("seat_reservations.seat_count_positive", F.col("seats") <= 0)]),
        _checks(b, "booking_id", [("bookings.seat_count_positive", F.col("seat_count") <= 0),
                                  ("bookings.total_price_positive", F.col("total_price") <= 0)]),
        _unique(b, "bookings.booking_unique", [F.col("booking_id")]),
        _foreign(t["order_items"], "product_id", p, "id", "order_items.product_fk"),
        _foreign(t["order_items"], "order_id", t["orders"], "id", "order_items.order_fk"),
        _foreign(t["orders"], "promo_code", t["promo_codes"], "code", "orders.promo_fk"),
        _foreign(b, "flight_id", f, "id", "bookings.flight_fk"),
        _foreign(sr, "flight_id", f, "id", "seat_reservations.flight_fk"),
    ]
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out


# ------------------------------------------------------- session audits

def session_sequence_audit(me: DataFrame, chunks: int | None = None) -> DataFrame:
    """V4 per session: events, starts_ok (first event is VIEW_STARTED),
    progress_falls (a progress value below an earlier one), after_finish
    (any event after the first VIEW_FINISHED).  Order is (event_time,
    event_id).  First/last and counts are plain aggregates (partial
    aggregation splits a hot session); the progress check is a running max
    that stays parallel inside a hot session (``keyed_running``)."""
    at = F.struct("event_time", "event_id")
    fin = F.col("event_type") == "VIEW_FINISHED"
    seq = me.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("events"),
        (F.min_by("event_type", at) == "VIEW_STARTED").alias("starts_ok"),
        F.coalesce(F.max(at) > F.min(F.when(fin, at)), F.lit(False)).alias("after_finish"))
    prog = me.where(F.col("progress_seconds").isNotNull()).select(
        "session_id", "event_time", "event_id", "progress_seconds")
    prior = keyed_running(prog, ["session_id"], ["event_time", "event_id"], "progress_seconds", "max",
                          "prior_max", inclusive=False, chunks=chunks)
    falls = (prior.groupBy("session_id")
             .agg(F.max(F.coalesce(F.col("progress_seconds") < F.col("prior_max"), F.lit(False)))
                  .alias("progress_falls")))
    return (seq.join(falls, "session_id", "left")
            .select("session_id", "events", "starts_ok",
                    F.coalesce("progress_falls", F.lit(False)).alias("progress_falls"), "after_finish"))


def dedup_events(events: DataFrame, key: str = "event_id", prefer: list[str] | None = None) -> DataFrame:
    """T3 (batch): one row per ``key``; the kept row is the smallest by
    ``prefer`` then the remaining columns.  A ``min`` over a struct is a
    partial aggregate, so a key delivered millions of times collapses
    map-side instead of landing in one task."""
    prefer = prefer or []
    rest = [c for c in events.columns if c != key and c not in prefer]
    best = F.min(F.struct(*prefer, *rest)).alias("_r")
    return events.groupBy(key).agg(best).select(key, *[F.col(f"_r.{c}").alias(c) for c in prefer + rest])


def session_rollup(me: DataFrame) -> DataFrame:
    """T5: per session start, end, last progress (by event order) and
    whether it finished."""
    at = F.struct("event_time", "event_id")
    return me.groupBy("session_id").agg(
        F.min("event_time").alias("started_at"),
        F.max("event_time").alias("ended_at"),
        F.max_by("progress_seconds", F.when(F.col("progress_seconds").isNotNull(), at)).alias("last_progress"),
        (F.count_if(F.col("event_type") == "VIEW_FINISHED") > 0).alias("finished"))
