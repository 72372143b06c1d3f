"""Flight search and bookings: P4 search, P6 a user's bookings, J8 booking
price, F4 booking lifecycle audit, F5 the provider failure window.  The seat
ledger (F1-F3) is ``operators.seats``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scan import keyed_position, keyed_sliding_sum

# Call outcomes that count as success for the failure window.
SUCCESS_CODES = ["OK", "NOT_FOUND", "RESOURCE_EXHAUSTED", "INVALID_ARGUMENT"]


def flight_search(flights: DataFrame, origin: str, destination: str, date: str | None = None) -> DataFrame:
    """Scheduled flights origin -> destination, optionally on a UTC date."""
    f = flights.where((F.col("origin_code") == origin) & (F.col("destination_code") == destination)
                      & (F.col("status") == "SCHEDULED"))
    if date is not None:
        f = f.where(F.to_date("departure_time") == F.lit(date).cast("date"))
    return f


def user_bookings(bookings: DataFrame, user_id: str) -> DataFrame:
    """A user's bookings, newest first."""
    return bookings.where(F.col("user_id") == user_id).orderBy(F.desc("created_at"), F.desc("booking_id"))


def booking_pricing(bookings: DataFrame, flights: DataFrame) -> DataFrame:
    """total_price = seat_count x flight price."""
    f = flights.select(F.col("id").alias("flight_id"), "price")
    j = bookings.select("booking_id", "flight_id", "seat_count").join(f, "flight_id")
    return j.select("booking_id", "seat_count", "price",
                    (F.col("seat_count") * F.col("price")).cast("decimal(12,2)").alias("total_price"))


def booking_transitions(events: DataFrame) -> DataFrame:
    """every lifecycle event with the state before it and whether it is
    legal (CREATE from nothing -> CONFIRMED; CANCEL only from CONFIRMED ->
    CANCELLED; an illegal event leaves the state).  Because the states only
    move forward, the state before an event follows from two per-booking
    minima (first CREATE, first CANCEL after it): plain aggregates, no
    per-booking ordered window.  (event_at, action) is unique per booking."""
    first_create = (events.where(F.col("action") == "CREATE").groupBy("booking_id")
                    .agg(F.min("event_at").alias("c_at")))
    e = events.join(first_create, "booking_id", "left")
    first_cancel = (e.where((F.col("action") == "CANCEL") & (F.col("event_at") > F.col("c_at")))
                    .groupBy("booking_id").agg(F.min("event_at").alias("x_at")))
    j = e.join(first_cancel, "booking_id", "left")
    before = (F.when(F.col("c_at").isNull() | (F.col("event_at") < F.col("c_at"))
                     | ((F.col("event_at") == F.col("c_at")) & (F.col("action") == "CREATE")), F.lit(None).cast("string"))
              .when(F.col("x_at").isNull() | (F.col("event_at") <= F.col("x_at")), F.lit("CONFIRMED"))
              .otherwise(F.lit("CANCELLED")))
    j = j.withColumn("from_status", before)
    legal = (((F.col("action") == "CREATE") & F.col("from_status").isNull())
             | ((F.col("action") == "CANCEL") & F.col("from_status").eqNullSafe("CONFIRMED")))
    to = (F.when(legal & (F.col("action") == "CREATE"), "CONFIRMED")
          .when(legal & (F.col("action") == "CANCEL"), "CANCELLED").otherwise(F.col("from_status")))
    return j.select("booking_id", "action", "event_at", "from_status", to.alias("to_status"), legal.alias("legal"))


def provider_failure_window(calls: DataFrame, window: int = 10, threshold: int = 5,
                            chunks: int | None = None) -> DataFrame:
    """per provider in call order (ts, call_id), failures among the last
    ``window`` calls; ``window_bad`` when the window is full and holds at
    least ``threshold`` failures; ``trips`` when that happens on a failing
    call.  Positions and sums over the window come from ordered scans that
    share one exchange; a provider too hot for one task is cut into chunks
    with a halo of the rows before them."""
    failed = (~F.col("code").isin(SUCCESS_CODES)).cast("long")
    c = calls.select("provider", "ts", "call_id", failed.alias("failed"))
    order = ["ts", "call_id"]
    j = keyed_sliding_sum(keyed_position(c, ["provider"], order, "pos", chunks), ["provider"], order, "failed", window, "failures", chunks)
    failures = F.col("failures").cast("int")
    bad = (F.col("pos") >= window) & (failures >= threshold)
    return j.select("provider", F.col("pos").alias("seq"), failures.alias("failures"), bad.alias("window_bad"),
                    (bad & (F.col("failed") == 1)).alias("trips"))
