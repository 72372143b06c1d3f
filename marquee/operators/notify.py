"""Notification delivery analytics (specified in the reference's design
document only): idempotency keys (N1), 24 h de-duplication (N2), routing by
preference (N3), channel plans (N4), failover (N5), delivery state (N6),
priority lanes (N7), dead letters (N8), delivery KPIs (N9), campaign
pacing (N10) and outbox events (N11).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.machine import run_machine
from ..functions.scan import global_position, keyed_position, keyed_running
from ..session import written

# Fixed values of the design.
DEFAULT_CHAIN = ["push", "sms", "email"]
MANDATORY_TYPES = ["TRANSACTIONAL"]      # cannot be opted out of
LANES = {"TRANSACTIONAL": "transactional", "SERVICE": "service", "MARKETING": "marketing"}
ACK_TIMEOUT_MS = 5000
DEDUP_TTL_HOURS = 24
P99_TARGET_MS = 5000
SUCCESS_TARGET = 0.995
SMS_SHARE_TARGET = 0.15
CAMPAIGN_BATCH = 1000
STATES = ["PENDING", "IN_FLIGHT", "DELIVERED", "FAILED", "FAILOVER", "EXHAUSTED"]
ALLOWED_MOVES = [("", "PENDING"), ("PENDING", "IN_FLIGHT"), ("IN_FLIGHT", "DELIVERED"), ("IN_FLIGHT", "FAILED"),
                 ("FAILED", "FAILOVER"), ("FAILOVER", "IN_FLIGHT"), ("FAILED", "EXHAUSTED")]


def idem_key(service: Column, event: Column, user: Column) -> Column:
    """SHA-256 of service, event and user ids joined by '|'."""
    return F.sha2(F.concat_ws("|", service.cast("string"), event.cast("string"), user.cast("string")), 256)


def notif_keys(attempts: DataFrame) -> DataFrame:
    """The idempotency key of every attempt's notification."""
    return attempts.select("attempt_id", idem_key(F.col("source_service"), F.col("notification_id"),
                                                  F.col("user_id")).alias("idem_key"))


def dedup_ttl(attempts: DataFrame, ttl_hours: int = DEDUP_TTL_HOURS) -> DataFrame:
    """Attempts kept by a per-(idem_key, channel) TTL: an attempt is
    dropped while a *kept* attempt of the same key and channel is younger
    than the TTL.

    An attempt at least the TTL after the one before it is kept whatever came
    earlier, so gaps cut a key into independent segments: their first attempts
    are kept, and only segments with a second attempt are looked into.  There
    the kept attempts form a chain (the first, then the first one at least the
    TTL after the last kept), so:

    * positions and each attempt's successor candidate ``nxt`` (first
      attempt at or after ts + ttl) come from ordered scans that stay
      parallel for a hot key;
    * chain membership is reachability from position 1 by pointer
      doubling: after round r the reached set holds every chain member
      fewer than 2**(r+1) steps away; jump pointers square each round.
      Every round is two equi-joins on (segment, position), written once."""
    ttl = ttl_hours * 3600 * 1_000_000
    lane = ["idem_key", "channel"]
    a = attempts.withColumn("idem_key", idem_key(F.col("source_service"), F.col("notification_id"), F.col("user_id"))).withColumn("_t", F.unix_micros("ts"))
    a = keyed_running(a, lane, ["ts", "attempt_id"], "_t", "max", "_before", inclusive=False)
    a = a.withColumn("_first", (F.col("_before").isNull() | (F.col("_t") - F.col("_before") >= ttl)).cast("long"))
    a = written(keyed_running(a, lane, ["ts", "attempt_id"], "_first", "sum", "_segment"), "ttl-segments")
    key = [*lane, "_segment"]
    dense = a.join(a.where("_first = 0").select(*key).distinct(), key, "left_semi")
    pos = written(keyed_position(dense.select(*key, "_t", "ts", "attempt_id"), key, ["ts", "attempt_id"], "pos"), "ttl-dense")
    # successor candidate: reverse scan over rows and probes (probe at t+ttl
    # sorts before a row at the same instant, so ">=" holds)
    none = F.lit(None).cast("long")
    rows = pos.select(*key, F.col("_t").alias("t"), F.lit(1).alias("kind"), "pos", none.alias("src"))
    probes = pos.select(*key, (F.col("_t") + ttl).alias("t"), F.lit(0).alias("kind"), none.alias("pos"), F.col("pos").alias("src"))
    both = rows.unionByName(probes).select(*key, (-F.col("t")).alias("nt"), (-F.col("kind")).alias("nk"),
                                            "pos", "src", F.coalesce("pos", "src").alias("tie"))
    nxt = (keyed_running(both, key, ["nt", "nk", "tie"], "pos", "min", "nxt", inclusive=True)
           .where(F.col("src").isNotNull()).select(*key, F.col("src").alias("pos"), "nxt"))
    jump = written(nxt.where(F.col("nxt").isNotNull()), "ttl-jump")
    reached = pos.where(F.col("pos") == 1).select(*key, "pos")
    while jump.limit(1).count():  # spans double: logarithmic in the longest chain
        step = reached.join(jump, [*key, "pos"]).select(*key, F.col("nxt").alias("pos"))
        reached = written(reached.unionByName(step).distinct(), "ttl-reached")
        far = jump.select(*key, F.col("pos").alias("nxt"), F.col("nxt").alias("far"))
        jump = written(jump.join(far, [*key, "nxt"]).select(*key, "pos", F.col("far").alias("nxt")), "ttl-jump")
    later = pos.join(reached.where(F.col("pos") > 1), [*key, "pos"], "left_semi").select(*key, "ts", "attempt_id")
    kept = a.where("_first = 1").unionByName(a.where("_first = 0").join(later, [*key, "ts", "attempt_id"], "left_semi"))
    return kept.select(*attempts.columns, "idem_key")


def routable(notifications: DataFrame, prefs: DataFrame) -> DataFrame:
    """Notifications left after opt-outs (mandatory types are always
    routable); users without preferences get the default plan."""
    p = prefs.select("user_key", "preferred_channel", "opted_out_types")
    j = notifications.join(p, "user_key", "left")
    opted = F.coalesce(F.array_contains(F.col("opted_out_types"), F.col("type")), F.lit(False))
    keep = F.col("type").isin(MANDATORY_TYPES) | ~opted
    return j.where(keep).select("notification_id", "user_key", "type", "preferred_channel")


def channel_plan(routed: DataFrame, chain: list[str] | None = None) -> DataFrame:
    """Preferred channel first, then the configured chain (comma-joined)."""
    return routed.select("notification_id", F.array_join(plan_of("preferred_channel", chain), ",").alias("channels"))


def plan_of(preferred: str, chain: list[str] | None = None) -> Column:
    """The channels of a user in order: the preferred one (a null has none), then the rest of the chain."""
    rest = F.array(*[F.lit(c) for c in chain or DEFAULT_CHAIN])
    return F.array_distinct(F.array_compact(F.concat(F.array(F.col(preferred)), rest)))


def with_plan(attempts: DataFrame, prefs: DataFrame | None, chain: list[str] | None = None) -> DataFrame:
    """``attempts`` plus ``plan``: the user's own channels; users without preferences (or no table) get the chain."""
    if prefs is None:
        return attempts.withColumn("preferred", F.lit(None).cast("string")).withColumn("plan", plan_of("preferred", chain)).drop("preferred")
    p = prefs.select("user_id", F.col("preferred_channel").alias("preferred"))
    return attempts.join(p, "user_id", "left").withColumn("plan", plan_of("preferred", chain)).drop("preferred")


def next_in_plan(plan: Column, channel: Column) -> Column:
    """The channel after the failed one in the plan; null at its end or outside it."""
    place = F.array_position(plan, channel)
    return F.when(place > 0, F.get(plan, place.cast("int")))


def acks_of(attempts: DataFrame) -> DataFrame:
    """Delivery acknowledgements: a delivered attempt acks after its latency."""
    return attempts.where(F.col("outcome") == "DELIVERED").select(
        "notification_id", "channel", (F.col("ts") + F.make_dt_interval(
            secs=F.col("latency_ms").cast("decimal(18,3)") / 1000)).alias("ack_at"))


def failover(attempts: DataFrame, acks: DataFrame, prefs: DataFrame | None = None, timeout_ms: int = ACK_TIMEOUT_MS,
             chain: list[str] | None = None, chunks: int | None = None) -> DataFrame:
    """Attempts that hand over to the next channel of their user's plan
    (``prefs``: user_id, preferred_channel): FAILED, or no ack
    for the (notification, channel) within the timeout after the send.  An
    ack inside the timeout cancels the failover.

    The interval join is an as-of look-up: attempts and acks are merged per
    (notification, channel) and a reverse ordered scan gives each attempt
    the first ack at or after its send time, so a busy notification never
    compares every attempt with every ack."""
    key = ["notification_id", "channel"]
    a = with_plan(attempts, prefs, chain).select("attempt_id", *key, "outcome", "ts", "plan")
    sends = a.select(*key, F.unix_micros("ts").alias("t"), F.lit(0).alias("kind"),
                     F.col("attempt_id").cast("long").alias("ref"), F.lit(None).cast("long").alias("ack_t"))
    acked_at = acks.select(*key, F.unix_micros("ack_at").alias("t"), F.lit(1).alias("kind"),
                           F.lit(None).cast("long").alias("ref"), F.unix_micros("ack_at").alias("ack_t"))
    # reverse order; at the same instant the ack sorts after the send in
    # reverse, i.e. it counts ("ack_at >= ts")
    both = sends.unionByName(acked_at).select(*key, (-F.col("t")).alias("nt"), (-F.col("kind")).alias("nk"),
                                               F.coalesce("ref", F.lit(-1)).alias("nr"), "ref", "ack_t")
    first_ack = (keyed_running(both, key, ["nt", "nk", "nr"], "ack_t", "min", "next_ack", inclusive=True, chunks=chunks)
                 .where(F.col("nk") == 0).select(F.col("ref").alias("attempt_id"), "next_ack"))
    j = a.join(first_ack, "attempt_id")
    late = F.col("next_ack").isNull() | (F.col("next_ack") > F.unix_micros("ts") + timeout_ms * 1000)
    out = j.where((F.col("outcome") == "FAILED") | late)
    return out.select("notification_id", F.col("channel").alias("failed_channel"),
                      next_in_plan(F.col("plan"), F.col("channel")).alias("next_channel"),
                      F.when(F.col("outcome") == "FAILED", "FAILED").otherwise("ACK_TIMEOUT").alias("reason"),
                      "attempt_id")


def state_events(attempts: DataFrame, prefs: DataFrame | None = None, chain: list[str] | None = None) -> DataFrame:
    """State events of the notifications: PENDING before the first attempt;
    per attempt IN_FLIGHT at its send and its outcome after the latency; a
    failure is followed by FAILOVER if the user's plan has a channel after the
    failed one, else by EXHAUSTED."""
    done_at = F.col("ts") + F.make_dt_interval(secs=F.col("latency_ms").cast("decimal(18,3)") / 1000)
    a = with_plan(attempts, prefs, chain).select("notification_id", "attempt_id", "outcome", "ts", done_at.alias("done_at"),
                                                 next_in_plan(F.col("plan"), F.col("channel")).isNotNull().alias("more"))
    begun = a.groupBy("notification_id").agg(F.min(F.struct("ts", "attempt_id")).alias("f")).select(
        "notification_id", F.col("f.attempt_id").alias("attempt_id"), F.lit(0).alias("step"), F.lit("PENDING").alias("state"), F.col("f.ts").alias("event_at"))
    event = lambda step, state, at: F.struct(F.lit(step).alias("step"), state.alias("state"), F.col(at).alias("event_at"))
    steps = F.array(event(1, F.lit("IN_FLIGHT"), "ts"), event(2, F.col("outcome"), "done_at"),
                    F.when(F.col("outcome") == "FAILED", event(3, F.when(F.col("more"), "FAILOVER").otherwise("EXHAUSTED"), "done_at")))
    return begun.unionByName(a.select("notification_id", "attempt_id", F.explode(F.array_compact(steps)).alias("e")).select("notification_id", "attempt_id", "e.*"))


def delivery_state(events: DataFrame, chunks: int | None = None) -> DataFrame:
    """The delivery state machine per notification: its state, since when,
    and how many events moved it or were not allowed and left it."""
    return run_machine(events, "notification_id", ["event_at", "attempt_id", "step"], "state", "event_at", STATES, ALLOWED_MOVES, chunks)


def lane_of(type_col: Column) -> Column:
    expr = None
    for t, lane in LANES.items():
        expr = F.when(type_col == t, F.lit(lane)) if expr is None else expr.when(type_col == t, F.lit(lane))
    return expr


def lanes(notifications: DataFrame) -> DataFrame:
    """Notifications per priority lane."""
    return (notifications.select(lane_of(F.col("type")).alias("lane")).groupBy("lane")
            .agg(F.count(F.lit(1)).alias("n")))


def dead_letters(attempts: DataFrame, prefs: DataFrame | None = None, chain: list[str] | None = None) -> DataFrame:
    """Notifications with no delivered attempt after every channel of
    their own plan was tried."""
    a = with_plan(attempts, prefs, chain)
    g = a.groupBy("notification_id").agg(
        F.count_if(F.col("outcome") == "DELIVERED").alias("delivered"),
        F.collect_set("channel").alias("channels"), F.max("plan").alias("plan"))
    left = F.size(F.array_except("plan", "channels"))
    return g.where((F.col("delivered") == 0) & (left == 0)).select("notification_id", F.size("channels").cast("long").alias("tried"))


def delivery_kpis(attempts: DataFrame) -> DataFrame:
    """N9 per channel and type: attempts and exact P99 latency; per type, over
    notifications: success rate (at least one channel reached), SMS share
    (notifications that needed an SMS) and duplicate deliveries (delivered
    attempts beyond a notification's first); with the design targets.

    Latencies are counted per value first, so the percentile weighs counts
    and a hot channel collapses map-side."""
    per = (attempts.groupBy("channel", "type", F.col("latency_ms").cast("double").alias("ms"))
           .agg(F.count(F.lit(1)).alias("k")).groupBy("channel", "type")
           .agg(F.sum("k").alias("n"), F.percentile("ms", 0.99, F.col("k")).alias("p99_ms")))
    each = attempts.groupBy("type", "notification_id").agg(
        F.count_if(F.col("outcome") == "DELIVERED").alias("d"), F.bool_or(F.col("channel") == "sms").alias("sms"))
    whole = each.groupBy("type").agg(
        (F.count_if(F.col("d") > 0) / F.count(F.lit(1))).alias("success_rate"),
        (F.count_if("sms") / F.count(F.lit(1))).alias("sms_share"),
        F.sum(F.greatest(F.col("d") - 1, F.lit(0))).cast("long").alias("duplicates"))
    return per.join(whole, "type").select(
        "channel", "type", "n", "p99_ms", "success_rate", "sms_share", "duplicates",
        (F.col("p99_ms") <= P99_TARGET_MS).alias("p99_ok"),
        (F.col("success_rate") >= SUCCESS_TARGET).alias("success_ok"),
        (F.col("sms_share") <= SMS_SHARE_TARGET).alias("sms_ok"))


def success_rolling(attempts: DataFrame, hours: int = 24) -> DataFrame:
    """N9 "success per 24 h": for each (channel, type) and each hour with
    attempts, the success rate over the ``hours`` hours ending with that
    hour, against the target.  Attempts are first reduced to hourly counts
    (partial aggregation, so a hot channel collapses map-side); the sliding
    sum then runs over at most one row per hour and group, a size set by
    the time span, not by the data volume."""
    hourly = (attempts.groupBy("channel", "type", F.floor(F.unix_seconds("ts") / 3600).alias("hour_no"))
              .agg(F.count(F.lit(1)).alias("n_h"), F.count_if(F.col("outcome") == "DELIVERED").alias("ok_h")))
    w = Window.partitionBy("channel", "type").orderBy("hour_no").rangeBetween(-(hours - 1), 0)
    rolled = hourly.select("channel", "type", "hour_no", F.sum("n_h").over(w).alias("attempts"),
                           F.sum("ok_h").over(w).alias("delivered"))
    rate = F.col("delivered") / F.col("attempts")
    return rolled.select("channel", "type", F.timestamp_seconds((F.col("hour_no") + 1) * 3600).alias("window_end"),
                         "attempts", "delivered", rate.alias("success_rate"),
                         (rate >= SUCCESS_TARGET).alias("success_ok"))


def campaign_batches(recipients: DataFrame, rate_per_sec: int, batch: int = CAMPAIGN_BATCH,
                     chunks: int | None = None) -> DataFrame:
    """Send slot (second) and provider batch per recipient in user
    order; the global numbering comes from per-chunk counts, never a
    single-partition window."""
    numbered = global_position(recipients.select("user_key"), ["user_key"], "rn", chunks)
    return numbered.select("user_key", F.floor((F.col("rn") - 1) / rate_per_sec).cast("long").alias("slot"),
                           F.floor((F.col("rn") - 1) / batch).cast("long").alias("batch_no"))


def outbox_messages(outbox: DataFrame) -> DataFrame:
    """Every outbox row as the message to publish."""
    return outbox.select("aggregate_id", "state", "written_at", "amount", F.to_json(F.struct("aggregate_id", "state", "amount")).alias("payload"))


def outbox_events(outbox: DataFrame) -> DataFrame:
    """Latest outbox row per aggregate as a publishable event (a max
    over a struct: partial aggregation, no per-key window)."""
    latest = outbox.groupBy("aggregate_id").agg(F.max(F.struct("written_at", "state", "amount")).alias("l"))
    return latest.select("aggregate_id", F.col("l.state").alias("state"), F.col("l.written_at").alias("written_at"),
                         F.col("l.amount").alias("amount"),
                         F.to_json(F.struct(F.col("aggregate_id"), F.col("l.state").alias("state"),
                                            F.col("l.amount").alias("amount"))).alias("payload"))
