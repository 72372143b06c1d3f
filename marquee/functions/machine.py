"""State machines over ordered events, as scans of composable tables.

An event moves a machine if the move is allowed, else it is illegal and
leaves the state.  A run of events is then a function from the state before
it to (state after, time of the last move, legal moves, illegal moves), and
such functions compose, so a key's events need not lie in one task: the
events of hot keys are cut into ordered chunks, each chunk is tabulated for
every possible start, and the tables are composed in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .scan import HOT_ROWS, default_chunks

_CUT = ">"


def run_machine(events: DataFrame, key: str, order: list[str], event: str, at: str, states: list[str], moves: list[tuple[str, str]],
                chunks: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per key: ``key``, state (null before the first legal move), since,
    legal_moves, illegal_moves.

    ``moves`` are the allowed (state, event) pairs; an event's name is the
    state it leads to, and a move from nothing is written with the state "".
    The order columns must be unique within a key.  With ``chunks`` every key
    is cut into ranges, else only keys of more than ``hot_rows`` events."""
    events = events.select(key, *order, F.col(at).alias("_at"), F.col(event).alias("_event"))
    if chunks:
        cut = _cut(events, key, order, chunks)
    else:
        hot = written(events.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(F.col(key).alias("_k")), "machine-hot")
        same = F.col(key).eqNullSafe(F.col("_k"))
        if hot.limit(1).count() == 0:
            cut = events.withColumn("_pid", F.lit(0))
        else:
            cut = events.join(hot, same, "left_anti").withColumn("_pid", F.lit(0)).unionByName(
                _cut(events.join(hot, same, "left_semi"), key, order, default_chunks(events)))
    line = F.array_sort(F.collect_list(F.struct(*order, "_at", "_event")))
    runs = cut.groupBy(key, "_pid").agg(line.alias("_line"))
    allowed = F.array(*[F.lit(f"{a}{_CUT}{b}") for a, b in moves])
    tables = runs.select(key, "_pid", *[_run(F.col("_line"), s, allowed).alias(f"_t{i}") for i, s in enumerate(["", *states])])
    chain = F.array_sort(F.collect_list(F.struct("_pid", *[f"_t{i}" for i in range(len(states) + 1)])))

    def step(acc: Column, x: Column) -> Column:
        t = x["_t0"]
        for i, s in enumerate(states, 1):
            t = F.when(acc["state"] == s, x[f"_t{i}"]).otherwise(t)
        return F.struct(t["state"].alias("state"), F.coalesce(t["since"], acc["since"]).alias("since"),
                        (acc["legal"] + t["legal"]).alias("legal"), (acc["illegal"] + t["illegal"]).alias("illegal"))
    whole = tables.groupBy(key).agg(F.aggregate(chain, _nothing(""), step).alias("_s"))
    return whole.select(key, F.when(F.col("_s.state") != "", F.col("_s.state")).alias("state"), F.col("_s.since").alias("since"),
                        F.col("_s.legal").alias("legal_moves"), F.col("_s.illegal").alias("illegal_moves"))


def _cut(events: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    return written(events.repartitionByRange(n, key, *order).withColumn("_pid", F.spark_partition_id()), "machine-chunks")


def _nothing(state: str) -> Column:
    zero = F.lit(0).cast("long")
    return F.struct(F.lit(state).alias("state"), F.lit(None).cast("timestamp").alias("since"), zero.alias("legal"), zero.alias("illegal"))


def _run(line: Column, start: str, allowed: Column) -> Column:
    """What a run of events makes of ``start``."""
    def step(acc: Column, x: Column) -> Column:
        ok = F.array_contains(allowed, F.concat(acc["state"], F.lit(_CUT), x["_event"]))
        return F.struct(F.when(ok, x["_event"]).otherwise(acc["state"]).alias("state"), F.when(ok, x["_at"]).otherwise(acc["since"]).alias("since"),
                        (acc["legal"] + ok.cast("long")).alias("legal"), (acc["illegal"] + (~ok).cast("long")).alias("illegal"))
    return F.aggregate(line, _nothing(start), step)
