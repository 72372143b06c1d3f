"""Ordered running aggregates per key that stay parallel when one key is hot.

``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one
task.  That is the cheapest plan, one exchange, while keys are small, so keys
of at most ``HOT_ROWS`` rows (a count with partial aggregates tells) take it.
The rows of hotter keys are range-partitioned on (key, order) instead, so the
sampler splits a hot key into many ordered chunks by its order columns.  Each
chunk computes its running value locally; a per-(chunk, key) total (one row
per chunk) gives the carry-in from the chunks before it, which is joined back
on (chunk, key).  The chunked rows are written once into the shared folder, so
every branch sees the same chunk ids (two separately planned range exchanges
need not pick the same bounds) and a lost executor changes nothing; nothing
stays cached.  The order columns must be unique within a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, written

_AGG = {"sum": F.sum, "max": F.max, "min": F.min}
#: Rows of one key that a single task may sort.
HOT_ROWS = 1 << 20


def _combine(how: str, carry: Column, local: Column) -> Column:
    if how == "sum":
        return F.when(carry.isNull() & local.isNull(), F.lit(None)).otherwise(
            F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0)))
    if how == "max":
        return F.greatest(carry, local)
    return F.least(carry, local)


def default_chunks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def keyed_running(df: DataFrame, key: list[str], order: list[str], value: Column | str, how: str,
                  out: str, inclusive: bool = True, chunks: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` plus ``out`` = ``how``(value) over the rows of the same key up
    to the current row (``inclusive``) or strictly before it."""
    return keyed_running_many(df, key, order, [(out, value, how)], inclusive, chunks, hot_rows)


def keyed_running_many(df: DataFrame, key: list[str], order: list[str],
                       specs: list[tuple[str, Column | str, str]], inclusive: bool = True,
                       chunks: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Several running aggregates ``(out, value, how)`` over one exchange.
    With ``chunks`` every key is cut into that many ranges."""
    for _, _, how in specs:
        if how not in _AGG:
            raise ValueError(f"unsupported running aggregate {how!r}")
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    r = df
    for i, (_, value, _) in enumerate(specs):
        r = r.withColumn(f"_v{i}", F.col(value) if isinstance(value, str) else value)
    if chunks:
        out = _chunk_running(r, key, order, specs, frame, chunks)
    else:
        hot = written(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).drop("_n"), "scan-hot")
        w = Window.partitionBy(*key).orderBy(*order).rowsBetween(*frame)
        plain = lambda d: d.withColumns({o: _AGG[how](f"_v{i}").over(w) for i, (o, _, how) in enumerate(specs)})
        if hot.limit(1).count() == 0:
            out = plain(r)
        else:
            mark = hot.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(key)])
            same = [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(key)]
            out = plain(r.join(mark, same, "left_anti")).unionByName(
                _chunk_running(r.join(mark, same, "left_semi"), key, order, specs, frame, default_chunks(df)))
    return out.drop(*[f"_v{i}" for i in range(len(specs))])


def _chunk_running(r: DataFrame, key: list[str], order: list[str], specs: list, frame: tuple, n: int) -> DataFrame:
    r = written(r.repartitionByRange(n, *[F.col(c) for c in key + order]).withColumn("_pid", F.spark_partition_id()), "scan-chunks")
    local_w = Window.partitionBy("_pid", *key).orderBy(*order).rowsBetween(*frame)
    carry_w = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    local = r.withColumns({f"_l{i}": _AGG[how](f"_v{i}").over(local_w) for i, (_, _, how) in enumerate(specs)})
    totals = r.groupBy("_pid", *key).agg(*[_AGG[how](f"_v{i}").alias(f"_t{i}") for i, (_, _, how) in enumerate(specs)])
    carry = totals.select(F.col("_pid").alias("_cp"), *[F.col(k).alias(f"_k{j}") for j, k in enumerate(key)],
                          *[_AGG[how](f"_t{i}").over(carry_w).alias(f"_c{i}") for i, (_, _, how) in enumerate(specs)])
    joined = local.join(carry, [F.col("_pid") == F.col("_cp"), *[F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(key)]])
    joined = joined.withColumns({o: _combine(how, F.col(f"_c{i}"), F.col(f"_l{i}")) for i, (o, _, how) in enumerate(specs)})
    return joined.drop("_pid", "_cp", *[f"_k{j}" for j in range(len(key))], *[f"_{p}{i}" for i in range(len(specs)) for p in ("l", "c")])


def keyed_sliding_sum(df: DataFrame, key: list[str], order: list[str], value: Column | str, rows: int, out: str,
                      chunks: int | None = None, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``df`` plus ``out`` = the sum of ``value`` over the last ``rows`` rows of
    the key, the current one included.

    A chunk of a hot key is given a halo: the last ``rows - 1`` rows before it,
    which the chunks' own last rows hold, however small those chunks are."""
    r = df.withColumn("_v", F.col(value) if isinstance(value, str) else value)
    frame = (-(rows - 1), 0)
    plain = lambda d: d.withColumn(out, F.sum("_v").over(Window.partitionBy(*key).orderBy(*order).rowsBetween(*frame)))
    if chunks:
        return _halo_sum(r, key, order, rows, out, chunks).drop("_v")
    hot = written(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).drop("_n"), "scan-hot")
    if hot.limit(1).count() == 0:
        return plain(r).drop("_v")
    mark = hot.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(key)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(key)]
    sums = _halo_sum(r.join(mark, same, "left_semi"), key, order, rows, out, default_chunks(df))
    return plain(r.join(mark, same, "left_anti")).unionByName(sums).drop("_v")


def _halo_sum(r: DataFrame, key: list[str], order: list[str], rows: int, out: str, n: int) -> DataFrame:
    r = written(r.repartitionByRange(n, *[F.col(c) for c in key + order]).withColumn("_pid", F.spark_partition_id()), "scan-chunks")
    last = Window.partitionBy("_pid", *key).orderBy(*[F.desc(c) for c in order])
    # at most rows - 1 rows per chunk and key; per key, those before a chunk's first tail row
    tails = r.withColumn("_back", F.row_number().over(last)).where(F.col("_back") < rows).select("_pid", *key, *order, "_v", "_back")
    before = Window.partitionBy(*key).orderBy("_pid", F.desc("_back")).rowsBetween(-(rows - 1), -1)
    held = tails.select("_pid", *key, "_back", F.collect_list(F.struct(*order, "_v")).over(before).alias("_halo"))
    first = held.groupBy("_pid", *key).agg(F.max_by("_halo", "_back").alias("_halo"))
    halo = first.select("_pid", *key, F.explode("_halo").alias("_h")).select("_pid", *key, *[F.col(f"_h.{c}").alias(c) for c in order], F.col("_h._v").alias("_v"))
    both = r.withColumn("_own", F.lit(True)).unionByName(halo.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy("_pid", *key).orderBy(*order).rowsBetween(-(rows - 1), 0)
    return both.withColumn(out, F.sum("_v").over(w)).where("_own").drop("_own", "_pid")


def chunked(df: DataFrame, key: list[str], order: list[str], chunks: int | None = None) -> DataFrame:
    """``df`` range-partitioned on (key, order) into ``chunks`` ordered
    chunks, each row tagged with its chunk id ``_pid`` and checkpointed, for
    per-chunk passes (``mapInPandas``) that must agree on chunk ids."""
    n = chunks or default_chunks(df)
    ensure_checkpoint_dir(df.sparkSession)
    return (df.repartitionByRange(n, *[F.col(c) for c in key + order])
            .withColumn("_pid", F.spark_partition_id())
            .checkpoint(eager=True))


def keyed_position(df: DataFrame, key: list[str], order: list[str], out: str = "pos",
                   chunks: int | None = None) -> DataFrame:
    """1-based position of each row within its key in ``order``."""
    return keyed_running(df, key, order, F.lit(1).cast("long"), "sum", out, True, chunks)


def global_position(df: DataFrame, order: list[str], out: str = "pos", chunks: int | None = None) -> DataFrame:
    """1-based position in ``order`` over the whole frame, without a
    single-partition window: per-chunk counts give each chunk its offset.
    Rows are range-partitioned and sorted once; a row's number inside its chunk
    is written with it, the chunks' offsets (one row each) are added on reading."""
    n = chunks or default_chunks(df)
    r = df.repartitionByRange(n, *[F.col(c) for c in order]).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    r = written(r, "scan-chunks", "zstd")
    chunk = F.shiftright("_id", 33)
    ends = r.groupBy(chunk.alias("_pid")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_all", F.shiftright("_pid", 32))  # one key
    before = Window.partitionBy("_all").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return r.withColumn("_pid", chunk).join(F.broadcast(starts), "_pid").withColumn(
        out, F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_pid", "_id", "_start")
