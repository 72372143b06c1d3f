"""Ordered running aggregates stay exact when a hot key spans many chunks."""

import random

import pandas as pd
from pyspark.sql import functions as F

from marquee.functions.scan import global_position, keyed_running, keyed_running_many


def _rows(n=3000, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 30)}"
        out.append((key, i, rnd.randint(-50, 50)))
    rnd.shuffle(out)
    return out


def _expected(rows, how, inclusive):
    pdf = pd.DataFrame(rows, columns=["k", "o", "v"]).sort_values(["k", "o"])
    res = {}
    for k, g in pdf.groupby("k"):
        acc = None
        for o, v in zip(g["o"], g["v"]):
            if inclusive:
                acc = v if acc is None else (acc + v if how == "sum" else max(acc, v) if how == "max" else min(acc, v))
                res[(k, o)] = acc
            else:
                res[(k, o)] = acc
                acc = v if acc is None else (acc + v if how == "sum" else max(acc, v) if how == "max" else min(acc, v))
    return res


def test_running_aggregates_match_sequential(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, o long, v long")
    for how in ("sum", "max", "min"):
        for inclusive in (True, False):
            got = keyed_running(df, ["k"], ["o"], "v", how, "r", inclusive, chunks=7).collect()
            exp = _expected(rows, how, inclusive)
            assert {(r.k, r.o): r.r for r in got} == exp, (how, inclusive)


def test_hot_key_is_split_across_chunks(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, o long, v long")
    pids = (df.repartitionByRange(7, "k", "o").withColumn("p", F.spark_partition_id())
            .where(F.col("k") == "hot").select("p").distinct().count())
    assert pids > 1


def test_many_and_global_position(spark):
    rows = _rows(500, seed=3)
    df = spark.createDataFrame(rows, "k string, o long, v long")
    got = keyed_running_many(df, ["k"], ["o"], [("pos", F.lit(1).cast("long"), "sum"), ("s", F.col("v"), "sum")],
                             chunks=5).collect()
    exp_s = _expected(rows, "sum", True)
    pos = {}
    for k, o, _ in sorted(rows):
        pos[(k, o)] = pos.get(("n", k), 0) + 1
        pos[("n", k)] = pos[(k, o)]
    for r in got:
        assert r.s == exp_s[(r.k, r.o)]
        assert r.pos == pos[(r.k, r.o)]
    g = global_position(df, ["o"], "rn", chunks=6).collect()
    assert sorted((r.o, r.rn) for r in g) == [(o, i + 1) for i, o in enumerate(sorted(r[1] for r in rows))]
