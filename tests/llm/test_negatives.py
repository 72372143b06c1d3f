import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm_cases import llm_spark  # noqa: F401
from marquee.llm import negatives


def _brute(rows, every, positives=5, most=5):
    """Rows (vec_id, label, vector); every pair, in exact integers."""
    ok = [(i, lab, v) for i, lab, v in rows if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [(i, lab, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, lab, v in ok]
    own = {}
    for i, lab, v in whole:
        if i % every == 0:
            own[i] = min(own.get(i, (lab, v)), (lab, v))
    out = []
    for a, (lab, v) in own.items():
        score = [(max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(x * y for x, y in zip(v, w)))), j, other) for j, other, w in whole if j != a]
        for ps, p, _ in sorted(((s, j, o) for s, j, o in score if o == lab), key=lambda x: (-x[0], x[1]))[:positives]:
            fit = sorted((-s, j) for s, j, o in score if o != lab and 80 * ps <= 100 * s <= 100 * ps)[:most]
            out += [(a, p, k, j, ps, -s) for k, (s, j) in enumerate(fit, 1)]
    return sorted(out)


def _run(spark, rows, every=10, **how):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "'x' as cell", "1 as kind", "2 as score", "3 as vector", "4 as limits", "5 as anchor_id")
    return sorted(map(tuple, negatives.hard_negatives(negatives.usable(df), F.col("vec_id") % every == 0, **how).collect()))


def _rows(n, dims=8, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    return [(i, int(rng.integers(labels)), (centre[rng.integers(labels)] + 0.6 * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


def test_all_pairs_over_many_blocks_and_shards(llm_spark):
    rows = _rows(600)
    want = _brute(rows, 10)
    assert len(want) > 500
    assert _run(llm_spark, rows) == want
    assert _run(llm_spark, rows, anchor_block=7, shard_rows=50) == want


def test_ties_copies_and_a_hot_vector(llm_spark):
    rows = _rows(300, dims=3, seed=2)
    rows += [(1000 + i, i % 3, [0.5, 0.25, 0.0]) for i in range(250)]  # one vector for nearly half of the rows
    rows += [(20, 1, rows[20][2]), (20, 0, [1.0, 0.0, 0.0]), (33, 2, rows[33][2]), (33, 2, rows[33][2])]  # repeated ids
    random.Random(4).shuffle(rows)
    assert _run(llm_spark, rows, shard_rows=60) == _brute(rows, 10)


def test_odd_rows(llm_spark):
    inf, nan = float("inf"), float("nan")
    odd = [(None, 1, [1.0, 1.0]), (10, None, [1.0, 1.0]), (20, 1, None), (30, 1, [1.0, None]), (40, 1, [nan, 1.0]), (50, 1, [inf, 1.0]),
           (60, 1, []), (70, 1, [1.0, 1.0, 5.0]), (80, 1, [2.0]), (90, 0, [0.0, 0.0]), (100, 0, [-3.0, -4.0]), (110, 0, [3e30, 1.0]), (-10, 1, [1.0, 2.0]), (-20, 0, [1e20, -1e20])]
    rows = odd + [(i, i % 2, [i / 7, 1 - i / 9]) for i in range(1, 10)]
    assert _run(llm_spark, rows) == _brute(rows, 10)
    assert _run(llm_spark, []) == [] and _run(llm_spark, [(10, 1, [1.0])]) == []


@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-40, 40), st.booleans(), st.integers(-3, 3)), max_size=60))
def test_windows_of_sorted_keys(pairs):
    keys = sorted(negatives.pack_key(a, s, int(neg), i) for a, s, neg, i in pairs)
    assert [negatives.unpack_key(k) for k in keys] == sorted(((a, s, int(neg), i) for a, s, neg, i in pairs), key=lambda x: (x[0], -x[1], x[2], x[3]))
    want = []
    for a in sorted({p[0] for p in pairs}):
        for ps, pid in sorted(((s, i) for x, s, neg, i in pairs if x == a and not neg), key=lambda x: (-x[0], x[1]))[:5]:
            fit = sorted((-s, i) for x, s, neg, i in pairs if x == a and neg and 80 * ps <= 100 * s <= 100 * ps)[:5]
            want += [(a, pid, k, i, ps, -s) for k, (s, i) in enumerate(fit, 1)]
    assert sorted(negatives.windows(keys)) == sorted(want)


def test_exact_scores():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(-2 ** 40, 2 ** 40, (5, 6)).astype(float) for _ in range(2))
    a[2] /= 2 ** 30
    a = np.floor(a)
    want = [[max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(int(x) * int(y) for x, y in zip(v, w)))) for w in b] for v in a]
    assert negatives.exact_scores(a, b).tolist() == want
