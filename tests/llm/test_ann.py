import numpy as np
import pytest

from llm_cases import llm_spark  # noqa: F401
from marquee.llm import ann


def _brute(rows, every, k, dims=16):
    ok = [(i, v) for i, v in rows if i is not None and v and len(v) == dims and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ok = {(i, tuple(np.float32(v).tolist())) for i, v in ok}
    out = {}
    for i, v in ok:
        if i % every == 0:
            scores = [(-float(np.dot(np.array(v), np.array(w))), j) for j, w in ok if j != i]
            out.setdefault(i, []).append(sorted(scores)[:k])
    return out


def _recall(got, want, k):
    hit = total = 0
    for i, lists in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == i)
        best = lists[0]
        assert [m[0] for m in mine] == list(range(1, len(best) + 1))
        assert all(a[2] >= b[2] and (a[2] > b[2] or a[1] < b[1]) for a, b in zip(mine, mine[1:]))
        total += len(best)
        hit += sum(m[2] >= -best[-1][0] - 1e-9 for m in mine)
    return hit / total


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, label int").selectExpr("*", "'z' as vec", "0 as shard", "1 as score", "2 as ids")


def test_recall_with_uneven_norms(llm_spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(3000, 16)) * rng.uniform(0.5, 1.5, (3000, 1))
    rows = [(i, v[i].astype(np.float32).tolist()) for i in range(3000)]
    got = ann.nearest(_frame(llm_spark, rows), 20, 20).collect()
    want = _brute(rows, 20, 20)
    assert len(got) == 20 * len(want)
    assert _recall(got, want, 20) >= 0.95
    vec = dict(rows)
    for r in got[:200]:
        assert abs(r.score - float(np.dot(np.array(vec[r.query_id], np.float64), np.array(vec[r.vec_id], np.float64)))) < 1e-12


def test_recall_with_a_few_long_vectors(llm_spark):
    rng = np.random.default_rng(7)
    v = rng.normal(size=(8000, 16))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[[11, 222, 3333, 4004, 7777]] *= 1e4
    rows = [(i, v[i].astype(np.float32).tolist()) for i in range(8000)]
    got = ann.nearest(_frame(llm_spark, rows), 40, 20).collect()
    want = _brute(rows, 40, 20)
    assert len(got) == 20 * len(want)
    assert _recall(got, want, 20) >= 0.95


def test_copies_ties_and_unusable_vectors(llm_spark):
    rng = np.random.default_rng(6)
    same = rng.normal(size=16).astype(np.float32).tolist()
    rows = [(i, same) for i in range(0, 400)] + [(400 + i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(60)]
    rows += [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [None] + [1.0] * 15), (1080, [float("inf")] + [0.0] * 15), (1100, [1.0, 2.0]), (1120, []), (None, same), (40, same)]
    got = ann.nearest(_frame(llm_spark, rows), 20, 20).collect()
    want = _brute(rows, 20, 20)
    assert {r.query_id for r in got} == set(want)
    mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == 40)
    assert [j for _, j in mine] == [j for j in range(21) if j != 40][:20]
    assert _recall(got, want, 20) >= 0.95


def test_few_and_none(llm_spark):
    rows = [(20 * i, np.eye(16)[i].tolist()) for i in range(3)]
    got = ann.nearest(_frame(llm_spark, rows), 20, 20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 20), (0, 2, 40), (20, 1, 0), (20, 2, 40), (40, 1, 0), (40, 2, 20)]
    assert ann.nearest(_frame(llm_spark, [(20, np.eye(16)[0].tolist())]), 20, 20).collect() == []
    none = llm_spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(none).collect() == []


def test_pruning_keeps_diverse_neighbours():
    nodes = np.array([[0, 0], [1, 0], [1.05, 0], [0, 2], [0, 0]], np.float32)
    # brought to one length, as the search does
    extra = np.sqrt(9 - (nodes ** 2).sum(1, keepdims=True))
    full = np.hstack([nodes, extra])
    full[4] = 0
    out = ann.robust_prune(full, np.array([0]), np.array([[1, 2, 3, 0]]), 4, 2, 1.2)
    assert out[0].tolist() == [1, 3]


@pytest.mark.parametrize("uneven", [False, True])
def test_recall_of_full_shards(llm_spark, uneven):
    """64 dimensions without any structure: two whole shards of one length, or lengths from 0.5 to 1.5."""
    rng = np.random.default_rng(9)
    v = rng.normal(size=(2 * ann.SHARD_ROWS, 64))
    v *= (rng.uniform(0.5, 1.5, (len(v), 1)) if uneven else 1) / np.linalg.norm(v, axis=1, keepdims=True)
    v = v.astype(np.float32)
    df = llm_spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<float>")
    got = ann.nearest(df, 80, 20, min_shards=2).collect()
    queries = np.arange(0, len(v), 80)
    score = v[queries].astype(float) @ v.T.astype(float)
    score[np.arange(len(queries)), queries] = -np.inf
    best = {q: set(np.argsort(-s)[:20].tolist()) for q, s in zip(queries.tolist(), score)}
    recall = sum(r.vec_id in best[r.query_id] for r in got) / len(got)
    print("recall", uneven, recall)
    assert len(got) == 20 * len(queries) and recall >= 0.9
