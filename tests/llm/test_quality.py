import random
import zlib

import numpy as np

from llm_cases import llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm import quality


def test_held_out_documents(llm_spark):
    docs, labels = (llm_spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    got = quality.score_quality(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    held = [(truth[r.doc_id], r.predicted, r.score) for r in got if r.held_out and r.doc_id in truth]
    good, bad = ([p for y, p, _ in held if y == k] for k in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.1
    assert np.mean([[a > b for y, _, b in held if y == 0] for y, _, a in held if y == 1]) >= 0.99


def test_labels_of_held_out_rows_do_not_matter(llm_spark):
    docs, labels = (llm_spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality")
    score = lambda lab: sorted((r.doc_id, r.score) for r in quality.score_quality(docs, lab).collect())
    assert np.allclose(score(labels), score(turned))


def test_features_against_plain_python():
    texts = ["", "Ab cd cd!\n9", "é é", "!!", "one one one two"]
    raw = [t.encode() for t in texts]
    data, offs = np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = quality.features(data, offs)
    for x, r in zip(got, raw):
        pairs = {}
        for a, b in zip(r, r[1:]):
            k = quality._KIND[a] * quality.KINDS + quality._KIND[b]
            pairs[k] = pairs.get(k, 0) + 1
        want = np.zeros(quality.WIDTH)
        for k, n in pairs.items():
            want[k] = (n / max(len(r) - 1, 1)) ** 0.5
        assert np.allclose(x[:-6], want[:-6], atol=1e-6)
        alone = quality.features(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0]
        assert np.allclose(alone, x)
    assert np.allclose(got[4][-6:-4], [2 / 4, 2 / 2]) and got[0][-1] == 1 and got[3][-1] == 1


def test_risk_never_below_zero_is_followed():
    p, u = np.array([0.9, 0.6]), np.array([0.5, 0.2, 0.7])
    prior, eps = 0.4, 1e-6
    logit = lambda v: np.log(v / (1 - v))
    squash = lambda z: 1 / (1 + np.exp(-z))

    def risk(zp, zu):
        a, b = squash(zp), squash(zu)
        return prior * -np.log(a).mean(), -np.log(1 - b).mean() - prior * -np.log(1 - a).mean()
    dp, du, pos, neg = quality.risk_step(p, u, prior)
    assert np.allclose(risk(logit(p), logit(u)), (pos, neg))
    total = sum if neg >= 0 else lambda r: -r[1]
    for i in range(2):
        z = logit(p).copy()
        z[i] += eps
        assert abs((total(risk(z, logit(u))) - total((pos, neg))) / eps - dp[i]) < 1e-4
    high = quality.risk_step(np.array([0.999999]), np.array([0.01]), 0.9)
    assert high[3] < 0 and high[0][0] > 0 and high[1][0] < 0  # the part of the negatives goes up


def test_odd_rows_and_nothing_to_learn(llm_spark, make_docs, odd_rows):
    none = llm_spark.createDataFrame([], "doc_id long, quality int")
    got = quality.score_quality(make_docs(odd_rows, clash=True), none).collect()
    assert len(got) == len(odd_rows) and {r.score for r in got} == {0.5}
    rnd = random.Random(1)
    docs = odd_rows + [(1000 + i, " ".join(rnd.choice(["lamp", "river", "stone"]) for _ in range(20)) + "." if i % 4 else "!!## " * 30) for i in range(400)]
    lab = llm_spark.createDataFrame([(1000 + i, int(i % 4 > 0)) for i in range(400)] + [(None, 1), (1, None), (1001, 0)], "doc_id long, quality int")
    got = quality.score_quality(make_docs(docs, clash=True), lab).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
    mark = lambda k: np.mean([r.score for r in got if r.doc_id and r.doc_id >= 1000 and (r.doc_id % 4 > 0) == k])
    assert mark(True) > 0.7 > 0.3 > mark(False)
    same = {}
    for r, (_, t) in zip(sorted(got, key=lambda r: (r.doc_id is not None, r.doc_id or 0)), sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))):
        same.setdefault((r.doc_id, t), set()).add(r.score)
    assert quality.score_quality(make_docs([]), lab).collect() == []
