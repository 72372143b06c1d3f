import numpy as np

from llm_cases import llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm import toxicity


def test_held_out_documents(llm_spark):
    docs, labels = (llm_spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rule = "pmod(xxhash64(doc_id), 4) = 0"
    model = toxicity.fit(docs, labels.where(f"not ({rule})"))
    assert (np.diff(model["thresholds"]) >= 0).all()
    truth = {r.doc_id: r.toxic for r in labels.where(rule).collect()}
    got = [r for r in toxicity.grade_toxicity(docs, model=model).collect() if r.doc_id in truth]
    caught = [r.toxic for r in got if truth[r.doc_id] == 1]
    false = [r.toxic for r in got if truth[r.doc_id] == 0]
    assert np.mean(caught) >= 0.85 and np.mean(false) <= 0.005
    assert all(0 <= r.expected_severity <= 3 and 0 <= r.grade <= 3 for r in got)


def _labelled(n=120):
    words = ["lamp", "river", "stone", "fern", "the", "of"]
    clean = [(i, " ".join(words[(i + j) % 6] for j in range(30))) for i in range(n)]
    bad = [(1000 + i, clean[i][1] + " vilest" * (1 + i % 6)) for i in range(n // 2)]
    return clean + bad, [(d, 0) for d, _ in clean] + [(d, 1) for d, _ in bad]


def test_severity_grows_with_evidence(llm_spark, make_docs):
    docs, labels = _labelled()
    lab = llm_spark.createDataFrame(labels + [(None, 1), (1, None), (5, 0)], "doc_id long, toxic int")
    probe = [(5000 + k, "lamp river" + " vilest" * k) for k in range(8)]
    got = {r.doc_id: r for r in toxicity.grade_toxicity(make_docs(docs + probe, clash=True), lab).collect()}
    severity = [got[5000 + k].expected_severity for k in range(8)]
    assert severity == sorted(severity) and severity[7] > severity[1] > severity[0]
    assert not got[5000].toxic and got[5006].toxic and got[5007].grade >= 2


def test_odd_rows(llm_spark, make_docs, odd_rows):
    docs, labels = _labelled()
    lab = llm_spark.createDataFrame(labels, "doc_id long, toxic int")
    got = toxicity.grade_toxicity(make_docs(docs + [(9000 + (d or 0) if d else None, t) for d, t in odd_rows], clash=True), lab).collect()
    assert len(got) == len(docs) + len(odd_rows)
    assert not any(r.toxic for r in got if r.doc_id is None or r.doc_id >= 9000)


def test_nothing_to_learn_from(llm_spark, make_docs):
    none = llm_spark.createDataFrame([], "doc_id long, toxic int")
    one = llm_spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    for lab in (none, one):
        assert [r.toxic for r in toxicity.grade_toxicity(make_docs([(1, "vile"), (2, None)]), lab).collect()] == [False, False]
    assert toxicity.grade_toxicity(make_docs([]), none).collect() == []
