"""The pipeline's stages against brute force on the smallest table."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm_cases import SF0001, llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm import common, packing
from marquee.sources.tables import read_table
from test_decontamination import _brute as contaminated
from test_lines import _brute as removed_lines
from test_simhash import _brute as near
from test_simhash import _fp


def _expected(rows, items):
    """(id, text) kept before packing."""
    order = [(r[0], r[1]) for r in rows]
    gone = removed_lines(order)
    docs = []
    for d, t in order:
        out = gone.get((d, t), set())
        text = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in out)
        if not out or text.strip():
            docs.append((d, text))
    least = {}
    for d, _, c in near([(d, _fp(t)) for d, t in docs], 2):
        least.setdefault(c, d)
        least[c] = min(least[c], d)
    docs = [(d, t) for d, t in docs if d in set(least.values())]
    bad = {int(w[0]) for w in contaminated(docs, items) if w[5]}
    return [(d, t) for d, t in docs if d not in bad]


def test_run_against_brute_force(llm_spark):
    docs = read_table(llm_spark, SF0001, "documents")
    rows = [(r.doc_id, r.text) for r in docs.withColumn("k", F.xxhash64("text")).orderBy("doc_id", "k").collect()]
    items = [(r.item_id, r.text) for r in read_table(llm_spark, SF0001, "benchmark").collect()]
    # the classifier is judged by its own tests: here it may reject nothing that has letters and is plainly of one language
    kept = corpus_pipeline.identify_language(llm_spark, docs, SF0001)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert len(ids) >= 0.99 * len(rows)
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for d, t in _expected([r for r in rows if r[0] in ids], items):
        own = [*tok.encode(t, add_special_tokens=False).ids, 0]
        want += [(d, p, zlib.crc32(np.array(own[a:a + 2048], "<u4").tobytes())) for p, a in enumerate(range(0, len(own), 2048))]
    got = corpus_pipeline.run(llm_spark, SF0001).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in got) == sorted(want)


def test_stages_keep_the_columns_and_odd_rows(llm_spark, make_docs, odd_rows):
    for rows, clash in ((odd_rows, True), ([], False)):
        docs = make_docs(rows, clash=clash)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(llm_spark, docs, SF0001)
            assert out.schema.simpleString() == docs.schema.simpleString()
            kept = out.collect()
            own = [c for c in docs.columns if c not in ("doc_id", "text", "lang", "source", "n_chars")]
            assert all(r[c] == (None if r.doc_id is None else f"x{r.doc_id}") for r in kept for c in own)
        corpus_pipeline.STAGES[-1][1](llm_spark, docs, SF0001).collect()


def test_workers_give_memory_back_after_every_task(llm_spark, make_docs, odd_rows, monkeypatch):
    """Workers are used again: what each stage's tasks leave behind would add up in them."""
    docs = make_docs(odd_rows)
    kind, unwrapped, calls = type(docs), [], []
    plain = kind.mapInArrow

    def noted(self, function, *args, **kwargs):
        calls.append(function)
        if getattr(function, "__wrapped__", None) is None or function.__globals__.get("give_back") is not common.give_back:
            unwrapped.append(function)
        return plain(self, function, *args, **kwargs)

    monkeypatch.setattr(kind, "mapInArrow", noted)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = common.written(stage(llm_spark, docs, SF0001), "stage")
    corpus_pipeline.STAGES[-1][1](llm_spark, docs, SF0001).collect()
    assert len(calls) >= 12 and not unwrapped


def test_lean_gives_back_at_the_end_and_when_ended_early(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    passed = common.lean(lambda batches: (b + 1 for b in batches))
    assert list(passed(iter([1, 2]))) == [2, 3] and given == [1]
    early = passed(iter([1, 2]))
    assert next(early) == 2
    early.close()
    assert given == [1, 1]


def test_no_learned_words_stay_behind(monkeypatch):
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 0})())}))
    path = public_tokenizers.path("word_bpe_49k.json")
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["some words here", "and others"]})
    assert sum(b.num_rows for b in packing._pieces(path, 2048, iter([batch]))) == 2
    assert not packing._tokens[path].words.young and not packing._tokens[path].words.old
