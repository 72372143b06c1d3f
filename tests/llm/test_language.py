import zlib

import numpy as np
import pyarrow as pa

from llm_cases import SF001, llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm import language


def test_held_out_accuracy_on_the_whole_table(llm_spark):
    docs = llm_spark.read.parquet(f"{SF001}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = language.identify(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.99
    assert all(0 <= r.score <= 1 for r in got) and sum(r.ambiguous for r in got) <= 2


def test_odd_rows(llm_spark, make_docs, odd_rows):
    sample = [(10_000 + r.doc_id, r.text, r.lang) for r in llm_spark.read.parquet(f"{SF001}/documents.parquet").limit(200).collect()]
    odd = odd_rows + [(700, "1234 5678 !!"), (701, "é"), (702, "Ω"), (703, "x" * 200_000)]
    docs = make_docs(sample + [(d, t, None) for d, t in odd], clash=True)
    got = [r for r in language.identify(docs).collect() if r.doc_id is None or r.doc_id < 10_000]
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert len(got) == len(odd)
    for d, t in odd:
        wordless = not any(c.isalpha() for c in t or "")
        assert any((r.lang_pred == "und") == wordless and (r.score == 0) == wordless for r in by[d])
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert not {1, 2, 3, 4, 700} & {r.doc_id for r in kept.select("doc_id").collect()}


def test_nothing_to_learn_from(make_docs):
    docs = make_docs([(1, "some words", None), (3, "other words", None)])
    assert {(r.lang_pred, r.score) for r in language.identify(docs).collect()} == {("und", 0.0)}
    assert language.keep_identified(docs).count() == 2
    assert language.identify(make_docs([])).collect() == []
    one = language.identify(make_docs([(i, "only one tongue", "en") for i in range(8)])).collect()
    assert {r.lang_pred for r in one} == {"en"}


def test_held_out_rows_teach_nothing(make_docs):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    docs = make_docs([(i, "zug und wagen", "de") for i in held] + [(i, "the train and the car", "en") for i in range(200) if i not in held])
    assert {r.lang_pred for r in language.identify(docs).collect()} == {"en"}


def test_codewords_are_far_apart_and_decode_through_a_wrong_bit():
    for n in (2, 4, 6, 12):
        code = language.codewords(n)
        far = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert far >= (1 if n == 2 else 2 ** (n - 2) if n <= 6 else 8)
        if n > 2:
            for i in range(n):
                flipped = code[i].copy()
                flipped[0] *= -0.5
                assert language.decode(4 * flipped[None], code)[0][0] == i
    best, second, p = language.decode(np.zeros((1, 7)), language.codewords(4))
    assert best[0] == 0 and second[0] == 1 and abs(p[0] - 0.25) < 1e-9  # a tie goes to the first, with no confidence


def test_a_text_scores_the_same_between_any_neighbours():
    rng = np.random.default_rng(4)
    model = {"languages": ["a", "b", "c"], "code": language.codewords(3), "bias": np.zeros(3, np.float32),
             "weights": rng.normal(size=(language.BUCKETS, 3)).astype(np.float32)}
    predict = language._predictor(model, 0.5)

    def scored(texts):
        row = pa.StructArray.from_arrays([pa.array(texts, pa.string())], names=["text"])
        [out] = predict([pa.RecordBatch.from_arrays([row], names=["row"])])
        return [(r["lang_pred"], round(r["score"], 12), r["runner_up"], r["ambiguous"]) for r in out.to_pylist()]

    texts = ["a", "ab", "abc", "wort", "Ω", "two words"]
    alone = [scored([t])[0] for t in texts]
    for neighbour in ("zzz", "q", "", None, "Éa"):
        got = scored([x for t in texts for x in (t, neighbour)])[::2]
        assert got == alone, neighbour
    assert scored(texts) == alone and scored(texts[::-1]) == alone[::-1]
