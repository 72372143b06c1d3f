import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import SF0001, llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm.packing import _Tokens, pack, plan_patterns

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    return t


def _check(tokenizer, rows, got, capacity):
    want = []
    for d, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for p, a in enumerate(range(0, len(ids), capacity)):
            own = np.array(ids[a:a + capacity], "<u4")
            want.append((str(d), p, a, len(own), zlib.crc32(own.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by), -(-sum(w[3] for w in want) // capacity)


def test_odd_rows(make_docs, odd_rows, tokenizer):
    extra = [(900, "<|endoftext|> don't we'll 'S O'REILLY'S İstanbul ſs K ẞ ß µ ª 12,345 ½ ² x\x1cy z\x85w 你好 日本 é é"), (901, " a b　"), (902, "'")]
    rows = odd_rows + extra
    n, least = _check(tokenizer, rows, pack(make_docs(rows, clash=True), PATH, 64).collect(), 64)
    assert n <= least * 1.02 + 1
    assert pack(make_docs([]), PATH).collect() == []


def test_whole_table_is_nearly_full(llm_spark, tokenizer):
    docs = llm_spark.read.parquet(f"{SF0001}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    n, least = _check(tokenizer, rows, pack(docs, PATH).collect(), 2048)
    assert n <= least + 1


def test_chunks_are_encoded_alike(tokenizer):
    rnd = random.Random(2)
    bits = ["Aé", "ß", "Ö", "'s", "'", "1", "23", ".", "!!", "×", "÷", "ÿ", "İ", "ǅ", "́", "¼", "_", "</w>", "Ω", "ς", "Σ", "-"]
    texts = [" ".join("".join(rnd.choice(bits) for _ in range(rnd.randint(1, 6))) for _ in range(20)) for _ in range(200)]
    own = _Tokens(PATH)
    for t, got in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
        assert got == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_chunks_are_learned_by_their_runs(tokenizer):
    """What is remembered grows with the runs, not with the chunks they make."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghéßö") for _ in range(6)) for _ in range(40)]
    ends = [".", ",", "!", "...", "9", "77", "-"]
    texts = [" ".join(rnd.choice([w, w.title(), w.upper()]) + rnd.choice(ends) + rnd.choice(["", rnd.choice(words)]) for w in words) for _ in range(60)]
    own = _Tokens(PATH)
    for t, got in zip(texts, own.encode([t.encode() for t in texts]), strict=True):
        assert got == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t
    runs = set(words) | {w.upper().lower() for w in words} | {w.title().lower() for w in words} | set(ends) | set("0123456789")
    assert sum(len(c.young) + len(c.old) for c in vars(own).values() if hasattr(c, "young")) <= len(runs)


def test_odd_characters_beside_any_white_space(tokenizer):
    rnd = random.Random(5)
    bits = [*"aAzZ09.,;<|>'\"_-~!\x7f\x00\x01\x1c\x1f\x85\xa0\u3000 \t\n\r\x0b\x0cÀÖØÞßàöøÿ×÷ªºµ½²İıſΣςé\u0301ǅ你😀Ａ", "'s", "'LL", "<|endoftext|>", "</w>", "<|"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(3000)]
    for t, got in zip(texts, _Tokens(PATH).encode([t.encode() for t in texts]), strict=True):
        assert got == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_the_histogram_exactly(seed):
    rnd = random.Random(seed)
    capacity = 100
    counts = {k: rnd.choice([0, 1, 3, 50, 4000]) for k in range(1, capacity + 1) if rnd.random() < 0.5}
    plan = plan_patterns(counts, capacity, 60)
    held = {}
    for pattern, times in plan:
        assert times > 0 and sum(k * c for k, c in pattern.items()) <= capacity
        for k, c in pattern.items():
            held[k] = held.get(k, 0) + c * times
    assert held == {k: c for k, c in counts.items() if c}
    fitted = sum(t for _, t in plan_patterns(counts, capacity, 0))  # best fit alone
    assert sum(t for _, t in plan) <= 1.015 * fitted


def test_plan_beats_greedy_where_patterns_matter():
    rnd = random.Random(2)
    counts = {k: rnd.choice([0, 1, 3, 50, 4000]) for k in range(1, 101) if rnd.random() < 0.5}
    assert sum(t for _, t in plan_patterns(counts, 100, 300)) < sum(t for _, t in plan_patterns(counts, 100, 0))


def test_program_places_a_wide_histogram():
    rnd = random.Random(3)
    counts = {k: rnd.randint(1, 12) for k in range(1, 513)}
    figures = {}
    plan = plan_patterns(counts, 512, figures=figures)
    held = {}
    for pattern, times in plan:
        assert times > 0 and sum(k * c for k, c in pattern.items()) <= 512
        for k, c in pattern.items():
            held[k] = held.get(k, 0) + c * times
    assert held == counts
    assert figures["pieces"] == sum(counts.values()) - counts[512]
    assert figures["placed"] >= 0.99 * figures["pieces"]
    assert sum(t for _, t in plan) <= 1.015 * sum(t for _, t in plan_patterns(counts, 512, 0))
