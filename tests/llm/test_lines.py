import random

import numpy as np
import pyarrow as pa
import pytest

from llm_cases import llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm import lines

_SEP = bytes((c + 32 if 65 <= c <= 90 else c) if (c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 or 65 <= c <= 90) else 32 for c in range(256))


def _brute(rows):
    """(id, text) -> numbers of the lines that go; rows in the operator's order."""
    seen, out = [], {}
    done = set()
    for d, t in rows:
        if (d, t) in done or t is None:
            continue
        done.add((d, t))
        for i, line in enumerate(t.split("\n")):
            w = line.encode().translate(_SEP).split()
            if not w:
                continue
            s = frozenset([tuple(w)]) if len(w) < 5 else frozenset(zip(*[w[j:] for j in range(5)]))
            if any(5 * len(s & x) >= 4 * len(s | x) for x in seen):
                out.setdefault((d, t), set()).add(i)
            seen.append(s)
    return out


def _check(docs, rows, order):
    got = lines.dedup_lines(docs).collect()
    assert len(got) == len(rows)
    want = _brute(order)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for d, t in rows:
        gone = want.get((d, t), set())
        text = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone)
        assert any(r.text == text and r.removed_lines == sorted(gone) and r.emptied == (bool(gone) and not text.strip()) for r in by[d]), (d, t[:200], gone, [r.removed_lines for r in by[d]])


def _ordered(spark, docs):
    return [(r.doc_id, r.text) for r in docs.selectExpr("doc_id", "text", "xxhash64(text) k").orderBy("doc_id", "k").collect()]


def test_odd_rows(llm_spark, make_docs, odd_rows):
    docs = make_docs(odd_rows, clash=True)
    _check(docs, odd_rows, _ordered(llm_spark, docs))
    out = lines.dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c not in ("removed_lines", "emptied", "_removed")] + ["removed_lines", "emptied"]
    assert all(r.n_chars == len(r.text) for r in out.where("size(removed_lines) > 0").collect())


@pytest.mark.parametrize("heavy,block", [(32, 512), (4, 6)])
def test_near_copies_and_heavy_tokens(llm_spark, make_docs, monkeypatch, heavy, block):
    """Many variants of few lines; small bounds force salts and the second round between them."""
    monkeypatch.setattr(lines, "HEAVY", heavy)
    monkeypatch.setattr(lines, "BLOCK", block)
    rnd = random.Random(heavy)
    vocab = [f"w{i}" for i in range(400)]
    bases = [[rnd.choice(vocab) for _ in range(rnd.randint(8, 60))] for _ in range(6)]
    rows = []
    for i in range(220):
        out = []
        for _ in range(rnd.randint(1, 3)):
            w = list(rnd.choice(bases))
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            out.append(" ".join(w))
        rows.append((i, "\n".join(out)))
    docs = make_docs(rows)
    _check(docs, rows, _ordered(llm_spark, docs))


@pytest.mark.parametrize("block", [512, 7])
def test_a_token_spread_evenly(llm_spark, make_docs, monkeypatch, block):
    """Lines of one template with one word of their own share their rarest-but-one token; no run of tokens shows it as heavy with small blocks."""
    monkeypatch.setattr(lines, "BLOCK", block)
    rnd = random.Random(3)
    template = [f"a{i}" for i in range(9)]
    longer = [f"a{i}" for i in range(30)]
    rows = []
    for i in range(260):
        kind = i % 4
        if kind == 3:  # 26 shingles, those of one word differ: between 0.62 and 0.93
            w = list(longer)
            w[rnd.choice([0, 1, 29, 28, 15])] = f"own{i % 90}"
        else:
            w = [*template[:rnd.randint(7, 9)], f"own{i}"]
        rows.append((i, " ".join(w)))
    docs = make_docs(rows)
    _check(docs, rows, _ordered(llm_spark, docs))


def test_long_runs_come_in_pieces(monkeypatch):
    """A key of more rows than one piece keeps each class once and is marked heavy to its last row; other keys stay as they are."""
    monkeypatch.setattr(lines, "LONG", 8192)
    n = 20_000
    key = np.concatenate([np.full(3, 1), np.full(n, 2), np.full(2, 3)])
    sig = np.concatenate([np.arange(3), np.repeat(np.arange(n // 4), 4), np.arange(2)])
    columns = {"key": key, "sig": sig, "shape": np.full(len(key), 10 << 32 | 1), "place": np.zeros(len(key), np.int32), "parity": np.zeros(len(key), np.int64)}
    whole = pa.record_batch({k: pa.array(v) for k, v in columns.items()})
    got = [tuple(r.values()) for b in lines._live((4, 5), 512, iter([whole.slice(i, 1000) for i in range(0, len(key), 1000)])) for r in b.to_pylist()]
    assert [g[:2] for g in got] == [(1, 0), (1, 1), (1, 2), *((2, i) for i in range(n // 4)), (3, 0), (3, 1)]
    assert {g[2] & 0xFFFF for g in got if g[0] == 2} == {2} and {g[2] & 0xFFFF for g in got if g[0] != 2} == {1}


@pytest.mark.parametrize("held,long,dealt", [(1 << 21, 1 << 16, 1 << 18), (700, 20, 300)])
def test_prefixes_are_shuffled_by_buckets(monkeypatch, held, long, dealt):
    """Few rows go through the shuffle, and no entry with a partner is lost, also from a bucket that is too large to be held."""
    for name, value in (("HELD", held), ("LONG", long), ("DEALT", dealt)):
        monkeypatch.setattr(lines, name, value)
    rnd = random.Random(4)
    own = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    common = own(8)
    texts = [own(40) for _ in range(200)] + [f"{common} {own(2)}" for _ in range(60)] + [own(12)] * 3
    shared = type("Shared", (), {"value": (np.zeros(1 << lines.RARITY_BITS, np.uint8), np.ones(1 << lines.RARITY_BITS, np.uint16))})
    batch = lambda: iter([pa.RecordBatch.from_pydict({"text": texts[i:i + 50]}) for i in range(0, len(texts), 50)])
    entries = np.concatenate(list(lines._prefixes(shared, 5, (4, 5), batch())))
    dealt_out = pa.Table.from_batches(list(lines._buckets(shared, 5, (4, 5), 4, batch())))
    assert sum(len(x) for x in dealt_out.column("rows").to_pylist()) == entries.nbytes
    assert dealt_out.num_rows <= 4 * (len(entries) // min(dealt, 300) + 1)
    ordered = dealt_out.sort_by("bucket").to_batches(max_chunksize=2)
    got = {(r["key"], r["sig"]) for b in lines._by_key(iter(ordered)) for r in b.to_pylist()}
    by_key = {}
    for k, s in zip(entries["key"].tolist(), entries["sig"].tolist(), strict=True):
        by_key.setdefault(k, set()).add(s)
    shared_keys = {(k, s) for k, sigs in by_key.items() if len(sigs) > 1 for s in sigs}
    assert len(shared_keys) > 50 and got >= shared_keys and len(got) < len(entries)


def test_threshold_is_exact(llm_spark, make_docs):
    # 13 words: 9 shingles; changing the last word leaves 8 of 10 shared: exactly 0.8; 12 words fall short
    a = " ".join(f"p{i}" for i in range(13))
    b = " ".join(f"q{i}" for i in range(12))
    rows = [(1, a), (2, a.replace("p12", "other")), (3, b), (4, b.replace("q11", "other")), (5, "in a word"), (6, "In, a WORD!"), (7, "in word a")]
    got = {r.doc_id: r.removed_lines for r in lines.dedup_lines(make_docs(rows)).collect()}
    assert got == {1: [], 2: [0], 3: [], 4: [], 5: [], 6: [0], 7: []}


def test_lines_whose_short_tokens_collide(llm_spark):
    """Tokens that are equal in the 48 bits of the join keys: the lines have names of their own, and the last check tells them apart."""
    x = np.uint64(0x1234_5678_9ABC_0001)
    owner, tokens = np.array([0, 1, 2, 3, 3]), np.array([x, x ^ np.uint64(2), x, x, x], np.uint64)
    (line, bounds, own, sig, begin, end), = lines._sets(owner, tokens)
    assert line.tolist() == [0, 1, 2, 3] and len(set(own.tolist())) == 1
    assert sig[0] == sig[2] == sig[3] != sig[1]
    sets = [(int(sig[k]), lines._distinct(tokens[begin[k]:end[k]]).view(np.int64).tolist()) for k in (0, 1)]
    sets += [(3, sets[0][1])]  # the same words under another name
    pairs = llm_spark.createDataFrame([(sets[1][0], sets[0][0], False), (3, sets[0][0], False)], "probe long, cand long, more boolean")
    assert [r.sig for r in lines._verified(pairs, llm_spark.createDataFrame(sets, "sig long, tokens array<long>"), (4, 5)).collect()] == [3]


def test_candidates_come_in_rounds():
    """A class asks for its earliest fitting candidates first and for the next ones later."""
    n = 40
    columns = {"key": [5] * n + [6], "sig": list(range(n + 1)), "shape": [10 << 32 | 1] * n + [10 << 32 | 1], "place": [0] * (n + 1), "parity": [0] * (n + 1),
               "probe": [False] * (n - 1) + [True, True], "answers": [True] * (n + 1)}
    run = lambda skip, take: [tuple(r.values()) for b in lines._candidates((4, 5), skip, take, iter([pa.record_batch({k: pa.array(v) for k, v in columns.items()})])) for r in b.to_pylist()]
    assert run(0, 2) == [(n - 1, 0, True), (n - 1, 1, True)]
    assert run(2, 8) == [(n - 1, k, True) for k in range(2, 10)]
    assert run(10, 32) == [(n - 1, k, False) for k in range(10, n - 1)]


def test_line_of_many_prefix_tokens(make_docs):
    """A line of 350,000 words has more prefix tokens than 16 bits count."""
    rnd = random.Random(11)
    words = [f"t{rnd.randrange(10 ** 6)}" for _ in range(350_000)]
    near, far = list(words), list(words)
    for i in range(0, 350_000, 70):  # 5 shingles of 70 differ: similarity near 0.87
        near[i] = "other"
    for i in range(0, 350_000, 25):  # 5 of 25: near 0.67
        far[i] = "another"
    rows = [(1, " ".join(words)), (2, " ".join(far)), (3, " ".join(near))]
    assert {r.doc_id: r.removed_lines for r in lines.dedup_lines(make_docs(rows)).collect()} == {1: [], 2: [], 3: [0]}


def test_empty(make_docs):
    assert lines.dedup_lines(make_docs([])).collect() == []
    assert [r.text for r in lines.dedup_lines(make_docs([(1, None), (2, "")])).orderBy("doc_id").collect()] == [None, ""]
