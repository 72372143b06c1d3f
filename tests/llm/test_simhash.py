import random

import pytest
import xxhash

from llm_cases import llm_spark, make_docs, odd_rows  # noqa: F401
from marquee.llm import simhash
from marquee.llm.components import components


def _fp(text, n=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in __import__("re").findall(r"[^\x20\x09-\x0D]+", w)]
    if not w:
        return 0
    sh = [" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _brute(pairs, bits):
    """component (least id) per row of (id, fp)."""
    fps = sorted({f for _, f in pairs})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if bin(a ^ b).count("1") <= bits:
                root[find(b)] = find(a)
    least = {}
    for d, f in pairs:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f, least.get(find(f))) for d, f in pairs]


def test_odd_rows(make_docs, odd_rows):
    got = simhash.near_duplicates(make_docs(odd_rows, clash=True)).collect()
    want = _brute([(d, _fp(t)) for d, t in odd_rows], 2)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == sorted((str(d), f"{f:016x}", c) for d, f, c in want)


def test_no_break_space_and_unit_separators_are_word_characters():
    for t in ("a b c\x1cd e", "A\x0bB\x0cC d", "x y", "one two three four é É"):
        assert simhash.fingerprint(t.encode()) == _fp(t)


@pytest.mark.parametrize("largest", [4, 1024])
def test_links_of_hot_classes(llm_spark, largest):
    """A cloud of fingerprints around one, far more than a class may hold, is refined and loses no link."""
    rnd = random.Random(9)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for c in list(fps)[:3]:
        for _ in range(150):
            f = c
            for _ in range(rnd.randint(1, 5)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    df = llm_spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    links = simhash.near_links(df, 2, largest).collect()
    got = components(llm_spark.createDataFrame(links, "a long, b long")).collect()
    root = {r.node % (1 << 64): r.root for r in got}
    want = _brute([(i, f) for i, f in enumerate(sorted(fps))], 2)
    by = {}
    for _, f, c in want:
        by.setdefault(c, set()).add(root.get(f, ("alone", f)))
    assert all(len(v) == 1 for v in by.values()) and len({next(iter(v)) for v in by.values()}) == len(by)
    assert len(links) < 60 * len(fps)


def test_components_of_chains_and_stars(llm_spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(llm_spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def test_keep_one(make_docs, odd_rows):
    docs = make_docs(odd_rows, clash=True)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = {}
    for d, f, c in _brute([(d, _fp(t)) for d, t in odd_rows], 2):
        want.setdefault(c, []).append(d)
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min((d for d in v if d is not None), default=None)) for v in want.values())


def test_empty(make_docs):
    assert simhash.near_duplicates(make_docs([])).collect() == []
    assert simhash.keep_one(make_docs([])).collect() == []
