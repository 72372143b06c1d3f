import random
import zlib

from llm_cases import make_docs, odd_rows, llm_spark  # noqa: F401
from marquee.llm.sharding import shard_by_bytes


def _check(rows, got, shards):
    size = lambda t: len((t or "").encode()) + 1
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(d), size(t), zlib.crc32((t or "").encode())) for d, t in rows)
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    total, largest = sum(size(t) for _, t in rows), max(size(t) for _, t in rows)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(shards)]
    assert max(abs(x - total / shards) for x in sizes) <= largest
    # contiguous: in (shard, slot) order the prefix sums follow one another
    line = sorted(got, key=lambda r: (r.shard, r.slot))
    at = 0
    for r in line:
        assert r.bytes_before == at
        at += r.size
    ids = [r.doc_id for r in line]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_odd_rows(make_docs, odd_rows):
    _check(odd_rows, shard_by_bytes(make_docs(odd_rows, clash=True), 16).collect(), 16)


def test_hot_id_and_many_documents(make_docs):
    rnd = random.Random(1)
    rows = [(7 if rnd.random() < 0.4 else i, "é" * rnd.randint(0, 60)) for i in range(4000)]
    got = shard_by_bytes(make_docs(rows), 16).collect()
    _check(rows, got, 16)
    sizes = [sum(r.size for r in got if r.shard == s) for s in range(16)]
    assert max(sizes) - min(sizes) <= 2 * 121


def test_empty(make_docs):
    assert shard_by_bytes(make_docs([]), 16).collect() == []
