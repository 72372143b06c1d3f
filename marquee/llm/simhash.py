"""Operator 7: SimHash near-duplicates by pigeonhole blocks.

Fingerprints within k differing bits agree on at least b - k of b blocks, so
every choice of b - k blocks is a join key; only fingerprints that share a key
are compared.  Equal fingerprints are one class beforehand.  A key whose
class is too large is refined by the same argument on the bits it leaves
open, down to a size that any task can hold.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import carried, lean, same_document, shuffle_parts, written
from marquee.llm.components import components
from marquee.llm.words import flat

#: Fingerprints under one key that are compared at once; larger classes are refined first.
LARGEST = 1024

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(raw: bytes, shingle: int = 3) -> int:
    """The 64-bit SimHash of a UTF-8 text: words between ASCII white space,
    lower-cased A-Z; a bit is set if over half of the shingles' XXH64 (seed
    42, repeats count) have it.  No word: 0."""
    words = raw.translate(_LOWER).split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest, seed = xxhash.xxh64_intdigest, 42
    h = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts[:n - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)), np.uint64, n - shingle + 1)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 14):
        octets = h[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int32)
    bits = np.flatnonzero(2 * ones > len(h))
    return int(sum(1 << int(b) for b in bits))


def _fingerprints(shingle, batches):
    for b in batches:
        data, offs = flat(b.column("text"))
        raw = data.tobytes()
        fp = np.array([fingerprint(raw[offs[i]:offs[i + 1]], shingle) for i in range(b.num_rows)], np.uint64).view(np.int64)
        names = [n for n in b.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(fp)], names=[*names, "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, text_key (hash of the text) and fp of every row, written out."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return written(slim.mapInArrow(lean(partial(_fingerprints, shingle)), f"doc_id {id_type}, text_key long, fp long"), "simhash-fp")


def _blocks(open_bits: list[int], bits: int) -> list[int]:
    """Masks, one per key: the open bits dealt into bits + 2 blocks, two of
    which stay equal whichever ``bits`` positions differ."""
    cut = np.array_split(np.array(open_bits), bits + 2)
    masks = [sum(1 << int(b) for b in blk) for blk in cut if len(blk)]
    return [a | b for a, b in combinations(masks, 2)] if len(masks) > bits + 1 else [0]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, bits: int) -> DataFrame:
    """First keys of (fp): key = (masked fingerprint, mask)."""
    masks = F.array(*(F.lit(_signed(m)).cast("long") for m in _blocks(list(range(64)), bits)))
    return rows.select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def _refined(rows: DataFrame, bits: int, level: int) -> DataFrame:
    """Finer keys for the rows of large classes: per mask so far, the masks that add two of the blocks of its open bits."""
    seen = {m: m for m in _blocks(list(range(64)), bits)}
    for _ in range(level):
        seen = {m: 0 for m in seen for m in _extended(m, bits)}
    table = F.create_map(*(x for m in seen for x in (F.lit(_signed(m)).cast("long"), F.array(*(F.lit(_signed(e)).cast("long") for e in _extended(m, bits))))))
    finer = rows.select("fp", F.explode(F.element_at(table, F.col("mask"))).alias("mask"))
    return finer.select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def _extended(mask: int, bits: int) -> list[int]:
    open_bits = [b for b in range(64) if not mask >> b & 1]
    return [mask | m for m in _blocks(open_bits, bits)]


def _linked(fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly what all pairs within ``bits`` join: a search
    tree over the class, so their number is below the class's."""
    a, b = [], []
    rest = fps
    while len(rest) > 1:
        front, rest = rest[:1], rest[1:]
        while len(front) and len(rest):
            at, front = front[0], front[1:]
            near = np.bitwise_count(rest ^ at) <= bits
            if near.any():
                new = rest[near]
                a.append(np.full(len(new), at))
                b.append(new)
                front, rest = np.concatenate([front, new]), rest[~near]
    z = np.zeros(0, np.uint64)
    return (np.concatenate(a), np.concatenate(b)) if a else (z, z)


def _compare(bits, batches):
    """Links inside runs of equal (mask, key); runs may cross batches."""
    held: list[np.ndarray] = []

    def pieces(last):
        table = np.concatenate(held, axis=1)
        change = np.flatnonzero((table[0, 1:] != table[0, :-1]) | (table[1, 1:] != table[1, :-1])) + 1
        cuts = np.concatenate([[0], change, [table.shape[1]]])
        done = len(cuts) - 1 if last else len(cuts) - 2
        held[:] = [table[:, cuts[done]:]]
        return table[2].view(np.uint64), cuts[:done + 1]

    def links(last):
        fp, cuts = pieces(last)
        if len(cuts) < 2:
            return None
        size = np.diff(cuts)
        a, b = [], []
        two = cuts[:-1][size == 2]  # most runs: one comparison for all of them
        near = np.bitwise_count(fp[two] ^ fp[two + 1]) <= bits
        a.append(fp[two][near])
        b.append(fp[two + 1][near])
        for i in np.flatnonzero(size > 2):
            x, y = _linked(fp[cuts[i]:cuts[i + 1]], bits)
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        held.append(np.stack([batch.column(k).to_numpy() for k in ("mask", "key", "fp")]))
        if (out := links(False)) is not None and out.num_rows:
            yield out
    if held and (out := links(True)) is not None and out.num_rows:
        yield out


def near_links(fps: DataFrame, bits: int = 2, largest: int = LARGEST) -> DataFrame:
    """(a, b): links between distinct fingerprints that join exactly those
    reachable over pairs within ``bits`` differing bits.

    Keys of one member are dropped after a count; keys above ``largest``
    members are refined until at most 2^8 bits are open, so no task holds an
    unbounded class.
    """
    spark = fps.sparkSession
    parts, todo, out = shuffle_parts(spark), _keyed(fps.select("fp").distinct(), bits), []
    level = 0
    while True:
        todo = written(todo, f"simhash-keys{level}")
        sizes = todo.groupBy("mask", "key").agg(F.count("*").alias("members")).where("members > 1")
        many = todo.join(sizes, ["mask", "key"])
        if level >= 2:
            small, large = many, None
        else:
            small, large = many.where(F.col("members") <= largest), many.where(F.col("members") > largest)
        dealt = small.select("mask", "key", "fp").repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "fp")
        out.append(dealt.mapInArrow(lean(partial(_compare, bits)), "a long, b long"))
        if large is None or not sizes.where(F.col("members") > largest).limit(1).count():
            break
        todo = _refined(large, bits, level).distinct()
        level += 1
    links = out[0]
    for x in out[1:]:
        links = links.unionByName(x)
    return written(links, "simhash-links")


def classes(prints: DataFrame, bits: int = 2) -> DataFrame:
    """(fp, root): every fingerprint's class, named by one of its members."""
    fps = prints.select("fp").distinct()
    linked = components(near_links(fps, bits)).select(F.col("node").alias("fp"), "root")
    return fps.join(linked, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits),
    component_id (the least id reachable over links of at most ``bits`` bits).

    Null, empty and wordless texts have fingerprint zero and link like any
    other; a text of fewer words than ``shingle`` has its whole sequence as
    its one shingle; very long texts are hashed whole; repeated rows repeat; null ids are passed over for the
    least id (all null: null); other columns are not read; an empty table
    gives no rows.
    """
    prints = fingerprints(docs, shingle)
    per_fp = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = written(per_fp.join(classes(prints, bits), "fp"), "simhash-roots")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(named, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 2) -> DataFrame:
    """``docs`` with one row of every near-duplicate class: the one of the
    least (id, text hash); of wholly equal rows one stays."""
    prints = fingerprints(docs, shingle)
    rooted = prints.join(classes(prints, bits), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("first")
    kept = rooted.groupBy("root").agg(first, F.count("*").alias("rows")).select("first.doc_id", "first.text_key", "rows")
    kept = written(kept, "simhash-kept")
    keyed = carried(docs)
    k, match = same_document(kept)
    # a class of one row cannot hold a repeated row; only the rest is looked through for them
    alone = keyed.join(k.where("rows = 1"), match, "left_semi")
    rest = keyed.join(k.where("rows > 1"), match, "left_semi").dropDuplicates(["id", "text_hash"])
    return alone.unionByName(rest).select("row.*")
