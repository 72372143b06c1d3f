"""Operator 11: hard negatives by a secondary-sort shuffle.

Pair scores are packed into keys (anchor, descending score, kind, id), dealt
by anchor and sorted inside the partitions; one iterator reads a partition's
keys, opens a window at each of an anchor's first positives and hands every
negative to the open windows that it fits, so no anchor's pairs are ever held
together.

Two scans score the rows first, anchors in blocks against rows in shards: one
leaves a shard's best same-label rows per anchor, the other, which knows the
anchors' positives, a shard's best rows below each of them.  A row that a
shard leaves out has enough better rows in that shard, so the windows come out
as if all pairs had been shuffled.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import shuffle_parts, written

POSITIVES = NEGATIVES = 5
#: A negative's score lies between these hundredths of the positive's score.
LEAST, MOST = 80, 100
#: Anchors that are scored together (their matrix is what a task holds), and rows of a shard, on average.
ANCHOR_BLOCK, SHARD_ROWS = 16384, 1 << 20
#: Cells of one score matrix.
CELLS = 1 << 21
_EDGE = (1 << 63) - 1
_SIGN = 1 << 63


def whole_parts(vectors: list, factor: int = 256) -> np.ndarray:
    """floor(factor * x) per component, in double precision; shorter vectors end in zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return np.floor(np.clip(out, -1e300, 1e300) * factor)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of vectors of whole numbers, exact; beyond 63 bits the
    nearest 63-bit number stands for them."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    plain = np.sqrt(2.0 ** 53 / max(width, 1)) - 1  # sums of such products are exact in double precision
    big_a, big_b = (np.abs(v).max(1, initial=0) > plain for v in (a, b))
    out = (np.where(big_a[:, None], 0, a) @ np.where(big_b[:, None], 0, b).T).astype(np.int64)
    if big_a.any() or big_b.any():
        whole_a, whole_b = ([[int(x) for x in v] for v in m] for m in (a, b))
        for i, j in np.argwhere(big_a[:, None] | big_b[None]).tolist():
            out[i, j] = max(-_EDGE, min(_EDGE, sum(x * y for x, y in zip(whole_a[i], whole_b[j], strict=True))))
    return out


class _Best:
    """The first rows by (score descending, id) per slot, at most ``most`` each."""

    def __init__(self, floors: np.ndarray, most: int):
        self.most, self.low = most, floors.copy()
        self.low_id = np.full(len(floors), -_EDGE - 1)  # at its low a slot takes smaller ids only
        self.slot = self.score = self.id = self.row = np.zeros(0, np.int64)

    def add(self, first: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray, allowed: np.ndarray) -> None:
        """Scores (slots from ``first`` on, rows) where ``allowed``."""
        last = first + len(score)
        low = self.low[first:last, None]
        at, j = np.nonzero(allowed & ((score > low) | ((score == low) & (ids[None] < self.low_id[first:last, None]))))
        if not len(at):
            return
        slot = np.concatenate([self.slot, at + first])
        kept = [np.concatenate(p) for p in ((self.score, score[at, j]), (self.id, ids[j]), (self.row, rows[j]))]
        order = np.lexsort((kept[2], kept[1], -kept[0], slot))
        slot, kept = slot[order], [k[order] for k in kept]
        start = np.searchsorted(slot, slot)
        ok = np.arange(len(slot)) - start < self.most
        self.slot, (self.score, self.id, self.row) = slot[ok], [k[ok] for k in kept]
        full = np.flatnonzero(np.arange(len(slot)) - start == self.most - 1)
        self.low[slot[full]], self.low_id[slot[full]] = kept[0][full], kept[1][full]


class _Cell:
    """One block of anchors and the rows that stream past it."""

    def __init__(self, positives: int, negatives: int, least: int, most: int):
        self.bounds, self.least, self.most = (positives, negatives), least, most
        self.parts: list[tuple] = []
        self.best: list[_Best] | None = None
        self.seen = 0

    def anchors(self, ids, labels, vectors, positives) -> None:
        self.parts.append((ids, labels, vectors, positives))

    def _open(self) -> None:
        self.ids = np.concatenate([p[0] for p in self.parts])
        self.labels = np.concatenate([p[1] for p in self.parts])
        self.matrix = whole_parts([v for p in self.parts for v in p[2]])
        limits = [s for p in self.parts for s in p[3]]
        n = len(self.ids)
        if limits[0] is None:  # the scan for positives
            self.best = [_Best(np.full(n, -_EDGE - 1), self.bounds[0])]
            return
        self.best, self.limits = [], []
        for k in range(max(map(len, limits), default=0)):
            limit = np.array([s[k] if k < len(s) else -_EDGE for s in limits], np.int64)
            floor = [-((-self.least * s[k]) // self.most) - 1 if k < len(s) else _EDGE for s in limits]
            self.limits.append(limit)
            self.best.append(_Best(np.array([max(-_EDGE - 1, min(_EDGE, f)) for f in floor], np.int64), self.bounds[1]))

    def rows(self, ids, labels, vectors) -> None:
        if not self.parts:
            return
        if self.best is None:
            self._open()
        m = whole_parts(vectors)
        step = max(1, CELLS // max(len(self.ids), 1))
        for a in range(0, len(ids), step):
            part = slice(a, a + step)
            score = exact_scores(self.matrix, m[part])
            same = self.labels[:, None] == labels[None, part]
            number = self.seen + np.arange(len(ids[part]))
            self.seen += len(number)
            if not hasattr(self, "limits"):
                self.best[0].add(0, score, ids[part], number, same & (self.ids[:, None] != ids[None, part]))
            else:
                other = ~same & (self.ids[:, None] != ids[None, part])
                for best, limit in zip(self.best, self.limits, strict=True):
                    best.add(0, score, ids[part], number, other & (score <= limit[:, None]))

    def found(self):
        """(anchor, score, id): each row once per anchor."""
        if not self.best:
            return [np.zeros(0, np.int64)] * 3
        slot, row, score, ids = (np.concatenate([getattr(b, k) for b in self.best]) for k in ("slot", "row", "score", "id"))
        first = np.unique(np.stack([slot, row]), axis=1, return_index=True)[1]
        return [self.ids[slot[first]], score[first], ids[first]]


def _scan(positives: int, negatives: int, least: int, most: int):
    def scan(batches):
        cell, now = None, None
        names = ["anchor_id", "score", "id"]
        for b in batches:
            cells, kinds = b.column("cell").to_numpy(), b.column("kind").to_numpy()
            cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cells)], strict=True):
                if a == z:
                    continue
                if now != cells[a]:
                    if cell is not None:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in cell.found()], names=names)
                    cell, now = _Cell(positives, negatives, least, most), cells[a]
                part = b.slice(a, z - a)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                vectors = part.column("vector")
                data = vectors.flatten().to_numpy().astype(np.float64)
                ends = np.cumsum(np.diff(vectors.offsets.to_numpy()))
                lists = np.split(data, ends[:-1])
                if kinds[a] == 0:
                    cell.anchors(ids, labels, lists, part.column("limits").to_pylist())
                else:
                    cell.rows(ids, labels, lists)
        if cell is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cell.found()], names=names)
    return scan


def _scored(anchors: DataFrame, rows: DataFrame, blocks: int, shards: int, scan) -> DataFrame:
    """(anchor_id, score, id) of what ``scan`` keeps of every block and shard.

    An anchor is copied to every shard and a row to every block: a copy costs
    its bytes, its scores a block of inner products, so the copies stay the
    smaller part.  Tasks hold a block of anchors and stream the rows."""
    block, shard = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shards))
    cell = lambda b, s: (b * shards + s).alias("cell")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    kept = ["vec_id", "label", "vector"]
    a = anchors.select(*kept, "limits", block.alias("b"), every(shards).alias("s")).select(cell(F.col("b"), F.col("s")), F.lit(0).alias("kind"), *kept, "limits")
    r = rows.select(*kept, shard.alias("s"), every(blocks).alias("b")).select(
        cell(F.col("b"), F.col("s")), F.lit(1).alias("kind"), *kept, F.lit(None).cast("array<long>").alias("limits"))
    dealt = a.unionByName(r).repartition(max(shuffle_parts(rows.sparkSession), blocks * shards), "cell").sortWithinPartitions("cell", "kind", "vec_id")
    return dealt.mapInArrow(scan, "anchor_id long, score long, id long")


def pack_key(anchor: int, score: int, kind: int, vec_id: int) -> bytes:
    """Bytes that sort by anchor, score descending, kind (positives first) and id."""
    return struct.pack(">QQBQ", anchor + _SIGN, _SIGN - 1 - score, kind, vec_id + _SIGN)


def unpack_key(key: bytes) -> tuple[int, int, int, int]:
    a, s, kind, i = struct.unpack(">QQBQ", key)
    return a - _SIGN, _SIGN - 1 - s, kind, i - _SIGN


def windows(keys, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST):
    """(anchor, positive, rank, negative, positive's score, negative's score)
    from sorted keys, in one pass; what is held is an anchor's open windows."""
    now, opened, open_ = None, 0, []
    for key in keys:
        anchor, score, kind, vec_id = unpack_key(key)
        if anchor != now:
            now, opened, open_ = anchor, 0, []
        if kind == 0:
            if opened < positives:
                opened += 1
                open_.append([vec_id, score, 0])
            continue
        left = False
        for w in open_:
            if least * w[1] > most * score:  # scores fall, so nothing later fits either
                w[2] = negatives
            elif w[2] < negatives:
                w[2] += 1
                yield anchor, w[0], w[2], vec_id, w[1], score
            left |= w[2] >= negatives
        if left:
            open_ = [w for w in open_ if w[2] < negatives]


def usable(rows: DataFrame, vec_col: str = "embedding") -> DataFrame:
    """(vec_id, label, vector) of the rows that take part."""
    bad = F.exists(vec_col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vec_col).isNotNull() & ~bad).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col(vec_col).alias("vector"))


def hard_negatives(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
                   anchor_block: int = ANCHOR_BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score over ``rows`` (vec_id, label, vector, see ``usable``).

    Scores are inner products of floor(256 x), exact (beyond 63 bits the
    nearest 63-bit number); a vector shorter than the anchor's ends in zeros.  An
    anchor's positives are its first ``positives`` other rows of its label by
    (score descending, vec_id); each positive gets the first ``negatives``
    rows of other labels whose score is ``least`` to ``most`` hundredths of
    its own.  Rows without an id, a label or a wholly finite vector take no
    part; rows that repeat an id each count, but never beside an anchor of
    their own id, and of an anchor's own repeated rows the least (label,
    vector) is the anchor; anchors without a positive or a fitting negative
    give no rows; other columns are not read.  ``anchor_block`` and
    ``shard_rows`` only set how the work is dealt.
    """
    if not 0 <= least <= most:
        raise ValueError("least and most are hundredths, least first")
    spark = rows.sparkSession
    rows = rows.select("vec_id", "label", "vector")
    anchors = written(rows.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("own")).select("vec_id", "own.*"), "neg-anchors")
    n_rows, n_anchors = rows.count(), anchors.count()
    blocks = max(1, -(-n_anchors // anchor_block))
    shards = max(1, -(-n_rows // shard_rows), -(-2 * spark.sparkContext.defaultParallelism // blocks))
    scan = _scan(positives, negatives, least, most)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    near = written(_scored(anchors.withColumn("limits", F.lit(None).cast("array<long>")), rows, blocks, shards, scan)
                   .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives).drop("rank"), "neg-positives")
    limits = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list("score").alias("limits"))
    far = written(_scored(anchors.join(limits, "vec_id"), rows, blocks, shards, scan), "neg-candidates")
    pairs = near.select("anchor_id", "score", F.lit(0).alias("kind"), "id").unionByName(far.select("anchor_id", "score", F.lit(1).alias("kind"), "id"))
    sorted_keys = (pairs.rdd.map(lambda r: (pack_key(*r), None))
                   .repartitionAndSortWithinPartitions(shuffle_parts(spark), lambda key: zlib.crc32(key[:8])))
    out = sorted_keys.mapPartitions(lambda part: windows((k for k, _ in part), positives, negatives, least, most))
    return spark.createDataFrame(out, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long", verifySchema=False)
