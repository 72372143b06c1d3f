"""Operator 2: nearest neighbours by inner product over robust-pruned graphs.

Vectors are dealt by length into shards of bounded size.  Each shard builds a
directed graph: a greedy search over the graph so far proposes a node's neighbours, and
relaxed distance pruning keeps diverse ones.  Queries run a beam search on
every shard's graph, and the shards' bests are merged.

Inner product becomes distance by one more component, sqrt(M^2 - |x|^2) with M
the largest norm of the shard: all its nodes then have length M and the largest
inner product is the smallest distance.  In a shard of similar lengths that
component is small, so the graph follows the vectors' own directions; over
uneven lengths it would swamp them.  Distances are taken in double precision as that of
the vectors and that of the extra components, so that one long vector does not
cancel those between short ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written

DEGREE, BUILD_BEAM, SEARCH_BEAM, RELAX = 32, 48, 160, 1.2
#: Distinct vectors per shard at most on average; at least MIN_SHARDS shards for the cluster's width.
SHARD_ROWS, MIN_SHARDS = 8192, 8
#: Largest ratio of lengths in a shard, and the most bands of such lengths.
BAND, MAX_BANDS = 1.1, 256
#: Queries that one task searches a shard for, on average.
QUERY_BLOCK = 16384


def _apart(dot, x2, y2, ex, ey):
    """Squared distances of lifted vectors by inner products, squared lengths
    and extra components; ex - ey is (y2 - x2) / (ex + ey)."""
    both = ex + ey
    extra = np.divide(y2 - x2, both, out=np.zeros(np.broadcast(x2, y2).shape), where=both > 0)
    return np.maximum(x2 + y2 - 2 * dot, 0) + extra * extra


def beam_search(nodes: np.ndarray, graph: np.ndarray, queries: np.ndarray, beam: int, starts: np.ndarray, n: int, width: int = 4, lifted: bool = False):
    """The ``beam`` best nodes found per query and their scores, best first
    (-1: none).  Each step expands the ``width`` best unexpanded nodes.  Scores
    are inner products, or with ``lifted`` (the last component is the extra
    one) negative squared distances."""
    if lifted:
        (nodes, n_extra), (queries, q_extra) = ((v[:, :-1], v[:, -1]) for v in (nodes, queries))
        n_square, q_square = (np.einsum("ij,ij->i", v, v) for v in (nodes, queries))
    q = len(queries)
    seen = np.zeros((q, n + 1), bool)
    seen[:, n] = True  # the padding node
    seen[:, starts] = True
    ids = np.full((q, beam), n, np.int64)
    score = np.full((q, beam), -np.inf, np.float32)
    open_ = np.zeros((q, beam), bool)
    m = min(beam, len(starts))
    first = queries @ nodes[starts].T
    if lifted:
        first = -_apart(first, n_square[starts], q_square[:, None], n_extra[starts], q_extra[:, None])
    top = np.argsort(-first, axis=1)[:, :m]
    ids[:, :m], score[:, :m], open_[:, :m] = starts[top], np.take_along_axis(first, top, 1), True
    live = np.arange(q)
    while len(live):
        # beams are kept sorted: the first open entries are the best ones
        rank = np.cumsum(open_[live], axis=1)
        chosen = open_[live] & (rank <= width)
        go = chosen.any(1)
        live, chosen = live[go], chosen[go]
        if not len(live):
            break
        expand = np.full((len(live), width), n, np.int64)
        r, c = np.nonzero(chosen)
        expand[r, np.cumsum(chosen, 1)[r, c] - 1] = ids[live[r], c]
        open_[live[r], c] = False
        near = graph[expand].reshape(len(live), -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        near[np.take_along_axis(seen[live], near, 1)] = n
        r, c = np.nonzero(near < n)
        seen[live[r], near[r, c]] = True
        got = np.full(near.shape, -np.inf, np.float32)
        for a in range(0, len(r), 1 << 15):  # bounds the gathered vectors
            rr, cc = r[a:a + (1 << 15)], c[a:a + (1 << 15)]
            to, own = near[rr, cc], live[rr]
            dot = np.einsum("ij,ij->i", nodes[to], queries[own])
            got[rr, cc] = -_apart(dot, n_square[to], q_square[own], n_extra[to], q_extra[own]) if lifted else dot
        all_ids = np.concatenate([ids[live], near], 1)
        all_score = np.concatenate([score[live], got], 1)
        all_open = np.concatenate([open_[live], near < n], 1)
        keep = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
        ids[live], score[live], open_[live] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_score, all_open))
    ids[~np.isfinite(score)] = -1
    return ids, score


def robust_prune(nodes: np.ndarray, at: np.ndarray, cand: np.ndarray, n: int, degree: int, relax: float) -> np.ndarray:
    """Out-neighbours (padded with n) of the nodes ``at``: the nearest candidate
    again and again, dropping those that are ``relax`` times nearer to it
    than to the node."""
    out = np.full((len(at), degree), n, np.int64)
    step = max(1, (1 << 21) // max(1, cand.shape[1] ** 2))
    for a in range(0, len(at), step):
        p, c = at[a:a + step], np.sort(cand[a:a + step], axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = n
        c[c == p[:, None]] = n
        x, own = nodes[c].astype(np.float64), nodes[p].astype(np.float64)
        x, extra, own, own_extra = x[:, :, :-1], x[:, :, -1], own[:, :-1], own[:, -1:]
        square, own_square = np.einsum("ijk,ijk->ij", x, x), np.einsum("ij,ij->i", own, own)[:, None]
        dist = _apart(np.einsum("ijk,ik->ij", x, own), square, own_square, extra, own_extra)
        dist[c == n] = np.inf
        order = np.argsort(dist, axis=1, kind="stable")
        c, dist, square, extra = (np.take_along_axis(v, order, 1) for v in (c, dist, square, extra))
        x = np.take_along_axis(x, order[:, :, None], 1)
        between = _apart(x @ x.transpose(0, 2, 1), square[:, :, None], square[:, None], extra[:, :, None], extra[:, None])
        alive, row = np.isfinite(dist), np.arange(len(p))
        for k in range(degree):
            best = alive.argmax(1)
            some = alive[row, best]
            if not some.any():
                break
            out[a + row[some], k] = c[row[some], best[some]]
            alive[row, best] = False
            alive[some] &= ~(relax * relax * between[row[some], best[some]] <= dist[some])
    return out


def build_graph(vectors: np.ndarray, largest: float, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX, seed: int = 1):
    """(nodes with the extra component and a padding row, graph, starts).
    The longest nodes are starts too: far from all others, few edges lead there."""
    n = len(vectors)
    square = np.einsum("ij,ij->i", vectors, vectors)
    extra = np.sqrt(np.maximum(largest ** 2 - square, 0))
    nodes = np.zeros((n + 1, vectors.shape[1] + 1))
    nodes[:n, :-1], nodes[:n, -1] = vectors, extra
    graph = np.full((n + 1, degree), n, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    first = order[:min(n, 128)]
    graph[first] = robust_prune(nodes, first, np.tile(first, (len(first), 1)), n, degree, relax)
    starts = first[:8]
    done = len(first)
    while done < n:
        batch = order[done:done + min(done, 1024)]
        cand, _ = beam_search(nodes, graph, nodes[batch], beam, starts, n, lifted=True)
        cand[cand < 0] = n
        graph[batch] = robust_prune(nodes, batch, cand, n, degree, relax)
        # the reverse edges, pruned anew where a list overflows
        target, source = graph[batch].ravel(), np.repeat(batch, degree)
        real = target < n
        target, source = target[real], source[real]
        by = np.argsort(target, kind="stable")
        target, source = target[by], source[by]
        uniq, at, count = np.unique(target, return_index=True, return_counts=True)
        have = (graph[uniq] < n).sum(1)
        place = np.arange(len(target)) - np.repeat(at, count)
        fits = have + count <= degree
        room = np.repeat(fits, count)
        graph[target[room], np.repeat(have, count)[room] + place[room]] = source[room]
        over = np.flatnonzero(~fits)
        for group in np.array_split(over[np.argsort(count[over])], max(1, len(over) // 256)):
            if len(group):
                width = int(count[group].max())
                new = np.full((len(group), width), n, np.int64)
                for i, g in enumerate(group):
                    new[i, :count[g]] = source[at[g]:at[g] + count[g]]
                graph[uniq[group]] = robust_prune(nodes, uniq[group], np.concatenate([graph[uniq[group]], new], 1), n, degree, relax)
        done += len(batch)
    return nodes, graph, np.union1d(starts, np.argsort(-square, kind="stable")[:8])


def _matrix(column) -> np.ndarray:
    arr = column.combine_chunks()
    return arr.flatten().to_numpy(zero_copy_only=False).reshape(len(arr), -1) if len(arr) else np.zeros((0, 0))


def _index(degree, beam, relax, group: pa.Table) -> pa.Table:
    """One shard's nodes with their out-neighbours; starts come first."""
    group = group.sort_by([("first", "ascending")])
    vectors = _matrix(group.column("vec")).astype(np.float64)
    largest = float(np.sqrt(np.einsum("ij,ij->i", vectors, vectors).max()))
    nodes, graph, starts = build_graph(vectors, largest, degree, beam, relax)
    n = len(group)
    is_start = np.zeros(n, bool)
    is_start[starts] = True
    near = [g[g < n] for g in graph[:n]]
    return pa.table({"shard": group.column("shard"), "node": pa.array(np.arange(n, dtype=np.int32)), "start": pa.array(is_start), "vec": group.column("vec"),
                     "ids": group.column("ids"), "near": pa.array([x.astype(np.int32) for x in near], pa.list_(pa.int32()))})


_FOUND = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _search(k, beam, index: pa.Table, queries: pa.Table) -> pa.Table:
    if not index.num_rows or not queries.num_rows:
        return _FOUND.empty_table()
    index = index.sort_by([("node", "ascending")])
    vec = _matrix(index.column("vec"))
    n = len(vec)
    nodes = np.zeros((n + 1, vec.shape[1]), np.float32)
    nodes[:n] = vec
    exact = vec.astype(np.float64)
    near = index.column("near").combine_chunks()
    sizes, flat = np.diff(near.offsets.to_numpy()), near.flatten().to_numpy()
    graph = np.full((n + 1, max(1, int(sizes.max()))), n, np.int64)
    row = np.repeat(np.arange(n), sizes)
    graph[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    starts = np.flatnonzero(index.column("start").to_numpy(zero_copy_only=False))
    ids = index.column("ids").to_pylist()
    qid, qkey, qvec = queries.column("query_id").to_numpy(), queries.column("query_key").to_numpy(), _matrix(queries.column("vec")).astype(np.float64)
    out: tuple[list, ...] = ([], [], [], [])
    for a in range(0, len(qid), 512):
        q = qvec[a:a + 512]
        found, _ = beam_search(nodes, graph, q.astype(np.float32), beam, starts, n)
        r, c = np.nonzero(found >= 0)
        node = found[r, c]
        score = np.einsum("ij,ij->i", exact[node], q[r])
        order = np.lexsort((node, -score, r))  # node order is the order of the classes' least ids
        r, node, score = r[order], node[order], score[order]
        cut = np.searchsorted(r, np.arange(len(q) + 1))
        for i in range(len(q)):
            own = qid[a + i]
            # k + 1 classes hold k others at least, whatever the query's own class is
            best = [(-s, v) for s, m in zip(score[cut[i]:cut[i] + k + 1].tolist(), node[cut[i]:min(cut[i + 1], cut[i] + k + 1)].tolist()) for v in ids[m] if v != own]
            best.sort()
            for s, v in best[:k]:
                out[0].append(own)
                out[1].append(qkey[a + i])
                out[2].append(v)
                out[3].append(-s)
    return pa.table([pa.array(x, f.type) for x, f in zip(out, _FOUND, strict=True)], schema=_FOUND)


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, vec): the rows that take part: vectors with finite components
    that are not all zero, of the table's commonest dimension, and with an id."""
    rows = (table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec"))
            .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where((F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def build_index(rows: DataFrame, k: int, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX,
                shard_rows: int = SHARD_ROWS, min_shards: int = MIN_SHARDS) -> DataFrame | None:
    """(shard, node, start, vec, ids, near): the written graphs of all shards;
    None without rows.  Equal vectors are one node with its k + 1 least ids,
    which is all that k nearest others can ask of it.  A shard holds lengths
    within a factor of ``BAND`` (more only where they span over ``MAX_BANDS``
    such bands); large bands are split by hash."""
    copies = Window.partitionBy("vec").orderBy("vec_id")
    nodes = (rows.withColumn("n", F.dense_rank().over(copies)).where(F.col("n") <= k + 1)
             .groupBy("vec").agg(F.array_sort(F.collect_set("vec_id")).alias("ids")))
    nodes = written(nodes, "ann-nodes")
    square = F.aggregate("vec", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))
    length = F.greatest(F.lit(1e-150), F.least(F.sqrt(square), F.lit(1e150)))
    sized = nodes.select("vec", "ids", length.alias("length"))
    n, low, high = sized.agg(F.count("*"), F.min("length"), F.max("length")).first()
    if not n:
        return None
    ratio = max(BAND, (high / low) ** (1 / MAX_BANDS))
    banded = sized.withColumn("band", F.floor(F.log(F.col("length") / low) / float(np.log(ratio))).cast("int"))
    per_band = {r["band"]: r["count"] for r in banded.groupBy("band").count().collect()}  # at most MAX_BANDS + 1 rows
    parts = {b: max(-(-c // shard_rows), -(-c * min_shards // n)) for b, c in per_band.items()}
    first = dict(zip(sorted(parts), np.concatenate([[0], np.cumsum([parts[b] for b in sorted(parts)])[:-1]]).astype(int).tolist()))
    pick = lambda by: F.element_at(F.create_map(*[F.lit(int(x)) for b in sorted(by) for x in (b, by[b])]), F.col("band"))
    shard = (pick(first) + F.pmod(F.xxhash64("vec"), pick(parts).cast("long"))).cast("int")
    dealt = banded.select(shard.alias("shard"), "vec", "ids", F.element_at("ids", 1).alias("first"))
    kind = nodes.schema["vec"].dataType.simpleString()

    def shard_graph(group: pa.Table) -> pa.Table:
        return _index(degree, beam, relax, group)

    index = dealt.groupBy("shard").applyInArrow(shard_graph, f"shard int, node int, start boolean, vec {kind}, ids array<bigint>, near array<int>")
    return written(index, "ann-index")


def nearest(table: DataFrame, every: int = 20, k: int = 20, search_beam: int = SEARCH_BEAM, shard_rows: int = SHARD_ROWS, min_shards: int = MIN_SHARDS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for every usable row whose
    vec_id ``every`` divides, the ``k`` other rows of the largest inner product
    found, ties to the smaller vec_id; score is the inner product of the
    original vectors in double precision.

    Null, zero and non-finite vectors, vectors with null components or of
    another than the commonest dimension, and rows without an id take no part;
    rows that repeat an id and its vector are one; an id with several vectors
    asks once for each; with fewer than ``k`` candidates all are returned; an
    empty table gives no rows; other columns are not read.

    A task holds one shard (bounded rows) and one block of queries.
    """
    spark = table.sparkSession
    rows = usable(table)
    index = build_index(rows, k, shard_rows=shard_rows, min_shards=min_shards)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("query_key"), "vec").distinct()
    queries = written(queries, "ann-queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    shards = index.select("shard").distinct()
    block = F.pmod(F.xxhash64("query_id", "query_key"), F.lit(blocks)).cast("int")
    shard_list = [r["shard"] for r in shards.collect()]  # one number per shard
    asked = queries.withColumn("block", block).withColumn("shard", F.explode(F.array(*map(F.lit, shard_list))))
    there = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(shard: pa.Table, block: pa.Table) -> pa.Table:
        return _search(k, search_beam, shard, block)

    found = (there.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block"))
             .applyInArrow(search, "query_id long, query_key long, vec_id long, score double"))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
