"""Operator 8: line de-duplication by an exact set-similarity join.

A line's tokens are its five-word shingles (the whole line, if shorter).
Lines of one token set are one class.  Tokens are ordered by rarity; two sets
of Jaccard similarity t share a token among the first n - ceil(t n) + 1 of
each, so only those prefixes are joined, sizes, positions and parity bits rule
most pairs out, and the rest is verified on the whole sets.  A line goes if an
earlier line (by document id, then line number) is similar.

Prefix tokens are shuffled as packed entries, many of one bucket of keys in
one row, and put in order bucket by bucket.
A token that a run of text holds often is salted before the first shuffle.
After it the classes of each token are counted exactly; those of a heavy token
are dealt to blocks by size, first compared inside their block, and what finds
no match there asks the blocks of fitting sizes.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import carried, lean, same_document, shuffle_parts, written
from marquee.llm.words import flat, mix, shingle_hashes, slices, word_hashes, word_spans

SHINGLE = 5
SIMILARITY = (4, 5)  # 0.8, as a fraction
#: Counters of the rarity table (top bits of a token); its size is fixed.
RARITY_BITS = 20
#: Pieces that a task's rarity table is summed up in.
SEGMENTS = 64
#: Occurrences in one run of tokens from which a token is counted as heavy.
HEAVY = 32
#: Classes that are compared at once under one heavy token; more are dealt out to blocks.
BLOCK = 512
#: Rows of one key from which its run is read in pieces.
LONG = 1 << 16
#: Bits of the filter of the classes whose sets are fetched.
FILTER_BITS = 23
_RUN = 1 << 20  # tokens per run
_TOKEN = np.uint64(48)
_ROW = ["key", "sig", "shape", "place", "parity"]
_ENTRY = np.dtype([("key", "<i8"), ("sig", "<i8"), ("shape", "<i8"), ("parity", "<i8"), ("place", "<i4")])
#: Buckets that keys are dealt to, per shuffle partition; entries that a task deals out at once, and those of a bucket from which its long runs go on.
BUCKETS, DEALT, HELD = 16, 1 << 18, 1 << 21
#: Earlier classes that a class is checked against first, per key; what is left asks for four times as many next.
ASKED = 2
#: Pairs of rows that are looked at in one step.
PAIRS = 1 << 20
#: Rows of a run up to which all its pairs are looked at; longer runs go by size.
LOOKED = 64


def _line_tokens(column, shingle: int):
    """Per slice of rows: (first row, rows, row and number of every line,
    line of every token, 64-bit tokens); tokens come in line order."""
    data, offs = flat(column)
    for i0, i1 in slices(offs, 1 << 20):
        sub, lo = data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0]
        n = i1 - i0
        breaks = np.flatnonzero(sub == 10)
        per_row = 1 + np.bincount(np.searchsorted(lo, breaks, "right") - 1, minlength=n)
        first = np.concatenate([[0], np.cumsum(per_row)])
        row = np.repeat(np.arange(n), per_row)
        number = np.arange(first[-1]) - first[row]
        begins = np.empty(first[-1], np.int64)
        begins[first[:-1]] = lo[:-1]
        rest = np.ones(first[-1], bool)
        rest[first[:-1]] = False
        begins[rest] = breaks + 1
        low, s, e = word_spans(sub, begins)
        line = np.searchsorted(begins, s, "right") - 1
        h = word_hashes(low, s, e)
        tokens, at = shingle_hashes(h, line, shingle)
        tokens, owner = [tokens], [line[at]]
        words = np.bincount(line, minlength=first[-1])
        for g in range(1, shingle):  # a shorter line is one token
            short = words[line] == g
            if short.any():
                t, at = shingle_hashes(h[short], line[short], g)
                tokens.append(t)
                owner.append(line[short][at])
        tokens, owner = np.concatenate(tokens), np.concatenate(owner)
        order = np.argsort(owner, kind="stable") if len(owner) and (np.diff(owner) < 0).any() else slice(None)
        yield i0, n, row, number, owner[order], tokens[order]


def _sets(owner: np.ndarray, tokens: np.ndarray, rarity: np.ndarray | None = None):
    """Distinct 48-bit tokens per line, ordered by (rarity, token): yields
    (lines, bounds into the tokens, tokens, names of the token sets, begins
    and ends of the lines in what came in) for up to 1,024 lines at a time."""
    i = 0
    while i < len(owner):
        base = int(owner[i])
        j = int(np.searchsorted(owner, base + 1024))
        near = owner[i:j] - base
        begin = i + np.concatenate([[0], np.flatnonzero(near[1:] != near[:-1]) + 1])
        key = near.astype(np.uint64) << np.uint64(54) | tokens[i:j] >> np.uint64(16)
        if rarity is not None:
            key |= rarity[(tokens[i:j] >> np.uint64(64 - RARITY_BITS)).astype(np.int64)] << _TOKEN
        key.sort()
        key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        line = (key >> np.uint64(54)).astype(np.int64)
        bounds = np.concatenate([[0], np.flatnonzero(np.diff(line)) + 1, [len(line)]])
        own = key & np.uint64((1 << 48) - 1)
        yield line[bounds[:-1]] + base, bounds, own, _signatures(bounds, own, tokens[begin]), begin, np.append(begin[1:], j)
        i = j


def _signatures(bounds: np.ndarray, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One 64-bit name per token set, whatever the order.  A set of one token,
    as most short lines are, is named by all 64 bits of it (``first``)."""
    size = np.diff(bounds)
    total = np.add.reduceat(mix(tokens), bounds[:-1]) + size.astype(np.uint64)
    return mix(np.where(size == 1, mix(first), total)).view(np.int64)


def _parities(bounds: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """64 parity bits per token set.  Each bit in which two sets differ takes
    a token that only one of them has."""
    return np.bitwise_xor.reduceat(np.uint64(1) << (tokens & np.uint64(63)), bounds[:-1]).view(np.int64)


def _distinct(tokens: np.ndarray) -> np.ndarray:
    tokens = np.sort(tokens)
    return tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.Array:
    """A list column: the next ``counts`` values of each row."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values))


class _Heavy:
    """Tokens that many different classes of a run of text hold."""

    def __init__(self):
        self.seen: set[int] = set()
        self.tokens: list[np.ndarray] = []
        self.held = 0

    def add(self, sig, bounds, tokens):
        new = _unseen(sig, self.seen)
        if new.any():
            own = tokens[np.repeat(new, np.diff(bounds))]
            self.tokens.append(own)
            self.held += len(own)

    def close(self):
        token, n = np.unique(np.concatenate(self.tokens) if self.tokens else np.zeros(0, np.uint64), return_counts=True)
        self.__init__()
        return token[n >= HEAVY].astype(np.int64).tolist(), n[n >= HEAVY].tolist()


def _unseen(sig: np.ndarray, seen: set[int]) -> np.ndarray:
    """Which are met for the first time; remembers them."""
    out = np.zeros(len(sig), bool)
    for i, x in enumerate(sig.tolist()):
        if x not in seen:
            seen.add(x)
            out[i] = True
    return out


def _survey(shingle, batches):
    """Per document the class of each line that has words; per run of tokens
    the counters of the rarity table and the heavy tokens."""
    ids, names = None, ["doc_id", "text_key", "n_lines", "line", "sig", "counters", "heavy", "heavy_n"]
    counts, heavy, buckets = np.zeros(1 << RARITY_BITS, np.int64), _Heavy(), []
    longs, ints, blobs = pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.binary())

    def record(id_type, counters, heavy, heavy_n):
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, ints), pa.nulls(1, longs),
             pa.array([counters], blobs), pa.array([heavy], longs), pa.array([heavy_n], longs)], names=names)

    for b in batches:
        ids = b.column("doc_id").type
        n_lines, held, lines, sigs = [], [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for _, n, row, number, owner, tokens in _line_tokens(b.column("text"), shingle):
            n_lines.append(np.bincount(row, minlength=n))
            here = np.zeros(n, np.int64)
            for at, bounds, own, sig, _, _ in _sets(owner, tokens):
                here += np.bincount(row[at], minlength=n)
                lines.append(number[at].astype(np.int32))
                sigs.append(sig)
                buckets.append((own >> (_TOKEN - np.uint64(RARITY_BITS))).astype(np.int32))
                heavy.add(sig, bounds, own)
            held.append(here)
            if sum(map(len, buckets)) >= _RUN:  # the table is long: added to in large pieces
                counts += np.bincount(np.concatenate(buckets), minlength=len(counts))
                buckets = []
            if heavy.held >= _RUN and (got := heavy.close())[0]:
                yield record(ids, None, *got)
        held = np.concatenate(held) if held else np.zeros(0, np.int64)
        nothing = [pa.nulls(b.num_rows, t) for t in (blobs, longs, longs)]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("text_key"), pa.array(np.concatenate(n_lines or [held]).astype(np.int32)),
             _lists(held, np.concatenate(lines)), _lists(held, np.concatenate(sigs)), *nothing], names=names)
    if ids is not None:
        counts += np.bincount(np.concatenate(buckets or [np.zeros(0, np.int32)]), minlength=len(counts))
        yield record(ids, [x.tobytes() for x in np.split(np.minimum(counts, 65535).astype("<u2"), SEGMENTS)], *heavy.close())


def _totals(batches):
    """(segment, log-scaled sums of the tasks' counters)."""
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for k, blob in zip(b.column("segment").to_pylist(), b.column("blob").to_pylist(), strict=True):
            own = np.frombuffer(blob, "<u2").astype(np.int64)
            sums[k] = sums[k] + own if k in sums else own
    steps = [np.minimum(63, 2 * np.log2(np.maximum(1, v))).astype(np.uint8).tobytes() for v in sums.values()]
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(steps, pa.binary())], names=["segment", "steps"])


def _prefixes(shared, shingle, similarity, batches):
    """Entries (key, sig, shape, place, parity) of every prefix token of every
    class met in this task: key holds token and salt; shape holds size and salts."""
    rarity, salts_of = shared.value[0].astype(np.uint64), shared.value[1]
    num, den = similarity
    seen: set[int] = set()
    for b in batches:
        for _, _, _, _, owner, tokens in _line_tokens(b.column("text"), shingle):
            for _, bounds, own, sig, _, _ in _sets(owner, tokens, rarity):
                size = np.diff(bounds)
                # a class's rows are alike wherever it stands: its first line here will do
                new = np.flatnonzero(_unseen(sig, seen))
                sig, size, begin = sig[new], size[new], bounds[:-1][new]
                take = size - -(-num * size // den) + 1
                which = np.repeat(np.arange(len(size)), take)
                place = np.arange(len(which)) - np.repeat(np.cumsum(take) - take, take)
                token, named = own[begin[which] + place], sig[which]
                salts = salts_of[(token >> (_TOKEN - np.uint64(RARITY_BITS))).astype(np.int64)].astype(np.int64)
                salt = mix(named.view(np.uint64)) % salts.astype(np.uint64)
                out = np.empty(len(which), _ENTRY)
                out["key"] = (token << np.uint64(16) | salt).view(np.int64)
                out["sig"], out["shape"], out["place"] = named, size[which] << 32 | salts, place
                out["parity"] = _parities(bounds, own)[new][which]
                yield out
        if len(seen) > 1 << 18:
            seen.clear()


def _buckets(shared, shingle, similarity, buckets, batches):
    """(bucket, rows): the entries of the prefixes, many of one bucket of keys
    in one value, so that a shuffle moves few rows."""
    held, most = [], min(4 * DEALT, max(DEALT, 8 * buckets))

    def dealt():
        entries = np.concatenate(held)
        bucket = (mix(entries["key"].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1])
        bounds = (np.append(first, len(bucket)) * _ENTRY.itemsize).astype(np.int32)
        rows = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(entries[order])])
        out, step = pa.RecordBatch.from_arrays([pa.array(bucket[first]), rows], names=["bucket", "rows"]), max(1, (4 << 20) * len(first) // int(bounds[-1]))
        held.clear()
        for i in range(0, len(first), step):
            yield out.slice(i, step)

    size = 0
    for entries in _prefixes(shared, shingle, similarity, batches):
        held.append(entries)
        size += len(entries)
        if size >= most:
            yield from dealt()
            size = 0
    if size:
        yield from dealt()


def _in_order(entries: np.ndarray) -> np.ndarray:
    """The entries by key and class, without those that are alone under a key
    of one salt: they have no partner."""
    order = np.argsort(entries["key"])
    key = entries["key"][order]
    same = key[1:] == key[:-1]
    held = np.append(same, False) | np.append(False, same) | ((entries["shape"][order] & 0xFFFF) > 1)
    entries = entries[order[held]]
    return entries[np.lexsort((entries["sig"], entries["key"]))]


def _by_key(batches):
    """Entries of whole buckets in order of key and class, as columns.  Of a
    bucket of more than HELD entries, keys of LONG or more go on early, marked
    by several salts as those of heavy tokens are."""
    bucket, held, size, heavy = None, [], 0, np.zeros(0, np.int64)

    def columns(entries):
        for i in range(0, len(entries), 1 << 16):
            part = entries[i:i + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[k])) for k in _ROW], names=_ROW)

    def marked(entries):
        known = np.isin(entries["key"], heavy)
        entries["shape"][known] = entries["shape"][known] >> 32 << 32 | 2
        return entries

    for b in batches:
        for own, rows in zip(b.column("bucket").to_pylist(), b.column("rows"), strict=True):
            if own != bucket:
                if held:
                    yield from columns(_in_order(marked(np.concatenate(held))))
                bucket, held, size, heavy = own, [], 0, heavy[:0]
            held.append(np.frombuffer(rows.as_buffer(), _ENTRY))
            size += len(held[-1])
            if size >= HELD:
                entries = np.concatenate(held)
                entries = entries[np.lexsort((entries["sig"], entries["key"]))]
                again = (entries["key"][1:] == entries["key"][:-1]) & (entries["sig"][1:] == entries["sig"][:-1])
                entries = entries[np.append(True, ~again)]
                key, n = np.unique(entries["key"], return_counts=True)
                heavy = np.union1d(heavy, key[n >= LONG])
                entries = marked(entries)
                gone = np.isin(entries["key"], heavy)
                yield from columns(entries[gone])
                held, size = [entries[~gone]], 0
    if held:
        yield from columns(_in_order(marked(np.concatenate(held))))


def _runs(batches, most=None):
    """Whole runs of equal ``key``, several at a time: (columns, cuts).  A run
    of more than ``most`` rows comes in pieces."""
    held = []

    def cut(last):
        table = pa.Table.from_batches(held)
        key = table.column("key").to_numpy()
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        done = len(cuts) - 1 if last else len(cuts) - 2
        held[:] = [] if last else table.slice(int(cuts[done])).combine_chunks().to_batches()
        return table.slice(0, int(cuts[done])), cuts[:done + 1]

    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= 8192:
            table, cuts = cut(False)
            size = sum(x.num_rows for x in held)
            if len(cuts) > 1:
                yield table, cuts
            elif most and size >= most:
                yield pa.Table.from_batches(held), np.array([0, size])
                held[:], size = [], 0
    if held:
        yield cut(True)


def _fits(size_a, place_a, size_b, place_b, similarity):
    """Length and position bounds: overlap from here on can still suffice."""
    num, den = similarity
    small, large = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    left = np.minimum(size_a - place_a, size_b - place_b)
    return (den * small >= num * large) & ((num + den) * left >= num * (size_a + size_b))


def _may_share(size_a, parity_a, size_b, parity_b, similarity):
    """Overlap bound by parity bits: at most half of what the differing bits leave."""
    num, den = similarity
    apart = np.bitwise_count(parity_a ^ parity_b).astype(np.int64)
    return (num + den) * (size_a + size_b - apart) >= 2 * num * (size_a + size_b)


def _shape(shape: np.ndarray):
    """Size and salts."""
    return shape >> 32, shape & 0xFFFF


def _pairs(begin, asks):
    """(i, j): every row before row j of its run, for the rows that ask; about
    PAIRS of them at a time, or all of one row."""
    earlier = asks - begin[asks]
    ends = np.cumsum(earlier)
    a = 0
    while a < len(asks):
        done = ends[a] - earlier[a]
        z = max(a + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        j = np.repeat(asks[a:z], earlier[a:z])
        yield np.arange(len(j)) - np.repeat(ends[a:z] - earlier[a:z] - done, earlier[a:z]) + begin[j], j
        a = z


def _live(similarity, block, batches):
    """Rows that have a class of fitting size, place and parities under their
    key, one per class.  The keys of heavy tokens, which are those of several
    salts and those of more than ``block`` classes, keep all their classes and
    are marked by several salts.  Rows come in order of key and class."""
    last = None  # key and class at the end of the piece before, if it was a long run's
    for table, _ in _runs(batches, LONG):
        sig, shape, place, key = (table.column(k).to_numpy() for k in ("sig", "shape", "place", "key"))
        parity = table.column("parity").to_numpy().view(np.uint64)
        fresh = np.concatenate([[last != (key[0], sig[0])], (key[1:] != key[:-1]) | (sig[1:] != sig[:-1])])
        goes_on = last is not None and key[0] == last[0]
        last = (key[-1], sig[-1]) if table.num_rows >= LONG and key[0] == key[-1] else None
        one = np.flatnonzero(fresh)
        if not len(one):
            continue
        sig, shape, place, key, parity = sig[one], shape[one], place[one], key[one], parity[one]
        cuts = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        length = np.diff(cuts)
        size, salts = _shape(shape)
        begin = np.repeat(cuts[:-1], length)
        keep = (salts > 1) | (np.repeat(length, length) > block)
        if goes_on or last is not None:
            keep[:cuts[1]] = True
        shape = np.where(keep, size << 32 | 2, shape)
        for x, y in _pairs(begin, np.flatnonzero((np.arange(len(key)) > begin) & ~keep & (np.repeat(length, length) <= LOOKED))):
            ok = (_fits(size[x], place[x], size[y], place[y], similarity)
                  & _may_share(size[x], parity[x], size[y], parity[y], similarity))
            keep[x[ok]] = keep[y[ok]] = True
        big = (length > LOOKED) & (shape[cuts[:-1]] & 0xFFFF < 2)
        for a, z in zip(cuts[:-1][big], cuts[1:][big], strict=True):
            # sizes in order: partners of a row stand next to it
            own = a + np.argsort(size[a:z], kind="stable")
            for step in range(1, len(own)):
                x, y = own[:-step], own[step:]
                near = similarity[1] * size[x] >= similarity[0] * size[y]
                if not near.any():
                    break
                ok = (near & _fits(size[x], place[x], size[y], place[y], similarity)
                      & _may_share(size[x], parity[x], size[y], parity[y], similarity))
                keep[x[ok]] = keep[y[ok]] = True
        if keep.any():
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (key, sig, shape, place, parity.view(np.int64))], names=_ROW)


def _live_of(similarity, block, batches):
    return _live(similarity, block, _by_key(batches))


def _slots(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _bitmap(df: DataFrame, col: str) -> np.ndarray:
    """A fixed-size filter of the values of a long column: at most 2^FILTER_BITS slot numbers come to the driver."""
    slot = F.shiftrightunsigned(col, 64 - FILTER_BITS).cast("int").alias("slot")
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[df.select(slot).distinct().toArrow().column("slot").to_numpy()] = True
    return np.packbits(bits)


def _fetch(shared, shingle, batches):
    """(sig, distinct 64-bit tokens) of the classes that pass the filter, from the documents that pass theirs."""
    in_docs, in_sigs = (np.unpackbits(x).astype(bool) for x in shared.value)
    seen: set[int] = set()
    for b in batches:
        b = b.filter(pa.array(in_docs[_slots(b.column("text_key").to_numpy())]))
        sigs, sets = [], []
        for _, _, _, _, owner, tokens in _line_tokens(b.column("text"), shingle) if b.num_rows else ():
            for _, _, _, sig, begin, end in _sets(owner, tokens):
                for i in np.flatnonzero(in_sigs[_slots(sig)]):
                    if (s := int(sig[i])) not in seen:
                        seen.add(s)
                        sigs.append(s)
                        sets.append(_distinct(tokens[begin[i]:end[i]]).view(np.int64))
        if len(seen) > 1 << 18:
            seen.clear()
        if sigs:
            yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["sig", "tokens"])


def _candidates(similarity, skip, take, batches):
    """(probe, cand, more): per row that asks, the classes earlier in its run
    that size, place and parities allow, from number ``skip`` on ``take`` of
    them, and whether there are more.  Rows of a run come in order of their
    classes' first lines."""
    for table, cuts in _runs(batches):
        sig, shape, place, parity, probe, answers = (table.column(k).to_numpy(zero_copy_only=False) for k in (*_ROW[1:], "probe", "answers"))
        size, parity = _shape(shape)[0], parity.view(np.uint64)
        begin = np.repeat(cuts[:-1], np.diff(cuts))
        for i, j in _pairs(begin, np.flatnonzero(probe & (np.arange(len(sig)) > begin))):
            ok = (answers[i] & (sig[i] != sig[j]) & _fits(size[i], place[i], size[j], place[j], similarity)
                  & _may_share(size[i], parity[i], size[j], parity[j], similarity))
            i, j = i[ok], j[ok]
            low, high = np.searchsorted(j, j), np.searchsorted(j, j, "right")
            number = np.arange(len(j)) - low
            pick = (number >= skip) & (number < skip + take)
            if pick.any():
                yield pa.RecordBatch.from_arrays([pa.array(sig[j[pick]]), pa.array(sig[i[pick]]), pa.array((high - low)[pick] > skip + take)], names=["probe", "cand", "more"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity) -> DataFrame:
    """(sig) of the pairs' probes whose whole set is similar to that of the candidate."""
    num, den = similarity
    p, c = (sets.select(F.col("sig").alias(name), F.col("tokens").alias(f"{name}_tokens")) for name in ("probe", "cand"))
    shared = F.size(F.array_intersect("probe_tokens", "cand_tokens"))
    both = F.size("probe_tokens") + F.size("cand_tokens")
    return pairs.join(p, "probe").join(c, "cand").where((num + den) * shared >= num * both).select(F.col("probe").alias("sig")).distinct()


def _matched(rows: DataFrame, sets: DataFrame, similarity) -> DataFrame:
    """(sig) of the asking classes that an earlier class of one of their keys
    is similar to.  A class is checked against its earliest candidates; only
    what nothing matched asks for the next ones, four times as many, until it
    has no more.  A pair is checked once a round, whatever the keys it shares,
    so a set travels with its pairs and not with its prefix tokens."""
    parts, skip, take, found = shuffle_parts(rows.sparkSession), 0, ASKED, None
    while True:
        # later rounds have few rows: without a number their partitions may be put together
        dealt = (rows.repartition("key") if skip else rows.repartition(parts, "key")).sortWithinPartitions("key", "first").drop("first")
        asked = dealt.mapInArrow(lean(partial(_candidates, similarity, skip, take)), "probe long, cand long, more boolean")
        pairs = written(asked.groupBy("probe", "cand").agg(F.max("more").alias("more")), "lines-pairs")
        hits = written(_verified(pairs, sets, similarity), "lines-hits")
        found = hits if found is None else found.unionByName(hits)
        left = written(pairs.where("more").select(F.col("probe").alias("sig")).distinct().join(hits, "sig", "left_anti"), "lines-left")
        if not left.limit(1).count():
            return found
        still = rows.join(left.withColumn("asks", F.lit(True)), "sig", "left")
        still = still.withColumn("probe", F.col("probe") & F.col("asks").isNotNull()).select(*rows.columns)
        rows = written(still.join(still.where("probe").select("key").distinct(), "key", "left_semi"), "lines-asking")
        skip, take = skip + take, take * 4


def _dealt(rows: DataFrame, similarity) -> tuple[DataFrame, DataFrame]:
    """The rows of heavy tokens, dealt to blocks of some BLOCK classes, and
    (token, band, blocks), from the exact number of classes of each token and
    band.  Similar sets lie in one band of sizes or in neighbouring ones."""
    step = float(np.log(similarity[1] / similarity[0] * 1.0001))
    size = F.shiftright("shape", 32)
    banded = written(rows.withColumn("token", F.shiftrightunsigned("key", 16)).withColumn("band", F.floor(F.log(size.cast("double")) / step).cast("int")), "lines-heavy")
    blocks = written(banded.groupBy("token", "band").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks")), "lines-blocks")
    dealt = banded.join(blocks, ["token", "band"]).withColumn("block", F.pmod(F.xxhash64("sig"), "blocks")).drop("blocks")
    return written(dealt.withColumn("key", F.xxhash64("token", "band", "block")), "lines-dealt"), blocks


def _asks(dealt: DataFrame, blocks: DataFrame, matched: DataFrame) -> DataFrame:
    """The classes of heavy tokens that nothing in their own block matched, once
    for each band (``asked``, of ``blocks`` blocks) that holds others they may
    be similar to: their own and the neighbouring ones."""
    asks = dealt.join(matched.distinct(), "sig", "left_anti").withColumn("answers", F.lit(False))
    asks = asks.withColumn("asked", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)))
    of = blocks.select("token", F.col("band").alias("asked"), "blocks")
    return written(asks.join(of, ["token", "asked"]).where((F.col("asked") != F.col("band")) | (F.col("blocks") > 1)), "lines-asks")


def _across(dealt: DataFrame, asks: DataFrame) -> DataFrame:
    """Rows of the asking classes with every block they ask.  Those that ask a
    band are cut into groups as well, so a key holds one block and one group."""
    groups = written(asks.groupBy("token", "asked").agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("groups")), "lines-groups")
    key = F.xxhash64("token", "asked", "other", "group")
    asking = asks.join(groups, ["token", "asked"]).withColumn("group", F.pmod(F.xxhash64("sig", F.lit(1)), "groups"))
    asking = asking.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where((F.col("asked") != F.col("band")) | (F.col("other") != F.col("block")))
    answering = dealt.withColumn("probe", F.lit(False)).withColumn("asked", F.col("band")).withColumn("other", F.col("block")).join(groups, ["token", "asked"])
    answering = answering.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    names = [*_ROW, "first", "probe", "answers"]
    return asking.withColumn("key", key).select(*names).unionByName(answering.withColumn("key", key).select(*names))


def removals(docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(survey, removed): the written per-document line classes, and
    (doc_id, text_key, lines): the numbers of the lines that go."""
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    slim = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    survey = written(slim.mapInArrow(lean(partial(_survey, shingle)), f"doc_id {id_type}, text_key long, n_lines int, line array<int>, sig array<long>, "
                                     "counters array<binary>, heavy array<long>, heavy_n array<long>"), "lines-survey")
    # rarity in steps of half a power of two, per counter; salts per counter that a heavy token falls in
    counters = survey.where("counters is not null").select(F.posexplode("counters").alias("segment", "blob"))
    rarity = np.zeros(1 << RARITY_BITS, np.uint64)
    for r in counters.repartition(parts, "segment").mapInArrow(lean(_totals), "segment int, steps binary").collect():
        width = len(rarity) // SEGMENTS
        rarity[r["segment"] * width:(r["segment"] + 1) * width] = np.frombuffer(r["steps"], np.uint8)
    heavy = (survey.where("heavy is not null").select(F.explode(F.arrays_zip("heavy", "heavy_n")).alias("c")).groupBy("c.heavy").agg(F.sum("c.heavy_n").alias("n"))
             .groupBy(F.shiftright("heavy", 48 - RARITY_BITS).cast("int").alias("bucket")).agg(F.max("n").alias("n")).toArrow())
    salts = np.ones(1 << RARITY_BITS, np.uint16)
    salts[heavy.column("bucket").to_numpy()] = np.clip(-(-heavy.column("n").to_numpy() // BLOCK), 1, 65535)
    shared = spark.sparkContext.broadcast((rarity.astype(np.uint8), salts))

    prefixes = slim.select("text").mapInArrow(lean(partial(_buckets, shared, shingle, similarity, BUCKETS * parts)), "bucket int, rows binary")
    live = written(prefixes.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(partial(_live_of, similarity, BLOCK)), "key long, sig long, shape long, place int, parity long"), "lines-live")

    lines = survey.where("size(sig) > 0").select("doc_id", "text_key", F.explode(F.arrays_zip("line", "sig")).alias("c")).select("doc_id", "text_key", "c.line", "c.sig")
    place = F.struct(F.col("doc_id"), F.col("text_key"), F.col("line"))
    first = written(lines.groupBy("sig").agg(F.min(place).alias("first"), F.count("*").alias("n")), "lines-first")
    wanted = live.select("sig").distinct().join(first, "sig").select("sig", "first")
    filters = spark.sparkContext.broadcast((_bitmap(wanted.select("first.text_key"), "text_key"), _bitmap(wanted, "sig")))
    sets = written(slim.select("text_key", "text").mapInArrow(lean(partial(_fetch, filters, shingle)), "sig long, tokens array<long>").dropDuplicates(["sig"])
                   .join(wanted.select("sig"), "sig", "left_semi"), "lines-sets")
    rows = live.join(wanted, "sig").select(*_ROW, "first", F.lit(True).alias("probe"), F.lit(True).alias("answers"))
    salted = F.col("shape").bitwiseAND(F.lit(0xFFFF)) > 1
    if live.where(salted).limit(1).count():
        dealt, blocks = _dealt(rows.where(salted), similarity)
        matched = _matched(rows.where(~salted).unionByName(dealt.select(*rows.columns)), sets, similarity)
        asks = _asks(dealt, blocks, matched)
        if asks.limit(1).count():
            rest = _across(dealt, asks).select(*rows.columns)
            matched = matched.unionByName(_matched(written(rest, "lines-across"), sets, similarity))
    else:
        matched = _matched(rows, sets, similarity)
    matched = matched.distinct().withColumn("matched", F.lit(True))
    # written: the join with all lines is then between two plain exchanges, which AQE can split at a very common line
    judged_classes = written(first.join(matched, "sig", "left").where("matched or n > 1")
                             .select("sig", F.when(F.col("matched").isNull(), F.col("first")).alias("stays")), "lines-judged")
    gone = lines.join(judged_classes, "sig").where(F.col("stays").isNull() | ~place.eqNullSafe(F.col("stays")))
    removed = gone.groupBy("doc_id", "text_key").agg(F.collect_set("line").alias("lines"))
    return survey, written(removed, "lines-removed")


def _apply(batches):
    """The rows without the removed lines; ``n_chars`` follows if there is one."""
    for b in batches:
        rows, removed = b.column("row"), b.column("removed")
        names = [f.name for f in rows.type]
        cols = dict(zip(names, rows.flatten(), strict=True))
        changed = removed.is_valid()
        gone = removed.filter(changed).to_pylist()
        old, new = cols["text"].filter(changed).to_pylist(), []
        for t, g in zip(old, gone, strict=True):
            out = set(g)
            new.append("\n".join(x for k, x in enumerate(t.split("\n")) if k not in out))
        cols["text"] = pc.replace_with_mask(cols["text"], changed, pa.array(new, cols["text"].type))
        if "n_chars" in cols:
            kind = cols["n_chars"].type
            cols["n_chars"] = pc.replace_with_mask(cols["n_chars"], changed, pa.array([len(t) for t in new], pa.int64()).cast(kind))
        emptied = np.zeros(b.num_rows, bool)
        emptied[changed.to_numpy(zero_copy_only=False)] = [not t.strip() for t in new]
        sizes = np.zeros(b.num_rows, np.int64)
        sizes[changed.to_numpy(zero_copy_only=False)] = [len(g) for g in gone]
        listed = _lists(sizes, np.array([k for g in gone for k in sorted(g)], np.int32))
        yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(list(cols.values()), names), listed, pa.array(emptied)], names=["row", "removed_lines", "emptied"])


def cleaned(docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """row (a struct of the columns of ``docs``, later similar lines taken out
    of text), removed_lines (their numbers from 0), emptied (lines went and
    none is left).

    Lines end at line feeds; words are runs of letters, digits and non-ASCII
    characters, A-Z lower-cased.  Lines without a word are never removed; a
    line of fewer than ``shingle`` words is similar only to lines of the same
    words.  Earlier means a smaller (doc_id, text hash, line number), null
    ids first; rows that repeat one (doc_id, text) are one document and get
    one result; a null text stays null; very long texts are read whole, a
    line of one in one task; ties inside a class go to the first line; an
    empty table gives no rows; columns of any name are kept.
    """
    _, removed = removals(docs, shingle, similarity)
    r, match = same_document(removed.withColumnRenamed("lines", "removed"))
    joined = carried(docs).join(r, match, "left").select("row", "removed")
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("removed_lines", T.ArrayType(T.IntegerType())), T.StructField("emptied", T.BooleanType())])
    return joined.mapInArrow(lean(_apply), schema)


def dedup_lines(docs: DataFrame, shingle: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``cleaned`` with the columns of ``docs`` beside removed_lines and
    emptied; columns that already have these names give way."""
    docs = docs.drop("removed_lines", "emptied", "_removed")
    return cleaned(docs, shingle, similarity).select("row.*", "removed_lines", "emptied")
