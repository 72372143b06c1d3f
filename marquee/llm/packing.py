"""Operator 3: packing token pieces by a configuration linear program.

Only the histogram of piece lengths (at most the capacity's number of
lengths) decides how sequences are filled.  The driver covers it by patterns
that fill a sequence exactly: multiplicative weights on the lengths, a
knapsack dynamic program that prices the exact fills under them, and a whole
number of sequences for each pattern taken, for a bounded number of rounds;
the pieces that rounding leaves are put by best fit, again on the histogram.
The plan, whose size the histogram bounds, then numbers the pieces inside
Spark tasks.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import lean, written
from marquee.llm.words import flat, slices

CAPACITY = 2048
#: How the query's program runs: rounds at most, share of a length per round, patterns near the best, pieces kept for filling up.
PROGRAM = {"rounds": 200, "step": 0.25, "near": 0.05, "eps": 0.01, "reserve": 0.0625, "exact": True}
#: Most cached words of a generation per Python worker; a full generation replaces the one before it.
CACHED_WORDS = 160_000


class _Cache:
    """Two generations of a bounded cache: what is asked for again moves to
    the young one, so frequent words stay."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def missing(self, keys: set) -> list:
        """The keys that must be learned; those of the old generation move up."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        todo = []
        for k in keys.difference(young):
            v = old.get(k)
            if v is None:
                todo.append(k)
            else:
                young[k] = v
        return todo


def _byte_kinds() -> np.ndarray:
    """Kind of every byte: 0 white space, 1 letter (ASCII, or of a two-byte
    letter after 0xC3), 2 digit, 3 other ASCII, 4 whatever needs the tokenizer."""
    kinds = np.full(256, 4, np.uint8)
    kinds[33:127] = 3
    kinds[ord("'")] = 4
    kinds[[9, 10, 11, 12, 13, 32]] = 0
    kinds[48:58] = 2
    kinds[65:91] = kinds[97:123] = 1
    return kinds


_KINDS = _byte_kinds()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class _Tokens:
    """Token ids of whole texts, as little-endian bytes.

    White space ends every pre-token of the vocabulary, so a text's ids are its
    chunks' ids in a row; a chunk's are those of its letter runs, digits and
    other runs, lower-cased.  The runs of many texts are found on their bytes,
    made distinct by Arrow and looked up once; what was learned is remembered.
    Chunks beyond plain Latin letters and ASCII (or with an apostrophe, which
    may join) are encoded as they stand, and so are whole texts that may hold
    an added token of the vocabulary.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        # for words that are lower-cased and split already: the same model without what comes before it
        self.model = Tokenizer(self.tok.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words = _Cache(CACHED_WORDS)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn_words(self, words: list[bytes]) -> None:
        """Encodes many words at once: between spaces each is one pre-token,
        whose last id is the only one that ends a word."""
        todo, known = iter(words), self.words.young
        while group := list(islice(todo, 256)):
            ids = np.array(self.model.encode_batch_fast([b" ".join(group).decode()], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(group):
                raw, cuts = ids.tobytes(), (4 * cuts).tolist()
                for w, a, b in zip(group, [0, *cuts[:-1]], cuts, strict=True):
                    known[w] = raw[a:b]
            else:
                for w in group:
                    known[w] = self._whole(w.decode())

    def _learn(self, keys: list[bytes], odd: np.ndarray) -> pa.Array:
        """The ids of every key; ``odd`` ones are whole chunks."""
        todo = self.words.missing(set(keys))
        if todo:
            strange = {keys[i] for i in np.flatnonzero(odd)}
            self._learn_words([k for k in todo if k not in strange])
            whole = [k for k in todo if k in strange]
            for k, e in zip(whole, self.tok.encode_batch_fast([k.decode() for k in whole], add_special_tokens=False) if whole else (), strict=True):
                self.words.young[k] = np.array(e.ids, "<u4").tobytes()
        return pa.array(map(self.words.young.__getitem__, keys), pa.large_binary(), size=len(keys))

    def flat_ids(self, data: np.ndarray, offs: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(ids of all texts in a row, where each text's begin and end), of the
        texts that ``offs`` cuts ``data`` into and that hold no added token."""
        n = len(data)
        if not n:
            return b"", np.zeros(len(offs), np.int64)
        kind = _KINDS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF, but for the signs of multiplication and division
        lead = lead[(data[lead + 1] & 0xDF) != 0x97]
        kind[lead] = kind[lead + 1] = 1
        low = _LOWER[data]
        upper = lead[data[lead + 1] < 0x9F] + 1
        low[upper] += 32
        cuts = offs[(offs > 0) & (offs < n)]
        begins = np.empty(n, bool)  # of runs: digits stand alone
        begins[0] = True
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begins[cuts] = True
        odd = np.flatnonzero(kind == 4)
        if len(odd):  # their chunks are one run each, as they stand
            edge = np.zeros(n, bool)
            edge[0] = True
            edge[1:] = (kind[1:] == 0) != (kind[:-1] == 0)
            edge[cuts] = True
            edge = np.append(np.flatnonzero(edge), n)
            chunk = np.searchsorted(edge, odd, "right") - 1
            chunk = chunk[np.append(True, chunk[1:] != chunk[:-1])]
            for a, z in zip(edge[chunk].tolist(), edge[chunk + 1].tolist(), strict=True):
                begins[a:z] = False
                begins[a] = True
                kind[a:z] = 4
                low[a:z] = data[a:z]
        starts = np.flatnonzero(begins)
        inside = kind[starts] != 0
        sizes, starts = np.diff(starts, append=n)[inside], starts[inside]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        runs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(low[kind != 0])])
        code = runs.dictionary_encode()
        strange = np.zeros(len(code.dictionary), bool)
        strange[code.indices.to_numpy()[kind[starts] == 4]] = True
        ids = self._learn(code.dictionary.to_pylist(), strange).take(code.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        raw = ids.buffers()[2]
        return (raw.to_pybytes() if raw is not None else b""), ends[np.searchsorted(starts, offs)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        marked = [b"<|" in t for t in texts]
        plain = [b"" if m else t for t, m in zip(texts, marked, strict=True)]
        offs = np.concatenate([[0], np.cumsum([len(t) for t in plain])]).astype(np.int64)
        raw, ends = self.flat_ids(np.frombuffer(b"".join(plain), np.uint8), offs)
        return [self._whole(t.decode()) if m else raw[a:z] for t, m, a, z in zip(texts, marked, ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


_tokens: dict[str, _Tokens] = {}


def _pieces(path, capacity, batches):
    """Per document its pieces: start, length, crc of the ids, and the number
    of earlier pieces of that length in this task."""
    if path not in _tokens:
        _tokens[path] = _Tokens(path)
    encode, part = _tokens[path].encode, TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    for b in batches:
        data, offs = flat(b.column("text"))
        raw = data.tobytes()
        rows, piece, start, length, crc, rank = [], [], [], [], [], []
        for i0, i1 in slices(offs):
            for i, ids in enumerate(encode([raw[offs[i]:offs[i + 1]] for i in range(i0, i1)]), i0):
                ids += b"\0\0\0\0"
                for p, a in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[a:a + 4 * capacity]
                    n = len(own) // 4
                    rows.append(i)
                    piece.append(p)
                    start.append(a // 4)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    rank.append(seen[n])
                    seen[n] += 1
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
             pa.array(crc, pa.int64()), pa.array(np.full(len(rows), part, np.int32)), pa.array(rank, pa.int64())],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank_in_part"])
    _tokens[path].words = _Cache(CACHED_WORDS)  # the worker may do other work next


def _price(value: np.ndarray, lengths: np.ndarray, capacity: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    """The greatest value that fits each space (``exact``: that fills it, -inf
    where nothing does), and the index of a length that reaches it (-1: none,
    the space is left open): unbounded knapsack by dynamic programming over
    the space used."""
    best, take = np.full(capacity + 1, -np.inf if exact else 0.0), np.full(capacity + 1, -1, np.int64)
    best[0] = 0
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for space in range(1, capacity + 1):
        k = fits[space]
        if not exact:
            best[space] = best[space - 1]
        if k:
            gain = value[:k] + best[space - lengths[:k]]
            top = int(gain.argmax())
            if gain[top] > best[space]:
                best[space], take[space] = gain[top], top
    return best, take


def _pattern(seed: int, value: np.ndarray, lengths: np.ndarray, best: np.ndarray, take: np.ndarray, room: np.ndarray, least: float, exact: bool) -> dict[int, int] | None:
    """The best pattern (index of length -> copies) that holds ``seed``, of at
    most ``room`` copies each; None if its value is below ``least`` or, where
    it must be full, no pieces that are left fill it."""
    pattern = {seed: 1}
    room[seed] -= 1
    space, total = len(best) - 1 - int(lengths[seed]), value[seed]
    while space > 0 and total + best[space] >= least:
        k = int(take[space])
        if k < 0:
            if exact:
                break
            space -= 1
            continue
        if not room[k]:  # priced without bounds: the best that is there
            fits = int(np.searchsorted(lengths, space, "right"))
            gain = np.where(room[:fits] > 0, value[:fits] + best[space - lengths[:fits]], -np.inf)
            k = int(gain.argmax())
            if gain[k] == -np.inf:
                break
        pattern[k] = pattern.get(k, 0) + 1
        room[k] -= 1
        total += value[k]
        space -= int(lengths[k])
    for k, c in pattern.items():
        room[k] += c
    return pattern if total >= least and not (exact and space) else None


def _program(left: dict[int, int], capacity: int, rounds: int | None, rate: float, step: float, near: float, eps: float, exact: bool):
    """After every round the whole numbers of sequences by pattern and the
    pieces that are left."""
    solved: dict[tuple, int] = {}
    left = dict(left)
    at_first, done = dict(left), 0
    enough = eps * sum(left.values())
    while left and sum(left.values()) > enough and (rounds is None or done < rounds):
        done += 1
        placed = sum(solved.values())
        lengths = np.array(sorted(left), np.int64)
        n, have = (np.array([d[k] for k in lengths.tolist()], np.int64) for d in (at_first, left))
        share = lengths / capacity
        covered = 1 - have / n
        value = share * (1 + 0.05 * share) * np.exp(-rate * (covered - covered.min()))
        best, take = _price(value, lengths, capacity, exact)
        room = np.minimum(have, np.maximum(1, (step * n).astype(np.int64)))
        through = value + best[capacity - lengths]
        least = 0.0  # the first pattern is taken as it comes
        for seed in np.argsort(-through, kind="stable").tolist():
            if through[seed] < least:
                break
            pattern = _pattern(seed, value, lengths, best, take, room, least, exact) if room[seed] else None
            if pattern is None:
                continue
            least = (1 - near) * best[capacity]
            times = min(int(room[k]) // c for k, c in pattern.items())
            for k, c in pattern.items():
                room[k] -= c * times
                have[k] -= c * times
            key = tuple(sorted((int(lengths[k]), c) for k, c in pattern.items()))
            solved[key] = solved.get(key, 0) + times
        left.update(zip(lengths.tolist(), have.tolist(), strict=True))
        for k in lengths[have == 0].tolist():
            del left[k]
        if sum(solved.values()) == placed:
            break
        yield dict(solved), dict(left)


def _best_fit(plan: list[tuple[dict[int, int], int]], left: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """The plan with the pieces that are left, longest first, in the narrowest
    space that takes them: classes of equal sequences by free space."""
    lengths = np.array(sorted(left), np.int64)
    open_by: dict[int, list[tuple[dict[int, int], int]]] = {}
    for pattern, times in plan:
        open_by.setdefault(capacity - sum(k * c for k, c in pattern.items()), []).append((pattern, times))
    free = sorted(open_by)
    for k in lengths[::-1].tolist():
        rest = left[k]
        while rest:
            i = bisect_left(free, k)
            if i == len(free):
                each = min(capacity // k, rest)
                pattern, times = {}, rest // each
            else:
                each = 1
                space = free[i]
                pattern, have = open_by[space].pop()
                times = min(have, rest)
                if have > times:
                    open_by[space].append((pattern, have - times))
                if not open_by[space]:
                    del open_by[space], free[i]
            grown = dict(pattern)
            grown[k] = grown.get(k, 0) + each
            space = capacity - sum(a * c for a, c in grown.items())
            if space not in open_by:
                open_by[space] = []
                free.insert(bisect_left(free, space), space)
            open_by[space].append((grown, times))
            rest -= each * times
    return [x for s in sorted(open_by) for x in open_by[s]]


def plan_patterns(counts: dict[int, int], capacity: int = CAPACITY, rounds: int | None = None, rate: float = 20.0, step: float = 0.1,
                  near: float = 0.005, eps: float = 0.01, reserve: float = 0.0, exact: bool = False, figures: dict | None = None) -> list[tuple[dict[int, int], int]]:
    """Patterns with their numbers of sequences, holding exactly ``counts``.

    Multiplicative weights: a length's weight falls exponentially with the
    share of its pieces that is covered, so lengths run out together.  Each
    round prices all patterns at once and takes, for every length, the best
    one that holds it if that is worth at least 1 - ``near`` of the best of
    all, a ``step`` of its scarcest length (one sequence at least): whole
    numbers, so what rounding leaves is priced again.  Rounds end after
    ``rounds`` (None: no bound), when nothing more is taken, or when at most
    ``eps`` of the pieces are left; those go by best fit, class of equal
    sequences by class.

    With ``exact`` only patterns that fill a sequence are priced, pieces up to
    ``reserve`` of the capacity are kept to fill up the others, and of the
    depths at which the program can hand over to best fit (every twentieth of
    the pieces) the one of fewest sequences, then of most placed pieces, is
    taken.  A round's work is bounded by the capacity and the number of
    lengths, whatever the counts.  ``figures`` takes the number of pieces
    below the capacity (``pieces``) and of those that the program placed
    (``placed``).
    """
    left = {n: c for n, c in counts.items() if c > 0}
    whole = [({capacity: 1}, left.pop(capacity))] if capacity in left else []
    pieces = sum(left.values())
    best, placed, kept = None, 0, -1.0
    small = {k: c for k, c in left.items() if k <= reserve * capacity}
    for solved, rest in _program({k: c for k, c in left.items() if k not in small}, capacity, rounds, rate, step, near, eps, exact):
        rest.update(small)
        share = 1 - sum(rest.values()) / pieces
        if exact and best is not None and share < kept + 0.05:
            continue
        if not exact:  # only the last round counts
            best, placed = (solved, rest), pieces - sum(rest.values())
            continue
        kept = share
        plan = _best_fit([(dict(key), times) for key, times in solved.items()], rest, capacity)
        if best is None or sum(t for _, t in plan) <= sum(t for _, t in best):
            best, placed = plan, pieces - sum(rest.values())
    if best is not None and not exact:
        best = _best_fit([(dict(key), times) for key, times in best[0].items()], best[1], capacity)
    if figures is not None:
        figures.update(pieces=pieces, placed=placed)
    return whole + (_best_fit([], left, capacity) if best is None else best)


def _segments(plan) -> dict[str, np.ndarray]:
    """The plan by length: for rank s onwards, a copies per sequence from
    sequence q on, the first at offset o.  Sorted by (length, s)."""
    rows, used, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for k in sorted(pattern, reverse=True):
            c = pattern[k]
            rows.append((k, used.get(k, 0), c, sequence, offset))
            used[k] = used.get(k, 0) + c * times
            offset += k * c
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T, strict=True))


def _placed(shared, batches):
    seg = shared.value
    cuts = {}
    for b in batches:
        length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
        at = np.empty(len(length), np.int64)
        for k in np.unique(length):
            if k not in cuts:
                cuts[k] = np.searchsorted(seg["length"], [k, k + 1])
            a, z = cuts[k]
            mine = length == k
            at[mine] = a + np.searchsorted(seg["first"][a:z], rank[mine], "right") - 1
        inside = rank - seg["first"][at]
        copies = seg["copies"][at]
        sequence = seg["sequence"][at] + inside // copies
        offset = seg["offset"][at] + inside % copies * length
        keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
        yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(sequence), pa.array(offset)], names=[*keep, "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, program: dict = PROGRAM) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.

    A document is its ids and one closing id 0; only documents longer than
    ``capacity`` are cut, every ``capacity`` ids.  Null and empty texts are
    the closing id alone; null ids and repeated rows are packed like others;
    an empty table gives no rows; other columns are not read.  Which of the
    pieces of one length goes where is settled by task and place in it.

    ``tokenizer_path`` must name the vocabulary file on every executor.  To
    the driver come the histogram's at most ``capacity`` rows; what goes back
    is the plan, at most a few patterns per length and round (``program`` sets
    how it is made, see ``plan_patterns``).
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    pieces = written(docs.select("doc_id", "text").mapInArrow(
        lean(partial(_pieces, tokenizer_path, capacity)),
        f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, part int, rank_in_part long"), "pack-pieces")
    per_part = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(_segments(plan_patterns(counts, capacity, **program)))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0).cast("long")).alias("before"))
    ranked = pieces.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("rank_in_part")).alias("rank"))
    return ranked.mapInArrow(lean(partial(_placed, shared)), f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
