"""Operator 13: conversation repair by a generalised LR parser with edits.

The roles of a conversation are parsed by the LR automaton of a role grammar.
The parser's stacks form a graph: a node is an automaton state, its links lead
to the states that can lie below it.  At every row all live stack tops advance
at once by keeping the row, reroling it, deleting it or inserting a turn
before it; tops that become equal are merged into the one of least (cost,
audit), where the audit is the string of edit initials.  That merge loses
nothing if what may follow depends on the top alone, as in grammars that grow
a list on the left.

Rows are dealt in ordered chunks, so that one conversation may span many
tasks.  For the conversations at a chunk's ends the chunk leaves the least
(cost, audit) from every top to every top; these compose in chunk order, and
each chunk then applies the edits that the composed path gives it.
"""

from __future__ import annotations

import hashlib
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.scan import chunked
from marquee.llm.common import shuffle_parts, written

#: Productions over role initials: an optional system turn, then user and assistant in turn; or nothing.
ROLE_GRAMMAR = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "T"), ("P", "PT"), ("T", "ua"))
#: Roles that a row can be given and that an inserted turn can have, by initial.
GIVEN = {"u": "user", "a": "assistant"}
WEIGHTS = {"keep": 0, "rerole": 3, "delete": 4, "insert": 3, "truncated": 3}
#: Neighbouring initials that are in order.
LEGAL = ("su", "ua", "au")
#: Rows per chunk on average.
CHUNK_ROWS = 32768
_DROPPED = ("blank", "duplicate")


class StackGraph:
    """The LR(0) automaton of a grammar and the graph of all its stacks."""

    def __init__(self, productions=ROLE_GRAMMAR):
        self.productions = tuple(productions)
        self.start = self.productions[0][0]
        self.heads = {lhs for lhs, _ in self.productions}
        self.states = [self._closure({(i, 0) for i, (lhs, _) in enumerate(self.productions) if lhs == self.start})]
        self.goto: dict[tuple[int, str], int] = {}
        for k, state in enumerate(self.states):  # grows while it is read
            for symbol in sorted({self.productions[i][1][dot] for i, dot in state if dot < len(self.productions[i][1])}):
                moved = self._closure({(i, dot + 1) for i, dot in state if self.productions[i][1][dot:dot + 1] == symbol})
                if moved not in self.states:
                    self.states.append(moved)
                self.goto[k, symbol] = self.states.index(moved)
        done = [{i for i, dot in s if dot == len(self.productions[i][1])} for s in self.states]
        self.accepting = {k for k, d in enumerate(done) if any(self.productions[i][0] == self.start for i in d)}
        self.reduces = [[self.productions[i] for i in sorted(d) if self.productions[i][0] != self.start] for d in done]
        self.shifts = {c for _, rhs in self.productions for c in rhs if c not in self.heads}
        self.below: dict[int, set[int]] = {0: set()}
        size = -1
        while size != (size := sum(len(v) + 1 for v in self.below.values())):
            for top in list(self.below):
                for symbol in self.shifts:
                    self._advance(top, symbol)
        self._steps: dict[tuple[int, str], tuple[int, ...]] = {}

    def _closure(self, items: set) -> frozenset:
        todo, seen = list(items), set(items)
        while todo:
            i, dot = todo.pop()
            following = self.productions[i][1][dot:dot + 1]
            new = {(j, 0) for j, (lhs, _) in enumerate(self.productions) if lhs == following} - seen
            seen |= new
            todo += new
        return frozenset(seen)

    def _advance(self, top: int, symbol: str) -> set[int]:
        """The tops after shifting ``symbol`` on ``top`` and every reduction, linked into the graph."""
        if (top, symbol) not in self.goto:
            return set()
        todo, seen = [(self.goto[top, symbol], top)], set()
        while todo:
            state, under = todo.pop()
            if (state, under) in seen:
                continue
            seen.add((state, under))
            self.below.setdefault(state, set()).add(under)
            for lhs, rhs in self.reduces[state]:
                ends = {under} if rhs else {state}
                for _ in rhs[1:]:
                    ends = set().union(*(self.below[e] for e in ends))
                todo += [(self.goto[e, lhs], e) for e in ends if (e, lhs) in self.goto]
        return {s for s, _ in seen if s in self.accepting or any((s, c) in self.goto for c in self.shifts)}

    def step(self, top: int, symbol: str) -> tuple[int, ...]:
        if (top, symbol) not in self._steps:
            self._steps[top, symbol] = tuple(sorted(self._advance(top, symbol)))
        return self._steps[top, symbol]

    @property
    def tops(self) -> list[int]:
        return sorted(s for s in self.below if s in self.accepting or any((s, c) in self.goto for c in self.shifts))


def _spelled(link, base) -> str:
    out = []
    while link is not base:
        out.append(link[1])
        link = link[0]
    return "".join(reversed(out))


def _before(a, b) -> bool:
    """Whether audit ``a`` comes before ``b``; they differ first after their last common link."""
    x, y = a, b
    while x is not y:
        if x is not None and (y is None or x[2] >= y[2]):
            x = x[0]
        else:
            y = y[0]
    return _spelled(a, x) < _spelled(b, x)


def _offer(tops: dict, state: int, cost: int, link, letters: str) -> bool:
    """Merges a stack top into ``tops``: the least (cost, audit) stays."""
    had = tops.get(state)
    if had is not None and had[0] < cost:
        return False
    new = (link, letters, (link[2] if link else 0) + 1)
    if had is None or cost < had[0] or _before(new, had[1]):
        tops[state] = (cost, new)
        return True
    return False


def insertions(graph: StackGraph, tops: dict, weights: dict) -> dict:
    """``tops`` closed under inserted turns."""
    out, todo = dict(tops), list(tops)
    while todo:
        top = todo.pop()
        cost, link = out[top]
        for symbol in GIVEN:
            for state in graph.step(top, symbol):
                if _offer(out, state, cost + weights["insert"], link, "I"):
                    todo.append(state)
    return out


def advance(graph: StackGraph, tops: dict, initial: str, fault: str | None, weights: dict) -> dict:
    """The tops after one more row."""
    out: dict = {}
    extra = weights["truncated"] if fault == "truncated" else 0
    for top, (cost, link) in insertions(graph, tops, weights).items():
        _offer(out, top, cost + weights["delete"], link, "D")
        if fault in _DROPPED:
            continue
        for state in graph.step(top, initial) if initial in graph.shifts else ():
            _offer(out, state, cost + weights["keep"] + extra, link, "K")
        for symbol in GIVEN:
            for state in graph.step(top, symbol):
                _offer(out, state, cost + weights["rerole"] + extra, link, "R")
    return out


def closed(graph: StackGraph, tops: dict, weights: dict):
    """The least (cost, link) of a complete parse."""
    best: dict = {}
    for state, (cost, link) in insertions(graph, tops, weights).items():
        if state in graph.accepting:
            _offer(best, 0, cost, link, "")
    return best[0]


# ------------------------------------------------------------------ chunks

_KEYED = ["conv_id", "turn", "role", "text", "fault", "initial"]
_TABLE = "_pid int, conv_id {id}, last string, table array<struct<start:int,end:int,cost:long,audit:string>>"
_PATHS = "_pid int, conv_id {id}, path_start int, path string, path_last string"
_EDITS = "conv_id {id}, chunk int, place long, turn {turn}, role string, text string, fault string, legal boolean, edit string, cost long, new_role string"


def _runs(batch):
    """(first, last) of the runs of equal conv_id in a batch."""
    ids = batch.column("conv_id").to_pylist()
    cuts = [0, *[i for i in range(1, len(ids)) if ids[i] != ids[i - 1]], len(ids)]
    return [(ids[a], a, z) for a, z in zip(cuts, cuts[1:], strict=False) if z > a]


def _summaries(grammar, weights, batches):
    """Transfer tables of the first and the last conversation of a chunk."""
    graph, nothing = StackGraph(grammar), object()
    first, current, pid, kind = True, nothing, None, None
    tables: dict = {}
    last = None

    def row():
        entries = [{"start": s, "end": e, "cost": c, "audit": _spelled(link, None)} for s, tops in tables.items() for e, (c, link) in tops.items()]
        return pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([current], kind), pa.array([last]),
                                           pa.array([entries], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])))],
                                          names=["_pid", "conv_id", "last", "table"])
    for b in batches:
        if not b.num_rows:
            continue
        initials, faults = b.column("initial").to_pylist(), b.column("fault").to_pylist()
        kind = b.schema.field("conv_id").type
        for conv, a, z in _runs(b):
            if current is nothing or conv != current:
                if current is not nothing and first:
                    yield row()
                    first = False
                pid, current = b.column("_pid")[a].as_py(), conv
                tables = {s: {s: (0, None)} for s in (graph.tops if first else [0])}
            for i in range(a, z):
                tables = {s: advance(graph, tops, initials[i], faults[i], weights) for s, tops in tables.items()}
            last = initials[z - 1]
    if current is not nothing:
        yield row()


def _composed(grammar, weights, table: pa.Table) -> pa.Table:
    """One conversation's chunks in order: where each chunk starts and its part of the best audit."""
    graph = StackGraph(grammar)
    rows = sorted(table.select(["_pid", "table", "last"]).to_pylist(), key=lambda r: r["_pid"])
    out = {"_pid": [], "path_start": [], "path": [], "path_last": []}
    if len(rows) > 1:
        # a top's link: (link before, this chunk's part, depth, its start)
        tops: dict = {0: (0, None)}
        for r in rows:
            new: dict = {}
            for e in r["table"]:
                if e["start"] in tops:
                    cost, link = tops[e["start"]]
                    if _offer(new, e["end"], cost + e["cost"], link, e["audit"]):
                        new[e["end"]] = (new[e["end"]][0], (*new[e["end"]][1], e["start"]))
            tops = new
        _, link = closed(graph, tops, weights)
        parts, tail = [], ""
        while link is not None:
            if len(link) == 3:  # insertions at the end
                tail = link[1] + tail
            else:
                parts.append((link[3], link[1] + tail))
                tail = ""
            link = link[0]
        for r, (start, path), before in zip(rows, reversed(parts), [None, *[r["last"] for r in rows]], strict=False):
            for k, v in zip(out, (r["_pid"], start, path, before), strict=True):
                out[k].append(v)
    n = len(out["_pid"])
    return pa.table([pa.array(out["_pid"], pa.int32()), table.column("conv_id").combine_chunks().take(pa.array([0] * n, pa.int64())), pa.array(out["path_start"], pa.int32()),
                     pa.array(out["path"], pa.string()), pa.array(out["path_last"], pa.string())], names=["_pid", "conv_id", "path_start", "path", "path_last"])


def _edited(grammar, weights, batches):
    """Every row of a chunk with its edit, inserted turns in their places."""
    graph, nothing = StackGraph(grammar), object()
    held: list = []
    current = nothing

    def flush():
        rows = held[0] if len(held) == 1 else pa.concat_batches(held)
        initials, faults = rows.column("initial").to_pylist(), rows.column("fault").to_pylist()
        path, start, before = (rows.column(c)[0].as_py() for c in ("path", "path_start", "path_last"))
        if path is None:
            tops: dict = {0: (0, None)}
            for x, f in zip(initials, faults, strict=True):
                tops = advance(graph, tops, x, f, weights)
            path, start = _spelled(closed(graph, tops, weights)[1], None), 0
        at, tops = [], {start}
        edits, costs, roles, legal = [], [], [], []
        i = 0
        for letter in path:
            take = None if letter == "I" else i
            i += letter != "I"
            extra = weights["truncated"] if take is not None and faults[take] == "truncated" and letter != "D" else 0
            role, symbol = None, None
            if letter == "K":
                symbol = initials[take]
            elif letter in "RI":  # of the roles that can be given, the one that the stack takes here
                symbol = next(s for s in GIVEN if any(graph.step(t, s) for t in tops))
                role = GIVEN[symbol]
            if symbol is not None:
                tops = {n for t in tops for n in graph.step(t, symbol)}
            at.append(take)
            edits.append(letter)
            costs.append(weights[{"K": "keep", "R": "rerole", "D": "delete", "I": "insert"}[letter]] + extra)
            roles.append(role)
            previous = None if take is None else (initials[take - 1] if take else before)
            legal.append(None if previous is None else previous + initials[take] in LEGAL)
        source = pa.array(at, pa.int64())
        n = len(at)
        kept = {c: rows.column(c).take(source) for c in ("turn", "role", "text", "fault")}
        new_role = pa.array([r if r is not None else (k if e == "K" else None) for r, k, e in zip(roles, kept["role"].to_pylist(), edits, strict=True)], pa.string())
        yield pa.RecordBatch.from_arrays(
            [rows.column("conv_id").take(pa.array([0] * n, pa.int64())), rows.column("_pid").take(pa.array([0] * n, pa.int64())), pa.array(range(n), pa.int64()),
             kept["turn"], kept["role"], kept["text"], kept["fault"], pa.array(legal, pa.bool_()), pa.array(edits, pa.string()), pa.array(costs, pa.int64()), new_role],
            names=["conv_id", "chunk", "place", "turn", "role", "text", "fault", "legal", "edit", "cost", "new_role"])

    for b in batches:
        for conv, a, z in _runs(b):
            if held and conv != current:
                yield from flush()
                held = []
            current = conv
            held.append(b.slice(a, z - a))
    if held:
        yield from flush()


def marked(rows: DataFrame) -> DataFrame:
    """Rows with ``fault``, ``initial`` and an order that splits repeats:
    conv_id, turn, role, text, fault, initial, said, uid."""
    text, role = F.coalesce(F.col("text"), F.lit(" ")), F.coalesce(F.col("role"), F.lit(" "))
    r = rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumn("said", F.md5(F.col("text").cast("binary"))).withColumn("uid", F.monotonically_increasing_id())
    r = written(r, "repair-rows")  # freezes uid
    at = F.struct("turn", "uid")
    same = ["conv_id", "role", "said"]
    firsts = (r.groupBy(*same).agg(F.min(at).alias("first"), F.count("*").alias("n")).where("n > 1")
              .select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("said").alias("_s"), "first"))
    found = r.join(firsts, r["conv_id"].eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("said") == F.col("_s")), "left")
    bare = F.rtrim("text", F.lit(" \t\n\u000b\f\r"))
    fault = (F.when(bare == "", "blank").when(F.col("first").isNotNull() & (at > F.col("first")), "duplicate")
             .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated"))
    return found.select("conv_id", "turn", "role", "text", fault.alias("fault"), F.substring("role", 1, 1).alias("initial"), "said", "uid")


def repair(rows: DataFrame, grammar=ROLE_GRAMMAR, weights: dict = WEIGHTS, chunks: int | None = None) -> DataFrame:
    """The edits of every conversation of ``rows`` (conv_id, turn, role, text):
    conv_id, chunk, place (together the order), turn, role and text of the row
    (null for an inserted turn), fault, legal (whether its initial may follow
    that of the row before; null for a first row), edit (K, R, D or I), cost,
    new_role (null where deleted).

    Rows stand by turn (nulls first), then role, then MD5 of the text; equal
    rows are interchangeable.  A null text or role is one space, a null
    conv_id is a conversation of its own.  A row's first fault counts: blank
    (white space only), duplicate (role and text seen earlier), truncated
    (its last other character is none of ``.!?``).  Blank and duplicate rows
    are always deleted.  Of the cheapest edits the ASCII-least audit is taken;
    it fixes all roles.  A role without an initial of the grammar (the empty
    one too) is never kept.  An empty table gives no rows, other columns are
    not read.  A conversation's rows in one chunk are held by one task, chunks
    have ``CHUNK_ROWS`` rows on average however long a conversation or a text
    is; what grows with a conversation in one task is its audit.
    """
    id_type, turn_type = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    spark = rows.sparkSession
    ready = written(marked(rows), "repair-marked")
    n = chunks or max(shuffle_parts(spark), -(-ready.count() // CHUNK_ROWS))
    order = ["turn", "role", "said", "uid"]
    dealt = chunked(ready, ["conv_id"], order, n)
    tables = dealt.sortWithinPartitions("conv_id", *order).select("_pid", "conv_id", "fault", "initial").mapInArrow(partial(_summaries, grammar, weights), _TABLE.format(id=id_type))
    paths = written(tables.groupBy("conv_id").applyInArrow(lambda t: _composed(grammar, weights, t), _PATHS.format(id=id_type)), "repair-paths")
    # at most two rows per chunk, joined without moving the chunks
    paths = F.broadcast(paths.select(F.col("_pid").alias("_p"), F.col("conv_id").alias("_c"), "path_start", "path", "path_last"))
    with_path = dealt.join(paths, (F.col("_pid") == F.col("_p")) & F.col("conv_id").eqNullSafe(F.col("_c")), "left")  # a join may drop the order below it
    sorted_rows = with_path.sortWithinPartitions("conv_id", *order).select("_pid", *_KEYED, "path_start", "path", "path_last")
    return written(sorted_rows.mapInArrow(partial(_edited, grammar, weights), _EDITS.format(id=id_type, turn=turn_type)), "repair-edits")


def report(edits: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    turns = edits.where("edit <> 'I'").groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    wide = lambda c: c.cast("decimal(38,0)")
    gaps = turns.groupBy("conv_id").agg(F.coalesce(wide(F.max("turn")) - wide(F.min("turn")) + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    # a chunk's letters, then the chunks': no list is longer than a chunk or the number of chunks
    by_chunk = edits.groupBy("conv_id", "chunk").agg(
        *[F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")], F.count_if(~F.col("legal")).alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "edit"))), lambda x: x["edit"]), "").alias("letters"))
    whole = by_chunk.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "letters"))), lambda x: x["letters"]), "").alias("audit"))
    gaps = gaps.withColumnRenamed("conv_id", "_c")
    return whole.join(gaps, whole["conv_id"].eqNullSafe(gaps["_c"])).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _digested(batches):
    """SHA-256 of each conversation's lines, read in order and never held together."""
    nothing = object()
    current, digest = nothing, None
    for b in batches:
        ids, shas = [], []
        lines = b.column("line").to_pylist()
        for conv, a, z in _runs(b):
            if current is nothing or conv != current:
                if current is not nothing:
                    ids.append(current)
                    shas.append(digest.hexdigest())
                current, digest, joint = conv, hashlib.sha256(), ""
            else:
                joint = "\n"
            digest.update((joint + "\n".join(lines[a:z])).encode())
        kind = b.schema.field("conv_id").type
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(shas)], names=["conv_id", "repaired_sha256"])
    if current is not nothing:
        yield pa.RecordBatch.from_arrays([pa.array([current], kind), pa.array([digest.hexdigest()])], names=["conv_id", "repaired_sha256"])


def digests(edits: DataFrame) -> DataFrame:
    """Per conversation with a row left: SHA-256 of its repaired ``role:text`` lines."""
    id_type = edits.schema["conv_id"].dataType.simpleString()
    line = F.concat("new_role", F.lit(":"), F.coalesce("text", F.lit(""))).alias("line")
    left = edits.where("edit <> 'D'").select("conv_id", "chunk", "place", line)
    return (left.repartition(shuffle_parts(edits.sparkSession), "conv_id").sortWithinPartitions("conv_id", "chunk", "place").select("conv_id", "line")
            .mapInArrow(_digested, f"conv_id {id_type}, repaired_sha256 string"))
