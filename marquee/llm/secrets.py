"""Operator 5: secrets by a trigram inverted index and verified regexes.

Every rule's regex is turned into a Boolean query over lower-cased trigrams
that any match must hold.  Each Arrow batch of documents is an index block:
its postings (trigram -> documents) are intersected and united as the query
says, and only the documents left are searched with the regex itself.  Rules
without mandatory trigrams search every document.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from re import _constants as RC
from re import _parser as RP

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import flat, slices


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern``, leftmost and not
    overlapping, whose group ``group`` has at least ``least`` characters."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    any_case: bool = False

    def compiled(self):
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The base rules of the contract.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# Public formats of further credentials.
EXTRA = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE + EXTRA

_MOST_STRINGS = 64  # a set of possible strings beyond this is given up for its trigrams so far
_MOST_CLASS = 8


def _strings_query(strings: set[str]):
    """The query all of whose answers hold one of ``strings``; None: no condition."""
    alts = set()
    for s in strings:
        tri = frozenset(s[i:i + 3] for i in range(len(s) - 2))
        if not tri:
            return None
        alts.add(tri)
    return alts


def _both(a, b):
    """Conjunction of two disjunctions of trigram sets (None: no condition)."""
    if a is None or b is None:
        return b if a is None else a
    out = {x | y for x in a for y in b}
    return out if len(out) <= _MOST_STRINGS else a


def _walk(parsed) -> tuple[set[str] | None, set | None]:
    """(strings, query) of a parsed pattern: the lower-cased strings it can
    match if they are few, else None; and a necessary trigram query."""
    done, query = {""}, None  # strings that end at the current place
    exact = True

    def cut(strings):
        nonlocal query
        query = _both(query, _strings_query(strings))

    for op, arg in parsed:
        strings = sub = None
        if op is RC.LITERAL:
            strings = {chr(arg).lower()}
        elif op is RC.IN:
            members: set[str] | None = set()
            for kind, v in arg:
                if kind is RC.LITERAL and members is not None:
                    members.add(chr(v).lower())
                elif kind is RC.RANGE and members is not None and v[1] - v[0] < _MOST_CLASS:
                    members |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
                else:
                    members = None
            strings = members if members and len(members) <= _MOST_CLASS else None
        elif op is RC.SUBPATTERN:
            strings, sub = _walk(arg[-1])
        elif op is RC.BRANCH:
            parts = [_walk(p) for p in arg[1]]
            if all(s is not None for s, _ in parts):
                strings = set().union(*(s for s, _ in parts))
            elif all(q is not None for _, q in parts):
                sub = set().union(*(q for _, q in parts))
        elif op in (RC.MAX_REPEAT, RC.MIN_REPEAT):
            low, high, body = arg
            inner, inner_query = _walk(body)
            if inner is not None and high is not RC.MAXREPEAT and high <= 1:
                strings = inner | ({""} if low == 0 else set())
            elif low >= 1:
                sub = inner_query if inner is None else _strings_query(inner)
        elif op is RC.AT:
            strings = {""}
        if strings is not None and len(done) * len(strings) <= _MOST_STRINGS:
            done = {a + b for a in done for b in strings}
            continue
        exact = False
        cut(done)
        query = _both(query, sub)
        if strings is not None:
            done = strings
        else:
            done = {""}
    if exact:
        return done, _strings_query(done)
    cut(done)
    return None, query


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-cased trigrams that must all occur;
    None if no trigram is mandatory (the rule scans every document)."""
    query = _walk(RP.parse(pattern))[1]
    if query is None or any(not a.isascii() for alt in query for a in alt):
        return None
    return sorted((a for a in query if not any(b < a for b in query)), key=sorted)


class _Block:
    """The trigram postings of some documents, for the rules' vocabulary."""

    def __init__(self, vocabulary: list[str]):
        self.slot = {t: i for i, t in enumerate(vocabulary)}
        self.code = np.full(1 << 24, -1, np.int16)
        for t, i in self.slot.items():
            a, b, c = t.encode()
            self.code[a << 16 | b << 8 | c] = i
        self.lower = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

    def postings(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """Per vocabulary trigram the sorted rows that hold it."""
        rows: list[np.ndarray] = [np.zeros(0, np.int64)] * len(self.slot)
        if len(data) < 3 or not self.slot:
            return rows
        low = self.lower[data].astype(np.int32)
        slot = self.code[(low[:-2] << 16) | (low[1:-1] << 8) | low[2:]]
        at = np.flatnonzero(slot >= 0)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        pairs = np.unique(slot[at[inside]].astype(np.int64) << 40 | row[inside])
        cut = np.searchsorted(pairs >> 40, np.arange(len(self.slot) + 1))
        return [pairs[cut[i]:cut[i + 1]] & ((1 << 40) - 1) for i in range(len(self.slot))]

    def answer(self, query, postings) -> set[int]:
        """Rows that satisfy one alternative: shortest postings first."""
        out: set[int] = set()
        for alt in query:
            lists = sorted((postings[self.slot[t]] for t in alt), key=len)
            got = lists[0]
            for x in lists[1:]:
                got = np.intersect1d(got, x, assume_unique=True)
            out.update(got.tolist())
        return out


def _spans(rule: Rule, regex, text: str):
    for m in regex.finditer(text):
        a, b = m.span(rule.group)
        if b - a >= rule.least:
            yield m.span()


def _scanner(rules: tuple[Rule, ...], n_base: int):
    def scan(batches):
        queries = [trigram_query(r.pattern) for r in rules]
        block = _Block(sorted({t for q in queries if q for alt in q for t in alt}))
        regexes = [r.compiled() for r in rules]
        # a whole-match class run of some length or more can be looked for at that length
        runs = {i: re.compile(re.sub(r"\+$", "{%d,}" % r.least, r.pattern).encode()) for i, r in enumerate(rules)
                if queries[i] is None and re.fullmatch(r"\[[^\]\\^]+\]\+", r.pattern) and r.least and not r.any_case}
        for b in batches:
            data, offs = flat(b.column("text"))
            n_of = {r.kind: np.zeros(b.num_rows, np.int64) for r in rules[:n_base]}
            base_hash, spans_out, extra_out = [], [], np.zeros(b.num_rows, np.int64)
            for i0, i1 in slices(offs):
                sub, lo = data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0]
                postings = block.postings(sub, lo)
                wanted = [None if q is None else block.answer(q, postings) for q in queries]
                for i in range(i1 - i0):
                    raw = sub[lo[i]:lo[i + 1]].tobytes()
                    text, found = None, []
                    for k, rule in enumerate(rules):
                        if k in runs:
                            for m in runs[k].finditer(raw):
                                at = len(raw[:m.start()].decode())
                                found.append((at, k, at + m.end() - m.start()))
                        elif wanted[k] is None or i in wanted[k]:
                            text = raw.decode() if text is None else text
                            found += [(a, k, e) for a, e in _spans(rule, regexes[k], text)]
                    found.sort()
                    for _, k, _ in found:
                        if k < n_base:
                            n_of[rules[k].kind][i0 + i] += 1
                        else:
                            extra_out[i0 + i] += 1
                    base_hash.append(hashlib.sha256(",".join(f"{rules[k].kind}:{a}:{e}" for a, k, e in found if k < n_base).encode()).hexdigest())
                    spans_out.append(",".join(f"{rules[k].kind}:{a}:{e}" for a, k, e in found))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(v) for v in n_of.values()), pa.array(base_hash, pa.string()),
                 pa.array(spans_out, pa.string()), pa.array(extra_out)],
                names=["doc_id", *(f"n_{k}" for k in n_of), "base_sha256", "spans", "n_extra"])
    return scan


def find_secrets(docs: DataFrame, base: tuple[Rule, ...] = BASE, extra: tuple[Rule, ...] = EXTRA,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_<kind> of every base rule, base_sha256
    (digest of the base spans), spans (all spans as ``kind:start:end`` in code
    points, by start, then rule order) and n_extra.

    Null and empty texts hold nothing; repeated rows give repeated rows; other
    columns are not read; an empty table gives no rows.  Each row is judged
    alone inside its task: no shuffle, memory bounded by an Arrow batch.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = "".join(f"n_{r.kind} long, " for r in base)
    return slim.mapInArrow(_scanner(base + extra, len(base)), f"doc_id {id_type}, {counts}base_sha256 string, spans string, n_extra long")
