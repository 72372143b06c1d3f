import hashlib
import itertools
import random
import re

import pytest

from llm_cases import llm_spark  # noqa: F401
from marquee.llm import queries, repair

FORM = re.compile(r"(s?(ua)+)?")


def _faults(rows):
    """Rows in order with their first fault, by plain Python."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
    seen, out = set(), []
    for t, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append((t, role, text, "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


def _enumerated(rows):
    """The least (cost, audit, lines) over all edit sequences of a few rows with at most three insertions."""
    best = None
    for inserted in range(4):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), inserted):
            for roles in itertools.product("ua", repeat=inserted):
                for choice in itertools.product(("D", "K", "Ru", "Ra"), repeat=len(rows)):
                    if any(c != "D" and r[3] in ("blank", "duplicate") for c, r in zip(choice, rows)):
                        continue
                    cost, audit, line = 3 * inserted, "", []
                    for i in range(len(rows) + 1):
                        for p, x in zip(places, roles):
                            if p == i:
                                audit += "I"
                                line.append((x, repair.GIVEN[x], ""))
                        if i < len(rows):
                            t, role, text, fault = rows[i]
                            audit += choice[i][0]
                            cost += {"D": 4, "K": 0, "R": 3}[choice[i][0]] + (3 if fault == "truncated" and choice[i] != "D" else 0)
                            if choice[i] == "K":
                                line.append((role[:1], role, text))
                            elif choice[i] != "D":
                                line.append((choice[i][1], repair.GIVEN[choice[i][1]], text))
                    if FORM.fullmatch("".join(x[0] for x in line)) and all(len(x[0]) == 1 for x in line):
                        new = (cost, audit, "\n".join(f"{r}:{t}" for _, r, t in line))
                        best = min(best or new, new, key=lambda b: b[:2])
    return best


def _folded(rows):
    """The same over four states, one row at a time, for long conversations."""
    nxt = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    def put(d, s, v):
        if s not in d or v[:2] < d[s][:2]:
            d[s] = v
            return True

    def inserted(d):
        d, todo = dict(d), list(d)
        while todo:
            s = todo.pop()
            c, a, o = d[s]
            todo += [nxt[s, y] for y in "ua" if (s, y) in nxt and put(d, nxt[s, y], (c + 3, a + "I", (*o, repair.GIVEN[y] + ":")))]
        return d
    front = {0: (0, "", ())}
    for _, role, text, fault in rows:
        new = {}
        for s, (c, a, o) in inserted(front).items():
            put(new, s, (c + 4, a + "D", o))
            if fault not in ("blank", "duplicate"):
                c += 3 * (fault == "truncated")
                if (s, role[:1]) in nxt:
                    put(new, nxt[s, role[:1]], (c, a + "K", (*o, f"{role}:{text}")))
                for y in "ua":
                    if (s, y) in nxt:
                        put(new, nxt[s, y], (c + 3, a + "R", (*o, f"{repair.GIVEN[y]}:{text}")))
        front = new
    c, a, o = min((v for s, v in inserted(front).items() if s in (0, 3)), key=lambda v: v[:2])
    return c, a, "\n".join(o)


def _want(rows, solve):
    rows = _faults([(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows])
    faults = [r[3] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    cost, audit, text = solve(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def _run(spark, convs, **how):
    rows = [(c, t, r, x) for c, rows in convs.items() for t, r, x in rows]
    random.Random(7).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as fault", "1 as chunk", "2 as place", "3 as initial", "4 as said", "5 as uid", "6 as _pid")
    edits = repair.repair(df, **how)
    empty = hashlib.sha256(b"").hexdigest()
    sha = {r.conv_id: r.repaired_sha256 for r in repair.digests(edits).collect()}
    return {r.conv_id: (*tuple(r)[1:], sha.get(r.conv_id, empty)) for r in repair.report(edits).collect()}


def _some(rnd, n):
    role = lambda: rnd.choice(["user"] * 4 + ["assistant"] * 4 + ["system", "tool", None, ""])
    text = lambda: rnd.choice(["Yes.", "no", " ", "", None, "What? ", "ok!\n", "é", f"t{rnd.random()}.", f"u{rnd.random()}"])
    return [(rnd.choice([None, *range(n + 2)]), role(), text()) for _ in range(n)]


def test_every_edit_sequence_of_short_conversations(llm_spark):
    rnd = random.Random(2)
    convs = {i: _some(rnd, rnd.randint(1, 4)) for i in range(60)} | {None: _some(rnd, 3)}
    got = _run(llm_spark, convs)
    assert got == {c: _want(rows, _enumerated) for c, rows in convs.items()}
    assert got == {c: _want(rows, _folded) for c, rows in convs.items()}


@pytest.mark.parametrize("chunks", [3, 40])
def test_a_conversation_over_many_chunks(llm_spark, chunks):
    rnd = random.Random(chunks)
    long = [(t, "user" if (t + (t > 700)) % 2 else rnd.choice(["assistant", "assistant", "user"]), f"{rnd.randint(0, 300)} words" + rnd.choice(["", ".", "?"])) for t in range(1500)]
    convs = {i: _some(rnd, rnd.randint(1, 8)) for i in range(80)} | {40: long, 41: [(None, "user", "same.")] * 400, 42: [(0, "system", "x" * 200_000 + ".")]}
    assert _run(llm_spark, convs, chunks=chunks) == {c: _want(rows, _folded) for c, rows in convs.items()}


def test_empty_table(llm_spark):
    assert _run(llm_spark, {}) == {}


def test_damage_and_registered_query(llm_spark):
    import zlib
    rows = [(c, t, r, "Is it? Yes.") for c in range(40) for t, r in enumerate(("user", "assistant"))] + [(None, None, None, None)]
    got = {}
    for r in queries.damaged(llm_spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect():
        got.setdefault((r.conv_id, r.turn), []).append((r.role, r.text))
    seen = set()
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        seen.add(fate)
        role, text = role or " ", text or " "
        want = {0: [], 1: [(role, "")], 2: [(role, re.sub("[.!?]", "", text))], 3: [(role, text)] * 2, 4: [("user", text)]}.get(fate, [(role, text)])
        assert got.get((c, t), []) == want
    assert {0, 1, 2, 3, 4} <= seen


def test_stack_graph():
    g = repair.StackGraph()
    assert g.step(0, "a") == () and len(g.step(0, "u")) == 1
    u, = g.step(0, "u")
    s, = g.step(0, "s")
    assert g.step(s, "u") == (u,) and all(t in g.accepting and g.step(t, "u") == (u,) for t in g.step(u, "a"))
    assert 0 in g.accepting and s not in g.accepting and u not in g.accepting
    other = repair.StackGraph((("S", "L"), ("L", "a"), ("L", "La")))  # any number of a, one at least
    tops = {0: (0, None)}
    for x in "aua":
        tops = repair.advance(other, tops, x, None, repair.WEIGHTS)
    cost, link = repair.closed(other, tops, repair.WEIGHTS)
    assert (cost, repair._spelled(link, None)) == (3, "KRK")
