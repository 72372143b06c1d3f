import hashlib
import random

import pytest

from llm_cases import SF0001, llm_spark  # noqa: F401
from marquee.llm import chat
from marquee.llm.queries import op10_chat
from marquee.plans.verify import plan_findings

MARKS = "</s>[INST] ok [/INST]"
TEXTS = [MARKS, "<|turn|>", "<|end|>\\", "\\<|text|>", "a<", "|b", "\\", "\\\\", "<\\|turn|>", "<<SYS>> x <</SYS>>", "", None, "line\nline", "<s>", "é \U0001f600 <", "[[INST]]", "plain"]


def _digest(s):
    return hashlib.sha256(s.encode()).hexdigest()


def _sums(turns):
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), _digest("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(loss), _digest(loss)


def _read(df):
    out = []
    for r in chat.read_back(df).collect():
        assert all(r.formatted[s.start:s.start + s.length] for s in r.loss_spans if s.length)
        turns = [(t.role, t.text) for t in r.turns]
        loss = "".join(r.loss_texts)
        out.append((r.tree_id, len(turns), _digest("".join(f"{a}\n{b}\n" for a, b in turns)), len(loss), _digest(loss)))
        assert not any(m in chunk for chunk in r.formatted.split(chat.TURN)[1:] for m in ("</s>", "[INST]", "[/INST]", "<<SYS>>", "<s>"))
    return sorted(out, key=str)


def test_round_trip_of_hostile_texts(llm_spark):
    rnd = random.Random(4)
    rows, want = [], []
    for c in [*range(40), None]:
        turns = [(rnd.choice(["user", "assistant", "system", None, "<|text|>"]), rnd.choice(TEXTS)) for _ in range(rnd.randint(1, 9))]
        order = list(range(len(turns)))
        rnd.shuffle(order)
        rows += [(c, i, *turns[i]) for i in order]
        want.append((c, *_sums(turns)))
    df = llm_spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as tree", "'y' as node", "2 as path", "3 as score")
    assert _read(chat.format_paths(chat.chain_nodes(df))) == sorted(want, key=str)


def test_repeated_and_null_turns(llm_spark):
    rows = [(1, None, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "z"), (2, 5, "assistant", None)]
    got = {r.tree_id: [(t.role, t.text) for t in r.turns] for r in chat.read_back(chat.format_paths(chat.chain_nodes(
        llm_spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))).collect()}
    assert got == {1: [("user", "b"), ("assistant", "z"), ("user", "a"), ("user", "a")], 2: [("assistant", "")]}


def _paths_brute(nodes, branches):
    """tree -> chosen paths as lists of nodes from the root."""
    out = {}
    for tree in {n[0] for n in nodes}:
        own = {n[1]: n for n in nodes if n[0] == tree}
        parents = {n[2] for n in own.values() if n[2] in own}
        found = []
        for leaf in (k for k in own if k not in parents):
            path, at = [], leaf
            while at is not None and at in own and len(path) <= len(own):
                path.append(at)
                at = own[at][2]
            if len(path) <= len(own):
                found.append((-sum(own[k][3] or 0 for k in path), f"k{leaf}", path[::-1]))
        out[tree] = [p for *_, p in sorted(found)[:branches]]
    return out


@pytest.mark.parametrize("branches", [1, 3])
def test_trees(llm_spark, branches):
    rnd = random.Random(branches)
    nodes = []
    for tree in range(12):
        n = rnd.randint(1, 40)
        nodes += [(tree, i, None if i == 0 or rnd.random() < 0.05 else rnd.randint(max(0, i - rnd.choice([1, 1, 5])), i - 1), rnd.choice([0.0, 1.0, 2.0, -1.0, None])) for i in range(n)]
    nodes += [(50, i, i - 1 if i else None, 0.5) for i in range(700)]  # a long chain: logarithmically many rounds
    nodes += [(51, 1, 2, 0.0), (51, 2, 1, 0.0), (51, 3, 2, 0.0), (51, 4, 99, 0.0), (51, 5, 4, 1.0)]  # a cycle, a lost parent
    df = llm_spark.createDataFrame([(*n, "user", f"t{n[1]}") for n in nodes], "tree_id long, node_id long, parent_id long, score double, role string, text string")
    got = {}
    for r in chat.read_back(chat.format_paths(df, branches)).collect():
        got.setdefault(r.tree_id, {})[r.branch] = [int(t.text[1:]) for t in r.turns]
    want = _paths_brute([n for n in nodes if n[0] != 51 or n[1] > 3], branches)
    assert {t: [v[k] for k in sorted(v)] for t, v in got.items()} == {t: v for t, v in want.items() if v}


def test_whole_table(llm_spark):
    rows = [tuple(r) for r in llm_spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", MARKS), (-7, 1, "assistant", MARKS)]
    by = {}
    for c, t, r, x in sorted(rows):
        by.setdefault(c, []).append((r, x))
    df = op10_chat(llm_spark, SF0001)
    got = df.collect()
    assert sorted((r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got) == sorted((c, *_sums(t)) for c, t in by.items())
    assert plan_findings(df) == [] and not any(w in df._jdf.queryExecution().toString() for w in ("Python", "Arrow", "Pandas"))


def test_empty(llm_spark):
    none = llm_spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_paths(chat.chain_nodes(none))).collect() == []
