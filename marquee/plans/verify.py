"""Compare a registered query with its DuckDB oracle (local checking tool).

Order-insensitive: both sides are normalised (columns sorted by name,
floats rounded, dates/timestamps as ISO text) and compared as sorted rows.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

# MARQUEE_STRICT=1 compares floats exactly as both engines returned them
STRICT = os.environ.get("MARQUEE_STRICT") == "1"

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
        "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck_connection(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')").fetchall()
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def check(spark, con, sf_dir: str, name: str, query, sql: str | None) -> dict:
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    res = {"key": name, "spark_rows": len(s_rows)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.cursor()
    d = cur.execute(sql)
    d_cols = [c[0] for c in d.description]
    d_rows = d.fetchall()
    res["oracle_rows"] = len(d_rows)
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    if sc != dc:
        res["status"] = "schema"
        res["detail"] = f"spark={sc} oracle={dc}"
    elif sr != dr:
        res["status"] = "values"
        diff_s = [r for r in sr if r not in set(dr)][:3]
        diff_d = [r for r in dr if r not in set(sr)][:3]
        res["detail"] = f"spark-only={diff_s} oracle-only={diff_d}"
    else:
        res["status"] = "ok"
    return res


# ------------------------------------------------------------ plan audit

_UNSCALABLE = {"CartesianProduct": "cartesian product", "BroadcastNestedLoopJoin": "nested-loop join",
               "BatchEvalPython": "row-at-a-time Python UDF"}


def _plan_nodes(node):
    """Every node of an executed physical plan, through adaptive plans,
    query stages, reused exchanges and cached relations."""
    stack = [node]
    while stack:
        n = stack.pop()
        yield n
        name = n.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(n.executedPlan())
        elif name.endswith("QueryStage"):
            stack.append(n.plan())
        elif name == "InMemoryTableScan":
            stack.append(n.relation().cachedPlan())
        kids = n.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))


_LIMITS = ("TakeOrderedAndProject", "GlobalLimit", "LocalLimit", "CollectLimit")
_PASS = ("Sort", "Project", "Exchange", "AQEShuffleRead", "InputAdapter", "WholeStageCodegen")


def _over_limit(n) -> bool:
    """True when ``n``'s input is a limit (a top-k), possibly behind sorts,
    projections, exchanges or query stages: a bounded number of rows."""
    while True:
        name = n.nodeName()
        if name.startswith(_LIMITS):
            return True
        if name.endswith("QueryStage"):
            n = n.plan()
        elif name.startswith(_PASS) and n.children().size() == 1:
            n = n.children().apply(0)
        else:
            return False


def _chain(n, depth: int = 14) -> str:
    names = []
    for _ in range(depth):
        names.append(n.nodeName())
        if n.nodeName().endswith("QueryStage"):
            n = n.plan()
        elif n.children().size() >= 1:
            n = n.children().apply(0)
        else:
            break
    return " > ".join(names)


def plan_findings(df) -> list[str]:
    """Operators that do not scale out, found in ``df``'s executed plan:
    cartesian products, nested-loop joins, row-at-a-time Python UDFs and
    windows without a partition key (one task for all rows) unless they
    rank the rows of a top-k."""
    out = []
    for n in _plan_nodes(df._jdf.queryExecution().executedPlan()):
        name = n.nodeName()
        if name in _UNSCALABLE:
            out.append(_UNSCALABLE[name])
        elif name == "Window" and n.partitionSpec().isEmpty() and not _over_limit(n.children().apply(0)):
            out.append(f"unpartitioned window over {_chain(n.children().apply(0))}")
    return out
