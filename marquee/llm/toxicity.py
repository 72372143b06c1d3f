"""Operator 1: toxicity grades by cumulative-link ordinal regression.

P(grade > k) = sigmoid(w . x - theta_k) with one weight vector for all ordered
thresholds; x are log counts of hashed words and word beginnings.  The output
is the expected severity, the sum of P(grade > k) over the thresholds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import flat, slices, word_hashes, word_spans

SPACE = 1 << 18  # hashed feature space
PREFIXES = (4, 5, 6)
#: Labelled documents per class that training may take (a documented bound).
SAMPLE_PER_CLASS = 3000
FEATURES = 2048  # kept features at most
GRADES = 4
#: Expected severity from which a document counts as toxic.
TOXIC_FROM = 0.45


def _hits(data: np.ndarray, offs: np.ndarray):
    """(row, feature) of every word and word beginning."""
    low, starts, ends = word_spans(data, offs)
    if not len(starts):
        z = np.zeros(0, np.int64)
        return z, z
    row = np.searchsorted(offs, starts, "right") - 1
    whole, heads = word_hashes(low, starts, ends, PREFIXES)
    rows, feats = [row], [(whole & np.uint64(SPACE - 1)).astype(np.int64)]
    for size, h in zip(PREFIXES, heads, strict=True):
        ok = ends - starts > size
        rows.append(row[ok])
        feats.append((h[ok] & np.uint64(SPACE - 1)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(feats)


def _counts(row: np.ndarray, feat: np.ndarray):
    key, n = np.unique(row << 20 | feat, return_counts=True)
    return key >> 20, key & ((1 << 20) - 1), n


def _sparse(batches):
    for b in batches:
        data, offs = flat(b.column("text"))
        idx, val = [], []
        for i0, i1 in slices(offs):
            r, f, n = _counts(*_hits(data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0]))
            cut = np.searchsorted(r, np.arange(i1 - i0 + 1))
            for i in range(i1 - i0):
                idx.append(f[cut[i]:cut[i + 1]].astype("<i4").tobytes())
                val.append(np.minimum(n[cut[i]:cut[i + 1]], 65535).astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("toxic"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["toxic", "idx", "val"])


def sample_labelled(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """At most about ``per_class`` documents of each label value: the smallest id hashes."""
    dice = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("toxicity")), F.lit(1_000_000))
    rows = (labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
            .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).withColumn("dice", dice))
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    part = [rows.where((F.col("toxic") == k) & (F.col("dice") <= int(1_000_000 * min(1.0, 1.2 * per_class / c)))).orderBy("dice", "doc_id").limit(per_class)
            for k, c in sorted(n.items())]
    if not part:
        return docs.select(F.lit(0).alias("toxic"), "text").limit(0)
    ids = part[0] if len(part) == 1 else part[0].unionByName(part[1])
    # bounded by 2 * per_class rows of an id and a label
    return docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id", "toxic")), "doc_id").select("toxic", "text")


def grade_rows(y: np.ndarray, evidence: np.ndarray, grades: int) -> np.ndarray:
    """Ordered grades from a binary label: 0 for clean documents; toxic ones
    are cut into grades 1.. at equal shares of their evidence (occurrences of
    words that the labels single out)."""
    out = np.zeros(len(y), int)
    if y.any():
        cuts = np.quantile(evidence[y == 1], np.linspace(0, 1, grades)[1:-1])
        out[y == 1] = 1 + (evidence[y == 1][:, None] > cuts[None]).sum(1)
    return out


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, grades: int = GRADES, rounds: int = 400) -> dict:
    """Weights per hashed feature and ordered thresholds.

    Features are those that the sampled labels single out most (log-odds of
    document frequency, at most ``FEATURES``).  Without labels of both
    values nothing is learned and every severity is 0.
    """
    got = sample_labelled(docs, labels, per_class).mapInArrow(_sparse, "toxic int, idx binary, val binary").collect()
    y = np.array([r["toxic"] for r in got], int)
    none = {"weights": np.zeros(SPACE, np.float32), "thresholds": np.full(grades - 1, 30.0)}
    if not len(y) or y.min() == y.max():
        return none
    idx = [np.frombuffer(r["idx"], "<i4") for r in got]
    df = [np.zeros(SPACE), np.zeros(SPACE)]
    for k, i in zip(y, idx, strict=True):
        df[k][i] += 1
    n = [max(1, int((y == k).sum())) for k in (0, 1)]
    p1, p0 = (df[1] + 0.5) / (n[1] + 1), (df[0] + 0.5) / (n[0] + 1)
    odds = np.log(p1 / p0)
    gain = np.where((df[1] >= 3) & (odds > 1.5), df[1] / n[1] * odds, 0)
    kept = np.argsort(-gain, kind="stable")[:FEATURES]
    kept = kept[gain[kept] > 0]
    if not len(kept):
        return none
    column = np.full(SPACE, -1)
    column[kept] = np.arange(len(kept))
    x = np.zeros((len(y), len(kept)), np.float32)
    for i, r in enumerate(got):
        c = column[idx[i]]
        x[i, c[c >= 0]] = np.frombuffer(r["val"], "<u2")[c >= 0]
    strong = odds[kept] > 4
    grade = grade_rows(y, x[:, strong].sum(1) if strong.any() else x.sum(1), grades)
    x = np.log1p(x)
    w, theta = np.zeros(len(kept)), np.linspace(0.5, 2.5, grades - 1)
    above = (grade[:, None] > np.arange(grades - 1)[None]).astype(float)
    moments = [np.zeros(len(kept)), np.zeros(len(kept)), np.zeros(grades - 1), np.zeros(grades - 1)]
    for t in range(1, rounds + 1):  # Adam on the summed cumulative log-likelihoods
        p = 1 / (1 + np.exp(-np.clip((x @ w.astype(np.float32))[:, None] - theta, -30, 30)))
        miss = (p - above) / len(y)
        steps = (x.T @ miss.sum(1).astype(np.float32) + 1e-5 * w, -miss.sum(0))
        for k, (g, v) in enumerate(zip(steps, (w, theta), strict=True)):
            m, s = moments[2 * k], moments[2 * k + 1]
            m[:] = 0.9 * m + 0.1 * g
            s[:] = 0.99 * s + 0.01 * g * g
            v -= 0.05 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-9)
        theta.sort()
    weights = np.zeros(SPACE, np.float32)
    weights[kept] = w
    return {"weights": weights, "thresholds": theta}


def _scorer(model: dict, toxic_from: float):
    weights, theta = model["weights"], model["thresholds"]

    def score(batches):
        for b in batches:
            data, offs = flat(b.column("text"))
            z = np.zeros(b.num_rows)
            for i0, i1 in slices(offs):
                row, feat = _hits(data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0])
                heavy = weights[feat] != 0
                r, f, n = _counts(row[heavy], feat[heavy])
                z[i0:i1] = np.bincount(r, weights[f] * np.log1p(n), i1 - i0)
            p = 1 / (1 + np.exp(-np.clip(z[:, None] - theta, -30, 30)))
            expected = p.sum(1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(expected), pa.array((p > 0.5).sum(1).astype(np.int32)), pa.array(expected >= toxic_from)],
                                             names=["doc_id", "expected_severity", "grade", "toxic"])
    return score


def grade_toxicity(docs: DataFrame, labels: DataFrame | None = None, model: dict | None = None, toxic_from: float = TOXIC_FROM) -> DataFrame:
    """One row per input row: doc_id, expected_severity, grade (the number of
    thresholds passed), toxic.

    Null and empty texts have no features and get the severity of the bare
    thresholds; repeated rows repeat; null ids and labels are not learned
    from; an id labelled both ways counts as toxic; an empty table gives no
    rows; other columns are not read.  Scoring is map-only over whole texts;
    the model is a fixed-size array.
    """
    model = model or fit(docs, labels)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_scorer(model, toxic_from), f"doc_id {id_type}, expected_severity double, grade int, toxic boolean")
