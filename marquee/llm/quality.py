"""Operator 12: quality scores by positive-unlabelled learning.

Trusted positives are documents labelled 1; the unlabelled ones are documents
at large, whatever their label.  With the class prior pi the risk of a linear
scorer g under the logistic loss l is

    pi E_P[l(g)] + max(0, E_U[l(-g)] - pi E_P[l(-g)]),

the non-negative unbiased estimate of the supervised risk: no text is ever
taken for a negative.  Features describe the writing, not its language: pairs
of neighbouring character kinds (letters by case, digits, blanks, each ASCII
mark by itself), repeated and distinct words, word and text lengths.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.words import flat, mix, slices, word_hashes, word_spans

#: Documents that training may take: trusted positives, and unlabelled ones (documented bounds).
SAMPLE_POSITIVE, SAMPLE_UNLABELLED = 4000, 8000
#: Score from which a document counts as good.
GOOD_FROM = 0.3

_MARKS = [b for b in range(33, 127) if not chr(b).isalnum()]
KINDS = 6 + len(_MARKS)


def _kind_table() -> np.ndarray:
    """Kind of a byte: lower case or beyond ASCII, upper case, digit, blank, line end, control, then each mark."""
    kinds = np.full(256, 5, np.int64)
    kinds[97:123] = kinds[128:] = 0
    kinds[65:91], kinds[48:58], kinds[32], kinds[10] = 1, 2, 3, 4
    kinds[_MARKS] = 6 + np.arange(len(_MARKS))
    return kinds


_KIND = _kind_table()
_PAIRS = KINDS * KINDS
#: Pairs of kinds, then: words like the one before, distinct words, mean word length, words, lines' mean length, no words.
WIDTH = _PAIRS + 6


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(rows, WIDTH) of the texts that ``offs`` cuts out of ``data``."""
    n = len(offs) - 1
    size = np.diff(offs)
    out = np.zeros((n, WIDTH), np.float32)
    row = np.repeat(np.arange(n), size)
    kind = _KIND[data]
    if len(data) > 1:
        inside = row[1:] == row[:-1]
        pair = (kind[:-1] * KINDS + kind[1:])[inside]
        counts = np.bincount(row[:-1][inside] * _PAIRS + pair, minlength=n * _PAIRS).reshape(n, _PAIRS)
        out[:, :_PAIRS] = np.sqrt(counts / np.maximum(size - 1, 1)[:, None])
    low, starts, ends = word_spans(data, offs)
    owner = np.searchsorted(offs, starts, "right") - 1
    words = np.bincount(owner, minlength=n)
    some = np.maximum(words, 1)
    if len(starts):
        h = word_hashes(low, starts, ends)
        again = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        out[:, _PAIRS] = np.bincount(owner[1:][again], minlength=n) / some
        named = np.unique(mix(h + mix(owner.astype(np.uint64))), return_index=True)[1]
        out[:, _PAIRS + 1] = np.bincount(owner[named], minlength=n) / np.sqrt(some)
        out[:, _PAIRS + 2] = np.bincount(owner, ends - starts, n) / some / 8
    out[:, _PAIRS + 3] = np.log1p(words) / 8
    breaks = np.bincount(row[data == 10], minlength=n) if len(data) else np.zeros(n)
    out[:, _PAIRS + 4] = np.log1p(size / (breaks + 1)) / 8
    out[:, _PAIRS + 5] = words == 0
    return out


def _described(batches):
    for b in batches:
        data, offs = flat(b.column("text"))
        rows = []
        for i0, i1 in slices(offs):
            rows += [x.tobytes() for x in features(data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0])]
        yield pa.RecordBatch.from_arrays([b.column("part"), pa.array(rows, pa.binary())], names=["part", "x"])


def crc_of(column: str) -> Column:
    """CRC32 of a value as text; a null is the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def _some(rows: DataFrame, order: str, most: int) -> DataFrame:
    """About the ``most`` rows of least dice: a threshold on the dice bounds what is sorted."""
    n = rows.count()
    return rows.where(F.col("dice") <= int(1_000_000 * min(1.0, 1.3 * most / max(n, 1)) + 1)).orderBy("dice", order).limit(most)


def sample(docs: DataFrame, labels: DataFrame, positives: int = SAMPLE_POSITIVE, unlabelled: int = SAMPLE_UNLABELLED) -> tuple[DataFrame, float]:
    """((part, text) with part 1 for trusted positives and 0 for unlabelled
    documents, the class prior).

    The prior is estimated by the share of label 1 among the labelled ids
    (an id labelled both ways is no trusted positive), with one of each
    value added."""
    dice = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("quality")), F.lit(1_000_000))
    known = (labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    good, count = known.agg(F.coalesce(F.sum("quality"), F.lit(0)), F.count("*")).first()
    trusted = _some(known.where("quality = 1").select("doc_id", dice.alias("dice")), "doc_id", positives)
    # bounded by ``positives`` ids
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted.select("doc_id")), "doc_id").select(F.lit(1).alias("part"), "text")
    at_large = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", dice.alias("dice"))
    ids = _some(at_large.select("doc_id", "dice"), "doc_id", unlabelled).select("doc_id").distinct()
    rest = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select(F.lit(0).alias("part"), "text")
    return marked.unionByName(rest).limit(2 * (positives + unlabelled)), (good + 1) / (count + 2)


def risk_step(p_pos: np.ndarray, p_unl: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Derivatives of the non-negative risk by the scores of the positives and
    of the unlabelled documents, and its two parts.

    ``p`` are sigmoid(g).  Where the part of the negatives falls below zero
    the step goes up that part instead, which stops fitting the positives
    away from the unlabelled."""
    loss = lambda p: -np.log(np.clip(p, 1e-9, 1)).mean() if len(p) else 0.0
    positive = prior * loss(p_pos)
    negative = loss(1 - p_unl) - prior * loss(1 - p_pos)
    n, u = max(len(p_pos), 1), max(len(p_unl), 1)
    if negative < 0:
        return prior * p_pos / n, -p_unl / u, positive, negative
    # prior * (p - 1) - prior * p: the logistic loss makes it a constant pull
    return np.full(len(p_pos), -prior / n), p_unl / u, positive, negative


def fit(docs: DataFrame, labels: DataFrame, positives: int = SAMPLE_POSITIVE, unlabelled: int = SAMPLE_UNLABELLED,
        rounds: int = 600, decay: float = 1e-4) -> dict:
    """Weights, bias and scale.  Without a trusted positive or without
    unlabelled documents nothing is learned: every score is the prior."""
    drawn, prior = sample(docs, labels, positives, unlabelled)
    got = drawn.mapInArrow(_described, "part int, x binary").collect()
    part = np.array([r["part"] for r in got], int)
    flat_model = {"weights": np.zeros(WIDTH, np.float32), "bias": float(np.log(prior / (1 - prior))), "prior": prior}
    if not len(part) or part.min() == part.max():
        return flat_model
    x = np.frombuffer(b"".join(r["x"] for r in got), np.float32).reshape(len(got), WIDTH)
    kept = np.flatnonzero((x != 0).sum(0) >= 3)
    x = x[:, kept]
    scale = 1 / (x.std(0) + 0.02)
    centre = x.mean(0)
    x = np.clip((x - centre) * scale, -8, 8)
    xp, xu = x[part == 1], x[part == 0]
    w, b = np.zeros(len(kept)), np.array([flat_model["bias"]])
    moments = [np.zeros(len(kept)), np.zeros(len(kept)), np.zeros(1), np.zeros(1)]
    squash = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for t in range(1, rounds + 1):  # Adam
        w32 = w.astype(np.float32)
        dp, du, _, _ = risk_step(squash(xp @ w32 + b), squash(xu @ w32 + b), prior)
        steps = (xp.T @ dp.astype(np.float32) + xu.T @ du.astype(np.float32) + decay * w, np.array([dp.sum() + du.sum()]))
        for k, (g, v) in enumerate(zip(steps, (w, b), strict=True)):
            m, s = moments[2 * k], moments[2 * k + 1]
            m[:] = 0.9 * m + 0.1 * g
            s[:] = 0.99 * s + 0.01 * g * g
            v -= 0.01 * (m / (1 - 0.9 ** t)) / (np.sqrt(s / (1 - 0.99 ** t)) + 1e-9)
    weights, centres, scales = (np.zeros(WIDTH, np.float32) for _ in range(3))
    weights[kept], centres[kept], scales[kept] = w, centre, scale
    return {"weights": weights, "bias": float(b[0]), "prior": prior, "centre": centres, "scale": scales}


def _scorer(model: dict, good_from: float):
    def score(batches):
        for b in batches:
            data, offs = flat(b.column("text"))
            z = np.full(b.num_rows, model["bias"])
            if "scale" in model:
                for i0, i1 in slices(offs, 1 << 20):
                    x = features(data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0])
                    z[i0:i1] += np.clip((x - model["centre"]) * model["scale"], -8, 8) @ model["weights"]
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p), pa.array((p >= good_from).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])
    return score


def score_quality(docs: DataFrame, labels: DataFrame | None = None, model: dict | None = None, good_from: float = GOOD_FROM) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1), predicted.

    Learned, unless a ``model`` is given, from rows with crc32(doc_id as
    text) mod 5 not 0, the others are held out; a null id counts as the empty
    text (held out) and is never learned from.  Null and empty texts are texts
    without characters and are scored as such; very long texts are scored
    whole; repeated rows repeat; an empty table gives no rows; columns beside
    doc_id and text are not read.  Scoring is map-only with a fixed-size model.
    """
    held = crc_of("doc_id") % 5 == 0
    if model is None:
        model = fit(docs.where(~held), labels.where(~held))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held.alias("held_out"), "text").mapInArrow(_scorer(model, good_from), f"doc_id {id_type}, held_out boolean, score double, predicted int")
