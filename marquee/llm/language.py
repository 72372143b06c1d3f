"""Operator 4: language identification by error-correcting output codes.

Every language has a codeword of +1/-1 bits; one linear classifier over
hashed byte n-grams predicts each bit.  Decoding adds each bit's logistic
loss against every codeword and chooses the least; a small lead over the
runner-up marks the document as ambiguous.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import lean
from marquee.llm.words import flat, mix, slices

BUCKETS = 1 << 13
SIZES = (1, 2, 3)
UNDETERMINED = "und"
#: Documents per language that training may take (a documented bound).
SAMPLE_PER_LANGUAGE = 400
#: A decoded probability below this marks the document as ambiguous.
AMBIGUOUS_BELOW = 0.5

_LOW = np.array([b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
_ASCII_LETTER = np.array([97 <= (b | 32) <= 122 for b in range(256)])


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """An n x bits matrix of +1/-1 rows far apart from one another.

    Up to six languages take the exhaustive code (every split of the
    languages); more take the best of several random dense codes.
    """
    if n <= 1:
        return np.ones((n, 1))
    if n <= 6:
        cols = [[1 if i == 0 or i in side else -1 for i in range(n)]
                for k in range(n - 1) for side in combinations(range(1, n), k)]
        return np.array(cols, float).T
    rng, best, far = np.random.default_rng(seed), None, -1
    bits = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        m = rng.choice([-1.0, 1.0], (n, bits))
        gram = m @ m.T - 2 * bits * np.eye(n)
        apart = (bits - gram.max()) / 2
        if apart > far and (np.abs(m.sum(0)) < n).all():
            best, far = m, apart
    return best


def _grams(data: np.ndarray, offsets: np.ndarray):
    """Hashed n-gram buckets and their rows' offsets: each byte position
    gives one bucket per size, so a row of b bytes has len(SIZES) * b.  Grams
    that reach beyond their own row's end are filled up with spaces."""
    low = _LOW[data].astype(np.uint32)
    n, out = len(low), np.empty((len(data), len(SIZES)), np.uint16)
    code = np.zeros(n, np.uint32)
    for k, size in enumerate(SIZES):
        shifted = np.full(n, 32, np.uint32)
        if size <= n:
            shifted[:n - size + 1] = low[size - 1:]
        for back in range(1, size):  # places whose gram ends beyond the row
            last = offsets[1:] - back
            shifted[last[last >= offsets[:-1]]] = 32
        code = code << np.uint32(8) | shifted
        out[:, k] = (((code + np.uint32(size << 24)) * np.uint32(0x9E3779B1)) >> np.uint32(19)).astype(np.uint16)
    return out


def _features(batches):
    """(lang, sparse n-gram shares) of training documents."""
    for b in batches:
        data, offs = flat(b.column("text"))
        idx, val = [], []
        for i in range(b.num_rows):
            g = _grams(data[offs[i]:offs[i + 1]], np.array([0, offs[i + 1] - offs[i]])).ravel()
            u, c = np.unique(g, return_counts=True)
            idx.append(u.astype("<u2").tobytes())
            val.append((c / max(1, len(g))).astype("<f4").tobytes())
        yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(idx, pa.binary()), pa.array(val, pa.binary())], names=["lang", "idx", "val"])


def in_training(id_col: str = "doc_id"):
    """Rows that may be learned from: crc32 of the id's text modulo 4 is not 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) != 2, F.lit(False))


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, rounds: int = 60) -> dict:
    """The classifiers, learned from at most ``per_language`` documents of
    each non-null ``lang`` (those with the smallest id hashes), whole texts.

    Returns languages, codewords, weights (buckets x bits) and bias; without
    any labelled row the languages are empty and nothing can be predicted.
    """
    rows = docs.select(F.col("doc_id"), F.col("text"), F.col("lang")).where(in_training() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    dice = (F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")) % 1_000_000 + 1_000_000) % 1_000_000
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return {"languages": [], "code": np.ones((0, 1)), "weights": np.zeros((BUCKETS, 1), np.float32), "bias": np.zeros(1, np.float32)}
    share = F.coalesce(*(F.when(F.col("lang") == r["lang"], F.lit(int(1_000_000 * min(1.0, 1.3 * per_language / r["count"] + 1e-5)))) for r in counts), F.lit(0))
    first = Window.partitionBy("lang").orderBy("dice", "doc_id")
    sample = (rows.withColumn("dice", dice).where(F.col("dice") <= share).withColumn("n", F.row_number().over(first))
              .where(F.col("n") <= per_language).select("lang", "text"))
    got = sample.mapInArrow(lean(_features), "lang string, idx binary, val binary").collect()
    languages = sorted({r["lang"] for r in got})
    code = codewords(len(languages))
    x = np.zeros((len(got), BUCKETS), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["idx"], "<u2")] = np.frombuffer(r["val"], "<f4")
    y = code[[languages.index(r["lang"]) for r in got]].astype(np.float32)
    scale = 1 / np.sqrt(x.mean(0) + 1e-6)
    x *= scale
    w, bias = np.zeros((BUCKETS, y.shape[1]), np.float32), np.zeros(y.shape[1], np.float32)
    rate = 4.0 / max(1e-6, float((x * x).sum(1).mean()))
    for _ in range(rounds):
        g = y / (1 + np.exp(np.clip(y * (x @ w + bias), -30, 30)))
        w += rate * (x.T @ g / len(x) * 4 - 1e-4 * w)
        bias += 0.5 * g.mean(0)
    return {"languages": languages, "code": code, "weights": (w * scale[:, None]).astype(np.float32), "bias": bias.astype(np.float32)}


def decode(margins: np.ndarray, code: np.ndarray):
    """(best, runner-up, probability of the best) per row by loss-weighted decoding."""
    loss = np.logaddexp(0, -margins[:, None, :] * code[None]).sum(2)
    p = np.exp(loss.min(1, keepdims=True) - loss)
    p /= p.sum(1, keepdims=True)
    order = np.argsort(-p, axis=1, kind="stable")
    best = order[:, 0]
    second = order[:, 1] if code.shape[0] > 1 else best
    return best, second, p[np.arange(len(p)), best]


def _predictor(model: dict, threshold: float):
    names, code, w, bias = model["languages"], model["code"], model["weights"], model["bias"]

    def predict(batches):
        for b in batches:
            data, offs = flat(b.column("row").field("text"))
            n = b.num_rows
            margins, letters = np.zeros((n, w.shape[1])), np.zeros(n, bool)
            for i0, i1 in slices(offs, 1 << 19):
                sub, lo = data[offs[i0]:offs[i1]], offs[i0:i1 + 1] - offs[i0]
                full = np.flatnonzero(np.diff(lo) > 0)
                if not len(full):
                    continue
                at = lo[full]
                letters[i0 + full] = np.logical_or.reduceat(_ASCII_LETTER[sub], at)
                for i in full[~letters[i0 + full]]:
                    letters[i0 + i] = any(map(str.isalpha, sub[lo[i]:lo[i + 1]].tobytes().decode()))
                g = _grams(sub, lo)
                sums = sum(np.add.reduceat(w[g[:, k]], at, axis=0, dtype=np.float64) for k in range(len(SIZES)))
                margins[i0 + full] = sums / (len(SIZES) * np.diff(lo)[full])[:, None] + bias
            if names:
                best, second, p = decode(margins, code)
                pred = [names[k] if ok else UNDETERMINED for k, ok in zip(best, letters, strict=True)]
                other = [names[k] if ok and len(names) > 1 else None for k, ok in zip(second, letters, strict=True)]
            else:
                pred, other, p, letters = [UNDETERMINED] * n, [None] * n, np.zeros(n), np.zeros(n, bool)
            score = np.where(letters, p, 0.0)
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(pred, pa.string()), pa.array(score), pa.array(other, pa.string()), pa.array(letters & (score < threshold))],
                names=["row", "lang_pred", "score", "runner_up", "ambiguous"])
    return predict


def annotate(docs: DataFrame, model: dict, threshold: float = AMBIGUOUS_BELOW) -> DataFrame:
    """row (a struct of all columns of ``docs``, whatever their names),
    lang_pred, score, runner_up, ambiguous."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(lean(_predictor(model, threshold)), f"row {kind}, lang_pred string, score double, runner_up string, ambiguous boolean")


def keep_identified(docs: DataFrame, model: dict | None = None, threshold: float = AMBIGUOUS_BELOW) -> DataFrame:
    """``docs`` without the rows rejected: ``und`` and ambiguous ones.
    Without any labelled row nothing can be told apart and all rows stay."""
    model = model or fit(docs)
    if not model["languages"]:
        return docs
    kept = annotate(docs, model, threshold).where((F.col("lang_pred") != UNDETERMINED) & ~F.col("ambiguous"))
    return kept.select("row.*")


def identify(docs: DataFrame, model: dict | None = None, threshold: float = AMBIGUOUS_BELOW) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, runner_up, ambiguous.

    Predictions use the whole text alone.  Null and empty texts and texts
    without a letter are ``und`` with score 0; a null id counts as held out
    from nothing (false) and is never learned from; a null lang is not learned from;
    repeated rows repeat; ties between languages go to the first by name; an
    empty table gives no rows.  The scan is map-only; the model (buckets x
    bits floats, a fixed size per language count) travels with the task.
    """
    model = model or fit(docs)
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    out = annotate(docs.select("doc_id", "text"), model, threshold)
    return out.select("row.doc_id", "lang_pred", "score", "runner_up", "ambiguous").select("doc_id", held.alias("held_out"), "lang_pred", "score", "runner_up", "ambiguous")
