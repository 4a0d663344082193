"""Toxicity scores by a factorization machine over hashed terms.

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

A term is a word or the beginning of a longer word (so inflected forms share
evidence), hashed to ``2 ** DIM_BITS`` weights; x is 1 for each term present.  The factors
v learn pairs of terms that matter together, beyond what the linear weights add up.

Only the fit sees a bounded sample of labelled rows (``MAX_FIT``), as rows of hashed terms in
one task.  Scoring is a narrow pass over all whole texts with the fitted weights, whose
size is fixed by ``DIM_BITS`` and ``FACTORS``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LETTERS, mix64, packed, prefix_hash, span_hash, staged, text_chunks, word_spans

DIM_BITS = 20
PIECE = 1 << 20             # bytes of text scored at once: bounds the arrays of terms
FACTORS = 4
BEGINNINGS = (4, 5, 6)   # bytes
MAX_FIT = 10_000            # labelled rows that the fit sees, about
MIN_ROWS, PER_ROWS = 2, 1500   # a term in fewer than MIN_ROWS + rows / PER_ROWS fitted rows has weight 0
EPOCHS, BATCH, RATE, DAMPING, DECAY = 5, 128, 0.25, 1e-2, 2e-5
MIN_STEPS = 600             # a small fit goes round more often
CALIBRATION = 5             # every fifth fitted row only calibrates the probability
HELD_ROWS = 64              # of them scored at once
THRESHOLD = 0.3
SEED = 20


def terms(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(indices, counts)``: distinct hashed terms of each text, ascending."""
    starts, ends, n = word_spans(buf, offsets, LETTERS)
    prefix = prefix_hash(buf)
    doc = np.repeat(np.arange(len(n)), n)
    found = [(doc, span_hash(prefix, starts, ends))]
    for b in BEGINNINGS:
        long = ends - starts >= b
        found.append((doc[long], mix64(span_hash(prefix, starts[long], starts[long] + b) + np.uint64(b))))
    key = np.concatenate([(d.astype(np.uint64) << np.uint64(DIM_BITS)) | (h >> np.uint64(64 - DIM_BITS)) for d, h in found])
    key.sort()
    if len(key):
        key = key[np.concatenate(([True], key[1:] != key[:-1]))]
    counts = np.bincount((key >> np.uint64(DIM_BITS)).astype(np.int64), minlength=len(n))
    return (key & np.uint64((1 << DIM_BITS) - 1)).astype(np.int32), counts


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of rows, ``counts`` long each (0 for none)."""
    total = np.zeros((len(values) + 1, *values.shape[1:]))
    np.cumsum(values, axis=0, out=total[1:])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def raw_score(bias: float, w: np.ndarray, v: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    vi = v[ids].astype(np.float64)
    s = _sums(vi, counts)
    return bias + _sums(w[ids].astype(np.float64), counts) + 0.5 * (s * s - _sums(vi * vi, counts)).sum(axis=1)


def calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic through raw scores, with smoothed targets, by Newton steps."""
    z = np.clip(z, -6, 6)       # a few far-off rows must not flatten the slope
    ones = y.sum()
    t = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        r, h = t - p, np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, [(r * z).sum(), r.sum()])
        a, b = max(a + np.clip(step[0], -1, 1), 1e-2), b + np.clip(step[1], -2, 2)
    return a, b


def fit(labels: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """``(bias, w, v)`` by Adagrad over seeded mini-batches, then calibrated on
    rows left out; the values x are folded into ``w`` and ``v``.  Without both
    classes the bias alone states the share of ones."""
    n = len(labels)
    w, v = np.zeros(1 << DIM_BITS, np.float32), np.zeros((1 << DIM_BITS, FACTORS), np.float32)
    share = min(max(labels.mean() if n else 0.0, 1e-4), 1 - 1e-4)
    bias = float(np.log(share / (1 - share)))
    rows_of = np.bincount(ids, minlength=1 << DIM_BITS)
    used = np.flatnonzero(rows_of >= MIN_ROWS + n // PER_ROWS)
    if n == 0 or labels.min() == labels.max() or len(used) == 0:
        return bias, w, v
    scale = (np.log(n / rows_of[used]) / np.log(n)) ** 2
    small = np.full(1 << DIM_BITS, -1, np.int32)
    small[used] = np.arange(len(used))
    at = small[ids]
    lo = np.concatenate(([0], np.cumsum(at >= 0)))[np.concatenate(([0], np.cumsum(counts)))]
    at = at[at >= 0]
    rng = np.random.default_rng(SEED)
    a = np.zeros(len(used))
    f = rng.normal(0, 0.01, (len(used), FACTORS))
    ga, gf, gb = np.full(len(used), DAMPING), np.full((len(used), FACTORS), DAMPING), DAMPING
    learn = np.flatnonzero(np.arange(n) % CALIBRATION != 0)
    for _ in range(max(EPOCHS, -(-MIN_STEPS * BATCH // n))):
        order = rng.permutation(learn)
        for i in range(0, len(order), BATCH):
            rows = order[i:i + BATCH]
            size = lo[rows + 1] - lo[rows]
            pick = at[np.repeat(lo[rows] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            x = scale[pick]
            fx = f[pick] * x[:, None]
            s = _sums(fx, size)
            z = bias + _sums(a[pick] * x, size) + 0.5 * (s * s - _sums(fx * fx, size)).sum(axis=1)
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) / len(rows)
            each = np.repeat(err, size) * x
            term, back = np.unique(pick, return_inverse=True)
            g = np.bincount(back, each) + DECAY * a[term]
            ga[term] += g * g
            a[term] -= RATE * g / np.sqrt(ga[term])
            turn = np.repeat(s, size, axis=0) - fx
            for j in range(FACTORS):
                g = np.bincount(back, each * turn[:, j]) + DECAY * f[term, j]
                gf[term, j] += g * g
                f[term, j] -= RATE * 0.3 * g / np.sqrt(gf[term, j])
            gb += err.sum() ** 2
            bias -= RATE * err.sum() / np.sqrt(gb)
    w[used], v[used] = a * scale, f * scale[:, None]
    held = np.flatnonzero(np.arange(n) % CALIBRATION == 0)
    if labels[held].min() != labels[held].max():
        ends = np.cumsum(counts)
        # the rows left out and no others, a few at a time: the terms of all rows times FACTORS are much memory
        z = np.concatenate([raw_score(bias, w, v, np.concatenate([ids[ends[i] - counts[i]:ends[i]] for i in part]), counts[part])
                            for part in np.array_split(held, -(-len(held) // HELD_ROWS))])
        slope, shift = calibrate(z, labels[held])
        bias, w, v = slope * bias + shift, w * np.float32(slope), v * np.float32(np.sqrt(slope))
    return float(bias), w, v


def crc_of(c: Column) -> Column:
    return F.crc32(c.cast("string").cast("binary"))


def learned(docs: DataFrame, labels: DataFrame, learn: Column | None = None, id_col: str = "doc_id",
            text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic",
            max_fit: int = MAX_FIT):
    """Broadcast weights, fitted on about ``max_fit`` labelled rows at most.

    ``learn`` says, on the labels' table, which rows may be learnt from (default all).  Null labels
    and null identifiers teach nothing; an identifier with several labels counts as toxic if
    one says so.  With an empty labels table every score is near 0.
    """
    known = labels if learn is None else labels.where(learn)
    known = staged(known.select(F.col(label_id).alias("_l"), F.col(label_col).alias("_y"))
                   .where(F.col("_l").isNotNull() & F.col("_y").isNotNull())
                   .groupBy("_l").agg(F.max("_y").cast("int").alias("_y")), "labels")
    n = known.count()
    scale = 1 << 20
    if n > max_fit:         # a fixed share of the identifiers, drawn by their hash
        known = known.where(F.pmod(F.xxhash64("_l"), F.lit(scale)) < int(scale * max_fit / n))
    # at most about max_fit small rows are broadcast
    taught = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(known), F.col("_id") == F.col("_l")).select("_id", "_y", "_text")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, buf, offsets in text_chunks(b.column(2)):
                ids, counts = terms(buf, offsets)
                part = b.slice(rows.start, rows.stop - rows.start)
                yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.string()), part.column(1), packed(ids, counts)],
                                                 ["_id", "_y", "_ids"])

    def trained(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_id", kind="stable")
        cells = [np.frombuffer(x, np.int32) for x in pdf["_ids"]]
        bias, w, v = fit(pdf["_y"].to_numpy(np.float64), np.concatenate(cells), np.array([len(c) for c in cells]))
        used = np.flatnonzero(w)
        return pd.DataFrame({"bias": [bias], "ids": [used.astype(np.int32).tobytes()],
                             "w": [w[used].tobytes()], "v": [v[used].tobytes()]})

    sample = taught.mapInArrow(featured, "_id string, _y int, _ids binary")
    model = sample.groupBy(F.lit(1).alias("one")).applyInPandas(
        trained, "bias double, ids binary, w binary, v binary").collect()
    bias, w, v = fit(np.zeros(0), np.zeros(0, np.int32), np.zeros(0, np.int64))
    if model:
        ids = np.frombuffer(model[0].ids, np.int32)
        bias = model[0].bias
        w[ids] = np.frombuffer(model[0].w, np.float32)
        v[ids] = np.frombuffer(model[0].v, np.float32).reshape(-1, FACTORS)
    return docs.sparkSession.sparkContext.broadcast((bias, w, v))


def _score_of(weights, texts: pa.Array) -> np.ndarray:
    out = [raw_score(*weights.value, *terms(buf, offsets)) for _, buf, offsets in text_chunks(texts, PIECE)]
    z = np.concatenate(out) if out else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def toxicity(docs: DataFrame, weights, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``score``, ``predicted``.  Null or empty texts get the
    score of the bias; repeated rows are scored alike."""
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(_score_of(weights, b.column(1)))], ["_id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        scored, f"_id {kind}, score double")
    return out.select(F.col("_id").alias(id_col), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, weights, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without the rows that are predicted toxic: a narrow pass."""
    place = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 1024):
                part = b.slice(lo, 1024)
                yield part.filter(pa.array(_score_of(weights, part.column(place)) < THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)
