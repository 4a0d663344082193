"""Hidden Markov language model, trained by Baum-Welch over all training documents.

Words fall into ``CLASSES`` hash classes.  A state emits a class, or an unknown word; a class emits
its known words by their training counts:

    P(word | state) = P(class | state) * (c + 1) / sum of (c + 1) over the class
    P(unknown | state): the share of words seen once (Good-Turing), per state

so what is broadcast (``STATES`` x ``CLASSES`` numbers) is of fixed size, while the
word counts, which grow with the corpus, stay distributed.

Texts are read once and kept as pages: about ``PAGE_BYTES`` of whole documents with a
page dictionary.  Only (page, word) pairs are shuffled to be counted and to carry the
counts back, so a word that is in every text costs one row per page.  Expectation
steps run over the pages' class sequences in segments of ``SEGMENT`` words and are summed slice by
slice; scoring runs the scaled forward recursion over each whole document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, mix64, packed, prefix_hash, span_hash, staged, text_chunks, word_spans

STATES = 8
CLASSES = 1 << 15           # the last one holds the end of a text alone
PAGE_BYTES = 8 << 20
SEGMENT, SIDE = 128, 1024   # words of a training segment, segments handled at once
ROUNDS = 5
PRIOR = 50.0                # pseudo-words of the corpus distribution in each state
SEED = 7
ONCE, UNKNOWN = 1 << 15, 0xFFFF     # marks in a class sequence
END_HASH = mix64(np.array([0xE0D], np.uint64))
SLICE = 1 << 13


def _pages():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, sizes, hashes, size, page = [], [], [], [], 0, 0

        def full() -> pa.RecordBatch:
            nonlocal ids, held, sizes, hashes, size, page
            h = np.concatenate(hashes)
            words, codes = np.unique(h, return_inverse=True)
            n = np.concatenate(sizes)
            out_ids = pa.concat_arrays(ids)
            flags = np.concatenate(held)
            tf = np.bincount(codes[np.repeat(~flags, n)], minlength=len(words)).astype(np.uint32)
            one = np.array([0, len(out_ids)], np.int32)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([page], pa.int64()), pa.ListArray.from_arrays(pa.array(one), out_ids),
                 pa.ListArray.from_arrays(pa.array(one), pa.array(flags)),
                 pa.ListArray.from_arrays(pa.array(one), pa.array(n, pa.int64())),
                 pa.array([codes.astype(np.uint32).tobytes()], pa.binary()),
                 pa.array([words.tobytes()], pa.binary()), pa.array([tf.tobytes()], pa.binary())],
                ["page", "ids", "held", "n", "codes", "words", "tf"])
            ids, held, sizes, hashes, size, page = [], [], [], [], 0, page + 1
            return batch

        for b in batches:
            for rows, buf, offsets in text_chunks(b.column(2)):
                starts, ends, n = word_spans(buf, offsets, NOT_SPACE)
                h = span_hash(prefix_hash(buf), starts, ends)
                at = np.cumsum(n)               # an end after each text's words
                hashes.append(np.insert(h, at, END_HASH[0]))
                sizes.append(n + 1)
                ids.append(b.column(0).slice(rows.start, rows.stop - rows.start))
                held.append(b.column(1).slice(rows.start, rows.stop - rows.start).to_numpy(zero_copy_only=False))
                size += len(buf)
                if size >= PAGE_BYTES:
                    yield full()
        if ids:
            yield full()
    return run


def _dictionary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(len(b)):
            words = np.frombuffer(b.column(1)[i].as_buffer(), np.int64)
            tf = np.frombuffer(b.column(2)[i].as_buffer(), np.uint32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(words), b.column(0)[i].as_py())), pa.array(np.arange(len(words), dtype=np.int32)),
                 pa.array(words), pa.array(tf.astype(np.int32))], ["page", "at", "word", "tf"])


def class_of(words: np.ndarray) -> np.ndarray:
    w = words.astype(np.uint64)
    return np.where(w == END_HASH[0], CLASSES - 1, (mix64(w) % np.uint64(CLASSES - 1)).astype(np.int64))


class Model:
    """Start, transition and emission (class, state) probabilities; the last emission row is the unknown word."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def first(cls, mass: np.ndarray, unknown: float) -> Model:
        rng = np.random.default_rng(SEED)
        emit = (mass / mass.sum())[:, None] * rng.uniform(0.3, 1.7, (CLASSES, STATES))
        emit = np.vstack([(1 - unknown) * emit / emit.sum(axis=0), np.full(STATES, unknown)])
        move = np.full((STATES, STATES), 0.1 / STATES) + 0.9 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit)

    @classmethod
    def of(cls, start: np.ndarray, move: np.ndarray, count: np.ndarray, once: np.ndarray, mass: np.ndarray) -> Model:
        """Maximisation step from expected counts."""
        p = mass / mass.sum()
        total = count.sum(axis=0)
        unknown = np.clip((once + PRIOR * once.sum() / max(total.sum(), 1)) / (total + PRIOR), 1e-9, 0.5)
        emit = (count + PRIOR * p[:, None]) / (total + PRIOR)
        move = move + 1.0 / STATES
        return cls((start + 1) / (start + 1).sum(), move / move.sum(axis=1, keepdims=True),
                   np.vstack([(1 - unknown) * emit, unknown]))


def expected(model: Model, seq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expected counts (start, move, emit, once) over ``seq`` (segments x words, padded with -1)."""
    s, length = seq.shape
    valid = seq >= 0
    cls = np.where(valid, seq & (CLASSES - 1), 0)
    # single precision: each step is rescaled, and sums over steps are in double.  Word-major, so that a
    # step is one block of memory.
    cls, valid, seq = cls.T, valid.T, seq.T
    e = model.emit.astype(np.float32)[cls]
    e[~valid] = 1
    step = model.move.astype(np.float32)
    full = valid.all(axis=1)
    alpha, scale = np.empty((length, s, STATES), np.float32), np.empty((length, s, 1), np.float32)
    a = model.start.astype(np.float32) * e[0]
    for t in range(length):
        if t:
            moved = (a @ step) * e[t]
            a = moved if full[t] else np.where(valid[t][:, None], moved, a)
        scale[t] = a.sum(axis=1, keepdims=True)
        a = np.divide(a, scale[t], out=alpha[t])
    beta = np.ones((s, STATES), np.float32)
    move = np.zeros((STATES, STATES))
    for t in range(length - 1, -1, -1):
        back = beta
        if t:
            out = e[t] * beta / scale[t]
            if not full[t]:
                out[~valid[t]] = 0
            move += alpha[t - 1].T @ out
            back = out @ step.T
            if not full[t]:
                back = np.where(valid[t][:, None], back, beta)
        alpha[t] *= beta
        beta = back
    move *= model.move
    alpha /= alpha.sum(axis=2, keepdims=True)
    start = alpha[0].sum(axis=0, dtype=np.float64)
    g, flat = alpha[valid], cls[valid]
    count = np.stack([np.bincount(flat, g[:, k], minlength=CLASSES) for k in range(STATES)], axis=1)
    once = g[(seq[valid] & ONCE) > 0].sum(axis=0, dtype=np.float64)
    return start, move, count, once


def segments(seq: np.ndarray, n: np.ndarray) -> Iterator[np.ndarray]:
    """Texts cut into rows of ``SEGMENT`` words, padded with -1, ``SIDE`` rows at a time."""
    per = -(-n // SEGMENT)
    lo = np.repeat(np.cumsum(n) - n, per) + SEGMENT * (np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per))
    hi = np.minimum(lo + SEGMENT, np.repeat(np.cumsum(n), per))
    for i in range(0, len(lo), SIDE):
        at = lo[i:i + SIDE, None] + np.arange(SEGMENT)
        ok = at < hi[i:i + SIDE, None]
        yield np.where(ok, seq[np.minimum(at, len(seq) - 1)].astype(np.int64), -1)


def log10_forward(model: Model, seq: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Exact log10 probability of each class sequence, all texts a step at a time."""
    first = np.cumsum(n) - n
    row = np.where(seq == UNKNOWN, CLASSES, seq & (CLASSES - 1))
    order = np.argsort(-n, kind="stable")
    live = np.searchsorted(-n[order], -np.arange(1, n.max() + 1), side="right") if len(n) else []
    total, a = np.zeros(len(n)), None
    for t, m in enumerate(live):
        e = model.emit[row[first[order[:m]] + t]]
        a = model.start * e if t == 0 else (a[:m] @ model.move) * e
        c = a.sum(axis=1)
        total[:m] += np.log10(c)
        a = a / c[:, None]
    out = np.empty(len(n))
    out[order] = total
    return out


def language_scores(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text",
                    rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 probabilities of the text with its end).

    Rows where ``held`` is true teach nothing (null counts as false).  Words are lower-cased in
    A-Z; a null text is empty and has only its end.  Repeated rows teach and are scored each.
    Without any training row every word is unknown.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(held, F.lit(False)).alias("_held"), F.col(text_col).alias("_text"))
    pages = staged(
        rows.mapInArrow(_pages(), f"page long, ids array<{kind}>, held array<boolean>, n array<bigint>, "
                                  "codes binary, words binary, tf binary")
        .withColumn("page", F.col("page") + F.spark_partition_id().cast("long") * (1 << 32)), "pages")
    words = pages.select("page", "words", "tf").mapInArrow(_dictionary, "page long, at int, word long, tf int")
    @F.pandas_udf("int")
    def word_class(w: pd.Series) -> pd.Series:
        return pd.Series(class_of(w.to_numpy(np.int64).view(np.uint64)).astype(np.int32))

    counts = staged(words.groupBy("word").agg(F.sum("tf").alias("c")).withColumn("k", word_class("word")), "word-counts")
    known = counts.where("c > 0")
    total, vocab, single = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*"),
                                     F.coalesce(F.sum((F.col("c") == 1).cast("int")), F.lit(0))).first()

    mass = np.zeros(CLASSES)
    for r in known.groupBy("k").agg(F.sum(F.col("c") + 1).alias("m")).collect():
        mass[r.k] = r.m             # one number per class
    if not mass.any():
        mass[CLASSES - 1] = 1.0
    masses = spark.sparkContext.broadcast(mass)

    def placed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for p in left.itertuples(index=False):
            c, k = np.zeros(len(right), np.int64), np.zeros(len(right), np.int64)
            c[right["at"].to_numpy()] = right["c"].to_numpy()
            k[right["at"].to_numpy()] = right["k"].to_numpy()
            inner = np.where(c > 0, np.log10((c + 1) / np.maximum(masses.value[k], 1)), 0.0)
            base = np.log10((c + 1) / (total + vocab + 1))
            mark = np.where(c == 0, UNKNOWN, np.where(c == 1, k | ONCE, k)).astype(np.uint16)
            codes, n = np.frombuffer(p.codes, np.uint32), np.asarray(p.n, np.int64)
            at = np.cumsum(n) - n
            out.append({"ids": p.ids, "held": p.held, "n": n, "known": np.add.reduceat((c > 0)[codes].astype(np.int64), at),
                        "base": np.add.reduceat(base[codes], at), "inner": np.add.reduceat(inner[codes], at),
                        "seq": mark[codes].tobytes()})
        return pd.DataFrame(out, columns=["ids", "held", "n", "known", "base", "inner", "seq"])

    back = words.select("page", "at", "word").join(counts, "word").select("page", "at", "c", "k")
    ready = staged(
        pages.select("page", "ids", "held", "n", "codes").groupBy("page").cogroup(back.groupBy("page"))
        .applyInPandas(placed, f"ids array<{kind}>, held array<boolean>, n array<bigint>, known array<bigint>, "
                               "base array<double>, inner array<double>, seq binary"), "sequences")

    model = Model.first(mass, min(max(single / max(total, 1), 1e-9), 0.5))
    for _ in range(rounds if total else 0):
        model = _round(ready, model, mass)
    final = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                n = np.asarray(b.column(2)[i].values)
                seq = np.frombuffer(b.column(6)[i].as_buffer(), np.uint16).astype(np.int64)
                score = log10_forward(final.value, seq, n) + np.asarray(b.column(5)[i].values)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[i].values, b.column(1)[i].values, pa.array(n), b.column(3)[i].values,
                     b.column(4)[i].values, pa.array(score)],
                    ["_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    out = ready.mapInArrow(scored, f"_id {kind}, held_out boolean, n_tokens long, n_known long, "
                                   "base_score double, score double")
    return out.select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(int(total)).cast("long").alias("train_tokens"), "base_score", "score")


def _round(ready: DataFrame, model: Model, mass: np.ndarray) -> Model:
    """One Baum-Welch round over all training pages."""
    shared = ready.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, move = np.zeros(STATES), np.zeros((STATES, STATES))
        count, once = np.zeros((CLASSES, STATES)), np.zeros(STATES)
        for b in batches:
            for i in range(len(b)):
                n = np.asarray(b.column(1)[i].values)
                held = b.column(0)[i].values.to_numpy(zero_copy_only=False)
                seq = np.frombuffer(b.column(2)[i].as_buffer(), np.uint16)[np.repeat(~held, n)]
                for part in segments(seq, n[~held]):
                    s, m, c, o = expected(shared.value, part)
                    start += s
                    move += m
                    count += c
                    once += o
        small = np.concatenate([start, move.ravel(), once])
        yield pa.RecordBatch.from_pydict({"part": pa.array([-1], pa.int32()), "v": pa.array([small.tobytes()], pa.binary())})
        for lo in range(0, CLASSES, SLICE):
            yield pa.RecordBatch.from_pydict({"part": pa.array([lo], pa.int32()),
                                              "v": pa.array([count[lo:lo + SLICE].astype(np.float32).tobytes()], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        part = key[0].as_py()
        kind = np.float64 if part < 0 else np.float32
        total = sum(np.frombuffer(x.as_buffer(), kind).astype(np.float64) for x in t.column("v").combine_chunks())
        return pa.table({"part": pa.array([part], pa.int32()), "v": pa.array([total.astype(kind).tobytes()], pa.binary())})

    got = (ready.select("held", "n", "seq").mapInArrow(run, "part int, v binary")
           .withColumn("half", F.pmod(F.spark_partition_id(), F.lit(32)))
           .groupBy("part", "half").applyInArrow(add, "part int, v binary")
           .groupBy("part").applyInArrow(add, "part int, v binary").collect())   # fixed size
    count = np.zeros((CLASSES, STATES))
    for r in got:
        if r.part < 0:
            small = np.frombuffer(r.v, np.float64)
        else:
            count[r.part:r.part + SLICE] = np.frombuffer(r.v, np.float32).reshape(-1, STATES)
    return Model.of(small[:STATES], small[STATES:STATES + STATES ** 2].reshape(STATES, STATES), count,
                    small[STATES + STATES ** 2:], mass)
