"""Alignment of two tokenizers over the same bytes, and counts of the identifier pairs it links.

Both tokenizers cut a text's bytes into ranges.  Places where both have an end cut the tokens into groups, and
an A and a B token whose ranges overlap are linked.  Each range between two neighbouring ends (of either
tokenizer) belongs to one such pair and each pair to one such range, so links are read off the merged
ends.  No token of either crosses a chunk (``word_chunks``), so a distinct chunk is aligned once per task.

Counting a pair is counting documents that hold it linked:

1. every task gathers the distinct pairs of its documents with their document counts, cut into
   ``SHARDS`` shards by A identifier;
2. a shard's keys of all tasks are united in a tree of fan-in ``FAN`` (as deep as there are tasks) and get a
   minimal perfect hash;
3. the tasks' counts become dense vectors indexed by that hash, every key verified, and the vectors of a
   shard are summed in a tree of the same kind;
4. a second pass aligns the documents again and looks up their links, every key verified.

The pairs that can occur are a property of the two vocabularies (both tokens must agree on the bytes they
share), not of the corpus.  Their table is sent to the tasks in parts of whole shards of up to ``PART_PAIRS`` pairs
each (an A identifier has no more pairs than B has identifiers); a task holds one part at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, staged
from .perfect_hash import Slots, build, in_slot_order
from .word_chunks import ByteLevel, Pieces, Remembered, give_back, loaded, runs, segments, sums_by_text

SHARDS = 128
FAN = 16                 # arrays of a shard that one task holds
PART_PAIRS = 1 << 21     # pairs of the table a task holds at once
MERGE_AT = 1 << 20       # gathered pairs a task merges

U64, I64 = np.dtype("<u8"), np.dtype("<i8")


def shard_of(pairs: np.ndarray) -> np.ndarray:
    return (mix64(pairs >> np.uint64(32)) % np.uint64(SHARDS)).astype(np.int64)


# --- chunks -------------------------------------------------------------------

N_A, N_B, N_GROUPS, N_LINKS, OK = range(5)


class Aligner:
    """Chunks to their alignments: as ``make`` of ``Remembered``, with the linked pairs as values, the numbers
    of tokens, groups and links and whether the tokens' bytes are the chunk's as row, the groups as text."""

    def __init__(self, path_a: str, path_b: str, texts: bool):
        self.texts = texts         # whether the groups are written out
        self.a, self.b = loaded(ByteLevel, path_a, True), loaded(Pieces, path_b)
        self.how = {"cut": self.a.cuts and self.b.cuts, "fine": True, "joined": self.b.joined}
        self.bytes_a, self.bytes_b = _Bytes(self.a.token_bytes), _Bytes(self.b.token_bytes)
        self.names = list(map(str, range(max(len(self.a.token_bytes), len(self.b.token_bytes)))))

    def __call__(self, chunks: list[bytes]):
        (n_a, a), (n_b, b) = self.a.encode(chunks), self.b.encode(chunks)
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        text = np.frombuffer(b"".join(chunks), np.uint8)
        ok = self.bytes_a.same(n_a, a, size, text) & self.bytes_b.same(n_b, b, size, text)
        a, b = a[np.repeat(ok, n_a)], b[np.repeat(ok, n_b)]
        n_a, n_b, size = n_a * ok, n_b * ok, size * ok
        # all chunks on one line of bytes: both tokenizers end at every chunk's end
        ends_a, ends_b, borders = np.cumsum(self.bytes_a.lens[a]), np.cumsum(self.bytes_b.lens[b]), np.cumsum(size)
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        again = np.concatenate([ends[1:] == ends[:-1], [False]])[:len(ends)]
        both, ends = ends[again], ends[~again]
        pairs = (a[np.searchsorted(ends_a, ends)].astype(np.uint64) << np.uint64(32)
                 | b[np.searchsorted(ends_b, ends)].astype(np.uint64))
        n_links = np.diff(np.searchsorted(ends, borders, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(both, borders, "right"), prepend=0)
        fixed = np.stack([n_a, n_b, n_groups, n_links, ok.astype(np.int64)], axis=1)
        return n_links, pairs, fixed, self._groups(a, b, np.searchsorted(ends_a, both, "right"),
                                                   np.searchsorted(ends_b, both, "right"), n_groups)

    def _groups(self, a, b, to_a, to_b, n_groups) -> list[bytes]:
        if not self.texts:
            return []
        sa, sb = [self.names[i] for i in a.tolist()], [self.names[i] for i in b.tolist()]
        texts, i, j = [], 0, 0
        for k, m in zip(to_a.tolist(), to_b.tolist()):
            texts.append((sa[i] if k - i == 1 else ",".join(sa[i:k])) + "|" + (sb[j] if m - j == 1 else ",".join(sb[j:m])))
            i, j = k, m
        ends = np.cumsum(n_groups)
        return [";".join(texts[lo:hi]).encode() for lo, hi in zip((ends - n_groups).tolist(), ends.tolist())]


class _Bytes:
    """The bytes of a vocabulary's tokens."""

    def __init__(self, tokens: list[bytes]):
        self.lens = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def same(self, n: np.ndarray, ids: np.ndarray, size: np.ndarray, text: np.ndarray) -> np.ndarray:
        """Which chunks, of ``n`` tokens and ``size`` bytes of ``text`` each, their tokens' bytes make up."""
        ok = sums_by_text(self.lens[ids], n) == size
        fits = ids[np.repeat(ok, n)]
        got = self.flat[runs(self.starts[fits], self.lens[fits])]
        wrong = got != text[np.repeat(ok, size)]
        ok[ok] = sums_by_text(wrong, size[ok]) == 0
        return ok


# --- first pass: distinct pairs and their document counts --------------------

class Gathered:
    """Pairs and counts, merged whenever many have come."""

    def __init__(self):
        self.keys, self.counts, self.size = [], [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.size += len(keys)
        if self.size > MERGE_AT and len(self.keys) > 1:
            k, c = self.merged()
            # the next merge only when as many have come again
            self.keys, self.counts, self.size = [k], [c], 0

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return summed(np.concatenate(self.keys), np.concatenate(self.counts))


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts[order], first) if len(first) else np.zeros(0, np.int64)


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values in order; sorting whole numbers is faster than the hashing of ``np.unique``."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def _document_pairs(counts: np.ndarray, codes: np.ndarray, known: Remembered, places: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(keys, texts, found)``: distinct pairs of a segment, and every (text, pair) in which the text
    holds the pair, the pair as a place in ``keys``.  Texts with a chunk that is not ok have none.
    ``places`` are those of the segment's distinct chunks."""
    n = max(len(places), 1)
    text = np.repeat(np.arange(len(counts)), counts)
    fine = sums_by_text(known.fixed[places, OK][codes] == 0, counts) == 0
    held = distinct(text * n + codes)
    held = held[fine[held // n]]
    keys, inverse = np.unique(known.values(places), return_inverse=True)
    lens = known.lens[places]
    starts, which = np.cumsum(lens) - lens, held % n
    both = distinct(np.repeat(held // n, lens[which]) * max(len(keys), 1) + inverse[runs(starts[which], lens[which])])
    return keys, both // max(len(keys), 1), both % max(len(keys), 1)


def _gather(path_a: str, path_b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, all_ = Aligner(path_a, path_b, texts=False), Gathered()
        known = Remembered(al)
        long_keys, long_ok = [], True        # of a text that goes on
        for b in batches:
            for _, counts, codes, chunks, goes_on in segments(b.column(0), **al.how):
                places = known(chunks)
                keys, _, found = _document_pairs(counts, codes, known, places)
                if goes_on or long_keys or not long_ok:      # such a segment has one text
                    long_keys.append(keys[found])
                    long_ok = long_ok and bool(known.fixed[places, OK].all())
                    if not goes_on:
                        if long_ok:
                            k = np.unique(np.concatenate(long_keys))
                            all_.add(k, np.ones(len(k), np.int64))
                        long_keys, long_ok = [], True
                    elif len(long_keys) > FAN:
                        long_keys = [np.unique(np.concatenate(long_keys))]
                else:
                    n = np.bincount(found, minlength=len(keys))
                    all_.add(keys[n > 0], n[n > 0])
        known = None
        keys, counts = all_.merged()
        give_back()
        shard = shard_of(keys)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(SHARDS + 1))
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            at = order[bounds[s]:bounds[s + 1]]
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([s], pa.int32()), "task": pa.array([TaskContext.get().partitionId()], pa.int64()),
                 "keys": pa.array([keys[at].astype(U64).tobytes()], pa.binary()),
                 "counts": pa.array([counts[at].astype(I64).tobytes()], pa.binary())})
    return run


# --- trees and the perfect hash ----------------------------------------------

def _merge(column: str, combine: Callable[[list[np.ndarray]], np.ndarray], kind: np.dtype):
    def run(t: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(x, kind) for x in t.column(column).to_pylist()]
        return pa.table({"shard": t.column("shard").slice(0, 1), "task": pa.array([t.column("up")[0].as_py()], pa.int64()),
                         column: pa.array([combine(arrays).astype(kind).tobytes()], pa.binary())})
    return run


def tree(rows: DataFrame, tasks: int, column: str, combine, kind: np.dtype) -> DataFrame:
    """``shard, task, column``: the arrays of a shard combined, ``FAN`` at a time, until one is left."""
    while tasks > 1:
        tasks = -(-tasks // FAN)
        rows = rows.withColumn("up", F.expr(f"task div {FAN}")).groupBy("shard", "up").applyInArrow(
            _merge(column, combine, kind), f"shard int, task long, {column} binary")
    return rows


def _hash_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for shard, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            keys = np.frombuffer(raw, U64)
            sizes, bits = build(keys)
            ordered = in_slot_order(keys, Slots(sizes, bits))
            yield pa.RecordBatch.from_pydict(
                {"shard": pa.array([shard], pa.int32()), "sizes": pa.array([sizes], pa.list_(pa.int64())),
                 "bits": pa.array([bits], pa.binary()), "slots": pa.array([ordered.astype(U64).tobytes()], pa.binary())})


def verified_slots(slots: Slots, ordered: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Slots of keys, each checked against the key stored there."""
    at = slots(keys)
    if len(keys) and (at.min() < 0 or (ordered[at] != keys).any()):
        raise ValueError("a pair is missing from the table of pairs: the documents changed between the passes")
    return at


def _dense(key, sparse: pa.Table, table: pa.Table) -> pa.Table:
    if not sparse.num_rows:
        return pa.table({"shard": pa.array([], pa.int32()), "task": pa.array([], pa.int64()), "vector": pa.array([], pa.binary())})
    slots = Slots(table.column("sizes")[0].as_py(), table.column("bits")[0].as_py())
    ordered = np.frombuffer(table.column("slots")[0].as_py(), U64)
    vector = np.zeros(len(ordered), np.int64)
    for k, c in zip(sparse.column("keys").to_pylist(), sparse.column("counts").to_pylist()):
        vector[verified_slots(slots, ordered, np.frombuffer(k, U64))] += np.frombuffer(c, I64)
    return pa.table({"shard": table.column("shard").slice(0, 1), "task": pa.array([key[1].as_py()], pa.int64()),
                     "vector": pa.array([vector.tobytes()], pa.binary())})


def pair_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``shard, sizes, bits, slots, vector``: per shard the perfect hash of its pairs, its keys and how many
    documents hold each, both in slot order.  ``docs`` has the column ``_text``."""
    sparse = staged(docs.select("_text").mapInArrow(
        _gather(path_a, path_b), "shard int, task long, keys binary, counts binary"), "pair-counts")
    tasks = (sparse.agg(F.max("task")).first()[0] or 0) + 1
    keys = tree(sparse.select("shard", "task", "keys"), tasks, "keys",
                lambda found: np.unique(np.concatenate(found)), U64)
    hashed = staged(keys.select("shard", "keys").mapInArrow(
        _hash_shards, "shard int, sizes array<bigint>, bits binary, slots binary"), "pair-hash")
    groups = -(-tasks // FAN)
    vectors = sparse.withColumn("up", F.expr(f"task div {FAN}")).groupBy("shard", "up").cogroup(
        hashed.withColumn("up", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
        .groupBy("shard", "up")).applyInArrow(_dense, "shard int, task long, vector binary")
    totals = tree(vectors, groups, "vector", lambda found: np.sum(found, axis=0), I64)
    return staged(hashed.join(totals.select("shard", "vector"), "shard"), "pair-table")


# --- second pass ---------------------------------------------------------------

class Part:
    """Some shards of the table, ready for look-ups."""

    def __init__(self, rows: list[tuple]):
        self.shards = {}
        for shard, sizes, bits, slots, vector in rows:
            keys, counts = np.frombuffer(slots, U64), np.frombuffer(vector, I64)
            a = keys >> np.uint64(32)
            ids, place = np.unique(a, return_inverse=True)
            top = np.zeros(len(ids), np.int64)
            np.maximum.at(top, place, counts)
            self.shards[shard] = (Slots(sizes, bits), keys, counts, counts == top[place])

    def look_up(self, pairs: np.ndarray, shard: np.ndarray, count: np.ndarray, best: np.ndarray) -> None:
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(SHARDS + 1))
        for s, (slots, keys, counts, tops) in self.shards.items():
            at = order[bounds[s]:bounds[s + 1]]
            if len(at):
                slot = verified_slots(slots, keys, pairs[at])
                count[at], best[at] = counts[slot], tops[slot]


def _score(path_a: str, path_b: str, parts: list, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = Aligner(path_a, path_b, texts=True)
        only = Part(parts[0].value) if len(parts) == 1 else None

        def measured(chunks: list[bytes]):
            """Alignments with their number of best links and the sum of their links' counts, without the pairs."""
            lens, flat, fixed, groups = al(chunks)
            pairs, place = np.unique(flat, return_inverse=True)
            count, best, shard = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64), shard_of(pairs)
            for p in parts:
                (only or Part(p.value)).look_up(pairs, shard, count, best)
                if only is None:
                    p.let_go()
            more = np.stack([sums_by_text(best[place], lens), sums_by_text(count[place], lens)], axis=1)
            return np.zeros(len(chunks), np.int64), np.zeros(0, np.uint64), np.concatenate([fixed, more], axis=1), groups

        known = Remembered(measured)
        for b in batches:
            n = b.num_rows
            sums, bad, shas = np.zeros((7, n), np.int64), np.zeros(n, bool), [None] * n
            for row, counts, codes, chunks, _ in segments(b.column(1), **al.how):
                places = known(chunks)
                at = slice(row, row + len(counts))
                numbers = known.fixed[places][codes]
                for k in range(7):
                    sums[k, at] += sums_by_text(numbers[:, k], counts)
                bad[at] |= sums_by_text(numbers[:, OK] == 0, counts) > 0
                texts = np.empty(len(places), object)
                texts[:] = [known.notes[i] for i in places.tolist()]
                flat, lo = texts[codes].tolist(), 0
                for j, c in enumerate(counts.tolist()):
                    if c:
                        sha = shas[row + j]
                        if sha is None:
                            sha = shas[row + j] = hashlib.sha256()
                        else:
                            sha.update(b";")
                        sha.update(b";".join(flat[lo:lo + c]))
                    lo += c
            sums[:, bad] = 0
            names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(sums[k]) for k in range(7) if k != OK],
                 pa.array(["" if s is None or bad[i] else s.hexdigest() for i, s in enumerate(shas)], pa.string())],
                ["_id", *names, "groups_sha256"])
        known = only = None
        give_back()
    return run


class TablePart:
    """A broadcast part of the table that a task can let go of."""

    def __init__(self, sent):
        self.sent = sent

    @property
    def value(self):
        return self.sent.value

    def let_go(self) -> None:
        """Drop this worker's copy; the executor keeps the file it was read from."""
        if hasattr(self.sent, "_value") and getattr(self.sent, "_path", None):
            del self.sent._value


def _parts(table: DataFrame) -> list[TablePart]:
    """The table in broadcast parts of whole shards."""
    sc = table.sparkSession.sparkContext
    sizes = sorted(table.select("shard", F.expr("length(slots) div 8").alias("n")).collect())
    out, held, n = [], [], 0

    def send() -> None:
        rows = table.where(F.col("shard").isin(held)).select("shard", "sizes", "bits", "slots", "vector").collect()
        out.append(TablePart(sc.broadcast([(r[0], list(r[1]), bytes(r[2]), bytes(r[3]), bytes(r[4])) for r in rows])))

    for r in sizes:
        if held and n + r.n > PART_PAIRS:
            send()
            held, n = [], 0
        held.append(r.shard)
        n += r.n
    if held:
        send()
    return out


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: id, ``n_a``, ``n_b`` tokens, ``n_groups``, ``n_links``, ``n_best`` (links whose count is the
    highest of their A identifier), ``count_sum`` (over links) and ``groups_sha256``.

    Tokenizer A (byte-level) reads a space and the text; B (pieces) adds that space itself.  Null and
    empty texts, and texts of which a tokenizer does not give the bytes back, have zeros and an empty
    ``groups_sha256`` and count for no pair.  Rows that repeat are documents of their own.  Very long
    texts are read in segments; a stretch without a space is held with its tokens.  An empty table gives no
    rows; only the two named columns are read, so others may have any name.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.when(text != "", F.concat(F.lit(" "), text)).otherwise("").alias("_text"))
    parts = _parts(pair_table(rows, path_a, path_b))
    return rows.mapInArrow(_score(path_a, path_b, parts, kind), f"_id {kind}, n_a long, n_b long, n_groups long, "
                           "n_links long, n_best long, count_sum long, groups_sha256 string").withColumnRenamed("_id", id_col)
