"""N-gram Jaccard join in metric space.

Jaccard distance d is a metric, so with r = 1 - threshold a pivot p tells much
about a pair that is within r of each other:

* the ball d(x, p) <= r is linked to p, hence one component, without pairs;
* a document y outside the ball can only link to documents x with
  |d(x, p) - d(y, p)| <= r: the region outside is joined again together with the
  ring of the ball that this window reaches, and the rest of the ball is done.

Pivots taken from the whole corpus would be useless, as unrelated documents all
lie at distance close to 1 of each other.  The first regions are
therefore the Voronoi cells of single shingles: a document lies in the cells of its
first floor(r n) + 1 shingles in a global order, and documents in no common cell
are further apart than r.  The order puts rare shingles first, so a passage that many
documents share makes no cell.  Inside a cell, document pivots split it as above,
again and again until nothing lies outside.

Before any whole set is moved, pairs of a cell are tested on short count vectors: each
set's shingles counted in ``BUCKETS`` hash buckets.  The weighted Jaccard distance
of two such vectors is never more than d, so it may only rule pairs out.

Large cells are split with DataFrame joins against their pivot (one row per member, no
gathering) and, if documents remain outside, into the cells of a second shingle;
only cells of at most ``SMALL`` members are finished inside one task.  The pivot of a cell
is its smallest set: linked sets that have no shingle in common but the cell's own both link
to it, so a pair for which no deeper cell is left is connected already.  Documents
with equal shingle sets are one node from the start.  Nothing is capped: every
pair within r shares a cell at every level until its link, or a path of links, is found.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (NOT_SPACE, mix64, ngram_hash, packed, prefix_hash, span_hash, staged, text_chunks,
                     word_spans)
from .components import components

SLOT_BITS = 24          # counters of the shingle order: fixed size, one byte each
SLICE = 1 << 16
SMALL = 4096            # members of a cell that one task finishes
TABLE = 1 << 26         # entries of a cell's membership table in memory
BUCKETS = 64            # counters of a count vector, one byte each


def shingles(buf: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, counts)``: hashes of each text's shingles, in order, repeats kept.
    A text of fewer than ``k`` words is one shingle, one without words has none."""
    starts, ends, n = word_spans(buf, offsets, NOT_SPACE)
    words = span_hash(prefix_hash(buf), starts, ends)
    first = np.zeros(len(n), np.int64)
    np.cumsum(n[:-1], out=first[1:])
    count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    at = np.arange(count.sum()) + np.repeat(first - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    grams = ngram_hash(words, k)
    grams = np.concatenate((grams, np.zeros(max(0, len(words) - len(grams)), np.uint64)))
    out = grams[at] if len(at) else np.zeros(0, np.uint64)
    for c in range(1, k):
        short = np.flatnonzero(n == c)
        if len(short):
            place = np.cumsum(count) - count
            out[place[short]] = mix64(ngram_hash(words, c)[first[short]] + np.uint64(c))
    return out, count


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def shingle_counts(docs: DataFrame, k: int, bits: int = SLOT_BITS) -> np.ndarray:
    """How often shingles of each hash slot occur, over all documents, on a scale of 0 to 255.

    Only an order is derived from it, so the scale is coarse: exact to 32,
    then logarithmic.  The table has 2 ** ``bits`` bytes whatever the corpus.
    """
    def scaled(n: np.ndarray) -> np.ndarray:
        return np.minimum(255, np.where(n < 32, n, 32 + 16 * np.log2(np.maximum(n, 32) / 32))).astype(np.uint8)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, held, room = np.zeros(1 << bits, np.uint32), [], 0

        def empty() -> None:
            ids = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            table[ids[first]] += np.diff(np.concatenate((first, [len(ids)]))).astype(np.uint32)
            held.clear()

        for b in batches:
            for _, buf, offsets in text_chunks(b.column(0)):
                h, _n = shingles(buf, offsets, k)
                if len(h):
                    held.append(_slots(h, bits).astype(np.uint32))
                    room += len(h)
                if room > 1 << 22:
                    empty()
                    room = 0
        if held:
            empty()
        for s in range(0, 1 << bits, SLICE):
            part = table[s:s + SLICE]
            if part.any():
                wide = part.max() > 255
                yield pa.RecordBatch.from_pydict(
                    {"slice": pa.array([s], pa.int32()),
                     "part": pa.array([part.astype(np.uint32 if wide else np.uint8).tobytes()], pa.binary())})

    def add(key: tuple[pa.Scalar, ...], frames: pa.Table) -> pa.Table:
        total = np.zeros(min(SLICE, 1 << bits), np.uint64)
        for cell in frames.column("part"):
            raw = cell.as_py()
            total += np.frombuffer(raw, np.uint8 if len(raw) == len(total) else
                                   np.uint32 if len(raw) == 4 * len(total) else np.uint64)
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()),
                         "part": pa.array([total.tobytes()], pa.binary())})

    parts = docs.mapInArrow(count, "slice int, part binary")
    def finish(key: tuple[pa.Scalar, ...], frames: pa.Table) -> pa.Table:
        total = add(key, frames)
        n = np.frombuffer(total.column("part")[0].as_buffer(), np.uint64).astype(np.float64)
        return pa.table({"slice": total.column("slice"), "part": pa.array([scaled(n).tobytes()], pa.binary())})

    # two levels, so that one task never holds the slices of all partitions
    some = (parts.withColumn("half", F.pmod(F.spark_partition_id(), F.lit(16)))
            .groupBy("slice", "half").applyInArrow(add, "slice int, part binary"))
    whole = some.groupBy("slice").applyInArrow(finish, "slice int, part binary")
    out = np.zeros(1 << bits, np.uint8)
    for row in whole.toLocalIterator():     # 2 ** bits bytes in all
        out[row.slice:row.slice + len(row.part)] = np.frombuffer(row.part, np.uint8)
    return out


def prefix_length(n: np.ndarray | int, threshold: tuple[int, int], depth: int = 1):
    """How many leading shingles of a set of ``n`` must be looked at so that every
    linked partner shares at least ``depth`` of them: n - ceil(t n) + depth."""
    a, b = threshold
    return n - -(-n * a // b) + depth


def ordered_sets(docs: DataFrame, k: int, order, threshold: tuple[int, int], whole: bool) -> DataFrame:
    """Per row of ``docs`` (``_id``, ``_text``): ``_id``, ``_n`` (set size), ``_digest`` (of the
    set, null when empty), the first shingles, or with ``whole`` all, as int64 in one cell, and
    ``_vec``, the count vector (empty if a counter does not fit its byte).

    A shingle is kept as its slot's count followed by 56 bits of its hash, so
    sorted sets are in the global order.
    """
    bits = int(math.log2(len(order.value)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows, buf, offsets in text_chunks(b.column(1)):
                h, count = shingles(buf, offsets, k)
                h = (order.value[_slots(h, bits)].astype(np.uint64) << np.uint64(56)) | (mix64(h) >> np.uint64(8))
                ends = np.cumsum(count)
                sizes, nodes, cells, vecs = [], [], [], []
                for lo, hi in zip(ends - count, ends):
                    s = np.unique(h[lo:hi])
                    sizes.append(len(s))
                    nodes.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    cells.append(s if whole else s[:prefix_length(len(s), threshold)])
                    v = np.bincount((s % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
                    vecs.append(v.astype(np.uint8).tobytes() if v.max() < 256 else b"")
                flat = np.concatenate(cells) if cells else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(rows.start, rows.stop - rows.start),
                     pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                     packed(flat, np.array([len(c) for c in cells], np.int64)), pa.array(vecs, pa.binary())],
                    ["_id", "_n", "_digest", "_set", "_vec"])

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.select("_id", "_text").mapInArrow(run, f"_id {kind}, _n long, _digest binary, _set binary, _vec binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _linked(common, na, nb, threshold: tuple[int, int]):
    a, b = threshold
    return common * b >= a * (na + nb - common)


def peel(sets: list[np.ndarray], group: np.ndarray, threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that connect all linked members of one cell; ``group`` numbers members already
    known to be connected.  Pivots are taken from what lies outside the balls so far."""
    flat = np.concatenate(sets)
    size = np.array([len(s) for s in sets])
    first = np.concatenate(([0], np.cumsum(size)[:-1]))
    values, column, often = np.unique(flat, return_inverse=True, return_counts=True)
    wide = int((often > 1).sum())
    table = None
    if len(sets) * wide <= TABLE:       # which member has which of the shingles that two or more have
        place = np.cumsum(often > 1) - 1
        both = often[column] > 1
        table = np.zeros((len(sets), wide), np.float32)
        table[np.repeat(np.arange(len(sets)), size)[both], place[column[both]]] = 1

    def common_with(p: int, region: np.ndarray) -> np.ndarray:
        if table is not None:
            out = (table @ table[p])[region].astype(np.int64)
            out[region == p] = size[p]
            return out
        pick = np.concatenate([np.arange(first[i], first[i] + size[i]) for i in region])
        at = np.searchsorted(sets[p], flat[pick])
        at[at == size[p]] = 0
        hit = sets[p][at] == flat[pick]
        return np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(size[region])[:-1])))

    group, links = group.copy(), []
    todo = [np.arange(len(sets))]
    radius = 1 - threshold[0] / threshold[1]
    while todo:
        region = todo.pop()
        if len(np.unique(group[region])) < 2:
            continue
        p = region[0]
        common = common_with(p, region)
        near = _linked(common, size[region], size[p], threshold)
        for i in region[near]:
            if group[i] != group[p]:
                links.append((int(p), int(i)))
                group[group == group[i]] = group[p]
        far = region[~near]
        if len(far):
            d = 1 - common / (size[region] + size[p] - common)
            ring = region[near & (d >= d[~near].min() - radius - 1e-9)]
            todo.append(np.concatenate((far, ring)))
    return links


def _pivot_distance(threshold: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mine, theirs = b.column("_set"), b.column("_pset")
            near, d = [], []
            for i in range(len(b)):
                x, p = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (mine, theirs))
                c = _common(x, p)
                near.append(bool(_linked(c, len(x), len(p), threshold)))
                d.append(1 - c / (len(x) + len(p) - c))
            keep = [b.schema.names.index(c) for c in ("_cell", "_node", "_pivot", "_pos", "_depth")]
            yield pa.RecordBatch.from_arrays(
                [b.column(j) for j in keep] + [pa.array(near, pa.bool_()), pa.array(d, pa.float64())],
                ["_cell", "_node", "_pivot", "_pos", "_depth", "_near", "_d"])
    return run


def _deeper(threshold: tuple[int, int]):
    """Members of large cells, spread over the cells of one more shingle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                r = {c: b.column(c)[i].as_py() for c in ("_cell", "_node", "_pos", "_depth")}
                s = np.frombuffer(b.column("_set")[i].as_buffer(), np.uint64)
                end = prefix_length(len(s), threshold, r["_depth"] + 1)
                at = np.arange(r["_pos"] + 1, min(end, len(s)))
                cells = mix64(s[at] ^ mix64(np.array([r["_cell"]], np.int64).view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cells.view(np.int64)), pa.array([r["_node"]] * len(at), pa.int64()),
                     pa.array(at, pa.int32()), pa.array([r["_depth"] + 1] * len(at), pa.int32()),
                     pa.array([len(s)] * len(at), pa.int64())],
                    ["_cell", "_node", "_pos", "_depth", "_n"])
    return run


CELL = "_cell long, _node long, _pos int, _depth int"
SIZED = CELL + ", _n long"


def _open_cells(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Cells whose members are not yet all connected: ``_cell``, ``_count``, ``_pivot`` (the
    member with the smallest set); of cells with the same members one is kept."""
    m = members
    if labels is not None:
        m = m.join(labels, m["_node"] == labels["node"], "left").withColumn("_comp", F.coalesce("component", "_node"))
    else:
        m = m.withColumn("_comp", F.col("_node"))
    # sizes come with the members that possible_members keeps; before that no pivot is used
    pivot = F.min_by("_node", F.struct("_n", "_node")) if "_n" in m.columns else F.min("_node")
    cells = (m.groupBy("_cell").agg(
        F.count("*").alias("_count"), F.min("_comp").alias("_lo"), F.max("_comp").alias("_hi"),
        pivot.alias("_pivot"), F.bit_xor(F.xxhash64("_node")).alias("_x"),
        F.bit_xor(F.hash("_node")).alias("_y")).where("_lo <> _hi"))
    # a large cell is kept for itself: equal members may sit at other places of their sets
    same = F.when(F.col("_count") > SMALL, F.col("_cell"))
    cells = staged(cells.groupBy("_count", "_pivot", "_x", "_y", same.alias("_own")).agg(
        F.min("_cell").alias("_cell")).select("_cell", "_count", "_pivot"), "cells")
    # a cell that lies within another one, which a task finishes as a whole, adds nothing
    here = members.join(cells, "_cell")
    best = here.where(F.col("_count") <= SMALL).groupBy("_node").agg(
        F.max_by("_cell", F.struct("_count", "_cell")).alias("_best"))
    within = (here.join(best, "_node", "left").groupBy("_cell")
              .agg(F.min("_best").alias("_lo"), F.max("_best").alias("_hi"),
                   F.count("_best").alias("_known"), F.count("*").alias("_all"))
              .where("_lo = _hi and _known = _all and _lo <> _cell").select("_cell"))
    return cells.join(within, "_cell", "left_anti")


def link_nodes(first: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Edges (``src``, ``dst``) between nodes whose components are those of all links.

    ``first``: the members of the first cells; ``sets``: ``_node``, ``_set`` of their nodes.
    """
    spark = first.sparkSession
    edges = spark.createDataFrame([], "src long, dst long")
    members, labels, star_first = first, None, True
    while True:
        cells = staged(_open_cells(members, labels), "cells")
        if cells.isEmpty():
            return edges
        here = members.join(cells, "_cell")
        if star_first:
            # most links at little cost: every node is compared with the pivot of its largest cell only
            best = here.groupBy("_node").agg(F.max_by("_pivot", F.struct("_count", "_cell")).alias("_pivot"))
            here = best.select(F.lit(0).cast("long").alias("_cell"), "_node", "_pivot",
                               F.lit(0).alias("_pos"), F.lit(1).alias("_depth")).where("_node <> _pivot")
            star = _against_pivot(here, sets, threshold)
            found = star.where("_near").select(F.col("_pivot").alias("src"), F.col("_node").alias("dst"))
            edges, star_first = staged(found, "edges"), False
            labels = staged(components(edges), "labels")
            members = first
            continue
        small = here.where(F.col("_count") <= SMALL).join(labels, F.col("_node") == labels["node"], "left").select(
            "_cell", "_node", F.coalesce("component", "_node").alias("_comp")).join(sets, "_node")

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("_node").reset_index(drop=True)
            links = peel([np.frombuffer(s, np.uint64) for s in pdf["_set"]],
                         pd.factorize(pdf["_comp"])[0], threshold)
            node = pdf["_node"].to_numpy()
            i, j = np.array(links, np.int64).reshape(-1, 2).T
            return pd.DataFrame({"src": node[i], "dst": node[j]})

        found = small.groupBy("_cell").applyInPandas(solve, "src long, dst long")
        large = here.where(F.col("_count") > SMALL)
        more = not cells.where(F.col("_count") > SMALL).isEmpty()
        if more:
            star = staged(_against_pivot(large.drop("_count"), sets, threshold), "star")
            found = found.unionByName(star.where("_near").select(
                F.col("_pivot").alias("src"), F.col("_node").alias("dst")))
            outside = star.where(~F.col("_near")).groupBy("_cell").agg(F.min("_d").alias("_dmin"))
            radius = 1 - threshold[0] / threshold[1]
            kept = (star.join(outside, "_cell")
                    .where(~F.col("_near") | (F.col("_d") >= F.col("_dmin") - F.lit(radius + 1e-9))))
            members = staged(kept.select("_cell", "_node", "_pos", "_depth").join(sets, "_node")
                             .mapInArrow(_deeper(threshold), SIZED), "deeper")
        edges = staged(edges.unionByName(found), "edges")
        labels = staged(components(edges), "labels") if more else labels
        if not more:
            return edges


def _possible(threshold: tuple[int, int]):
    """From members sorted by cell, those with a partner in the cell that sizes and count vectors
    do not rule out; large cells pass whole."""
    names = ["_cell", "_node", "_pos", "_depth", "_n"]

    def partners(n: np.ndarray, vecs: list[bytes]) -> np.ndarray:
        v = np.frombuffer(b"".join(x or bytes(BUCKETS) for x in vecs), np.uint8).reshape(len(n), BUCKETS)
        open_ = np.array([not x for x in vecs])
        found = np.zeros(len(n), bool)
        for i in range(len(n) - 1):
            rest = slice(i + 1, len(n))
            most = np.minimum(v[i], v[rest]).sum(axis=1, dtype=np.int64)
            most = np.where(open_[rest] | open_[i], np.minimum(n[i], n[rest]), most)
            ok = _linked(most, n[i], n[rest], threshold)
            found[rest] |= ok
            found[i] |= ok.any()
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in itertools.chain(batches, [None]):
            if b is not None:
                t = pa.Table.from_batches([b])
                held = t if held is None else pa.concat_tables([held, t])
            if held is None or not len(held):
                continue
            cell = held.column("_cell").to_numpy()
            cut = len(cell) if b is None else int(np.searchsorted(cell, cell[-1], "left"))
            part, held = held.slice(0, cut), held.slice(cut)
            if not cut:
                continue
            cell = cell[:cut]
            n, vec = part.column("_n").to_numpy(), part.column("_vec").to_pylist()
            first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
            keep = np.zeros(cut, bool)
            for lo, hi in zip(first, [*first[1:], cut]):
                keep[lo:hi] = partners(n[lo:hi], vec[lo:hi])
            yield from part.filter(pa.array(keep)).select(names).to_batches()
    return run


def possible_members(members: DataFrame, nodes: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """``members`` without those that the count vectors rule out, and without cells that
    repeat another cell's members."""
    cells = staged(_open_cells(members, None).select("_cell", "_count"), "cells")
    here = members.join(cells, "_cell")
    # a large cell is not gathered for this test
    tested = (here.where(F.col("_count") <= SMALL).drop("_count").join(nodes.select("_node", "_n", "_vec"), "_node")
              .repartition("_cell").sortWithinPartitions("_cell")
              .select("_cell", "_node", "_pos", "_depth", "_n", "_vec").mapInArrow(_possible(threshold), SIZED))
    large = here.where(F.col("_count") > SMALL).drop("_count").join(nodes.select("_node", "_n"), "_node")
    return tested.unionByName(large)


def _against_pivot(members: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """Distance of each member to its ``_pivot``."""
    pivots = sets.join(members.select(F.col("_pivot").alias("_node")).distinct(), "_node", "left_semi").select(
        F.col("_node").alias("_pivot"), F.col("_set").alias("_pset"))
    rows = members.join(sets, "_node").join(pivots, "_pivot").select(
        "_cell", "_node", "_pivot", "_pos", "_depth", "_set", "_pset")
    return rows.mapInArrow(_pivot_distance(threshold), "_cell long, _node long, _pivot long, _pos int, _depth int, "
                                                        "_near boolean, _d double")


def ngram_components(docs: DataFrame, k: int, threshold: tuple[int, int], id_col: str = "doc_id",
                     text_col: str = "text", slot_bits: int = SLOT_BITS) -> DataFrame:
    """One row per input row: id, ``n_shingles``, ``component_id`` (least identifier reachable).

    Documents link when their sets of ``k``-word shingles (A-Z lower-cased) have
    Jaccard similarity at least ``threshold`` = (numerator, denominator).  A null text, or one
    without words, has the empty set and its own identifier as component.  Null
    identifiers take part and are never a component's name unless it has no other.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    order = spark.sparkContext.broadcast(shingle_counts(rows.select("_text"), k, slot_bits))
    heads = staged(ordered_sets(rows, k, order, threshold, False), "heads")
    nodes = staged(heads.where("_digest is not null").groupBy("_digest").agg(
        F.min("_id").alias("_rep"), F.first("_set").alias("_set"), F.first("_n").alias("_n"),
        F.first("_vec").alias("_vec")).withColumn("_node", F.monotonically_increasing_id()), "nodes")

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = pa.array(b.column(1)).cast(pa.large_binary())
            n = np.diff(np.frombuffer(cell.buffers()[1], np.int64)[cell.offset:cell.offset + len(cell) + 1]) // 8
            flat = np.concatenate([np.frombuffer(c.as_buffer(), np.int64) for c in cell]) if len(cell) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat), b.column(0).take(pa.array(np.repeat(np.arange(len(n)), n))),
                 pa.array((np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)),
                 pa.array(np.ones(n.sum(), np.int32))], ["_cell", "_node", "_pos", "_depth"])

    members = nodes.select("_node", "_set").mapInArrow(explode, CELL)
    shared = members.groupBy("_cell").agg(F.count("*").alias("n")).where("n > 1").select("_cell")
    members = staged(members.join(shared, "_cell", "left_semi"), "members")
    members = staged(possible_members(members, nodes, threshold), "possible")
    wanted = members.select("_node").distinct().join(nodes.select("_node", "_rep", "_digest"), "_node")
    texts = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_rep"))).select(
        F.struct("_node", F.col("_digest").alias("is")).alias("_id"), "_text")
    # rows may share an identifier: the digest tells whose set it is
    sets = staged(ordered_sets(texts, k, order, threshold, True).where("_id.is = _digest")
                  .select("_id._node", "_set").dropDuplicates(["_node"]), "sets")
    edges = link_nodes(members, sets, threshold)
    comp = components(edges)
    named = nodes.select("_node", "_rep", "_digest").join(comp, F.col("_node") == F.col("node"), "left").select(
        "_digest", "_rep", F.coalesce("component", "_node").alias("_comp"))
    least = named.groupBy("_comp").agg(F.min("_rep").alias("_name"))
    named = staged(named.join(least, "_comp").select("_digest", "_name"), "names")
    return heads.select("_id", "_n", "_digest").join(named, "_digest", "left").select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
        F.coalesce("_name", "_id").alias("component_id"))
