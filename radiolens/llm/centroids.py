"""Centroid clustering with nearest centroids found by the threshold algorithm.

For every dimension the centroids are sorted by their value there.  From a vector's own value a list is walked
outward, nearer side first; a centroid met for the first time gets its exact distance.  The frontier of
a list is the gap to its next centroid, and no centroid that was not met can be nearer than the sum of the
squared frontiers over all lists.  The search stops when that sum strictly exceeds the best exact distance, so a
tie beyond the frontier is still found.  Lists take turns, ``TURN`` of them at a time, for many vectors at once.

All arithmetic is on whole numbers.  Between tasks only sums per centroid travel; the
driver holds the centroids, whose number and size are parameters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

TURN = 8                 # lists walked between two looks at the threshold
CELLS = 1 << 19          # numbers of one array inside a task
LARGEST = 1 << 27        # largest component: squared distances of 64 components stay below 2^62
FAR = np.int64(1) << 31  # frontier of a list walked to both ends


class Lists:
    """Centroids sorted along every dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        k, self.dims = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """``(number, squared distance, distances computed)`` of each row's nearest centroid, the smaller
        number on ties."""
        n, k = len(x), len(self.centroids)
        hi = np.empty((n, self.dims), np.int64)           # next centroid at or above the value
        for d in range(self.dims):
            hi[:, d] = np.searchsorted(self.values[:, d], x[:, d])
        lo = hi - 1                                       # next one below
        frontier = self._gaps(x, lo, hi, slice(None))[0]
        best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, k, np.int64)
        met = np.zeros((n, k), bool)
        live, computed, turn = np.arange(n), 0, 0
        while len(live):
            dims = np.arange(turn * TURN, turn * TURN + TURN) % self.dims
            dims = np.unique(dims)
            turn += 1
            grid = np.ix_(live, dims)
            low, high, at = lo[grid], hi[grid], x[grid]
            _, below = self._gaps(at, low, high, dims)
            walked = np.where(below, low, high)
            there = (walked >= 0) & (walked < k)
            cid = self.order[np.clip(walked, 0, k - 1), dims]
            fresh = np.zeros((len(live), k), bool)
            fresh[np.nonzero(there)[0], cid[there]] = True
            fresh &= ~met[live]
            met[live] |= fresh
            rows, cents = np.nonzero(fresh)
            computed += len(rows)
            if len(rows):
                dist = ((x[live[rows]] - self.centroids[cents]) ** 2).sum(axis=1)
                pick = np.lexsort((cents, dist, rows))
                first = pick[np.concatenate([[True], rows[pick][1:] != rows[pick][:-1]])]
                v, d, c = live[rows[first]], dist[first], cents[first]
                nearer = (d < best[v]) | ((d == best[v]) & (c < who[v]))
                best[v[nearer]], who[v[nearer]] = d[nearer], c[nearer]
            lo[grid] = low - (below & there)
            hi[grid] = high + (~below & there)
            frontier[grid] = self._gaps(at, lo[grid], hi[grid], dims)[0]
            # a list walked to both ends has met every centroid
            beyond = (frontier[live] ** 2).astype(np.float64).sum(axis=1) > 2.0 ** 62
            total = np.where(beyond, np.iinfo(np.int64).max, (np.minimum(frontier[live], LARGEST * 2) ** 2).sum(axis=1))
            live = live[~((total > best[live]) | met[live].all(axis=1))]
        return who, best, computed

    def _gaps(self, x: np.ndarray, lo: np.ndarray, hi: np.ndarray, dims) -> tuple[np.ndarray, np.ndarray]:
        """``(gap, below)``: distance to the next centroid of each list, and whether it lies below."""
        k = len(self.centroids)
        values = self.values[:, dims]
        cols = np.arange(values.shape[1])
        down = np.where(lo >= 0, x - values[np.clip(lo, 0, k - 1), cols], FAR)
        up = np.where(hi < k, values[np.clip(hi, 0, k - 1), cols] - x, FAR)
        return np.minimum(down, up), down <= up


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """``_id, _v``: rows whose vector has ``dims`` components, none null or not finite, each as
    ``floor(scale * component)``."""
    v, finite = F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    whole = lambda x: F.when(F.abs(x.cast("double") * scale) < LARGEST, F.floor(x.cast("double") * scale).cast("int")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more: distances would leave 64 bits")).cast("int"))
    return df.where((F.size(v) == dims) & F.forall(v, finite)).select(F.col(id_col).alias("_id"), F.transform(v, whole).alias("_v"))


def _matrices(column: pa.Array, dims: int, k: int) -> Iterator[np.ndarray]:
    """The vectors of a batch, some rows at a time."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)
    step = max(1, CELLS // (dims + k))
    for at in range(0, len(flat), step):
        yield flat[at:at + step]


def _sums(centroids: np.ndarray):
    """One row per centroid and task: sums of its vectors' components and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        sums, counts = np.zeros(centroids.shape, np.int64), np.zeros(len(centroids), np.int64)
        for b in batches:
            for x in _matrices(b.column(0), lists.dims, len(centroids)):
                who, _, _ = lists.nearest(x)
                order = np.argsort(who, kind="stable")
                first = np.flatnonzero(np.diff(who[order], prepend=-1))
                sums[who[order][first]] += np.add.reduceat(x[order], first, axis=0)
                counts += np.bincount(who, minlength=len(centroids))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(counts[some]), *[pa.array(sums[some, d]) for d in range(lists.dims)]],
            ["cluster", "n", *[f"s{d}" for d in range(lists.dims)]])
    return run


def _placed(centroids: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for b in batches:
            found = [lists.nearest(x)[:2] for x in _matrices(b.column(1), lists.dims, len(centroids))]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.concatenate([w for w, _ in found]).astype(np.int32)),
                     pa.array(np.concatenate([d for _, d in found]))], ["_id", "cluster", "distance"])
    return run


def move(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's vectors, empty ones as they were."""
    dims = centroids.shape[1]
    names = [f"s{d}" for d in range(dims)]
    part = vectors.select("_v").mapInArrow(
        _sums(centroids), "cluster int, n long, " + ", ".join(f"{s} long" for s in names))
    # a task sends one row per centroid; sums are combined before and after the shuffle
    rows = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in names]).collect()
    out = centroids.copy()
    for r in rows:
        out[r.cluster] = [r[s] // r.n for s in names]
    return out


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose identifiers hash least, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256)
    rows = vectors.select(digest.alias("h"), "_v").orderBy(F.asc_nulls_last("h"), "_v").limit(k).collect()
    return np.array([r["_v"] for r in rows], np.int64)


def centroid_clusters(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, k: int = 16,
                      rounds: int = 3, scale: int = 64, seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """``(rows, centroids)``; per kept vector: id, ``cluster``, ``distance`` (squared), ``cluster_inertia``,
    ``inertia`` and ``centroid_sha256``.

    Kept are vectors of exactly ``dims`` components, none null or not finite; other rows, null vectors
    included, are left out.  Rows that repeat are vectors of their own.  First centroids equal in
    identifier are ordered by their components, null identifiers come last; with fewer than ``k`` vectors
    each is a centroid.  Equal centroids stay apart, the smaller number gets the vectors.  An empty
    table gives no rows.  A component too large for exact distances in 64 bits stops the query with an
    error that says so.  Only the two named columns are read, so others may have any name.
    """
    if not 0 < dims <= 64:
        raise ValueError("dims must be 1 to 64: distances are exact 64-bit numbers")
    kind = df.schema[id_col].dataType.simpleString()
    # components as small integers compress well and are read once a round
    vectors = staged(whole_vectors(df, id_col, vector_col, dims, scale), "whole-vectors")
    centroids = first_centroids(vectors, k, seed)
    shape = f"{id_col} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return df.sparkSession.createDataFrame([], shape), centroids
    for _ in range(rounds):
        centroids = move(vectors, centroids)
    placed = staged(vectors.mapInArrow(_placed(centroids, kind), f"_id {kind}, cluster int, distance long"), "placed")
    sums = {r.cluster: r.n for r in placed.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per = df.sparkSession.createDataFrame(
        [(c, sums[c], sum(sums.values()), names[c]) for c in sorted(sums)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row per centroid
    out = placed.join(F.broadcast(per), "cluster").select(
        F.col("_id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return out, centroids


SQL = """
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
parts AS (SELECT vec_id, unnest(range(64)) AS d, unnest(v) AS x FROM kept),
c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS c, vec_id FROM (
  SELECT vec_id, sha256('1:' || vec_id::VARCHAR) AS h FROM kept ORDER BY h LIMIT 16)),
m0 AS (SELECT c, d, x FROM c0 JOIN parts USING (vec_id)),
""" + "".join(f"""
d{r} AS (SELECT p.vec_id, m.c, sum((p.x - m.x) * (p.x - m.x))::BIGINT AS s FROM parts p JOIN m{r} m USING (d) GROUP BY ALL),
a{r} AS (SELECT vec_id, c, s FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s, c) = 1),
""" + (f"""
n{r} AS (SELECT c, d, sum(x)::BIGINT AS t, count(*) AS n FROM a{r} JOIN parts USING (vec_id) GROUP BY c, d),
m{r + 1} AS (SELECT m.c, m.d, CASE WHEN n.n IS NULL THEN m.x ELSE (n.t - ((n.t % n.n) + n.n) % n.n) // n.n END AS x
  FROM m{r} m LEFT JOIN n{r} n ON m.c = n.c AND m.d = n.d),
""" if r < 3 else "") for r in range(4)) + """
named AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM m3 GROUP BY c),
sums AS (SELECT c, sum(s)::BIGINT AS t FROM a3 GROUP BY c)
SELECT a.vec_id, a.c::INTEGER AS cluster, a.s AS distance, t AS cluster_inertia,
  (SELECT sum(t)::BIGINT FROM sums) AS inertia, centroid_sha256
FROM a3 a JOIN sums USING (c) JOIN named USING (c)
"""
