"""Cell-interference graph: edges, nodes, connected components, summary.

Edges and node totals are aggregates and equi-joins; every join of a
large side with a one-row-per-key side splits hot keys (a hub cell) over
several tasks (``joins.join_one_per_key``).  Components use the
alternating large-star / small-star rounds of Kiveris et al. ("Connected
Components in MapReduce and Beyond", SoCC 2014): every round is a
``groupBy(min)`` (map-side combined) and one equi-join, and it converges
in O(log^2 n) rounds.  Each round's edge set is written as a table in the
session's shared checkpoint folder, so lineage stays short and a lost
executor only recomputes the current round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L
from ..session import staging_path
from .joins import join_one_per_key


def interference_edges(stats: DataFrame, *, threshold: float = L.EDGE_THRESHOLD) -> DataFrame:
    """Directed edges ``serving -> neighbor`` for non-self pairs whose count
    exceeds ``threshold`` times the serving cell's total non-self count
    (strict ``>``).  Output: ``src, dst, cnt, total``."""
    nonself = stats.where(F.col("serving_cell") != F.col("neighbor_cell")) \
                   .select(F.col("serving_cell").alias("src"),
                           F.col("neighbor_cell").alias("dst"), "cnt")
    totals = nonself.groupBy("src").agg(F.sum("cnt").alias("total"),
                                        F.count(F.lit(1)).alias("_deg"))
    return (join_one_per_key(nonself, totals, "src", counts="_deg")
            .where(F.col("cnt").cast("double") > F.col("total").cast("double") * F.lit(float(threshold)))
            .select("src", "dst", "cnt", "total"))


def nodes(stats: DataFrame) -> DataFrame:
    """Every cell that appears on either side of a pair (self pairs keep
    their cell as a node)."""
    return (stats.select(F.col("serving_cell").alias("node"))
            .union(stats.select(F.col("neighbor_cell").alias("node")))
            .distinct())


def _undirected(edges: DataFrame) -> DataFrame:
    """Edge set as ``(a, b)`` with ``a != b``, one row per undirected edge."""
    return (edges.where(F.col("src") != F.col("dst"))
            .select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
            .distinct())


def _large_star(e: DataFrame) -> DataFrame:
    # neighbourhood of u over both directions; m(u) = min(u, N(u));
    # link every larger neighbour v > u to m(u)
    sym = e.select(F.col("a").alias("u"), F.col("b").alias("v")) \
           .union(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
    m = sym.groupBy("u").agg(F.min("v").alias("mn"), F.count(F.lit(1)).alias("_deg")) \
           .select("u", F.least("u", "mn").alias("m"), "_deg")
    return (join_one_per_key(sym.where(F.col("v") > F.col("u")), m, "u", counts="_deg")
            .select(F.least("v", "m").alias("a"), F.greatest("v", "m").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    # orient each edge to its larger end u with v <= u; m(u) = min(u, those v);
    # link every such v (and u itself) to m(u)
    d = e.select(F.col("b").alias("u"), F.col("a").alias("v"))
    m = d.groupBy("u").agg(F.min("v").alias("mn"), F.count(F.lit(1)).alias("_deg")) \
         .select("u", F.least("u", "mn").alias("m"), "_deg")
    linked = join_one_per_key(d, m, "u", counts="_deg").select(F.col("v").alias("x"), "m") \
              .union(m.select(F.col("u").alias("x"), "m"))
    return (linked.select(F.least("x", "m").alias("a"), F.greatest("x", "m").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _save(df: DataFrame) -> DataFrame:
    """Materialise one round as a table in the shared checkpoint folder: it
    survives executor loss and cuts the lineage.  (A ``checkpoint()`` of an
    uncached frame would compute the round twice: once to count, once to
    write.)"""
    path = staging_path(df.sparkSession, "components-round")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _signature(e: DataFrame) -> tuple:
    """Cheap fingerprint of an edge set: size and XOR of two row hashes
    (edges are distinct, so equal sets give equal fingerprints)."""
    r = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
              F.bit_xor(F.hash("a", "b"))).first()
    return tuple(r)


def _same(e1: DataFrame, e2: DataFrame) -> bool:
    return e1.exceptAll(e2).isEmpty() and e2.exceptAll(e1).isEmpty()


def components(node_df: DataFrame, edges: DataFrame, *, report: dict | None = None) -> DataFrame:
    """Connected components, edge direction ignored, isolated nodes kept.

    Returns ``node, component`` where ``component`` is the smallest node id
    of the component.  A round is one large-star and one small-star step;
    the loop stops when a round leaves the edge set unchanged -- checked by
    a fingerprint each round and confirmed exactly once it matches.
    ``report``, if given, receives the number of rounds.
    """
    e = _save(_undirected(edges))
    sig = _signature(e)
    done, rnd = sig[0] == 0, 0                # no edge: every node alone
    while not done:
        nxt = _save(_small_star(_large_star(e)))
        nsig = _signature(nxt)
        done, rnd = nsig == sig and _same(nxt, e), rnd + 1
        e, sig = nxt, nsig
    if report is not None:
        report["rounds"] = rnd
    # converged: every edge is (root, leaf) with root the component minimum
    labels = e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return (join_one_per_key(node_df.select("node"), labels, "node", how="left")
            .select("node", F.coalesce("component", "node").alias("component")))


def component_summary(comp: DataFrame, edges: DataFrame) -> DataFrame:
    """Per component: node count and undirected edge count."""
    n = comp.groupBy("component").agg(F.count(F.lit(1)).alias("n_nodes"))
    und = join_one_per_key(_undirected(edges), comp.withColumnRenamed("node", "a"), "a")
    m = und.groupBy("component").agg(F.count(F.lit(1)).alias("n_edges"))
    return (n.join(m, "component", "left")
            .select("component", "n_nodes", F.coalesce("n_edges", F.lit(0)).cast("bigint").alias("n_edges")))


def graph_counts(node_df: DataFrame, edges: DataFrame, comp: DataFrame) -> DataFrame:
    """Whole-graph counts as ``(metric, value)`` rows: nodes, directed
    edges, components."""
    n = node_df.agg(F.lit("nodes").alias("metric"), F.count(F.lit(1)).alias("value"))
    m = edges.select("src", "dst").distinct() \
             .agg(F.lit("edges").alias("metric"), F.count(F.lit(1)).alias("value"))
    c = comp.agg(F.lit("components").alias("metric"),
                 F.countDistinct("component").alias("value"))
    return n.unionByName(m).unionByName(c)
