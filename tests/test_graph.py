"""Interference graph and connected components."""

import random

from radiolens.operators import graph

STATS = "serving_cell string, neighbor_cell string, cnt bigint"


def test_graph_check(spark):
    # FIXTURES.md §3: threshold 0.09, strict
    stats = spark.createDataFrame([("A", "B", 91), ("A", "C", 9), ("A", "A", 50), ("D", "D", 4)], STATS)
    e = graph.interference_edges(stats, threshold=0.09)
    assert [(r.src, r.dst, r.total) for r in e.collect()] == [("A", "B", 100)]
    n = graph.nodes(stats)
    comp = {r.node: r.component for r in graph.components(n, e).collect()}
    assert comp == {"A": "A", "B": "A", "C": "C", "D": "D"}
    summ = {r.component: (r.n_nodes, r.n_edges) for r in graph.component_summary(
        graph.components(n, e), e).collect()}
    assert summ == {"A": (2, 1), "C": (1, 0), "D": (1, 0)}
    counts = {r.metric: r.value for r in graph.graph_counts(n, e, graph.components(n, e)).collect()}
    assert counts == {"nodes": 4, "edges": 1, "components": 3}


def _union_find(nodes, edges):
    parent = {v: v for v in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    groups = {}
    for v in nodes:
        groups.setdefault(find(v), []).append(v)
    return {v: min(g) for g in groups.values() for v in g}


def test_components_match_brute_force(spark):
    rng = random.Random(3)
    for trial in range(4):
        n = rng.randint(5, 60)
        names = [f"c{i:03d}" for i in range(n)]
        edges = {(rng.choice(names), rng.choice(names)) for _ in range(rng.randint(0, 2 * n))}
        # a long path stresses the number of rounds
        if trial == 3:
            edges |= {(names[i], names[i + 1]) for i in range(n - 1)}
        nodes_df = spark.createDataFrame([(v,) for v in names], "node string")
        edges_df = spark.createDataFrame(list(edges) or [("c000", "c000")], "src string, dst string")
        got = {r.node: r.component for r in graph.components(nodes_df, edges_df).collect()}
        assert got == _union_find(names, [e for e in edges if e[0] != e[1]])


def test_components_without_edges(spark):
    stats = spark.createDataFrame([("A", "A", 5), ("B", "C", 1), ("B", "D", 1)], STATS)
    e = graph.interference_edges(stats, threshold=0.9)
    rep = {}
    comp = {r.node: r.component for r in graph.components(graph.nodes(stats), e, report=rep).collect()}
    assert comp == {"A": "A", "B": "B", "C": "C", "D": "D"} and rep["rounds"] == 0
