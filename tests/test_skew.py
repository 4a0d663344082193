"""Hot keys: one report holds ~30% of the rows and one pair dominates.
Results equal a brute force, and the plans never gather a group."""

import random
from collections import defaultdict

from radiolens.operators import moments, pairs


def _brute(rows):
    # rows: (report, order, cell, value) -> pair sums by the reference rules
    by_rep = defaultdict(list)
    for r in rows:
        by_rep[r[0]].append(r)
    out = defaultdict(lambda: [0, 0.0, 0.0])
    for rep, rs in by_rep.items():
        rs.sort(key=lambda x: x[1])
        srv = rs[0][2]
        last = {}
        for _, _, c, v in rs:
            last[c] = v
        if srv not in last:
            continue
        s = last[srv]
        for c, v in last.items():
            acc = out[(srv, c)]
            acc[0] += 1
            acc[1] += s
            acc[2] += v
    return {k: (v[0], v[1] / v[0], v[2] / v[0]) for k, v in out.items()}


def test_hot_report_and_pair(spark):
    rng = random.Random(11)
    rows = []
    for i in range(3000):                       # the hot report
        rows.append((0, i, f"c{rng.randint(0, 400)}", float(rng.randint(0, 97))))
    for rep in range(1, 2000):                  # many small reports, one hot pair
        for j in range(rng.randint(1, 6)):
            cell = "hot" if j == 0 or rng.random() < 0.5 else f"c{rng.randint(0, 50)}"
            rows.append((rep, j, cell, float(rng.randint(0, 97))))
    df = spark.createDataFrame(rows, "rep long, ord int, cell string, v double")
    p = pairs.serving_pairs_tabular(df, report="rep", cell="cell", value="v", order=["ord"])
    got = {(r.serving_cell, r.neighbor_cell): (r.cnt, r.mean_s, r.mean_n)
           for r in moments.pair_stats(p).collect()}
    want = _brute(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert abs(got[k][1] - want[k][1]) < 1e-9 and abs(got[k][2] - want[k][2]) < 1e-9


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_never_gather_groups(spark):
    df = spark.createDataFrame([(1, 0, "a", 1.0)], "rep long, ord int, cell string, v double")
    plan = _plan(moments.pair_stats(pairs.serving_pairs_tabular(
        df, report="rep", cell="cell", value="v", order=["ord"])))
    assert "collect_list" not in plan and "Window" not in plan
    assert "partial_" in plan                   # map-side combine before each shuffle
    rec = spark.createDataFrame([("6|",)], "value string")
    plan = _plan(moments.pair_stats(pairs.serving_pairs(rec)))
    assert "collect_list" not in plan and "Window" not in plan and "partial_sum" in plan


def test_join_one_per_key_salts_hot_keys(spark):
    from radiolens.operators.joins import hot_keys, join_one_per_key
    many = spark.createDataFrame([(0 if i % 3 else i, i) for i in range(3000)], "k long, x long")
    one = spark.createDataFrame([(k, f"v{k}") for k in range(0, 3000, 7)], "k long, v string")
    cnt = many.groupBy("k").count()
    assert [r.k for r in hot_keys(cnt, ["k"], "count", max_keys=5, task_rows=10).collect()] == [0]
    plain = sorted(tuple(r) for r in many.join(one, "k").collect())
    for how in ("inner", "left"):
        got = sorted(tuple(r) for r in join_one_per_key(
            many, one, "k", how=how, max_keys=5, task_rows=10).collect())
        want = plain if how == "inner" else sorted(tuple(r) for r in many.join(one, "k", "left").collect())
        assert got == want
        # with the per-key count supplied by the one side
        one_n = one.join(cnt, "k", "left").fillna(0, ["count"])
        got = sorted(tuple(r) for r in join_one_per_key(
            many, one_n, "k", how=how, counts="count", max_keys=5, task_rows=10).collect())
        assert got == want
    # the hot key's rows really are spread over several salts
    from pyspark.sql import functions as F
    salted = many.join(F.broadcast(hot_keys(cnt, ["k"], "count", max_keys=5, task_rows=10)), "k")
    assert salted.select("_salts").distinct().collect()[0][0] == 201      # 2001 rows, 10 to a task
    assert salted.select(F.pmod(F.xxhash64("k", "x"), "_salts")).distinct().count() > 190


def test_operators_with_salting_active(spark, monkeypatch):
    """Force every many-to-one join to salt (tiny thresholds) and check the
    operators still give the exact answers."""
    from radiolens.operators import graph, joins
    monkeypatch.setattr(joins, "TASK_ROWS", 5)
    monkeypatch.setattr(joins, "MAX_HOT_KEYS", 3)
    # a hub graph: "a00" linked to 40 leaves, plus a chain and an isolated node
    names = [f"a{i:02d}" for i in range(50)]
    edges = [("a00", names[i]) for i in range(1, 41)] + [("a41", "a42"), ("a42", "a43")]
    nodes_df = spark.createDataFrame([(v,) for v in names], "node string")
    edges_df = spark.createDataFrame(edges, "src string, dst string")
    got = {r.node: r.component for r in graph.components(nodes_df, edges_df).collect()}
    want = {v: "a00" for v in names[:41]}
    want.update({"a41": "a41", "a42": "a41", "a43": "a41"})
    want.update({v: v for v in names[44:]})
    assert got == want
    # tabular pairs on the hot-report fixture
    rng = random.Random(5)
    rows = [(0, i, f"c{rng.randint(0, 40)}", float(rng.randint(0, 97))) for i in range(300)]
    rows += [(r, j, f"c{rng.randint(0, 5)}", float(rng.randint(0, 97)))
             for r in range(1, 60) for j in range(rng.randint(1, 4))]
    df = spark.createDataFrame(rows, "rep long, ord int, cell string, v double")
    p = pairs.serving_pairs_tabular(df, report="rep", cell="cell", value="v", order=["ord"])
    got = {(r.serving_cell, r.neighbor_cell): (r.cnt, r.mean_s, r.mean_n)
           for r in moments.pair_stats(p).collect()}
    want = _brute(rows)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9


def test_rendered_records_are_narrow(spark):
    """One order with a third of the rows: a record per row, no gather, no shuffle."""
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    from radiolens.sources import render
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, 1).otherwise(F.col("l_orderkey")))
    rec = render.call_records(hot, split_reports=True)
    plan = _plan(rec)
    assert "collect_list" not in plan and "Exchange" not in plan
    assert rec.count() == li.count()
    # the order number is not part of the statistics
    a, b = (moments.pair_stats(pairs.serving_pairs(r)).collect()
            for r in (rec, render.call_records(li, split_reports=True)))
    assert sorted(a) == sorted(b)
