"""Moments: closed-form check, merge property, field statistics."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from radiolens.operators import moments


def test_moment_check(spark):
    # pairs (1,2), (3,5) of one key (FIXTURES.md §3)
    p = spark.createDataFrame([("A", "B", 1.0, 2.0), ("A", "B", 3.0, 5.0)],
                              "serving_cell string, neighbor_cell string, s double, n double")
    r = moments.pair_stats(p).first()
    assert (r.mean_s, r.mean_n, r.var_s, r.cov_sn, r.var_n, r.cnt) == (2.0, 3.5, 1.0, 1.5, 2.25, 2)
    raw = moments.pair_stats(p, finalize=False).first()
    assert (raw.mean_ss, raw.mean_sn, raw.mean_nn) == (5.0, 8.5, 14.5)


pair_rows = st.lists(st.tuples(st.sampled_from("ABC"), st.sampled_from("ABC"),
                               st.integers(0, 97), st.integers(0, 97), st.integers(0, 4)),
                     min_size=1, max_size=60)


@settings(max_examples=6, deadline=None)
@given(pair_rows)
def test_partials_merge_equals_one_pass(spark, rows):
    schema = "part int, serving_cell string, neighbor_cell string, s double, n double"
    df = spark.createDataFrame([(p, a, b, float(s), float(n)) for a, b, s, n, p in rows], schema)
    one = {tuple(r) for r in moments.pair_stats(df).collect()}
    parts = moments.pair_partials(df, by=["part"])
    merged = {tuple(r) for r in moments.finalize_partials(moments.merge_partials(parts)).collect()}
    assert one == merged


def test_population_variance_matches_python(spark):
    rng = random.Random(7)
    vals = [(float(rng.randint(0, 97)), float(rng.randint(0, 97))) for _ in range(200)]
    p = spark.createDataFrame([("A", "B", s, n) for s, n in vals],
                              "serving_cell string, neighbor_cell string, s double, n double")
    r = moments.pair_stats(p).first()
    c = len(vals)
    ms = sum(s for s, _ in vals) / c
    mn = sum(n for _, n in vals) / c
    assert abs(r.var_s - sum((s - ms) ** 2 for s, _ in vals) / c) < 1e-9
    assert abs(r.cov_sn - sum((s - ms) * (n - mn) for s, n in vals) / c) < 1e-9


def test_field_stats(spark):
    df = spark.createDataFrame([("k1", 1.0, 2), ("k1", 3.0, 2), ("k1", None, 2),
                                ("k2", 5.0, 1), ("k3", None, 2)],
                               "key string, v double, bc int")
    from pyspark.sql import functions as F
    got = {r.key: (r.mean, r.second_moment, r.var, r.cnt)
           for r in moments.field_stats(df, "key", "v", where=F.col("bc") == 2).collect()}
    assert got == {"k1": (2.0, 5.0, 1.0, 2), "k3": (None, None, None, 0)}


def test_field_stats_of_large_values(spark):
    # byte counters: 1e9 and 1e9 + 1 in turn
    df = spark.range(100_000).selectExpr("'k' AS key", "1e9D + id % 2 AS v")
    assert abs(moments.field_stats(df, "key", "v").first()["var"] - 0.25) < 1e-6


def test_statistics_of_large_values(spark):
    """4 M rows of 1e9 and 1e9 + 1: in one pass and rolled up from parts of unequal means."""
    p = spark.range(4_000_000).selectExpr(
        "'A' AS serving_cell", "'B' AS neighbor_cell", "1e9D + id % 2 AS s", "1e9D + id % 2 AS n",
        "CASE WHEN id % 4 = 1 THEN 0 ELSE id % 37 + 1 END AS part")
    parts = moments.pair_partials(p, by=["part"])
    merged = moments.finalize_partials(moments.merge_partials(parts))
    twice = moments.finalize_partials(moments.merge_partials(moments.merge_partials(
        parts.withColumn("half", parts.part % 2), by=["half"])))
    for r in (moments.pair_stats(p).first(), merged.first(), twice.first()):
        assert r.cnt == 4_000_000 and r.mean_s == 1e9 + 0.5
        assert all(abs(x - 0.25) < 1e-6 for x in (r.var_s, r.cov_sn, r.var_n))


def test_fractions_are_finalised_from_centred_moments(spark):
    """Values that are no multiples of a quarter, with a large mean: sums of squares would lose them."""
    rng = random.Random(11)
    vals = [(1e7 + rng.random(), -1e7 + rng.random(), i % 5) for i in range(500)]
    p = spark.createDataFrame([("A", "B", *v) for v in vals],
                              "serving_cell string, neighbor_cell string, s double, n double, part int")
    from fractions import Fraction
    s, n = [Fraction(v[0]) for v in vals], [Fraction(v[1]) for v in vals]
    ms, mn = sum(s) / 500, sum(n) / 500
    want = (float(sum((x - ms) ** 2 for x in s) / 500), float(sum((x - ms) * (y - mn) for x, y in zip(s, n)) / 500),
            float(sum((y - mn) ** 2 for y in n) / 500))
    merged = moments.finalize_partials(moments.merge_partials(moments.pair_partials(p, by=["part"])))
    for r in (moments.pair_stats(p).first(), merged.first()):
        assert all(abs(a - b) < 1e-7 for a, b in zip((r.var_s, r.cov_sn, r.var_n), want))
