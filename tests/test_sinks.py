"""Long table, text report, tuple export, replace-by-key write."""

from radiolens.operators import sinks

STATS = ("serving_cell string, neighbor_cell string, mean_s double, mean_n double, "
         "var_s double, cov_sn double, var_n double, cnt bigint")


def _stats(spark, rows):
    return spark.createDataFrame(rows, STATS)


def test_to_long(spark):
    df = sinks.to_long(_stats(spark, [("a", "b", 44.0, 42.0, 1.0, 0.5, 2.0, 3)]), 7, 9)
    rows = [(r.kind, r.value, r.cell, r.measured_cell_1, r.measured_cell_2, r.cnt) for r in df.collect()]
    assert sorted(rows) == sorted([
        ("MeanServer", -96.0, "a", "a", "b", 3), ("MeanNeighbor", -98.0, "a", "a", "b", 3),
        ("VarianceServer", 1.0, "a", "a", "b", 3), ("CovarianceNeighbor", 0.5, "a", "a", "b", 3),
        ("VarianceNeighbor", 2.0, "a", "a", "b", 3)])
    assert {(r.case_id, r.rnp_simulation_id) for r in df.collect()} == {(7, 9)}


def test_report_lines(spark):
    rows = [("001:01:abc01", "001:01:abc02", 44.0, 42.0, 0.25, 2.5, 1.125, 1),
            ("a-very-long-cell-identifier", "b", -0.004, 1234567.891, 0.0, -1.5, 99.5, 123456789)]
    got = [r.line for r in sinks.report_lines(_stats(spark, rows)).collect()]
    # worked out by hand: two names in 16 columns, five values in 10, the count in 8
    assert got == [
        "001:01:abc01      001:01:abc02            44.00     42.00      0.25      2.50      1.12       1",
        "a-very-long-cell-identifier  b                       -0.00"
        "1234567.89      0.00     -1.50     99.50123456789"]


def test_tuple_lines(spark):
    df = sinks.to_long(_stats(spark, [("a", "b", 44.0, 42.0, 1.0, 0.5, 2.0, 3)]), 1, 2)
    lines = sorted(r.line for r in sinks.tuple_lines(df).collect())
    assert "(1, 2, 'MeanServer', 'a', 'a', 'b', -96.0, 3)" in lines


def test_tuple_digits(spark):
    """Lines written out by hand, and random values against the C format of 12 digits."""
    import math
    import random
    import struct

    from pyspark.sql import functions as F

    hand = [(8.0 / 3, "2.66666666667"), (0.1 + 0.2, "0.3"), (-96.0, "-96.0"), (1e11, "100000000000.0"),
            (123456789012.0, "123456789012.0"), (999999999999.5, "1e+12"), (1e12, "1e+12"), (0.0001, "0.0001"),
            (1234567890123.0, "1.23456789012e+12"), (0.00001, "1e-05"), (1.5e-300, "1.5e-300"), (-0.0, "-0.0"), (0.0, "0.0"),
            (float("inf"), "inf"), (9.9999999999995, "10.0"), (0.5, "0.5"), (2.5e-05, "2.5e-05"), (1e100, "1e+100")]
    rnd = random.Random(2)
    many = [rnd.gauss(0, 1) * 10 ** rnd.randint(-9, 16) for _ in range(2000)]
    many += [struct.unpack("<d", rnd.randbytes(8))[0] for _ in range(2000)] + [k / 16 + 1e8 for k in range(200)]
    many = [x for x in many if math.isfinite(x)]

    def c_text(x):
        t = f"{x:.12g}"
        return t if any(c in t for c in ".en") else t + ".0"

    df = spark.createDataFrame([(x,) for x in [*(x for x, _ in hand), *many]], "x double")
    got = [(r.x, r.t) for r in df.select("x", sinks.short_double(F.col("x")).alias("t")).collect()]
    for x, t in got[len(hand):]:
        assert t == c_text(x), (x, t)
    assert [t for _, t in got[:len(hand)]] == [t for _, t in hand]
    assert spark.createDataFrame([(float("nan"),), (None,)], "x double").select(
        sinks.short_double(F.col("x")).alias("t")).collect() == [("nan",), (None,)]


def test_replace_cases_all_or_nothing(spark, tmp_dir):
    """Several cases in one write; a job that fails half-way leaves every case as it was."""
    import os

    import pytest
    from pyspark.sql import functions as F

    path = f"{tmp_dir}/long"
    st = _stats(spark, [("a", "b", 44.0, 42.0, 1.0, 0.5, 2.0, 3)])
    two = _stats(spark, [("a", "b", 44.0, 42.0, 1.0, 0.5, 2.0, 3), ("a", "c", 4.0, 2.0, 1.0, 0.5, 2.0, 1)])

    def counts():
        t = sinks.read_long_table(spark, path)
        return {(r[0], r[1]): r[2] for r in t.groupBy("case_id", "rnp_simulation_id").count().collect()}

    cases = [(1, 1), (1, 2), (2, 1)]
    every = sinks.to_long(st, 1, 1).unionByName(sinks.to_long(st, 1, 2)).unionByName(sinks.to_long(st, 2, 1))
    sinks.replace_cases(every.unionByName(sinks.to_long(st, 9, 9)), path, cases)
    assert counts() == {c: 5 for c in cases}
    late = sinks.to_long(two, 1, 1).unionByName(sinks.to_long(two, 1, 2)).repartition(2)
    bad = late.withColumn("value", F.when(F.col("measured_cell_2") == "c", F.raise_error(F.lit("half-way")).cast("double"))
                          .otherwise(F.col("value")))
    with pytest.raises(Exception, match="half-way"):
        sinks.replace_cases(bad, path, cases)
    assert counts() == {c: 5 for c in cases}
    # (2, 1) has no new rows and is cleared, (1, 2) is not named and stays
    sinks.replace_cases(late, path, [(1, 1), (2, 1)])
    assert counts() == {(1, 1): 10, (1, 2): 5}
    sinks.replace_cases(late, path, [(1, 1), (1, 2)], overwrite=False)
    assert counts() == {(1, 1): 20, (1, 2): 15}
    sinks.replace_cases(late, path, [])
    assert counts() == {(1, 1): 20, (1, 2): 15}
    assert not [n for n in os.listdir(path) if n.startswith("_")]


def test_sorted_files(spark, tmp_dir):
    df = spark.range(5000).selectExpr("cast(id * 7919 % 1009 AS string) AS a", "id % 3 AS b", "id")
    sinks.write_sorted(df, f"{tmp_dir}/sorted", ["a", "b"], files=6)
    got = [(r.a, r.b) for r in sinks.read_places(spark, f"{tmp_dir}/sorted").orderBy("place").collect()]
    assert got == sorted(got) and len(got) == 5000
    places = sinks.read_places(spark, f"{tmp_dir}/sorted").selectExpr("min(place)", "max(place)", "count(DISTINCT place)").first()
    assert tuple(places) == (1, 5000, 5000)


def test_replace_case(spark, tmp_dir):
    path = f"{tmp_dir}/long"
    st = _stats(spark, [("a", "b", 44.0, 42.0, 1.0, 0.5, 2.0, 3)])
    sinks.replace_case(sinks.to_long(st, 1, 1), path, 1, 1)
    sinks.replace_case(sinks.to_long(st, 1, 2), path, 1, 2)
    sinks.replace_case(sinks.to_long(st, 1, 2), path, 1, 2, overwrite=False)
    t = sinks.read_long_table(spark, path)
    assert {(r[0], r[1], r[2]) for r in t.groupBy("case_id", "rnp_simulation_id").count().collect()} \
        == {(1, 1, 5), (1, 2, 10)}
    # an empty result still replaces the key's old rows; other keys stay
    empty = sinks.to_long(st.limit(0), 1, 2)
    sinks.replace_case(empty, path, 1, 2, overwrite=True)
    t = sinks.read_long_table(spark, path)
    assert {(r[0], r[1], r[2]) for r in t.groupBy("case_id", "rnp_simulation_id").count().collect()} \
        == {(1, 1, 5)}


def test_replaced_cases_keep_pairs_together(spark, tmp_dir, monkeypatch):
    """The files of every case hold the rows of a pair side by side, in the order of the pairs (F9)."""
    from pyspark.sql import functions as F

    from radiolens.plans import queries

    made = [(o, o * 7 % 50 + k, (o * 5 + k * k) % 23 + 1, k, float(o % 9 + k)) for o in range(400) for k in range(1, 6)]
    spark.createDataFrame(made, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double") \
        .write.parquet(f"{tmp_dir}/sf/lineitem.parquet")
    monkeypatch.setattr(queries, "staging_path", lambda spark, name: f"{tmp_dir}/{name}")
    kept = queries.q_replace_partition(spark, f"{tmp_dir}/sf").count()
    rows = spark.read.parquet(f"{tmp_dir}/long-table").select(
        "case_id", "rnp_simulation_id", "measured_cell_1", "measured_cell_2", F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.row_index").alias("place")).collect()
    files = {}
    for r in sorted(rows, key=lambda r: r.place):
        files.setdefault((r.case_id, r.rnp_simulation_id, r.file), []).append((r.measured_cell_1, r.measured_cell_2))
    assert len(rows) == kept and {f[:2] for f in files} == {(1, 1), (1, 2), (2, 1)}
    assert all(pairs == sorted(pairs) for pairs in files.values())


def test_cases_are_written_side_by_side(spark, tmp_dir, monkeypatch):
    """Rows of several cases in one task are not sorted by case, also where there are more cases than open files; files are zstd."""
    import contextlib
    import os

    used, real = [], sinks.setting

    @contextlib.contextmanager
    def noted(s, key, value):
        with real(s, key, value):
            used.append((key, s.conf.get(key)))
            yield

    monkeypatch.setattr(sinks, "setting", noted)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    rows = [(i % 5, 1, "mean", f"c{i}", "a", "b", float(i), i) for i in range(500)]
    df = spark.createDataFrame(rows, sinks.LONG_SCHEMA).coalesce(2)
    for n, most in enumerate((16, 2)):
        monkeypatch.setattr(sinks, "OPEN_CASES", most)
        path = f"{tmp_dir}/t{n}"
        sinks.replace_cases(df, path, [(c, 1) for c in range(5)])
        assert sorted(tuple(r) for r in sinks.read_long_table(spark, path).collect()) == sorted(rows)
        assert all(f.endswith(".zstd.parquet") for _, _, names in os.walk(path) for f in names if f.endswith(".parquet"))
    assert used == [(key, "16"), (key, "2")] and spark.conf.get(key) == before
