"""Synthetic format (FIXTURES.md §2)."""

from radiolens.operators import pairs


def _pairs(spark, lines, **kw):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    return {tuple(r) for r in pairs.synthetic_pairs(df, **kw)
            .select("serving_cell", "neighbor_cell", "s", "n").collect()}


def test_normal(spark):
    assert _pairs(spark, ["X:1,0,0,2,X:1,-100.0,X:2,-110.0"]) == \
        {("X:1", "X:1", 40.0, 40.0), ("X:1", "X:2", 40.0, 30.0)}


def test_clamp(spark):
    assert _pairs(spark, ["X:1,0,0,2,X:1,-100.0,X:2,-150.0"]) == \
        {("X:1", "X:1", 40.0, 40.0), ("X:1", "X:2", 40.0, 0.0)}


def test_first_listed_is_server(spark):
    assert _pairs(spark, ["X:1,0,0,2,X:3,-90.0,X:1,-100.0"]) == \
        {("X:1", "X:3", 50.0, 50.0), ("X:1", "X:1", 50.0, 40.0)}


def test_raw_dbm(spark):
    assert _pairs(spark, ["X:1,0,0,2,X:1,-100.0,X:2,-150.0"], offset=0.0, clamp=False) == \
        {("X:1", "X:1", -100.0, -100.0), ("X:1", "X:2", -100.0, -150.0)}


def test_damaged_count_and_number(spark):
    assert _pairs(spark, ["X:1,0,0,2000000000,X:1,-100.0,X:2,-90d", "X:1,0,0,x,X:1,-100.0"]) == \
        {("X:1", "X:1", 40.0, 40.0)}


def test_count_beyond_data(spark):
    assert _pairs(spark, ["X:1,0,0,3,X:1,-100.0"]) == {("X:1", "X:1", 40.0, 40.0)}
