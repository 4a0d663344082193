"""Golden tests of the record decoder on invented lines (FIXTURES.md §1)."""

import pytest
from pyspark.sql import functions as F

from conftest import record_line
from radiolens.functions import decode as D
from radiolens.operators import pairs, records

CASES = [
    ("two reports, serving absent in first", "[1;7;X:2;24;9;2;7;X:2;24;9;8;X:1;40;|",
     {("X:1", "X:2", 40.0, 24.0), ("X:1", "X:1", 40.0, 40.0)}),
    ("one report, serving only", "[1;7;X:1;29;5|", {("X:1", "X:1", 29.0, 29.0)}),
    ("blank RSRP", "[2;7;X:1;30;5;8;X:2;;4|", {("X:1", "X:1", 30.0, 30.0)}),
    ("blank cell", "[2;7;X:1;30;5;8;;20;4|", {("X:1", "X:1", 30.0, 30.0)}),
    ("duplicate cell, last wins", "[3;7;X:1;30;5;8;X:2;20;4;8;X:2;22;4|",
     {("X:1", "X:1", 30.0, 30.0), ("X:1", "X:2", 30.0, 22.0)}),
    ("duplicate, later one blank", "[3;7;X:1;30;5;8;X:2;20;4;8;X:2;;4|",
     {("X:1", "X:1", 30.0, 30.0), ("X:1", "X:2", 30.0, 20.0)}),
    ("count larger than data", "[3;7;X:1;30;5|", {("X:1", "X:1", 30.0, 30.0)}),
    ("zero count, then report", "[0;1;7;X:1;30;5|", {("X:1", "X:1", 30.0, 30.0)}),
    ("damage after first report", "[1;7;X:1;30;5;bad;1|", {("X:1", "X:1", 30.0, 30.0)}),
    ("no payload", "|", set()),
    ("no end mark", "[1;7;X:1;30;5", set()),
]


def _pairs(spark, lines, **kw):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    return {tuple(r) for r in pairs.serving_pairs(df, **kw)
            .select("serving_cell", "neighbor_cell", "s", "n").collect()}


@pytest.mark.parametrize("name,payload,expected", CASES, ids=[c[0] for c in CASES])
def test_golden_payloads(spark, name, payload, expected):
    assert _pairs(spark, [record_line(payload=payload)]) == expected


def test_too_few_fields(spark):
    assert _pairs(spark, ["6;x|"]) == set()
    assert _pairs(spark, ["6;x[1;7;X:1;30;5|"]) == set()


def test_sentinel_keeps_missing_serving(spark):
    got = _pairs(spark, [record_line(payload=CASES[0][1])], missing_serving="sentinel")
    assert got == CASES[0][2] | {("X:1", "X:2", -1.0, 24.0)}


def test_zero_adds_self_pair_and_first_report_only(spark):
    line = record_line(payload="[1;7;X:2;24;9;2;7;X:2;25;9;8;X:1;40;|")
    got = _pairs(spark, [line], missing_serving="zero", which="first",
                 serving_field=3)
    assert got == {("X:1", "X:2", 0.0, 24.0), ("X:1", "X:1", 0.0, 0.0)}
    # a report without usable measurement yields nothing, not a zero pair
    assert _pairs(spark, [record_line(payload="[1;7;X:2;;9|")], missing_serving="zero") == set()


def test_negative_and_nan_server_values_dropped(spark):
    lines = [record_line(payload="[2;7;X:1;-5;5;8;X:2;20;4|"),
             record_line(payload="[2;7;X:1;NaN;5;8;X:2;20;4|")]
    assert _pairs(spark, lines) == set()


def test_parse_error_flags(spark):
    lines = [record_line(payload=p) for _, p, _ in CASES] + ["6;x[1;7;X:1;30;5|"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id int, value string")
    rows = records.reports(df).groupBy("id").agg(F.max("parse_error").alias("e")).collect()
    flagged = {r["id"] for r in rows if r["e"]}
    # records with reports: the damaged one and the one too short for field 21
    assert flagged == {8, 11}
    # records without any report: flag computed before the explode
    base = df.select("id", (D.has_payload(F.col("value")) & ~D.payload_ok(F.col("value")))
                     .alias("bad"))
    assert {r["id"] for r in base.collect() if r["bad"]} == {10}


def test_damaged_counts_and_numbers(spark):
    huge = [record_line(payload="[999999999;7;X:1;30;5|"), record_line(payload="[1;7;X:1;30d;5|"),
            record_line(payload="[1;7;X:1;30;5;x;7;X:1;31;5|"), record_line(payload="[z;7;X:1;30;5|"),
            record_line(payload="[1;7;X:1;30;5"), record_line(payload="|"),
            record_line(n_fields=233 + 36, payload="|", fields={173: "2000000000", 234: "pgw"})]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(huge)], "id int, value string")
    got = {r.id: (r.n_reports, r.parse_error) for r in records.parse_errors(df).collect()}
    assert got == {0: (1, False), 1: (1, True), 2: (1, True), 3: (0, True), 4: (0, True),
                   5: (0, False), 6: (0, False)}
    assert _pairs(spark, huge[:3]) == {("X:1", "X:1", 30.0, 30.0)}
    assert [(r.id, r.bearer_pos, r.pgw_id) for r in records.bearers(df).collect()] == [(6, 0, "pgw")]


def test_long_report_last_wins(spark):
    # one report of 20 000 measurements over 100 cells
    n = 20_000
    body = ";".join(f"7;X:{i % 100};{i};5" for i in range(n))
    got = _pairs(spark, [record_line(payload=f"[{n};{body}|")])
    assert got == {("X:1", f"X:{c}", float(n - 99), float(n - 100 + c)) for c in range(100)}


def test_field_at_matches_field_array(spark):
    line = record_line(payload="[1;7;X:1;29;5|", fields={5: "03:26", 8: "76320870", 173: "2"})
    df = spark.createDataFrame([(line,), ("6;x|",), ("",)], "value string")
    v = F.col("value")
    for pos in (1, 3, 5, 8, 21, 173, 233, 234, 400):
        a = [r[0] for r in df.select(D.field_at(v, pos)).collect()]
        b = [r[0] for r in df.select(D.field(D.field_array(v), pos)).collect()]
        assert a == b, pos


def test_fields_and_event_time(spark):
    line = record_line(payload="|", fields={5: "03:26", 6: "2014", 8: "76320870", 173: "1"})
    df = spark.createDataFrame([(line,)], "value string")
    row = records.event_time(records.fields(df)).select(
        "version", "month_day", "year", "time_ms", "serving_cell", "bearer_count",
        F.unix_millis("event_ts").alias("ms")).first()
    assert (row.version, row.month_day, row.year, row.time_ms, row.serving_cell,
            row.bearer_count) == (6, "03:26", 2014, 76320870, "X:1", 1)
    # 2014-03-26 00:00 UTC + 76 320 870 ms
    assert row.ms == 1395792000000 + 76320870


def test_bearers_stride(spark):
    fields = {173: "2"}
    for k in range(2):
        base = 234 + 36 * k
        fields.update({base: f"pgw{k}", base + 1: f"apn{k}", base + 5: str(8 + k),
                       base + 7: str(5 + k), base + 17: str(100 * (k + 1))})
    line = record_line(n_fields=233 + 72, payload="|", fields=fields)
    df = spark.createDataFrame([(line,)], "value string")
    got = [tuple(r) for r in records.bearers(df).orderBy("bearer_pos").select(
        "bearer_pos", "pgw_id", "apn", "qci", "bearer_id", "dl_rlc_bytes").collect()]
    assert got == [(0, "pgw0", "apn0", 8, 5, 100), (1, "pgw1", "apn1", 9, 6, 200)]


def test_measurements_rows(spark):
    line = record_line(payload="[3;7;X:1;30;5;8;X:2;20;4;8;X:2;22;4|")
    df = spark.createDataFrame([(line,)], "value string")
    rows = {(r.cell, r.rsrp) for r in records.measurements(records.reports(df)).collect()}
    assert rows == {("X:1", 30.0), ("X:2", 22.0)}


def test_serving_field_option(spark):
    # field 131 as the serving cell (the one-field fork's key)
    line = record_line(serving="X:9", payload="[2;7;X:1;30;5;8;X:2;20;4|", fields={131: "X:2"})
    got = _pairs(spark, [line], serving_field=131)
    assert got == {("X:2", "X:1", 20.0, 30.0), ("X:2", "X:2", 20.0, 20.0)}


def test_one_record_of_many_reports(spark):
    """A record of 20 000 reports: every report is there, and no row carries the line."""
    n = 20_000
    body = ";".join(f"1;7;c{i % 50};{i % 97};1" for i in range(n))
    df = spark.createDataFrame([(1, record_line(serving="c1", payload=f"[{body}|"))], "id int, value string")
    rep = records.reports(df)
    assert rep.columns == ["id", "serving_cell", "parse_error", "report_pos", "meas"]
    out = records.measurements(rep).agg(F.count("*"), F.sum("rsrp"), F.max("report_pos")).first()
    assert tuple(out) == (n, float(sum(i % 97 for i in range(n))), n - 1)
    err = records.parse_errors(df).first()
    assert (err.n_reports, err.parse_error) == (n, False)
    # damage after many reports keeps those before it
    cut = spark.createDataFrame([(1, record_line(serving="c1", payload=f"[{body};x;7|"))], "id int, value string")
    assert records.reports(cut).where("parse_error").count() == n


def test_plans_split_a_record_once(spark):
    """One split of the line per record in the plans of field statistics and synthetic pairs."""
    import contextlib
    import io

    from radiolens.operators import moments

    df = spark.createDataFrame([("a",)], "value string").repartition(2)
    for plan in (moments.default_field_stats(df), pairs.record_pairs(df, fmt="synthetic")):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            plan.explain("formatted")
        assert text.getvalue().count("split(") == 1


def test_payload_is_cut_with_one_split(spark):
    """The line is split once, at the first ``[``; a record is well-formed if that comes before the first ``|``."""
    lines = ["6;a[1;b|", "6;a[1;b", "6;a|[1;b|", "6;a|", "6;a", "", "[|", "[", "|", "x[1[2|3[4|", "x[;;|", "x[|y|", "é;ü[1;ß|", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    got = D.payload_columns(df, "value", "i")
    assert got.columns == ["i", "_has", "_tokens"]

    def want(v):
        if v is None:
            return None, None
        p, q = v.find("["), v.find("|")
        return p >= 0, v[p + 1:q].split(";") if 0 <= p < q else None

    assert [(r._has, r._tokens) for r in got.orderBy("i").collect()] == [want(v) for v in lines]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("substring_index(") == 1 and "substring_index(_rest" in plan
