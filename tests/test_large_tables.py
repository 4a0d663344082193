"""Steps that were rewritten for large tables give what the plainer ones gave."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL, record_line
from radiolens import session
from radiolens.functions import decode as D
from radiolens.operators import records
from radiolens.plans import partial_store, queries
from radiolens.sources import landing, render
from radiolens.streaming import pair_sums


def test_walk_without_fold_equals_fold(spark):
    one = "1;7;A;30;1"
    payloads = ["", "x", "-1", "0", "0;0;0;0;0;0", one, ";".join([one] * 3), ";".join([one] * 4), ";".join([one] * 9),
                f"{one};x;{one}", f"{one};-2;{one}", "999999999;0;c;5;", f"{one};{one};1;7;A", ";".join([one] * 4) + ";x",
                ";".join([one] * 4) + ";1;7;A;3;1", "1;7;A;30;1;"]
    df = spark.createDataFrame([(p,) for p in payloads], "p string").select("p", F.split("p", ";", -1).alias("_tokens"))
    rows = D.walked(df.withColumn("_all", D.report_walk(F.col("_tokens")))).collect()
    assert [(r.p, r._walk.ok, r._walk.spans) for r in rows] == [(r.p, r._all.ok, r._all.spans) for r in rows]


def test_last_of_short_and_long_reports(spark):
    def last(n):
        cells = [f"C{i % (n // 2 + 1)}" for i in range(n)]
        text = ";".join(f"{i};{c};{i}.5;" for i, c in enumerate(cells))
        df = spark.createDataFrame([(record_line(payload=f"[{n};{text}|"),)], "value string")
        got = [(m.cell, m.rsrp) for m in records.reports(df).first().meas]
        want = {c: i + 0.5 for i, c in enumerate(cells)}
        return got == sorted(want.items(), key=lambda x: x[1])

    assert all(last(n) for n in (1, 3, D.SHORT_REPORT, D.SHORT_REPORT + 1, 80))


def test_landed_files_are_compressed(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("file_month", render.file_month(F.col("l_shipdate")))
    rec = render.call_records(li, keep=("file_month",))
    names = landing.land(rec, f"{tmp_dir}/in", key="file_month")
    assert names and all(n.endswith(".gz") for n in names)
    chars = rec.agg(F.sum(F.length("value"))).first()[0]
    assert sum(os.path.getsize(f"{tmp_dir}/in/{n}") for n in names) * 4 < chars
    assert sorted(r[0] for r in spark.read.text(f"{tmp_dir}/in").collect()) == sorted(r[0] for r in rec.select("value").collect())


def test_large_splits_are_spread(spark, monkeypatch):
    monkeypatch.setattr(queries, "TASK_ROWS", 1000)
    df = spark.range(0, 10_000, 1, 5)
    assert queries._spread(df).rdd.getNumPartitions() == 10
    assert sorted(r.id for r in queries._spread(df).collect()) == list(range(10_000))
    small = spark.range(0, 3000, 1, 5)
    assert queries._spread(small).rdd.getNumPartitions() == 5


def test_state_settings_are_put_back(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    before = {k: spark.conf.get(k, None) for k in pair_sums.STORED_STATE}
    pair_sums.run_available(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", window="1 hour", watermark="1 hour")
    assert {k: spark.conf.get(k, None) for k in pair_sums.STORED_STATE} == before


def test_landing_moves_rows_and_renders_where_it_writes(spark, tmp_dir):
    """Rows are dealt and sorted before their lines are made, null and blank months included; the lines are those of rendering first."""
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").withColumn("file_month", F.when(F.col("l_orderkey") % 50 == 0, F.lit(None))
        .when(F.col("l_orderkey") % 50 == 1, F.lit("")).otherwise(render.file_month(F.col("l_shipdate"))))
    seen = []

    def lines(rows):
        seen.append(rows)
        return render.call_records(rows, keep=("file_month",))

    names = landing.land(li, f"{tmp_dir}/in", key="file_month", slices=3, render=lines, by=queries.ROW_KEY)
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [file_month" in plan and "RepartitionByExpression" in plan and "value" not in seen[0].columns
    assert not seen[0].schema["file_month"].nullable          # so the writer does not sort the lines again
    want = sorted((r.value, r.file_month) for r in render.call_records(li, keep=("file_month",)).where("file_month != ''").collect())
    got = spark.read.text(f"{tmp_dir}/in").select("value", F.substring_index(F.col("_metadata.file_name"), ".", 2).alias("m"))
    assert sorted((r.value, r.m) for r in got.collect()) == want
    # as before, rows without a month are landed under a name that readers pass over
    assert {n.split(".")[0] for n in names} == {m[:10] for _, m in want} | {landing.NO_KEY}


def test_log_of_a_stream_is_small_and_read_without_a_sort(spark, tmp_dir):
    rows = [("2031-05-09 00:00:00", "2031-05-09 01:00:00", "A", c, b, 1.0 * b, 2.0, 3.0, 4.0, 5.0, 0.0, 0.0, 0.0, True)
            for b in (0, 1, 10) for c in "BC"]
    log = spark.createDataFrame(rows, "window_start string, window_end string, serving_cell string, neighbor_cell string, batch_id long, "
                                      "sum_s double, sum_n double, sum_ss double, sum_sn double, sum_nn double, m2_s double, "
                                      "c_sn double, m2_n double, quarters boolean")
    newest = pair_sums.latest(log)
    assert sorted((r.neighbor_cell, r.sum_s, r.quarters) for r in newest.collect()) == [("B", 10.0, True), ("C", 10.0, True)]
    plan = newest.select("serving_cell", "sum_s")._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan and "sum_nn" not in plan.split("Scan")[0]


def test_shuffles_of_finished_jobs_go(spark, tmp_dir, monkeypatch):
    """Their files go when asked for, not when the driver happens to collect garbage; a stream asks in every batch."""
    def held():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return blocks.mkString(" ").count("shuffle_")

    session.drop_shuffles(spark)
    for n in range(5):
        spark.range(1000).repartition(7).write.parquet(f"{tmp_dir}/rows{n}")
    most = held()
    assert most > 0
    session.drop_shuffles(spark)
    until = time.time() + 20
    while held() >= most and time.time() < until:
        time.sleep(0.1)
    assert held() < most
    asked = []
    monkeypatch.setattr(pair_sums, "drop_shuffles", asked.append)
    lines = [record_line(serving="A", payload="[1;7;A;40;1|", fields={5: "03:26", 6: "2014", 8: "61200000"})] * 3
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(f"{tmp_dir}/in")
    pair_sums.run_available(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", window="1 hour", watermark="1 day")
    assert len(asked) >= 3


def test_store_writes_its_rows_once(spark, tmp_dir, monkeypatch):
    """A run of the store writes its rows in one job, old rows of the same day with them, and nothing beside the store."""
    made = []
    monkeypatch.setattr(session, "staging_path", lambda *a: made.append(a))
    monkeypatch.setattr(partial_store, "staging_path", lambda *a: made.append(a), raising=False)
    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    os.makedirs(src)
    for n, value in enumerate((10, 20, 40)):
        with open(f"{src}/2031-05-08.06_0{n}", "w") as f:
            f.write(record_line(serving="A", payload=f"[1;7;A;{value};1|") + "\n")
        assert partial_store.update(spark, src, store) == 1
    assert not made
    row = partial_store.statistics(spark, store).first()
    assert (row.cnt, row.mean_s) == (3, 70 / 3)
    assert partial_store.partials(spark, store).count() == 3
