"""The stream's per-window sums equal the batch computation."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from radiolens.functions import decode as D
from radiolens.operators import moments, pairs, records
from radiolens.sources import render
from radiolens.streaming import pair_sums


def test_stream_equals_batch(spark, tmp_dir):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    rec = render.call_records(li).select("value")
    src = f"{tmp_dir}/in"
    rec.repartition(4).write.text(src)
    out = pair_sums.run_available(spark, src, f"{tmp_dir}/out", window="1 hour",
                                  watermark="100000 days", max_files_per_trigger=1)
    got = {tuple(r) for r in out.drop("window_end", *moments.CENTRED_COLS).collect()}
    # batch: same decode, same windows
    b = records.event_time(rec.withColumn("fields", D.field_array(F.col("value"))))
    p = pairs.serving_pairs(b.drop("fields"), keep=("event_ts",))
    p = p.withColumn("window", F.window("event_ts", "1 hour"))
    batch = moments.pair_partials(p, by=["window"]).select(
        F.col("window.start").alias("window_start"), "serving_cell", "neighbor_cell",
        *moments.SUM_COLS)
    assert got == {tuple(r) for r in batch.collect()}
    assert len(got) > 0


def test_watermark_drops_late_rows(spark, tmp_dir):
    """Rows older than the watermark are ignored; earlier windows stay."""
    import os
    import time

    from conftest import record_line

    def rec(day, ms, rsrp):
        return record_line(serving="A", payload=f"[1;7;A;{rsrp};1|",
                           fields={5: day, 6: "2014", 8: str(ms)})

    src = f"{tmp_dir}/in"
    os.makedirs(src)
    # Spark judges late input against the previous batch's watermark, so
    # the late row comes two batches after the one that moved the watermark.
    batches = [
        [rec("03:26", 61_200_000, 40)],            # 17:00 on day 26
        [rec("03:27", 61_200_000, 42)],            # a day later: watermark moves past day 26
        [rec("03:27", 63_000_000, 43)],            # 17:30 on day 27, same window
        [rec("03:26", 61_300_000, 44)],            # late for the day-26 window: dropped
    ]
    for i, lines in enumerate(batches):
        with open(os.path.join(src, f"part-{i}.txt"), "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(os.path.join(src, f"part-{i}.txt"), (1_000_000 + i, 1_000_000 + i))
        time.sleep(0.01)
    seen = []
    out = pair_sums.run_available(spark, src, f"{tmp_dir}/out", window="1 hour",
                                  watermark="1 hour", max_files_per_trigger=1, report=seen)
    # the late row is reported, and the closed window has left the state store
    assert sum(p["late_groups"] for p in seen) == 1
    assert max(p["state_rows"] for p in seen) == 2 and seen[-1]["state_rows"] == 1
    got = sorted((r.window_start.day, r.cnt, r.sum_s) for r in out.collect())
    assert got == [(26, 1, 40.0), (27, 2, 85.0)]


def test_stream_without_input(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/in")
    out = pair_sums.run_available(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", window="1 hour",
                                  watermark="1 hour")
    assert out.count() == 0


def test_state_of_large_values(spark, tmp_dir):
    """Variance of 1e9 and 1e9 + 1 in turn, over several batches."""
    from conftest import record_line

    src = f"{tmp_dir}/in"
    lines = [record_line(serving="A", payload=f"[2;7;A;{1e9 + i % 2:.1f};1;7;B;{1e9 + i % 2:.1f};1|",
                         fields={5: "03:26", 6: "2014", 8: str(61_200_000 + i)}) for i in range(4000)]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(4).write.text(src)
    out = pair_sums.run_available(spark, src, f"{tmp_dir}/out", window="1 hour", watermark="1 day")
    got = moments.finalize_partials(out.drop("window_start", "window_end")).collect()
    assert len(got) == 2 and all(r.cnt == 4000 for r in got)
    assert all(abs(x - 0.25) < 1e-6 for r in got for x in (r.var_s, r.cov_sn, r.var_n))


def _land(folder, name, lines, at):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(os.path.join(folder, name), (at, at))


def test_store_and_stream_count_each_file_once(spark, tmp_dir):
    """Batch and stream overlap, the stream restarts, a file changes: the same as one batch over all."""
    import random

    from conftest import record_line
    from radiolens.plans import partial_store

    rnd = random.Random(3)

    def lines(n):
        return [record_line(serving=rnd.choice("AB"), payload=f"[2;7;A;{rnd.randint(0, 97)};1;7;B;{rnd.randint(0, 97)};1|")
                for _ in range(n)]

    src, store, out = f"{tmp_dir}/in", f"{tmp_dir}/store", f"{tmp_dir}/out"
    names = [f"2031-05-{d:02d}.06_{m}" for d in (8, 9) for m in ("00", "05", "10")]
    for i, name in enumerate(names[:4]):
        _land(src, name, lines(20), 1_000_000 + i)
    _land(src, "notes.txt", ["no record file"], 1_000_000)
    boundary = "2031-05-08.06_10"
    assert partial_store.update(spark, src, store, before=boundary) == 2
    options = {"since": "2031-05-08.06_05", "watermark": "7 days"}
    pair_sums.run_file_partials(spark, src, out, **options)
    for i, name in enumerate(names[4:]):
        _land(src, name, lines(20), 1_000_100 + i)
    streamed = pair_sums.run_file_partials(spark, src, out, **options)

    def one_batch():
        rec = spark.read.text([f"{src}/{n}" for n in names])
        return {tuple(r) for r in moments.pair_stats(pairs.serving_pairs(rec)).collect()}

    for at in (boundary, "2031-05-09.06_05"):
        partial_store.update(spark, src, store, before=at)
        united = partial_store.united(partial_store.partials(spark, store), streamed, at)
        assert {tuple(r) for r in united.collect()} == one_batch()
    # nothing new: nothing read
    assert partial_store.update(spark, src, store, before="2031-05-09.06_05") == 0
    # a file of unchanged size and time is not read again, a changed one is
    with open(f"{src}/{names[0]}") as f:
        size = len(f.read())
    before = {tuple(r) for r in partial_store.statistics(spark, store).collect()}
    _land(src, names[0], ["x" * (size - 1)], 1_000_000)
    assert partial_store.update(spark, src, store, before=at) == 0
    assert {tuple(r) for r in partial_store.statistics(spark, store).collect()} == before
    _land(src, names[0], lines(7), 1_000_500)
    assert partial_store.update(spark, src, store) == 3         # that one and two beyond the boundary
    assert {tuple(r) for r in partial_store.statistics(spark, store).collect()} == one_batch()
    day = {tuple(r) for r in partial_store.statistics(spark, store, start="2031-05-08.06_00", minutes=60).collect()}
    rec = spark.read.text([f"{src}/{n}" for n in names[:3]])
    assert day == {tuple(r) for r in moments.pair_stats(pairs.serving_pairs(rec)).collect()}


def test_failed_store_run_changes_nothing(spark, tmp_dir, monkeypatch):
    """A run that dies before its ledger leaves the old result, and the next run does its work."""
    import pytest
    from conftest import record_line
    from radiolens.plans import partial_store

    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    old = [record_line(serving="A", payload=f"[1;7;A;{v};1|") for v in (10, 20)]
    _land(src, "2031-05-08.06_00", old, 1_000_000)
    partial_store.update(spark, src, store)
    _land(src, "2031-05-08.06_00", [old[0]], 1_000_001)
    real = spark.createDataFrame

    def dies(data, schema=None, *a, **kw):
        if schema == partial_store.LEDGER and data:
            raise OSError("lost")
        return real(data, schema, *a, **kw)

    monkeypatch.setattr(spark, "createDataFrame", dies)
    with pytest.raises(OSError):
        partial_store.update(spark, src, store)
    monkeypatch.undo()
    assert [r.cnt for r in partial_store.statistics(spark, store).collect()] == [2]
    assert partial_store.update(spark, src, store) == 1
    assert [r.cnt for r in partial_store.statistics(spark, store).collect()] == [1]
