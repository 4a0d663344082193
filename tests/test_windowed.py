"""End to end: record files of a window -> statistics -> outputs -> graph."""

import os

from conftest import record_line
from radiolens.operators import sinks
from radiolens.plans import windowed


def test_windowed_end_to_end(spark, tmp_dir):
    src = f"{tmp_dir}/records"
    os.makedirs(src)
    files = {
        "2031-05-09.06_41": ["[2;7;A;40;1;8;B;30;1|", "[2;7;A;44;1;8;B;34;1|"],
        "2031-05-09.06_43": ["[1;7;A;42;1|"],
        "2031-05-09.06_50": ["[2;7;A;1;1;8;C;1;1|"],          # outside the window
    }
    for name, payloads in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(record_line(serving="A", payload=p) for p in payloads) + "\n")
    stats = windowed.windowed_cell_statistics(spark, src, "2031-05-09.06_41", 2)
    got = [tuple(r) for r in stats.collect()]
    assert got == [("A", "A", 42.0, 42.0, 8.0 / 3, 8.0 / 3, 8.0 / 3, 3),
                   ("A", "B", 42.0, 32.0, 4.0, 4.0, 4.0, 2)]
    windowed.write_outputs(stats, f"{tmp_dir}/out", case_id=3, rnp_id=4, table=f"{tmp_dir}/table")
    report = spark.read.text(f"{tmp_dir}/out/report").collect()
    assert len(report) == 2 and report[0].value.startswith("A                 A")
    assert spark.read.text(f"{tmp_dir}/out/tuples").count() == 10
    assert sinks.read_long_table(spark, f"{tmp_dir}/table").count() == 10
    e, comp, summary, counts = windowed.interference_clusters(stats)
    assert [(r.src, r.dst) for r in e.collect()] == [("A", "B")]
    assert {r.metric: r.value for r in counts.collect()} == {"nodes": 2, "edges": 1, "components": 1}


def test_synthetic_dispatch(spark, tmp_dir):
    src = f"{tmp_dir}/syn"
    os.makedirs(src)
    with open(os.path.join(src, "2031-05-09.06_41"), "w") as f:
        f.write("X:1,0,0,2,X:1,-100.0,X:2,-110.0\n")
    stats = windowed.windowed_cell_statistics(spark, src, "2031-05-09.06_41", 0, fmt="synthetic")
    assert [(r.neighbor_cell, r.mean_s, r.mean_n) for r in stats.collect()] == \
        [("X:1", 40.0, 40.0), ("X:2", 40.0, 30.0)]


def test_damage_counted_with_the_statistics(spark, tmp_dir):
    """Per file: its records and the damaged ones, each once however many reports are bad; the statistics
    are those of the plain job."""
    src = f"{tmp_dir}/records"
    os.makedirs(src)
    files = {
        "2031-05-09.06_41": ["[2;7;A;40;1;8;B;30;1|", "[1;7;A;4x;1;1;8;A;5x;1|", "|", "[1;7;A;44;1"],
        "2031-05-09.06_43": ["[1;7;A;42;1;x|", "[1;7;A;43;1|", "[0|"],
        "2031-05-09.06_50": ["[1;7;A;4x;1|"],          # outside the window
    }
    for name, payloads in files.items():
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(record_line(serving="A", payload=p) for p in payloads) + "\n")
    for missing in ("drop", "sentinel", "zero"):
        stats, damage = windowed.windowed_with_damage(spark, src, "2031-05-09.06_41", 2, missing_serving=missing)
        plain = windowed.windowed_cell_statistics(spark, src, "2031-05-09.06_41", 2, missing_serving=missing)
        assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, plain.collect()))
        assert sorted((r.file_ts.minute, r.records, r.damaged) for r in damage.collect()) == [(41, 4, 2), (43, 3, 1)]


def test_command_line(spark, tmp_dir):
    from radiolens.__main__ import main

    src = f"{tmp_dir}/records"
    os.makedirs(src)
    with open(os.path.join(src, "2031-05-09.06_41"), "w") as f:
        f.write("\n".join(record_line(serving="A", payload=p) for p in ("[2;7;A;40;1;8;B;30;1|", "[1;7;A;4x;1|")) + "\n")
    main([src, "2031-05-09.06_41", "0", "--out", f"{tmp_dir}/out", "--table", f"{tmp_dir}/table", "--case", "2"])
    assert spark.read.text(f"{tmp_dir}/out/report").count() == 2
    damage = spark.read.option("header", True).csv(f"{tmp_dir}/out/damage").collect()
    assert [(r.records, r.damaged) for r in damage] == [("2", "1")]
    assert {r.case_id for r in sinks.read_long_table(spark, f"{tmp_dir}/table").collect()} == {2}
