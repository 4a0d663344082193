"""Command line: windowed cell statistics over a directory of record files.

    spark-submit -m radiolens DIR START MINUTES --out OUT [--case 1 --rnp 1]
        [--table TABLE] [--append] [--synthetic] [--threshold 0.09]

START is ``yyyy-mm-dd.HH_MM``; files whose name time lies in
[START, START + MINUTES] are read.  Writes the text report, the tuple export
and the component summary under OUT, with the damaged records per file of real records,
replaces the (case, rnp) rows of TABLE, and prints the graph counts.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions import layout as L
from .plans import windowed


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="radiolens")
    ap.add_argument("directory")
    ap.add_argument("start", help="yyyy-mm-dd.HH_MM")
    ap.add_argument("minutes", type=int)
    ap.add_argument("--out", required=True)
    ap.add_argument("--case", type=int, default=1)
    ap.add_argument("--rnp", type=int, default=1)
    ap.add_argument("--table")
    ap.add_argument("--append", action="store_true", help="keep the key's old rows")
    ap.add_argument("--synthetic", action="store_true", help="records in the ',' format")
    ap.add_argument("--threshold", type=float, default=L.EDGE_THRESHOLD)
    a = ap.parse_args(argv)

    spark = SparkSession.builder.appName("radiolens").getOrCreate()
    if a.synthetic:
        stats = windowed.windowed_cell_statistics(spark, a.directory, a.start, a.minutes, fmt="synthetic")
    else:
        stats, damage = windowed.windowed_with_damage(spark, a.directory, a.start, a.minutes)
        damage.orderBy("file_ts").write.mode("overwrite").csv(f"{a.out}/damage", header=True)
    windowed.write_outputs(stats, a.out, case_id=a.case, rnp_id=a.rnp, table=a.table,
                           overwrite=not a.append)
    _, _, summary, counts = windowed.interference_clusters(stats, threshold=a.threshold)
    summary.orderBy("component").write.mode("overwrite").csv(f"{a.out}/components", header=True)
    counts.show()


if __name__ == "__main__":
    main()
