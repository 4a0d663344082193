"""Windowed cell statistics end to end: select the record files of a time
window, decode them, compute the pair statistics, and produce the outputs
(text report, tuple export, replaceable long table, interference graph).

The files are pruned by name before any is opened, and decoded once: the
statistics are stored in the shared folder and every output reads that table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import layout as L
from ..operators import graph, moments, pairs, sinks
from ..session import staging_path
from ..sources import records as rsrc


def windowed_cell_statistics(spark: SparkSession, path: str | list[str], start: str,
                             minutes: int, *, fmt: str = "real", sort: bool = True,
                             time_from: str = "file_name", **options) -> DataFrame:
    """Pair statistics over the files whose name time lies in
    ``[start, start + minutes]``.  ``options`` go to the pair decoder
    (``missing_serving``, ``which``, ``serving_field``, or ``offset`` /
    ``clamp`` for the synthetic format).  The statistics are computed here,
    once, and stored; the result reads the stored table."""
    read = rsrc.read_synthetic if fmt == "synthetic" else rsrc.read_records
    recs = read(spark, path, start=start, minutes=minutes, time_from=time_from)
    stats = moments.pair_stats(pairs.record_pairs(recs, fmt=fmt, **options))
    stored = staging_path(spark, "cell-statistics")
    stats.write.parquet(stored)
    stats = spark.read.schema(stats.schema).parquet(stored)
    return stats.orderBy(*moments.PAIR_KEYS) if sort else stats


def windowed_with_damage(spark: SparkSession, path: str | list[str], start: str, minutes: int, *,
                         time_from: str = "file_name", **options) -> tuple[DataFrame, DataFrame]:
    """``(statistics, damage)`` over the files of a window of real records: the pair statistics, and per file time
    its ``records`` and how many of them are ``damaged``.  Both come from one scan, one decode and one
    aggregation, stored once."""
    recs = rsrc.read_records(spark, path, start=start, minutes=minutes, time_from=time_from)
    rows = pairs.pairs_and_damage(recs, by="file_ts", **options)
    stored = staging_path(spark, "cell-statistics")
    (rows.groupBy("file_ts", *moments.PAIR_KEYS)
     .agg(*moments.state_columns(), F.sum("records").alias("records"), F.sum("damaged").alias("damaged"))
     .write.parquet(stored))
    table = spark.read.parquet(stored)
    # files of the window have a time, so rows without one are pairs
    return (moments.finalize_partials(table.where(F.col("file_ts").isNull())),
            table.where(F.col("file_ts").isNotNull()).select("file_ts", "records", "damaged"))


def write_outputs(stats: DataFrame, out_dir: str, *, case_id: int, rnp_id: int,
                  table: str | None = None, overwrite: bool = True) -> None:
    """Text report and tuple export under ``out_dir``; with ``table``, the
    long rows of ``(case_id, rnp_id)`` replace that key in the table."""
    sinks.report_lines(stats).select("line").write.mode("overwrite").text(f"{out_dir}/report")
    long_df = sinks.to_long(stats, case_id, rnp_id)
    sinks.tuple_lines(long_df).write.mode("overwrite").text(f"{out_dir}/tuples")
    if table is not None:
        sinks.replace_case(long_df, table, case_id, rnp_id, overwrite=overwrite)


def interference_clusters(stats: DataFrame, *, threshold: float = L.EDGE_THRESHOLD):
    """Edges, components and per-component counts of the statistics."""
    e = graph.interference_edges(stats, threshold=threshold)
    n = graph.nodes(stats)
    comp = graph.components(n, e)
    return e, comp, graph.component_summary(comp, e), graph.graph_counts(n, e, comp)
