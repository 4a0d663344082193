"""Incremental pair moments on a stream of record files.

Records land as text files; each micro-batch is decoded with the same
in-row expressions as the batch path, and only the mergeable state of a pair
(``moments.state_columns``) is kept, by event-time window (``run_available``) or by the
time of the file that a record came in (``run_file_partials``).

State is bounded by a watermark: a window (or file time) whose end lies behind it
leaves the state store (RocksDB, so state need not fit in memory), and rows for it that come
later are ignored.  Spark judges an input row against the
watermark of the previous micro-batch, so a row is dropped at the latest
one batch after it became late; rows within the delay are always kept.  What was
dropped and how much state is held is in the query's progress (``progress``).

The sink is a parquet log written by ``foreachBatch`` in update mode: every
batch writes the groups it changed into its own ``batch_id=N`` folder
(overwritten, so a re-run batch is idempotent), and the current value of a
group is its latest version (``latest``).  Nothing is collected on the
driver and the log survives a restart from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import layout as L
from ..operators import moments, pairs, records
from ..session import drop_shuffles
from ..sources.records import name_time

KEYS = ["window_start", "window_end", "serving_cell", "neighbor_cell"]
FILE_KEYS = ["file_ts", "serving_cell", "neighbor_cell"]
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: a batch stores what it changed, not all its state, and the state of the last batches only
STORED_STATE = {STATE_STORE: ROCKSDB, "spark.sql.streaming.minBatchesToRetain": "2",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
                "spark.sql.streaming.stateStore.compression.codec": "zstd",
                "spark.sql.streaming.stateStore.rocksdb.compression": "zstd"}


def stream_pairs(stream_records: DataFrame, *, value: str = "value") -> DataFrame:
    """Decode streamed records to pairs with ``event_ts``."""
    fields = D.field_array(F.col(value), L.FIELD_MAP["time_ms"][0])     # the last field that is read
    rec = records.event_time(stream_records.withColumn("fields", fields))
    return pairs.serving_pairs(rec.drop("fields"), keep=("event_ts",))


def stream_pair_sums(stream_pairs_df: DataFrame, *, window: str, watermark: str) -> DataFrame:
    """Per tumbling event-time window and pair: the mergeable state (A2)."""
    # The window must be a grouping expression over the watermarked column
    # itself; only then can Spark drop late rows and evict closed windows.
    p = stream_pairs_df.withWatermark("event_ts", watermark)
    sums = p.groupBy(F.window("event_ts", window).alias("window"), *moments.PAIR_KEYS).agg(*moments.state_columns())
    return sums.select(F.col("window.start").alias("window_start"),
                       F.col("window.end").alias("window_end"),
                       "serving_cell", "neighbor_cell", *moments.STATE_COLS)


def stream_file_partials(stream: DataFrame, *, since: str | None, watermark: str, value: str = "value") -> DataFrame:
    """Per file time and pair: the mergeable state of the records of the files named so.  ``since``
    (``yyyy-MM-dd.HH_mm``) leaves out files of an earlier time, and so do names without a time."""
    rec = stream.select(value, name_time(F.col("_metadata.file_name")).alias("file_ts"))
    rec = rec.where(F.col("file_ts").isNotNull() if since is None else F.col("file_ts") >= name_time(F.lit(since)))
    p = pairs.serving_pairs(rec.withWatermark("file_ts", watermark), value=value, keep=("file_ts",))
    return p.groupBy(*FILE_KEYS).agg(*moments.state_columns())


def latest(log: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Current value per group from the update log (latest batch
    wins; a batch has a group once); a partial aggregation, no group is collected.  Each column
    has its own aggregate of numbers: none is sorted for, and those nobody reads are left out."""
    keys = keys or KEYS
    cols = [c for c in log.columns if c not in keys and c != "batch_id"]
    return log.groupBy(*keys).agg(*[F.max_by(c, "batch_id").alias(c) for c in cols])


def read_log(spark: SparkSession, out: str, keys: list[str] | None = None) -> DataFrame:
    """Current values of the update log under ``out``."""
    log = spark.read.parquet(f"{out}/log").withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return latest(log, keys)


def progress(query) -> list[dict]:
    """Of each reported micro-batch that had a watermark or state: its number, the watermark, rows read,
    groups held in the state store afterwards, and groups of rows dropped as late."""
    out = []
    for p in query.recentProgress:
        state = p["stateOperators"][0] if p["stateOperators"] else None
        if state is not None:
            out.append({"batch_id": p["batchId"], "watermark": p["eventTime"].get("watermark"),
                        "input_rows": p["numInputRows"], "state_rows": state["numRowsTotal"],
                        "late_groups": state["numRowsDroppedByWatermark"]})
    return out


def _run(spark: SparkSession, sums: DataFrame, out: str, report: list | None) -> None:
    # an empty seed batch, so the log is readable even when no batch runs
    spark.createDataFrame([], sums.schema).write.mode("overwrite") \
        .parquet(f"{out}/log/batch_id=-1")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # one folder per batch, overwritten: a batch re-run after a failure
        # (foreachBatch is at-least-once) replaces its own output
        drop_shuffles(spark)      # those of the batches before
        batch.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/log/batch_id={batch_id}")

    before = {k: spark.conf.get(k, None) for k in STORED_STATE}
    for k, v in STORED_STATE.items():
        spark.conf.set(k, v)      # read once, when the query starts
    try:
        q = (sums.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", f"{out}/_checkpoint")
             .trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    if report is not None:
        report.extend(progress(q))


def _files(spark: SparkSession, src: str, max_files_per_trigger: int) -> DataFrame:
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files_per_trigger).load(src)


def run_available(spark: SparkSession, src: str, out: str, *, window: str, watermark: str,
                  max_files_per_trigger: int = 1, report: list | None = None) -> DataFrame:
    """Process every file now in ``src`` (trigger ``availableNow``), oldest first, into
    the update log at ``out``; return the current state per event-time window and pair.
    ``report`` receives the ``progress`` of the run."""
    stream = _files(spark, src, max_files_per_trigger)
    _run(spark, stream_pair_sums(stream_pairs(stream), window=window, watermark=watermark), out, report)
    return read_log(spark, out)


def run_file_partials(spark: SparkSession, src: str, out: str, *, since: str | None = None,
                      watermark: str = "1 day", max_files_per_trigger: int = 1,
                      report: list | None = None) -> DataFrame:
    """As ``run_available``, by the time in the names of the files: the state per file time and
    pair, which ``plans.partial_store.united`` joins to stored batch partials."""
    stream = _files(spark, src, max_files_per_trigger)
    _run(spark, stream_file_partials(stream, since=since, watermark=watermark), out, report)
    return read_log(spark, out, FILE_KEYS)
