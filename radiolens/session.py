"""Session helpers: a local session for tests and benches, and the shared
folder used to cut lineage and to stage written tables.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names
(HDFS, S3, ...).  A session that names none works only on a local master.
"""

from __future__ import annotations

import contextlib
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "radiolens") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: keep post-shuffle partitions small enough that
        # every core gets a share of the CPU-heavy decode
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session: the one ``spark.checkpoint.dir`` names,
    or the folder set with ``setCheckpointDir``.

    With neither, a cluster session is an error: a folder of the driver's
    machine is not seen by executors.  A ``local`` master has one machine and
    one process, so a fresh folder of its own is named there.
    """
    sc = spark.sparkContext
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        # setCheckpointDir appends a random sub-folder; stage next to it.
        return current.rstrip("/").rsplit("/", 1)[0]
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = f"{tempfile.gettempdir()}/radiolens-{uuid.uuid4().hex[:12]}"
    sc.setCheckpointDir(own)
    return own


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one written table."""
    return f"{shared_dir(spark)}/radiolens-staging/{name}-{uuid.uuid4().hex[:12]}"


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session that is put back afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def drop_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of finished jobs removed now: Spark removes them when the driver's JVM has collected
    what refers to them, which can be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
