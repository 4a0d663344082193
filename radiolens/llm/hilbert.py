"""Sharding along a Hilbert curve.

Several metadata columns are quantised to ``BITS`` bits each, which gives every
row a cell of a fixed grid; the cells are numbered along a Hilbert curve, the rows
sorted by that number, and the order cut into shards of equal row counts.  Files
written per shard then cover small boxes of the metadata space, so a reader can
skip files on any of the columns.

The grid has ``2 ** (BITS * dimensions)`` cells whatever the table's size, and
only cell counts meet in one place.  Rows get their rank from three sums: the
rows of earlier cells, of earlier buckets of their cell, and their place in their
bucket.  Buckets split by identifier hash, so a cell or a group of equal texts
with a third of all rows is many tasks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BITS = 5
CRC_BUCKETS, ID_BUCKETS = 16, 64


def hilbert_index(coords: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``coords`` (n points, d axes).

    Works from the highest bit down: each axis in turn either inverts the lower
    bits of the first axis or swaps them with its own, which turns the cube's
    sub-cubes so that neighbours on the curve touch; a Gray-code pass then
    yields the index bits, one per axis and level.
    """
    x = coords.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(d):
            high = (x[axis] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= np.where(high, low, swap)
            x[axis] ^= swap if axis else 0
    for axis in range(1, d):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(len(coords), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros(len(coords), np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(d):
            out = (out << 1) | ((x[axis] >> level) & 1)
    return out


def _quantised(rows: DataFrame, name: str, bits: int) -> DataFrame:
    """Replace column ``name`` by its equi-depth quantum: the share of rows with a smaller
    value, in ``2 ** bits`` steps; nulls come last."""
    values = rows.groupBy(name).agg(F.count("*").alias("_c"))
    before = Window.orderBy(F.col(name).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    values = values.select(F.col(name).alias("_v"), F.least(
        F.lit((1 << bits) - 1),
        F.floor(F.coalesce(F.sum("_c").over(before), F.lit(0)) * (1 << bits) / F.sum("_c").over(every))
    ).cast("int").alias("_q"))
    return (rows.join(values, F.col(name).eqNullSafe(F.col("_v")), "left")
            .drop(name, "_v").withColumnRenamed("_q", name))


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text",
          dims: tuple[str, ...] = ("source", "lang"), bits: int = BITS) -> DataFrame:
    """One row per input row: id, ``size``, ``text_crc32``, ``shard``, ``slot``, ``curve``.

    The axes are the columns ``dims`` (few distinct values, any type) and the logarithm of
    the text's size.  Shards' row counts differ by one at most.  A null or empty text
    has size 8; null metadata is the last quantum; equal rows lie side by side in any
    order, which changes no value.  Fewer rows than shards leave the last shards empty.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + 8).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"),
        *[F.col(c).alias(f"_d{i}") for i, c in enumerate(dims)])
    rows = staged(rows, "shard-rows")
    axes = [f"_d{i}" for i in range(len(dims))]
    for a in axes:
        rows = _quantised(rows, a, bits)
    rows = rows.withColumn("_dz", F.least(F.lit((1 << bits) - 1), F.floor(F.log2(F.col("_size").cast("double")))).cast("int"))
    axes.append("_dz")
    rows = rows.withColumns({
        "_crcb": F.pmod(F.col("_crc"), F.lit(CRC_BUCKETS)).cast("int"),
        "_idb": F.pmod(F.xxhash64("_id"), F.lit(ID_BUCKETS)).cast("int")})
    rows = staged(rows, "shard-cells")

    @F.pandas_udf("long")
    def curve(*c: pd.Series) -> pd.Series:
        return pd.Series(hilbert_index(np.stack([s.to_numpy() for s in c], axis=1), bits))

    cells = rows.groupBy(*axes).agg(F.count("*").alias("_n"))   # at most the cells of the grid
    cells = staged(cells.withColumn("_curve", curve(*axes)), "shard-curve")
    upto = Window.orderBy("_curve").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*axes, "_curve", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_base"),
                         F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("_total"))
    part = ["_crcb", "_idb"]
    buckets = rows.groupBy(*axes, *part).agg(F.count("*").alias("_n"))
    inner = Window.partitionBy(*axes).orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*axes, *part, F.coalesce(F.sum("_n").over(inner), F.lit(0)).alias("_skip"))
    place = F.row_number().over(Window.partitionBy(*axes, *part).orderBy("_crc", "_id", "_size"))
    ranked = (rows.withColumn("_place", place).join(buckets, [*axes, *part]).join(cells, axes)
              .withColumn("_rank", F.col("_base") + F.col("_skip") + F.col("_place") - 1))
    # shard of rank r among n rows: floor(r * shards / n); its first rank: ceil(shard * n / shards)
    ranked = ranked.withColumn("shard", F.expr(f"cast((_rank * {n_shards}) div _total as int)"))
    return ranked.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard",
        F.expr(f"_rank - ((shard * _total + {n_shards - 1}) div {n_shards})").alias("slot"),
        F.col("_curve").alias("curve"))
