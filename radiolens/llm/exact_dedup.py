"""Exact dedup by a tree merge of digest runs.

Each row goes to one of ``FAN_IN ** ROUNDS`` runs by its identifier.  A run
holds one entry per text digest: the identifier it retains and how many rows
it stands for.  In every round ``FAN_IN`` runs merge into one (a grouped
aggregate on digest and run number, combined map-side), so no task ever
receives more than ``FAN_IN`` entries of a digest from the round before, however
many copies a text has.  The winners then travel the same tree downwards, and the
rows meet their winner on (digest, run), never on the digest alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_az, staged

FAN_IN, ROUNDS = 4, 3
#: a digest is verified at every level by the text's length and a second, independent hash
KEY = ["_sha", "_len", "_check"]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: str = "max") -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; null counts as
    empty.  ``keep`` names the identifier that stays, ``max`` or ``min``.  A null
    identifier is kept only by a group that has no other (``keep_id`` null);
    rows that repeat an identifier and text are each counted and each kept
    or dropped alike.  An empty table gives an empty result.
    """
    best = {"max": F.max, "min": F.min}[keep]
    text = lower_az(F.col(text_col))
    rows = staged(docs.select(F.col(id_col).alias("_id"), text.alias("_text")).select(
        "_id", F.unhex(F.sha2("_text", 256)).alias("_sha"),
        F.octet_length("_text").alias("_len"), F.xxhash64("_text").alias("_check"),
        F.pmod(F.xxhash64("_id"), F.lit(FAN_IN ** ROUNDS)).cast("int").alias("_run")), "digests")

    levels = [rows.groupBy(*KEY, "_run").agg(best("_id").alias("_keep"), F.count("*").alias("_n"))]
    for _ in range(ROUNDS):
        levels.append(levels[-1]
                      .withColumn("_run", F.floor(F.col("_run") / FAN_IN).cast("int"))
                      .groupBy(*KEY, "_run")
                      .agg(best("_keep").alias("_keep"), F.sum("_n").alias("_n")))

    won = levels[-1]
    for below in reversed(levels[:-1]):
        up = won.withColumnRenamed("_run", "_up")
        won = (below.select(*KEY, "_run", F.floor(F.col("_run") / FAN_IN).cast("int").alias("_up"))
               .join(up, [*KEY, "_up"]).drop("_up"))
    return rows.join(won, [*KEY, "_run"]).select(
        F.col("_id").alias(id_col), F.col("_keep").alias("keep_id"),
        F.col("_n").cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""
