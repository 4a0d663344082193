"""Line dedup by winnowing over line hashes.

A document is the sequence of its non-blank lines (compared without white space at
their ends).  A run of at least ``run`` lines that also starts earlier in
(identifier, line) order is deleted; blank lines stay.

Each window of ``run`` lines chooses its smallest line hash, so equal windows
choose equal fingerprints.  Only windows whose fingerprint occurs more than once can
be repeats; those join the first position of the same window, and adjoining
repeated windows extend one another both ways into maximal runs.  A fingerprint
or window that a third of all documents share is one partial sum per task,
and its occurrences are joined to a single first position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, staged

RUN = 2
TRIM = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashes(text: Column) -> Column:
    """Structs (line number from 0, hash) of the non-blank lines."""
    every = F.transform(_lines(text), lambda line, i: F.struct(
        i.alias("no"), F.when(F.btrim(line, F.lit(TRIM)) != "", F.xxhash64(F.btrim(line, F.lit(TRIM)))).alias("h")))
    return F.filter(every, lambda x: x["h"].isNotNull())


def _windows(lines: Column, run: int) -> Column:
    """Structs (place, fingerprint, window hash, line numbers) of every window."""
    return let(lines, lambda ls: F.when(F.size(ls) >= run, F.transform(
        F.sequence(F.lit(0), F.size(ls) - run),
        lambda i: F.struct(
            i.alias("at"),
            F.array_min(F.transform(F.slice(ls, i + 1, run), lambda x: x["h"])).alias("least"),
            F.xxhash64(*[F.get(ls, i + j)["h"] for j in range(run)]).alias("whole"),
            F.transform(F.slice(ls, i + 1, run), lambda x: x["no"]).alias("nos")))))


def repeated_lines(docs: DataFrame, id_col: str, text_col: str, run: int = RUN) -> DataFrame:
    """``_id``, ``_key``, ``_nos`` (line numbers to delete), ``_runs`` per affected document."""
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    # rows that repeat an identifier and text are one document here, and get one decision
    wins = staged(
        docs.select(F.col(id_col).alias("_id"), key.alias("_key"), _hashes(F.col(text_col)).alias("_l"))
        .select("_id", "_key", F.explode(_windows(F.col("_l"), run)).alias("w")).select("_id", "_key", "w.*").distinct(), "line-windows")
    often = (wins.groupBy("least").agg(F.count("*").alias("n")).where("n > 1").select("least"))
    place = F.struct(F.col("_id").isNull().alias("z"), "_id", "_key", "at")
    wins = staged(wins.join(often, "least", "left_semi").withColumn("_place", place), "line-candidates")
    first = (wins.groupBy("whole").agg(F.min("_place").alias("_first"), F.max("_place").alias("_last"))
             .where(F.col("_first") < F.col("_last")).drop("_last"))
    later = wins.join(first, "whole").where(F.col("_place") > F.col("_first"))
    gone = later.select("_id", "_key", "at", F.posexplode("nos").alias("j", "no")).select(
        "_id", "_key", (F.col("at") + F.col("j")).alias("at"), "no").distinct()
    before = F.lag("at").over(Window.partitionBy("_id", "_key").orderBy("at"))
    return (gone.withColumn("_new", (F.col("at") - F.coalesce(before, F.lit(-2)) > 1).cast("int"))
            .groupBy("_id", "_key").agg(F.collect_list("no").alias("_nos"), F.sum("_new").alias("_runs")))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        run: int = RUN) -> DataFrame:
    """One row per input row: id, ``n_lines``, ``n_removed``, ``n_runs`` (stretches of
    neighbouring non-blank lines removed), ``kept_text``.

    Null texts count as empty and give an empty kept text.  Null identifiers come
    last in the order.  Rows that repeat an identifier and text are one document.
    """
    hit = repeated_lines(docs, id_col, text_col, run).withColumnsRenamed({"_id": "_i", "_key": "_k"})
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"))
    rows = base.join(hit, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size(_lines(F.col("_text"))) - 1), F.col("_nos"))
    return rows.select(
        F.col("_id").alias(id_col), F.size(_lines(F.col("_text"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("_nos"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_runs", F.lit(0)).cast("long").alias("n_runs"),
        F.when(F.col("_nos").isNull(), F.coalesce("_text", F.lit(""))).otherwise(
            let(_lines(F.col("_text")), lambda ls: F.array_join(F.transform(left, lambda i: F.get(ls, i)), "\n"))
        ).alias("kept_text"))


SQL = """
WITH l AS (
  SELECT doc_id, i - 1 AS no, ls[i] AS raw, trim(ls[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS line
  FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
n AS (SELECT doc_id, no, line, row_number() OVER (PARTITION BY doc_id ORDER BY no) AS pos FROM l WHERE line <> ''),
w AS (SELECT a.doc_id, a.pos, a.no AS n1, b.no AS n2, a.line || chr(10) || b.line AS pair
      FROM n a JOIN n b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1),
r AS (SELECT *, row_number() OVER (PARTITION BY pair ORDER BY doc_id, pos) AS k FROM w),
g AS (SELECT DISTINCT doc_id, unnest([n1, n2]) AS no FROM r WHERE k > 1),
q AS (SELECT n.doc_id, n.no, g.no IS NOT NULL AS gone,
             coalesce(lag(g.no IS NOT NULL) OVER (PARTITION BY n.doc_id ORDER BY n.pos), false) AS before
      FROM n LEFT JOIN g USING (doc_id, no)),
c AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (gone AND NOT before) AS n_runs
      FROM q GROUP BY doc_id)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, coalesce(any_value(n_removed), 0)::BIGINT AS n_removed,
       coalesce(any_value(n_runs), 0)::BIGINT AS n_runs,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY l.no) FILTER (g.no IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.no = g.no LEFT JOIN c ON l.doc_id = c.doc_id
GROUP BY l.doc_id
"""
