"""Benchmark decontamination by winnowing, with DataFrame functions only.

Both sides hash every run of ``K`` words and keep the smallest hash of each
window of ``span - K + 1`` runs.  Equal spans of ``span`` words choose the same
minimum, so every shared span has a joined fingerprint.  Each joined pair is
then extended word by word both ways; it counts when the agreeing stretch
is at least ``span`` words long.  Items shorter than ``span`` are one window of
their own length: for each such length all runs of that length are fingerprints.

Documents are read and cut into words once.  A fixed-size bit table of the
benchmark's hashes discards most fingerprints inside the row, before anything
is exploded or shuffled; it only ever lets too much through.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, lower_az, staged

SPAN, K = 10, 5
SLOTS = 1 << 16          # size of the bit table, whatever the benchmark's size
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(lower_az(text), SEPARATORS), lambda w: w != "")


def run_hashes(ws: Column, k: int) -> Column:
    """Hash of each run of ``k`` words, in order; empty when there are fewer."""
    return F.when(F.size(ws) >= k, F.transform(
        F.sequence(F.lit(1), F.size(ws) - (k - 1)),
        lambda i: F.xxhash64(*[F.element_at(ws, i + j) for j in range(k)]))
    ).otherwise(F.array().cast("array<bigint>"))


def slot(h: Column) -> Column:
    return F.pmod(h, F.lit(SLOTS)).cast("int")


def context(ws: Column, pos: Column, k: int, reach: int) -> Column:
    """Words ``pos - reach`` to ``pos + k + reach - 1`` (null outside the text)."""
    return F.transform(F.sequence(pos - reach, pos + (k - 1 + reach)),
                       lambda p: F.when((p >= 1) & (p <= F.size(ws)), F.get(ws, p - 1)))


FP = "array<struct<k:int,h:bigint,pos:int,ctx:array<string>>>"


def fingerprints(ws: Column, k: int, span: int, within: bytes | None) -> Column:
    """Structs (k, hash, position, context) of the winnowed runs: those that are the smallest of some window they lie in;
    with ``within`` only those whose slot is set in the bit table.  The work is linear in the text."""
    none, width = F.array().cast(FP), span - k + 1

    def least(gs: Column, i: Column, g: Column) -> Column:
        """Some window of ``width`` hashes round place ``i`` has none below ``g``."""
        whole = lambda j: (i > j) & (i - j + width - 1 <= F.size(gs))
        tests = [F.when(whole(j), F.array_min(F.slice(gs, F.greatest(i - j, F.lit(1)), width)) >= g).otherwise(F.lit(False))
                 for j in range(width)]
        return functools.reduce(lambda x, y: x | y, tests)

    def kept(gs: Column, i: Column) -> Column:
        g = F.element_at(gs, i)
        tests = [] if width == 1 else [least(gs, i, g)]
        if within is not None:
            tests.insert(0, F.substring(F.lit(within), slot(g) + 1, F.lit(1)) == F.lit(b"\x01"))
        return functools.reduce(lambda x, y: x & y, tests) if tests else F.lit(True)

    def chosen(gs: Column) -> Column:
        return F.when(F.size(gs) < width, none).otherwise(F.transform(
            F.filter(F.sequence(F.lit(1), F.size(gs)), lambda i: kept(gs, i)),
            lambda i: F.struct(F.lit(k).alias("k"), F.element_at(gs, i).alias("h"), i.alias("pos"),
                               context(ws, i, k, span - k).alias("ctx"))))

    return let(run_hashes(ws, k), chosen)


def _cells(text: Column, classes: list[tuple[int, int]], tables: dict | None) -> Column:
    """Struct of the number of words and the fingerprints of all classes (k, span)."""
    def cell(ws: Column) -> Column:
        fps = [fingerprints(ws, k, s, tables and tables[(k, s)]) for k, s in classes]
        return F.struct(F.size(ws).alias("n"), (F.concat(*fps) if len(fps) > 1 else fps[0]).alias("fp"))

    return let(words(text), cell)


def find_hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_id: str = "item_id", item_text: str = "text", span: int = SPAN
              ) -> tuple[DataFrame, DataFrame]:
    """``(rows, hits)``.  ``rows``: ``_id``, ``_key``, ``_n`` (words) per input row;
    ``hits``: ``_id``, ``_key``, ``_item``, ``_lo``, ``_hi``, the agreeing stretches.
    ``_key`` (a hash of the text) tells rows apart that share an identifier."""
    k = min(K, span)
    its = items.select(F.col(item_id).alias("_item"), F.col(item_text).alias("_text"),
                       F.size(words(F.col(item_text))).alias("_len"))
    its = staged(its.where("_len > 0"), "bench-items")
    # at most span - 1 numbers: the lengths of items shorter than a full window
    short = sorted(r[0] for r in its.where(F.col("_len") < span).select("_len").distinct().collect())
    classes = [(k, span)] + [(n, n) for n in short]
    want = None
    for kk, s in classes:   # a full-length item belongs to the first class, a shorter one to its length's
        part = (its.where(F.least(F.col("_len"), F.lit(span)) == s)
                .select("_item", F.lit(s).alias("_s"), F.explode(_cells(F.col("_text"), [(kk, s)], None)["fp"]).alias("f")))
        want = part if want is None else want.unionByName(part)
    want = staged(want.select("_item", F.col("_s").alias("_need"), F.col("f.k").alias("k"),
                              F.col("f.h").alias("h"), F.col("f.ctx").alias("_ictx")), "bench-prints")
    tables = {}
    for kk, s in classes:   # at most SLOTS small numbers per class
        table = bytearray(SLOTS)
        for r in want.where(F.col("_need") == s).select(slot(F.col("h")).alias("s")).distinct().collect():
            table[r.s] = 1
        tables[(kk, s)] = bytes(table)

    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"),
                       _cells(F.col(text_col), classes, tables).alias("_c"))
    rows = staged(rows.select("_id", "_key", F.col("_c.n").alias("_n"), F.col("_c.fp").alias("_fp")), "doc-prints")
    found = (rows.where(F.size("_fp") > 0)
             .select("_id", "_key", F.explode("_fp").alias("f"))
             .select("_id", "_key", F.col("f.k").alias("k"), F.col("f.h").alias("h"),
                     F.col("f.pos").alias("_pos"), F.col("f.ctx").alias("_dctx"),
                     F.size("f.ctx").alias("_width"))
             .join(want, ["k", "h"]))
    # both contexts hold reach + k + reach words; agreement is counted outwards from the run
    same = F.transform(F.arrays_zip("_dctx", "_ictx"), lambda z: F.coalesce(z["_dctx"] == z["_ictx"], F.lit(False)))
    found = (found.withColumns({"_same": same, "_reach": ((F.col("_width") - F.col("k")) / 2).cast("int")})
             .where(F.forall(F.slice("_same", F.col("_reach") + 1, F.col("k")), lambda x: x)))
    left = F.coalesce(F.array_position(F.reverse(F.slice("_same", F.lit(1), F.col("_reach"))), False), F.lit(0))
    right = F.coalesce(F.array_position(F.slice("_same", F.col("_reach") + F.col("k") + 1, F.col("_reach")), False),
                       F.lit(0))
    grow = lambda c: F.when(c > 0, c - 1).otherwise(F.col("_reach")).cast("int")
    found = found.withColumns({"_lo": F.col("_pos") - grow(left), "_hi": F.col("_pos") + F.col("k") - 1 + grow(right)})
    hits = found.where(F.col("_hi") - F.col("_lo") + 1 >= F.col("_need"))
    return rows.select("_id", "_key", "_n"), hits.select("_id", "_key", "_item", "_lo", "_hi")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", span: int = SPAN) -> DataFrame:
    """One row per input row: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``,
    ``contaminated``.

    Null or empty texts have no words and are clean.  Rows that repeat an
    identifier and text have equal results.  Null item identifiers are not named
    in the digest but their hits count.  Empty tables give clean or no rows.
    """
    rows, hits = find_hits(docs, items, id_col, text_col, item_id, item_text, span)
    by = ["_id", "_key"]
    hits = staged(hits.distinct(), "hits")
    spots = (hits.select(*by, F.explode(F.sequence("_lo", "_hi")).alias("p")).distinct()
             .groupBy(*by).agg(F.count("*").alias("_hit")))
    named = (hits.groupBy(*by).agg(F.array_sort(F.collect_set(F.col("_item").cast("string"))).alias("_items"),
                                   F.count_distinct(F.coalesce(F.col("_item").cast("string"), F.lit("\0"))).alias("_ni")))
    named = named.withColumnsRenamed({"_id": "_i", "_key": "_k"})
    per = (spots.join(named, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")))
           .select("_i", "_k", "_hit", "_items", "_ni"))
    out = rows.join(per, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_key") == F.col("_k")), "left")
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_words"),
        F.coalesce("_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("_ni", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("_items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("_hit").isNotNull().alias("contaminated"))


def _sql_words(col: str) -> str:
    low = f"translate(coalesce({col}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


SQL = f"""
WITH d AS (SELECT doc_id, {_sql_words('text')} AS ws FROM documents),
b AS (SELECT item_id, {_sql_words('text')} AS ws FROM benchmark),
g AS (SELECT item_id, ws, least(len(ws), {SPAN}) AS n FROM b WHERE len(ws) > 0),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS gram
  FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM g)),
ns AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, ns WHERE len(ws) >= n)),
m AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN iw USING (n, gram)),
p AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM m)) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""
