"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Weights give each source a target number of words; a target stops at a
   multiple of its source's size and the excess is reshared.
2. Equal blocks of words are apportioned to the sources by highest quotients
   target / (2k - 1), then each source's blocks to its shards by size: every
   shard gets an integer quota.
3. A shard lays its documents in a seeded order, cut into blocks, and takes
   its quota from a seeded block onwards, round and round the shard.  Whole
   passes repeat documents; only the two ends of a pass cut one.

Only (identifier, size, source) rows are shuffled; shards, not sources, are what a task
sorts, so a source with a third of all rows is many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

BLOCK_WORDS = 64
SHARD_WORDS = 4_000_000
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def water_fill(sources: DataFrame, budget: float, cap: float) -> DataFrame:
    """``target`` per row of (``_weight``, ``_size``): weight shares of
    ``budget`` times all sizes, none above ``cap`` times its size."""
    order = Window.orderBy(F.col("_size") / F.col("_weight"), "_rank")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = sources.select("*", F.lit(cap).alias("_cap"),
                       F.sum("_size").over(upto).alias("_full"), F.sum("_weight").over(upto).alias("_wfull"),
                       F.sum("_size").over(every).alias("_all"), F.sum("_weight").over(every).alias("_wall"))
    # level: what a unit of weight gets if exactly the sources before this one are full
    level = ((F.lit(budget) * F.col("_all") - F.col("_cap") * (F.col("_full") - F.col("_size")))
             / (F.col("_wall") - F.col("_wfull") + F.col("_weight")))
    s = s.withColumn("_level", level)
    right = F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap") * F.col("_size"),
                         F.struct(F.col("_size") / F.col("_weight"), F.col("_rank"), F.col("_level").alias("level")))
                  ).over(every)["level"]
    return (s.withColumn("_level", right)
            .withColumn("target", F.coalesce(F.least(F.col("_cap") * F.col("_size"),
                                                     F.col("_level") * F.col("_weight")),
                                             F.col("_cap") * F.col("_size")).cast("double"))
            .drop("_cap", "_full", "_wfull", "_all", "_wall", "_level"))


def sainte_lague(df: DataFrame, group: list[str], key: str, votes: str, seats: Column) -> DataFrame:
    """Add ``_seats``: ``seats`` of each group dealt by the highest quotients
    votes / 1, 3, 5, ...; ties go to the smaller ``key``.

    With S rows and N seats, seats up to floor(v (N - S/2) / W + 1/2) are
    certainly among the N highest and seats past floor(v (N + S/2) / W + 1/2)
    are certainly not, so about 2 S quotients are ranked, not N.
    """
    g = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    whole = g.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    v = F.col(votes).cast("double")
    s = df.withColumns({"_want": seats.cast("long"), "_rows": F.count("*").over(whole).cast("double"),
                        "_votes": F.sum(v).over(whole)})
    ratio = v / F.col("_votes")
    sure = F.floor(ratio * (F.col("_want") - F.col("_rows") / 2) + 0.5) - 1
    most = F.floor(ratio * (F.col("_want") + F.col("_rows") / 2) + 0.5) + 1
    s = s.withColumns({"_sure": F.when(v > 0, F.greatest(F.lit(0).cast("long"), sure)).otherwise(0).cast("long"),
                       "_most": F.when(v > 0, F.greatest(F.lit(0).cast("long"), most)).otherwise(0).cast("long")})
    s = s.withColumn("_left", F.col("_want") - F.sum("_sure").over(whole))
    q = (s.where(F.col("_most") > F.col("_sure"))
         .select(*group, key, "_left", v.alias("_v"),
                 F.explode(F.sequence(F.col("_sure") + 1, F.col("_most"))).alias("_k"))
         .withColumn("_q", F.col("_v") / (2 * F.col("_k") - 1)))
    won = (q.withColumn("_place", F.row_number().over(g.orderBy(F.desc("_q"), key, "_k")))
           .where(F.col("_place") <= F.col("_left"))
           .groupBy(*group, key).agg(F.count("*").alias("_more")))
    return (s.join(won, [*group, key], "left")
            .withColumn("_seats", F.col("_sure") + F.coalesce("_more", F.lit(0)))
            .drop("_want", "_rows", "_votes", "_sure", "_most", "_left", "_more"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, cap: float = 2.0,
        block: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """One row per input row: id, ``size``, ``source_size``, ``target``, ``taken``, ``first``.

    Sources in code point order, null last, carry ``weights`` in turn.
    ``taken`` counts the words the mix takes of the row, repeats counted;
    ``first`` is the first word taken by the cut pass (0 if none is cut).
    A null or empty text has size 0 and gives nothing.  Equal identifiers are
    ordered by size, so reruns agree; an empty table gives an empty result.
    """
    rows = staged(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("_source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("_words"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("_draw")), "mix-rows")
    by_source = Window.orderBy(F.col("_source").asc_nulls_last())
    sources = (rows.groupBy("_source").agg(F.sum("_words").alias("_size"))
               .withColumn("_rank", F.row_number().over(by_source))
               .withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)),
                                                   ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))))
    sources = water_fill(sources, budget, cap)
    blocks = F.round(F.sum("target").over(Window.partitionBy(F.lit(1))) / block)
    sources = staged(
        sainte_lague(sources, [], "_rank", "target", blocks)
        .withColumn("_shards", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("_size") / shard_words)))
        .select(F.col("_source").alias("_s"), "_rank", "_size", "target", "_seats", "_shards"), "mix-sources")

    draw = F.conv(F.substring("_draw", 1, 8), 16, 10).cast("long")
    placed = (rows.join(sources, F.col("_source").eqNullSafe(F.col("_s")))
              .withColumn("_shard", draw % F.col("_shards")))
    shards = placed.groupBy("_rank", "_shard").agg(F.sum("_words").alias("_sw"), F.first("_seats").alias("_quota"))
    shards = (sainte_lague(shards, ["_rank"], "_shard", "_sw", F.col("_quota"))
              .withColumn("_take", F.least(F.col("_seats") * block, F.floor(F.col("_sw") * cap))))
    n_blocks = F.ceil(F.col("_sw") / block)
    turn = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("_rank"), F.col("_shard"))), 1, 8),
                  16, 10).cast("long")
    shards = shards.select(
        "_rank", "_shard", "_sw",
        F.when(F.col("_sw") > 0, F.floor(F.col("_take") / F.col("_sw"))).otherwise(0).alias("_passes"),
        F.when(F.col("_sw") > 0, F.col("_take") % F.col("_sw")).otherwise(0).alias("_rest"),
        F.when(F.col("_sw") > 0, (turn % n_blocks) * block).otherwise(0).alias("_from"))

    run = (Window.partitionBy("_rank", "_shard").orderBy("_draw", "_id", "_words")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    lined = (placed.withColumn("_end", F.sum("_words").over(run))
             .join(shards, ["_rank", "_shard"])
             .withColumn("_at", F.col("_end") - F.col("_words")))

    def overlap(shift: Column) -> Column:
        return F.greatest(F.lit(0).cast("long"),
                          F.least(F.col("_end"), F.col("_from") + F.col("_rest") - shift)
                          - F.greatest(F.col("_at"), F.col("_from") - shift))

    cut = overlap(F.lit(0)) + overlap(F.col("_sw"))
    begin = F.when(overlap(F.lit(0)) > 0, F.greatest(F.lit(0).cast("long"), F.col("_from") - F.col("_at"))).otherwise(0)
    return lined.select(
        F.col("_id").alias(id_col), F.col("_words").alias("size"), F.col("_size").alias("source_size"),
        "target", (F.col("_passes") * F.col("_words") + cut).cast("long").alias("taken"),
        begin.cast("long").alias("first"))


def mixed_rows(docs: DataFrame, taken: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               length_col: str | None = "n_chars") -> DataFrame:
    """The mix itself: ``docs``' columns, a row once per whole pass, and once more with the words
    that a cut pass takes.  ``taken`` is what :func:`mix` returned for ``docs``; rows that share an
    identifier are told apart by their size, and rows equal in both take the most that either takes.
    Helper columns are named ``__mix_*``."""
    t = (taken.groupBy(F.col(id_col).alias("__mix_id"), F.col("size").alias("__mix_words"))
         .agg(F.max(F.struct("taken", "first")).alias("t")).select("__mix_id", "__mix_words", "t.*"))
    t = t.where("taken > 0").withColumns({"__mix_passes": F.expr("taken div __mix_words"), "__mix_rest": F.col("taken") % F.col("__mix_words")})
    t = t.select("__mix_id", "__mix_words", F.col("first").alias("__mix_first"), F.explode(F.concat(
        F.array_repeat(F.col("__mix_words"), F.col("__mix_passes").cast("int")),
        F.when(F.col("__mix_rest") > 0, F.array("__mix_rest")).otherwise(F.array().cast("array<bigint>")))).alias("__mix_part"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.withColumn("__mix_size", size).join(t, F.col(id_col).eqNullSafe(F.col("__mix_id")) & (F.col("__mix_size") == F.col("__mix_words")))
    every = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"))
    # a pass may end in the document it began in: its words then go on from the beginning
    cut = F.array_join(F.slice(F.concat(every, every), (F.col("__mix_first") + 1).cast("int"), F.col("__mix_part").cast("int")), " ")
    text = F.when(F.col("__mix_part") == F.col("__mix_words"), F.col(text_col)).otherwise(cut)
    out = rows.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], "__mix_part", "__mix_words")
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.when(F.col("__mix_part") == F.col("__mix_words"), F.col(length_col))
                             .otherwise(F.length(text_col)).cast(docs.schema[length_col].dataType))
    return out.select(*docs.columns)


SQL = f"""
WITH r AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('{SEED}' || coalesce(doc_id::VARCHAR, '')) AS draw FROM documents),
s0 AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk
  FROM r GROUP BY source),
s1 AS (SELECT *, CASE (rk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w FROM s0),
s2 AS (
  SELECT *, sum(source_size) OVER u AS fl, sum(w) OVER u AS wf,
         sum(source_size) OVER () AS al, sum(w) OVER () AS wa
  FROM s1 WINDOW u AS (ORDER BY source_size / w::DOUBLE, rk ROWS UNBOUNDED PRECEDING)),
s3 AS (SELECT *, (1.5::DOUBLE * al - 2.0::DOUBLE * (fl - source_size)) / (wa - wf + w)::DOUBLE AS lv FROM s2),
lv AS (SELECT lv FROM s3 WHERE lv * w <= 2.0::DOUBLE * source_size ORDER BY source_size / w::DOUBLE, rk LIMIT 1),
s4 AS (
  SELECT source, source_size, rk,
         coalesce(least(2.0::DOUBLE * source_size, (SELECT lv FROM lv) * w), 2.0::DOUBLE * source_size) AS target
  FROM s3),
s5 AS (SELECT *, round(sum(target) OVER () / {BLOCK_WORDS})::BIGINT AS n FROM s4),
s6 AS (
  SELECT g.rk, count(q.k) AS seats FROM s5 g LEFT JOIN (
    SELECT rk, k, row_number() OVER (ORDER BY q DESC, rk, k) AS place FROM (
      SELECT rk, k, target / (2 * k - 1) AS q
      FROM (SELECT rk, target, unnest(generate_series(1, (target / {BLOCK_WORDS})::BIGINT + 30)) AS k
            FROM s5 WHERE target > 0))) q
  ON g.rk = q.rk AND q.place <= g.n GROUP BY g.rk),
s7 AS (
  SELECT s5.*, seats, greatest(1, ceil(source_size / {SHARD_WORDS}::DOUBLE)::BIGINT) AS shards
  FROM s5 JOIN s6 USING (rk)),
p AS (
  SELECT r.doc_id, r.size, r.draw, s7.*, ('0x' || substr(draw, 1, 8))::BIGINT % shards AS shard
  FROM r JOIN s7 ON r.source IS NOT DISTINCT FROM s7.source),
h0 AS (SELECT rk, shard, sum(size)::BIGINT AS sw, any_value(seats) AS quota FROM p GROUP BY rk, shard),
h1 AS (
  SELECT g.rk, g.shard, any_value(g.sw) AS sw, count(q.k) AS seats FROM h0 g LEFT JOIN (
    SELECT rk, shard, k, row_number() OVER (PARTITION BY rk ORDER BY q DESC, shard, k) AS place FROM (
      SELECT rk, shard, k, sw / (2 * k - 1)::DOUBLE AS q
      FROM (SELECT rk, shard, sw, unnest(generate_series(1, 2 * (sw // {BLOCK_WORDS}) + 30)) AS k
            FROM h0 WHERE sw > 0))) q
  ON g.rk = q.rk AND g.shard = q.shard AND q.place <= g.quota GROUP BY g.rk, g.shard),
h2 AS (
  SELECT rk, shard, sw, least(seats * {BLOCK_WORDS}, 2 * sw) AS take,
         CASE WHEN sw > 0 THEN (('0x' || substr(md5('{SEED}:' || rk || ':' || shard), 1, 8))::BIGINT
              % ceil(sw / {BLOCK_WORDS}::DOUBLE)::BIGINT) * {BLOCK_WORDS} ELSE 0 END AS fr FROM h1),
l AS (
  SELECT p.doc_id, p.size, p.source_size, p.target, h2.sw, h2.take, h2.fr,
         CASE WHEN sw > 0 THEN take % sw ELSE 0 END AS rest,
         sum(p.size) OVER (PARTITION BY p.rk, p.shard ORDER BY p.draw, p.doc_id, p.size ROWS UNBOUNDED PRECEDING) AS e
  FROM p JOIN h2 ON p.rk = h2.rk AND p.shard = h2.shard)
SELECT doc_id, size, source_size, target,
       ((CASE WHEN sw > 0 THEN take // sw ELSE 0 END) * size
        + greatest(0, least(e, fr + rest) - greatest(e - size, fr))
        + greatest(0, least(e, fr + rest - sw) - greatest(e - size, fr - sw)))::BIGINT AS taken,
       (CASE WHEN least(e, fr + rest) - greatest(e - size, fr) > 0
             THEN greatest(0, fr - (e - size)) ELSE 0 END)::BIGINT AS first
FROM l
"""
