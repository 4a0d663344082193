"""Per-pair moments: one pass, mergeable partial states, raw moments and
statistics of any field.

Every aggregation here is a plain ``groupBy().agg()`` of built-in
aggregates, so Spark combines map-side before the shuffle: a hot pair
costs one partial row per task, not one task holding all its rows.

The state of a pair holds its sums and its centred moments (squared deviations and
co-deviations from its own means), which Spark merges pairwise inside an aggregation and
``merge_partials`` merges between stored states.  Sums of RSRP indices (multiples of a quarter)
are exact, and so is the closed form made of them; values for which it would round are finalised
from the centred moments, which lose nothing to values far from 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import layout as L

PAIR_KEYS = ["serving_cell", "neighbor_cell"]
STAT_COLS = ["mean_s", "mean_n", "var_s", "cov_sn", "var_n", "cnt"]
SUM_COLS = ["cnt", "sum_s", "sum_n", "sum_ss", "sum_sn", "sum_nn"]
CENTRED_COLS = ["m2_s", "c_sn", "m2_n", "quarters"]
STATE_COLS = SUM_COLS + CENTRED_COLS
#: count times sum of squares up to which the closed form of multiples of 1/4 is exact
#: (both are multiples of 1/16, and a double holds 53 bits)
EXACT_UP_TO = float(1 << 49)


def pair_stats(pairs: DataFrame, *, finalize: bool = True, by: list[str] | None = None,
               sort: bool = False) -> DataFrame:
    """Means and population (co)variances of ``(s, n)`` per pair.

    One ``groupBy`` of the state (``pair_partials``) then its finalisation, so a
    one-pass result, a roll-up of stored partials and a stream all end in the
    same arithmetic.  ``finalize=False`` returns the raw
    moments the older fork produced: means of ``s, n, s*s, s*n, n*n`` and
    the count (A5).
    """
    keys = (by or []) + PAIR_KEYS
    sums = pair_partials(pairs, by=by)
    out = finalize_partials(sums, by=by) if finalize else raw_moments(sums, by=by)
    return out.orderBy(*keys) if sort else out


def state_columns(s: str = "s", n: str = "n") -> list[Column]:
    """The aggregates of the mergeable state of a pair: count, sums of s, n, s², s·n, n²; the sums of
    squared deviations and co-deviations from the means; whether all values are multiples of 1/4.
    For batch and streaming aggregations alike."""
    s, n = F.col(s), F.col(n)
    count = F.count(F.lit(1))
    return [count.alias("cnt"), F.sum(s).alias("sum_s"), F.sum(n).alias("sum_n"), F.sum(s * s).alias("sum_ss"),
            F.sum(s * n).alias("sum_sn"), F.sum(n * n).alias("sum_nn"), (F.var_pop(s) * count).alias("m2_s"),
            (F.covar_pop(s, n) * count).alias("c_sn"), (F.var_pop(n) * count).alias("m2_n"),
            F.every(((s * 4) % 1 == 0) & ((n * 4) % 1 == 0)).alias("quarters")]


def pair_partials(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mergeable partial state per pair (and per ``by``, e.g. ``file_ts``); see ``state_columns``."""
    return pairs.groupBy(*(by or []), *PAIR_KEYS).agg(*state_columns())


def merge_partials(partials: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Roll partial states up to ``by`` + pair, whatever the split of the input.

    Sums add up.  The centred moments of the parts are moved to the common mean first: a part of
    ``cnt`` values whose mean lies ``d`` from it adds ``cnt * d²``.  One shuffle by key; a key has as
    many rows as it has stored parts (periods), and none is collected into a value."""
    keys = (by or []) + PAIR_KEYS
    of_key = Window.partitionBy(*keys)
    c, total = F.col("cnt").cast("double"), F.sum("cnt").over(of_key)
    moved = partials.withColumns({
        "_ds": F.col("sum_s") / c - F.sum("sum_s").over(of_key) / total,
        "_dn": F.col("sum_n") / c - F.sum("sum_n").over(of_key) / total})
    ds, dn = F.col("_ds"), F.col("_dn")
    return moved.groupBy(*keys).agg(
        *[F.sum(x).alias(x) for x in SUM_COLS],
        F.sum(F.col("m2_s") + c * ds * ds).alias("m2_s"), F.sum(F.col("c_sn") + c * ds * dn).alias("c_sn"),
        F.sum(F.col("m2_n") + c * dn * dn).alias("m2_n"), F.every("quarters").alias("quarters"))


def _var(c: Column, sxx: Column, sx: Column) -> Column:
    """Population variance from sums: (c·Σx² − (Σx)²) / c², floored at 0."""
    return F.greatest(F.lit(0.0), (c * sxx - sx * sx) / (c * c))


def finalize_partials(partials: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Statistics of a state (population form).

    Variances and the covariance ((c·Σsn − Σs·Σn) / c²) come from the sums where every step of that is
    exact, else from the centred moments."""
    keys = (by or []) + PAIR_KEYS
    c = F.col("cnt").cast("double")
    ss, sn = F.col("sum_s"), F.col("sum_n")
    exact = F.col("quarters") & (c * F.greatest("sum_ss", "sum_nn") <= EXACT_UP_TO)

    def pick(closed: Column, centred: str) -> Column:
        return F.when(exact, closed).otherwise(F.col(centred) / c)

    return partials.select(
        *keys, (ss / c).alias("mean_s"), (sn / c).alias("mean_n"),
        pick(_var(c, F.col("sum_ss"), ss), "m2_s").alias("var_s"),
        pick((c * F.col("sum_sn") - ss * sn) / (c * c), "c_sn").alias("cov_sn"),
        pick(_var(c, F.col("sum_nn"), sn), "m2_n").alias("var_n"),
        F.col("cnt"))


def raw_moments(partials: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Means of s, n, s², s·n, n² and the count, from summed state."""
    keys = (by or []) + PAIR_KEYS
    c = F.col("cnt").cast("double")
    return partials.select(
        *keys, *[(F.col(f"sum_{k}") / c).alias(f"mean_{k}") for k in ("s", "n", "ss", "sn", "nn")],
        F.col("cnt"))


def field_stats(df: DataFrame, key: str | Column, value: str | Column, *,
                where: Column | None = None, min_fields: int | None = None) -> DataFrame:
    """Statistics of any value field by any key field: mean, second moment,
    population variance and count of non-null values.

    ``key`` / ``value`` are column names or expressions (e.g. from
    ``records.fields``); ``where`` filters records first; ``min_fields``
    requires that many positional fields (needs a ``fields`` column).
    """
    k = F.col(key) if isinstance(key, str) else key
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    cond = F.lit(True)
    if where is not None:
        cond = cond & where
    if min_fields is not None:
        cond = cond & (F.size("fields") >= min_fields)
    # the condition goes into the aggregates: as a row filter it would be pushed below the decoded
    # columns and decode there again
    rows = df.select(k.alias("key"), F.when(cond, v).alias("v"), cond.alias("_in"))
    # ``var_pop`` keeps centred moments, combined map-side: values far from 0 lose nothing
    return rows.groupBy("key").agg(
        F.avg("v").alias("mean"), F.avg(F.col("v") * F.col("v")).alias("second_moment"),
        F.var_pop("v").alias("var"), F.count("v").alias("cnt"), F.count_if("_in").alias("_rows")) \
        .where(F.col("_rows") > 0).drop("_rows")


def default_field_stats(records: DataFrame, *, value: str = "value") -> DataFrame:
    """The one-field statistic of the fork: key field 131, value field 251
    (first bearer's downlink bytes), records with ``bearer_count = 2`` and
    at least 253 fields."""
    f = D.field_array(F.col(value))
    rec = records.select(f.alias("fields"))
    return field_stats(
        rec, D.field(F.col("fields"), L.FIELD_MAP["cell_id"][0]),
        D.field(F.col("fields"), 251, "double"),
        where=D.field(F.col("fields"), L.BEARER_COUNT_FIELD, "int") == 2,
        min_fields=L.MIN_FIELDS_FIELD_STATS)
