"""(serving cell, measured cell) pairs.

``serving_pairs`` works on decoded text records (in-row join of a report's
measurements with the serving cell's own measurement, J1).  For data that
is already tabular, ``serving_pairs_tabular`` does the same with partial
aggregations and one equi-join, which stays balanced under hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import layout as L
from .joins import join_one_per_key
from .records import reports as _reports

MISSING = ("drop", "sentinel", "zero")


def serving_pairs(records: DataFrame, *, missing_serving: str = "drop",
                  which: str = "all", serving_field: int = L.SERVING_FIELD,
                  value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Decode text records into ``(serving_cell, neighbor_cell, s, n)``.

    Per report, every usable measured cell -- the serving cell included --
    forms a pair with the serving cell; ``s`` is the serving cell's RSRP in
    the same report.  When the serving cell is absent:

    * ``drop`` (canonical): ``s = -1`` and the pair filter ``s > -0.001``
      removes it (negative and NaN server values go too);
    * ``sentinel``: ``s = -1`` is kept, no filter;
    * ``zero``: ``s = 0`` and a ``(serving, serving)`` pair with 0/0 is
      added, as the older first-report decoder did; no filter.

    ``keep`` names input columns carried to the output (e.g. ``file_ts``).
    """
    reps = _reports(records, which=which, value=value, serving_field=serving_field, keep=keep)
    rows = (_report_pairs(reps, missing_serving)
            .select(*keep, "serving_cell", "s", F.explode_outer("_meas").alias("_m"))
            .where(F.col("_m").isNotNull()))
    return rows.select(*keep, "serving_cell", F.col("_m")["cell"].alias("neighbor_cell"),
                       "s", F.col("_m")["rsrp"].alias("n"))


def _report_pairs(reps: DataFrame, missing_serving: str) -> DataFrame:
    """Reports with ``s`` and ``_meas``, the measurements that pair with it."""
    if missing_serving not in MISSING:
        raise ValueError(f"missing_serving must be one of {MISSING}")
    srv = F.col("serving_cell")
    found = D.serving_value(F.col("meas"), srv)
    meas = F.col("meas")
    if missing_serving == "zero":
        s = F.coalesce(found, F.lit(0.0))
        meas = F.when(found.isNull() & srv.isNotNull() & (F.size(meas) > 0),
                      F.concat(meas, F.array(F.struct(
                          F.lit(None).cast("string").alias("f1"), srv.alias("cell"),
                          F.lit(0.0).alias("rsrp"), F.lit(None).cast("string").alias("f4")))))\
                .otherwise(meas)
    else:
        s = F.coalesce(found, F.lit(-1.0))
    reps = reps.withColumn("s", s)
    if missing_serving == "drop":
        # The pair filter is applied to the array, not to the exploded rows:
        # a row filter on ``s`` would be pushed below the generator and
        # re-evaluate the whole decode there.
        meas = F.when(D.valid_serving(F.col("s")), meas)
    return reps.withColumn("_meas", meas)


def pairs_and_damage(records: DataFrame, *, by: str, missing_serving: str = "drop", which: str = "all",
                     serving_field: int = L.SERVING_FIELD, value: str = "value") -> DataFrame:
    """The pairs of ``serving_pairs`` and, among them, one row per record that counts it for its ``by``
    (a file's time, say): ``by, serving_cell, neighbor_cell, s, n, records, damaged``.  Rows of pairs have no
    ``by`` and 0 records, rows of records no pair.  One decode serves both, and one aggregation by
    ``by`` and pair ends in the statistics of the pairs and the counts of each ``by``."""
    reps = _reports(records, which=which, value=value, serving_field=serving_field, keep=(by,), marks=True)
    of = records.schema[by].dataType
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    text, number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def row(group, serving, neighbor, s, n, counted, bad):
        return F.struct(group.alias(by), serving.alias("serving_cell"), neighbor.alias("neighbor_cell"), s.alias("s"),
                        n.alias("n"), counted.alias("records"), bad.alias("damaged"))

    found = F.transform(F.coalesce(F.col("_meas"), F.slice("meas", 1, 0)), lambda m: row(
        F.lit(None).cast(of), F.col("serving_cell"), m["cell"], F.col("s"), m["rsrp"], none, none))
    mark = F.array(row(F.col(by), text, text, number, number, one, F.col("record_error").cast("long")))
    found = F.coalesce(found, F.slice(mark, 1, 0))
    rows = _report_pairs(reps, missing_serving).select(
        F.when(F.col("first"), F.concat(found, mark)).otherwise(found).alias("_rows"))
    return rows.select(F.explode_outer("_rows").alias("_r")).where(F.col("_r").isNotNull()).select("_r.*")


def serving_pairs_tabular(df: DataFrame, *, report: str, cell: str, value: str,
                          order: list[str], keep: tuple[str, ...] = (),
                          missing_serving: str = "drop", task_rows: int | None = None) -> DataFrame:
    """Pairs from a table with one row per measurement.

    ``report`` identifies the report, ``order`` orders rows within it; the
    serving cell is the report's first row, each cell's value is its last
    row (last wins).  Built from two partial (map-side combined)
    aggregations and one equi-join; no group is ever collected, and a report
    holding a large share of all rows is spread over several tasks by
    ``join_one_per_key``, ``task_rows`` to each.
    """
    o = F.struct(*[F.col(c) for c in order])
    v = F.col(value).cast("double")
    # rows without a cell are no measurements; dropping them first keeps both
    # uses of ``per_cell`` identical, so Spark computes it (and its shuffle) once
    base = df.select(F.col(report).alias("_r"), F.col(cell).alias("_c"), v.alias("_v"),
                     o.alias("_o"), *[F.col(k) for k in keep]).where(F.col("_c").isNotNull())
    # a cell's first row gives the kept columns, whatever the task order
    kept = [F.min_by(F.struct(F.col(k)), F.col("_o"))[k].alias(k) for k in keep]
    # Per (report, cell): last non-null value (last wins, blanks never
    # override) and the first position of the cell.  Partial aggregation.
    per_cell = (base.groupBy("_r", "_c")
                .agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_o"))).alias("n"),
                     F.min("_o").alias("_first"), *kept))
    # Per report: the serving cell is the cell of the first row, and its
    # value is that cell's last value.  Again a partial aggregation.
    rep = (per_cell.groupBy("_r")
           .agg(F.min_by(F.struct(F.col("_c").alias("c"), F.col("n").alias("v")),
                         F.col("_first")).alias("_srv"))
           .select("_r", F.col("_srv")["c"].alias("serving_cell"),
                   F.col("_srv")["v"].alias("s")))
    if missing_serving == "drop":
        rep = rep.where(F.col("s").isNotNull() & D.valid_serving(F.col("s")))
        s = F.col("s")
    elif missing_serving == "sentinel":
        s = F.coalesce(F.col("s"), F.lit(-1.0))
    else:
        raise ValueError("tabular pairs support 'drop' and 'sentinel'")
    # Both uses of per_cell read the same aggregate columns (``_first`` too),
    # so the two branches are one plan and Spark reuses its shuffle.
    meas = per_cell.where(F.col("n").isNotNull() & F.col("_first").isNotNull())
    # hot reports from a count over the report column alone (one narrow
    # column of the input; an upper bound on the report's cells)
    return join_one_per_key(meas, rep, "_r", key_rows=base.select("_r"),
                            task_rows=task_rows).select(
        *keep, "serving_cell", F.col("_c").alias("neighbor_cell"), s.alias("s"), "n")


def synthetic_pairs(df: DataFrame, *, offset: float = -L.RSRP_MIN, clamp: bool = True,
                    value: str = "value", keep: tuple[str, ...] = (), valid_only: bool = False) -> DataFrame:
    """Pairs of the synthetic ``,`` format
    ``serving,u1,u2,count,cell0,rsrp0,cell1,rsrp1,...``.

    The server value is the *first listed* cell's value, whatever its id;
    values are shifted by ``offset`` and clamped at 0 (``offset=0,
    clamp=False`` keeps raw dBm).  No dedupe.  A count beyond the data or a
    non-numeric value drops that measurement.  ``valid_only`` applies the
    canonical server-value filter, on the record before its pairs are made.
    """
    # the tokens are a column, so the line is split once; the pairs are an array column of their
    # own, and the _outer generator keeps Spark from deriving a filter on its size that
    # would be pushed below and build it twice
    t = F.col("_t")
    cnt = F.get(t, L.SYN_COUNT_INDEX).try_cast("int")
    idx = D.counted(cnt, F.floor((F.size(t) - L.SYN_FIRST_CELL_INDEX) / F.lit(2.0)))

    def item(j: Column) -> Column:
        pos = L.SYN_FIRST_CELL_INDEX + 2 * j
        return F.struct(F.get(t, pos).alias("cell"), D.number(F.get(t, pos + 1)).alias("v"))

    usable = F.filter(F.col("_items"), lambda m: m["cell"].isNotNull() & m["v"].isNotNull())
    if valid_only:
        usable = F.when(D.valid_serving(F.col("s")), usable)
    rec = (df.select(*keep, F.split(F.col(value), L.SYN_SEP, -1).alias("_t"))
           .select(*keep, F.get(t, 0).alias("serving_cell"),
                   D.offset_clamp(D.number(F.get(t, L.SYN_FIRST_CELL_INDEX + 1)), offset, clamp).alias("s"),
                   F.transform(idx, item).alias("_items"),
                   D.number(F.get(t, L.SYN_FIRST_CELL_INDEX + 1)).isNotNull().alias("_served")))
    rows = (rec.select(*keep, "serving_cell", "s", F.when(F.col("_served"), usable).alias("_items"))
            .select(*keep, "serving_cell", "s", F.explode_outer("_items").alias("_m"))
            .where(F.col("_m").isNotNull()))
    return rows.select(*keep, "serving_cell", F.col("_m")["cell"].alias("neighbor_cell"), "s",
                       D.offset_clamp(F.col("_m")["v"], offset, clamp).alias("n"))


def record_pairs(records: DataFrame, *, fmt: str = "real", **options) -> DataFrame:
    """Format dispatch: pairs of real (``;``) or synthetic (``,``) records,
    both with the pair schema ``serving_cell, neighbor_cell, s, n``.  The
    canonical server-value filter applies to both formats."""
    if fmt == "real":
        return serving_pairs(records, **options)
    if fmt == "synthetic":
        keep = options.pop("keep", ())
        return synthetic_pairs(records, keep=keep, valid_only=True, **options)
    raise ValueError("fmt must be 'real' or 'synthetic'")
