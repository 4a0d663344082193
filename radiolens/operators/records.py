"""Record-level operators: positional fields, reports, measurements,
bearer blocks and event time.  All are narrow (per-row) transformations,
usable with ``DataFrame.transform``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import decode as D
from ..functions import layout as L


def fields(df: DataFrame, field_map: Mapping[str, tuple[int, str]] | None = None,
           *, value: str = "value", keep: bool = True) -> DataFrame:
    """Extract any fields by 1-based position, typed.

    ``field_map`` is ``{name: (position, type)}``; the default is the
    record layout's map.  With ``keep`` the ``fields`` array stays for later
    operators (``bearers``, ``field_stats``).
    """
    fmap = dict(field_map or L.FIELD_MAP)
    upto = None if keep else max((pos for pos, _ in fmap.values()), default=1)
    out = df.withColumn("fields", D.field_array(F.col(value), upto))
    out = out.select("*", *[D.field(F.col("fields"), pos, t).alias(name)
                            for name, (pos, t) in fmap.items()])
    return out if keep else out.drop("fields")


def reports(df: DataFrame, *, which: str = "all", value: str = "value",
            serving_field: int = L.SERVING_FIELD, keep: tuple[str, ...] | None = None,
            marks: bool = False) -> DataFrame:
    """One row per measurement report of each record.

    Adds ``serving_cell`` (from ``serving_field``), ``report_pos`` and
    ``meas`` (usable, last-wins deduplicated measurements) and the record's
    ``parse_error`` flag.  ``which="first"`` keeps only the first report
    (the older decoder).  Records without payload yield no rows.

    ``keep`` names the columns carried along; without it, all but the line and its
    ``fields``.  A record is cut into its reports' measurements in-row, and a report's row holds
    its own only, so a record costs what its text costs however many reports it has.

    ``marks`` keeps a row, without measurements, of records that have no report, and adds ``first`` (true
    on one row of each record) and ``record_error`` (damage anywhere in the record, as in
    ``parse_errors``), so records and damage can be counted from the same rows as the reports.
    """
    if which not in ("all", "first"):
        raise ValueError("which must be 'all' or 'first'")
    keep = tuple(c for c in df.columns if c not in (value, "fields")) if keep is None else tuple(keep)
    # Each step is its own column, so the split tokens and the usable
    # measurements are computed once per row, not once per lambda call.
    rec = D.walked(D.payload_columns(df, value, *keep, D.field_at(F.col(value), serving_field).alias("serving_cell")))
    spans = F.col("_walk")["spans"]
    if which == "first":
        spans = F.slice(spans, 1, 1)
    # without tokens a payload is not well-formed
    bad = F.col("_has") & (F.col("_tokens").isNull() | ~F.col("_walk")["ok"] | F.col("serving_cell").isNull())
    raw = D.report_measurements(F.col("_tokens"), spans)
    rec = rec.select(*keep, "serving_cell", bad.alias("parse_error"), raw.alias("_reports"))
    carried = [*keep, "serving_cell", "parse_error"]
    if marks:
        wrong = F.coalesce(F.exists("_reports", D.bad_rsrp), F.lit(False))
        rec = rec.withColumn("record_error", F.col("parse_error") | wrong)
        carried.append("record_error")
    # The _outer generator keeps Spark from inferring a size() filter that
    # would be pushed below this projection and re-run the walk there.
    exploded = rec.select(*carried, F.posexplode_outer("_reports").alias("report_pos", "_raw"))
    if marks:
        exploded = exploded.withColumn("first", F.coalesce(F.col("report_pos") == 0, F.lit(True)))
    else:
        exploded = exploded.where(F.col("report_pos").isNotNull())
    return (exploded
            .withColumn("parse_error", F.col("parse_error") | F.coalesce(D.bad_rsrp(F.col("_raw")), F.lit(False)))
            .withColumn("_use", D.usable(F.col("_raw")))
            .withColumn("_back", F.reverse(F.col("_use")["cell"]))
            .withColumn("_cells", F.when(F.size("_use") > D.SHORT_REPORT, D.by_cell(F.col("_use"))))
            .withColumn("meas", D.last_wins(F.col("_use"), F.col("_back"), F.col("_cells")))
            .drop("_raw", "_use", "_back", "_cells"))


def parse_errors(df: DataFrame, *, value: str = "value",
                 serving_field: int = L.SERVING_FIELD) -> DataFrame:
    """The rows of ``df`` with ``n_reports`` (reports before any damage) and
    the record-level ``parse_error``: a payload that is not closed, a damaged
    report count, a non-numeric RSRP, or no serving field.  Records whose
    damage leaves no report are rows here too; a record without a payload has
    no reports and no error."""
    rec = D.walked(D.payload_columns(df, value, "*"))
    bad = F.exists(D.report_measurements(F.col("_tokens"), F.col("_walk")["spans"]), D.bad_rsrp)
    err = F.col("_has") & (F.col("_tokens").isNull() | ~F.col("_walk")["ok"] | bad
                           | D.field_at(F.col(value), serving_field).isNull())
    return (rec.withColumn("n_reports", F.greatest(F.coalesce(F.size(F.col("_walk")["spans"]), F.lit(0)), F.lit(0)))
            .withColumn("parse_error", F.coalesce(err, F.col("_has"), F.lit(False)))
            .drop("_has", "_tokens", "_walk"))


def measurements(report_rows: DataFrame) -> DataFrame:
    """One row per (deduplicated) measurement of each report."""
    others = [c for c in report_rows.columns if c != "meas"]
    return (report_rows
            .select(*others, F.posexplode_outer("meas").alias("meas_pos", "_m"))
            .where(F.col("meas_pos").isNotNull())
            .select(*others, "meas_pos", F.col("_m")["f1"].alias("f1"), F.col("_m")["cell"].alias("cell"),
                    F.col("_m")["rsrp"].alias("rsrp"), F.col("_m")["f4"].alias("f4")))


def bearers(df: DataFrame, *, value: str = "value", names=None, keep: tuple[str, ...] | None = None) -> DataFrame:
    """One row per bearer block: block ``k`` starts at field 234 + 36k and
    ``bearer_count`` (field 173) blocks exist, as far as the record reaches
    (a count beyond its fields is damage).  Adds ``bearer_pos``, ``bearer_count`` and the typed
    bearer fields to the ``keep`` columns (without it, all but the line and its ``fields``).  The
    blocks are built in-row as small structs, so no row carries the line or its field array."""
    names = list(names or L.BEARER_FIELDS)
    keep = tuple(c for c in df.columns if c not in (value, "fields", "bearer_count")) if keep is None else tuple(keep)
    fields = F.col("fields") if "fields" in df.columns else D.field_array(F.col(value))
    count = F.col("bearer_count") if "bearer_count" in df.columns else D.field(F.col("fields"), L.BEARER_COUNT_FIELD, "int")
    given = ["bearer_count"] if "bearer_count" in df.columns else []
    base = df.select(*keep, *given, fields.alias("fields")).select(*keep, "fields", count.alias("bearer_count"))
    # a block cut short still counts: its missing fields are null
    room = F.ceil((F.size("fields") - L.FIXED_FIELDS) / F.lit(float(L.BEARER_WIDTH)))

    def block(k):
        start = F.lit(L.BEARER_FIRST_FIELD) + k * L.BEARER_WIDTH
        return F.struct(*[D.field(F.col("fields"), start + L.BEARER_FIELDS[n][0], L.BEARER_FIELDS[n][1]).alias(n)
                          for n in names])

    blocks = base.select(*keep, "bearer_count", F.transform(D.counted(F.col("bearer_count"), room), block).alias("_blocks"))
    return (blocks.select(*keep, "bearer_count", F.posexplode_outer("_blocks").alias("bearer_pos", "_b"))
            .where(F.col("bearer_pos").isNotNull()).select(*keep, "bearer_count", "bearer_pos", "_b.*"))


def event_time(df: DataFrame, *, fields_col: str = "fields") -> DataFrame:
    """``event_ts`` from fields 6 (year), 5 (``MM:dd``) and 8 (ms since
    midnight UTC).  Computed on epoch milliseconds, so it does not depend on
    the session time zone."""
    f = F.col(fields_col)
    year = D.field(f, L.FIELD_MAP["year"][0], "string")
    md = D.field(f, L.FIELD_MAP["month_day"][0], "string")
    ms = D.field(f, L.FIELD_MAP["time_ms"][0], "bigint")
    day = F.try_to_date(F.concat_ws("-", year, F.regexp_replace(md, ":", "-")), "yyyy-MM-dd")
    epoch_ms = F.unix_date(day).cast("bigint") * 86400000 + ms
    return df.withColumn("event_ts", F.timestamp_millis(epoch_ms))
