"""Render the driver's tables as call records, so every record-format
operator runs on data that grows with the given tables.

Stand-in mapping: every ``lineitem`` row is one call record, rendered from
that row's own columns.  Rendering is narrow -- no shuffle, nothing is
gathered, no count is limited:

* serving cell (field 21) = supplier; field 3 = the next supplier number;
  field 131 = a cell from the part number, so the three serving fields differ;
* ``bearer_count`` = line number - 1, and as many bearer blocks; records
  whose cell number is 5 modulo 11 state the count but are cut before the
  first block (a short record);
* one report, or 1 to 3 with ``split_reports``, of 2 to 4 measurements: a
  neighbour, the serving cell, the neighbour again (last wins) and the next
  cell (a blank cell id where the line status is ``F``);
* line 7 has no payload.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import layout as L

# --- fixed values of the rendering ------------------------------------------
CELL_PREFIX = "001:01:"      # cell id = prefix + lower-case hex of a number
RECORD_VERSION = "6"
TZ_OFFSET = "+00:00"
FIRST_BLOCKS = 6              # bearer blocks written by plain expressions, further ones by a lambda
NO_PAYLOAD_LINE = 7           # records of this line number have no payload


def cell_id(number: Column) -> Column:
    return F.concat(F.lit(CELL_PREFIX), F.lower(F.hex(number)))


def _part_number() -> Column:
    return F.col("l_partkey") % 100 + 1


def _text(x: Column) -> Column:
    return x.cast("string")


def _upto(n: Column, since: int = 0) -> Column:
    """``since .. n-1``; empty for ``n <= since``."""
    return F.slice(F.sequence(F.lit(since), F.greatest(n - 1, F.lit(since))), 1, F.greatest(n - since, F.lit(0)))


def _joined(n: Column, most: int, item, sep: str) -> Column:
    """``item(0) .. item(n-1)`` joined, for an ``n`` of at most ``most``: plain expressions, which Spark compiles
    where it would interpret a lambda."""
    return F.concat(*[F.coalesce(F.when(n > k, F.concat(F.lit(sep if k else ""), item(F.lit(k)))), F.lit("")) for k in range(most)])


def _rsrp(j: Column, k: Column) -> Column:
    return F.col("l_quantity") + k * F.lit(0.25) + j * F.lit(2.0)


def _measurement(j: Column, k: Column, blank_returnflag: str | None) -> Column:
    sk = F.col("l_suppkey")
    cell = (F.when(k == 1, cell_id(sk))
            .when((k == 3) & (F.col("l_linestatus") == "F"), F.lit(""))
            .when(k == 3, cell_id(sk + 1)).otherwise(cell_id(_part_number())))
    rsrp = _text(_rsrp(j, k))
    if blank_returnflag is not None:
        rsrp = F.when((k == 1) & (F.col("l_returnflag") == blank_returnflag), F.lit("")).otherwise(rsrp)
    return F.concat_ws(L.FIELD_SEP, _text(k), cell, rsrp, F.lit(""))


def _report_text(j: Column, blank_returnflag: str | None) -> Column:
    # a remainder by 3 is 2 at most
    n = F.lit(2) + F.col("l_linenumber") % 3
    return F.concat_ws(L.FIELD_SEP, _text(n), _joined(n, 4, lambda k: _measurement(j, k, blank_returnflag), L.FIELD_SEP))


def _payload(*, split_reports: bool, blank_returnflag: str | None) -> Column:
    if split_reports:
        n = F.lit(1) + F.col("l_linenumber") % 3
        body = _joined(n, 3, lambda j: _report_text(j, blank_returnflag), L.FIELD_SEP)
    else:
        body = _report_text(F.lit(0), blank_returnflag)
    return F.when(F.col("l_linenumber") == NO_PAYLOAD_LINE, F.lit(L.RECORD_END)) \
            .otherwise(F.concat(F.lit(L.PAYLOAD_START), body, F.lit(L.RECORD_END)))


def join_fields(values: dict[int, Column], n: int) -> Column:
    """``;``-joined text of ``n`` positional fields (1-based), blank where no
    value is given.  Runs of blanks become one literal, so the expression
    stays short whatever ``n`` is."""
    parts: list[Column] = []
    lit = ""
    for p in range(1, n + 1):
        if p > 1:
            lit += L.FIELD_SEP
        if p in values:
            if lit:
                parts.append(F.lit(lit))
                lit = ""
            parts.append(F.coalesce(values[p], F.lit("")))
    if lit:
        parts.append(F.lit(lit))
    return F.concat(*parts)


def _cents() -> Column:
    return F.round(F.col("l_extendedprice") * 100).cast("bigint")


def _bearer_block(k: Column) -> Column:
    cents = F.col("_cents")
    first = F.when(F.col("l_returnflag") == "A", cents).when(F.col("l_returnflag") == "R", cents % 4)
    later = F.when(F.col("l_linestatus") == "F", F.lit(-1).cast("bigint")).otherwise(cents + k)
    vals = {
        0: F.concat(F.lit("pgw-"), _text(F.col("l_partkey") + k)),
        1: F.concat(F.lit("apn."), F.lower("l_linestatus")),
        5: _text(F.col("l_linenumber")),
        6: _text(F.col("l_partkey") % 1000 + k),
        7: _text(k + 5),
        16: _text(F.col("l_quantity").cast("bigint")),
        17: _text(F.when(k == 0, first).otherwise(later)),
        31: F.lit("0"),
    }
    return join_fields({i + 1: v for i, v in vals.items()}, L.BEARER_WIDTH)


def call_records(lineitem: DataFrame, *, split_reports: bool = False,
                 blank_returnflag: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``l_orderkey`` and ``value`` (the record text) per row, with ``keep``.

    ``split_reports`` writes several reports per record; ``blank_returnflag``
    blanks the serving cell's RSRP on rows with that flag, so their reports
    miss the serving cell.
    """
    nb = F.greatest(F.coalesce(F.col("l_linenumber"), F.lit(0)) - 1, F.lit(0))
    head = {
        1: F.lit(RECORD_VERSION),
        2: _text(F.col("l_orderkey")),
        3: cell_id(F.col("l_suppkey") + 1),
        4: F.lit(TZ_OFFSET),
        5: F.date_format("l_shipdate", "MM:dd"),
        6: _text(F.year("l_shipdate")),
        8: _text((F.col("l_partkey") * 60000) % 86400000),
        21: cell_id(F.col("l_suppkey")),
        131: cell_id(_part_number()),
        173: _text(nb),
    }
    written = F.when(_part_number() % 11 == 5, F.lit(0)).otherwise(nb)
    block = lambda k: F.concat(F.lit(L.FIELD_SEP), _bearer_block(k))
    rest = F.when(written > FIRST_BLOCKS, F.array_join(F.transform(_upto(written, FIRST_BLOCKS), block), ""))
    value = F.concat(join_fields(head, L.FIXED_FIELDS), _joined(written, FIRST_BLOCKS, block, ""), F.coalesce(rest, F.lit("")),
                     _payload(split_reports=split_reports, blank_returnflag=blank_returnflag))
    return lineitem.withColumn("_cents", _cents()).select("l_orderkey", *keep, value.alias("value"))


def synthetic_records(lineitem: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Synthetic ``,`` records per row: the serving cell, then 2 to 4
    measurements in dBm, of which the first is a neighbour's."""
    n = F.lit(2) + F.col("l_linenumber") % 3
    items = _joined(n, 4, lambda k: F.concat_ws(
        L.SYN_SEP, F.when(k == 1, cell_id(F.col("l_suppkey"))).otherwise(cell_id(_part_number() + k)),
        _text(F.col("l_quantity") - F.lit(150.0) + k * F.lit(0.25))), L.SYN_SEP)
    value = F.concat_ws(L.SYN_SEP, cell_id(F.col("l_suppkey")), _text(F.col("l_orderkey")), F.lit("0"),
                        _text(n), items)
    return lineitem.select("l_orderkey", *keep, value.alias("value"))


def file_month(ts: Column) -> Column:
    """File key of a row's month, in the form of the file names."""
    return F.date_format(F.date_trunc("month", ts), "yyyy-MM-dd.HH_mm")


def event_lines(events: DataFrame) -> DataFrame:
    """Events as ``;`` text lines with an hourly file key ``file_hour``
    (``yyyy-MM-dd.HH_mm``), for the file-window scan."""
    value = F.concat_ws(L.FIELD_SEP, F.col("event_id").cast("string"),
                        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
                        F.col("user_id").cast("string"), F.col("event_type"),
                        F.col("value").cast("string"), F.col("props"))
    return events.select(value.alias("value"),
                         F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd.HH_mm").alias("file_hour"))
