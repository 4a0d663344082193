"""Column expressions that decode one call record in-row.

Everything here is a built-in Spark expression (string functions and
higher-order array functions), so decoding is a narrow, per-row step: no
shuffle, no Python worker.  Spark 4 runs in ANSI mode, so every lookup uses
``get`` / ``try_cast`` and a damaged record yields nulls instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import layout as L

SPAN_TYPE = "array<struct<start:int,n:int>>"
WALK_BLOCK = 512          # tokens whose reports are gathered apart
WALK_FIRST = 4            # reports that are found without a fold
SHORT_REPORT = 32         # measurements up to which a cell's last one is looked up, not sorted for


def fixed_part(value: Column) -> Column:
    """Text before the first ``[`` or ``|`` (the payload is glued to the
    last fixed field, so the line is cut before it is split)."""
    return F.substring_index(F.substring_index(value, L.PAYLOAD_START, 1), L.RECORD_END, 1)


def field_array(value: Column, upto: int | None = None) -> Column:
    """``;``-split fixed part; trailing blanks kept (limit -1).  Use it when
    many fields are needed; ``field_at`` reads one without the array.  With ``upto`` only the first
    fields are cut, and what follows them is one item more."""
    return F.split(fixed_part(value), L.FIELD_SEP, -1 if upto is None else upto + 1)


def _typed(raw: Column, type_: str) -> Column:
    if type_ == "string":
        return raw
    if type_ == "double":
        return number(raw)
    return F.when(raw != "", raw).try_cast(type_)


def field(fields: Column, position: int | Column, type_: str = "string") -> Column:
    """Field at a 1-based position of a ``field_array``, typed with
    ``try_cast`` (blank -> null for numbers).  Out of range gives null."""
    raw = F.get(fields, position - 1 if isinstance(position, int) else position - F.lit(1))
    return _typed(raw, type_)


def counted(count: Column, room: Column) -> Column:
    """``0 .. count-1`` for a stated count, as far as the record has ``room``;
    a blank, negative or damaged count gives no more than there is."""
    n = F.greatest(F.least(F.coalesce(count, F.lit(0)), room.cast("int")), F.lit(0))
    return F.slice(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), 1, n)


def field_at(value: Column, position: int, type_: str = "string") -> Column:
    """One field of the raw record text by 1-based position, without
    splitting the whole line; null when the record is shorter."""
    # The field exists when the line has position-1 separators and the last
    # of them lies before the payload (the payload also holds separators).
    if position == 1:
        exists = F.lit(True)
    else:
        before = F.substring_index(value, L.FIELD_SEP, position - 1)
        exists = ((F.octet_length(before) < F.octet_length(value))
                  & (F.instr(before, L.PAYLOAD_START) == 0) & (F.instr(before, L.RECORD_END) == 0))
    cell = F.substring_index(F.substring_index(value, L.FIELD_SEP, position), L.FIELD_SEP, -1)
    raw = F.when(exists, fixed_part(cell))
    return _typed(raw, type_)


NUMBER = r"^\s*[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[nN][aA][nN]|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$"


def number(text: Column) -> Column:
    """The text as a double where it has the form of a number, else null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def has_payload(value: Column) -> Column:
    return F.instr(value, L.PAYLOAD_START) > 0


def payload_ok(value: Column) -> Column:
    """A payload exists and is closed by ``|`` after its ``[``."""
    start = F.instr(value, L.PAYLOAD_START)
    end = F.instr(value, L.RECORD_END)
    return (start > 0) & (end > start)


def payload_columns(df: DataFrame, value: str, *keep: str | Column) -> DataFrame:
    """``keep`` (of ``df``'s columns) with ``_has``, whether a payload begins, and
    ``_tokens`` between the first ``[`` and the first ``|``, null when the record has no (well-formed) payload.
    The line is split once, at the first ``[``, which costs a fraction of a search byte by byte."""
    names = df.select(*keep).columns
    head, rest = F.get("_parts", F.lit(0)), F.get("_parts", F.lit(1))
    cut = df.select(*keep, F.col(value).alias("_value")).select("*", F.split("_value", "\\" + L.PAYLOAD_START, 2).alias("_parts"))
    cut = cut.select(*names, F.when(F.col("_value").isNotNull(), rest.isNotNull()).alias("_has"),
                     F.when(~F.contains(head, F.lit(L.RECORD_END)), rest).alias("_rest"))
    return cut.select(*names, "_has", F.when(F.contains("_rest", F.lit(L.RECORD_END)), F.split(
        F.substring_index("_rest", L.RECORD_END, 1), L.FIELD_SEP, -1)).alias("_tokens"))


def _count(tokens: Column, i: Column) -> Column:
    """The count at token ``i``, null if it is no number.  One larger than the
    payload reads it to its end, so a damaged count cannot overflow."""
    n = F.get(tokens, i).try_cast("int")
    return F.when(n.isNotNull(), F.least(n, F.size(tokens)))


def report_walk(tokens: Column) -> Column:
    """Walk the counted report groups of a payload.

    Each report is ``n`` followed by ``n`` measurements of 4 tokens.  A fold
    over the token indices keeps ``(next, ok, heads)``: at ``i = next`` the
    count is read and ``(i, n)`` appended.  A count that is not a number or
    is negative stops the walk with ``ok = false``; reports before it stay.
    Returns ``struct<next, ok, spans>``.

    ``walked`` spares most payloads the fold.  Spark copies what a fold keeps at every step.  So the reports of a block of tokens are gathered by a fold of
    their own, as one number each, and added to those before once per block.
    """
    size = F.size(tokens)
    none = F.array().cast("array<bigint>")

    def state(next_: Column, ok: Column, heads: Column) -> Column:
        return F.struct(next_.alias("next"), ok.alias("ok"), heads.alias("heads"))

    def step(acc: Column, i: Column) -> Column:
        cnt = _count(tokens, i)
        at_head = acc["ok"] & (i == acc["next"])
        bad = cnt.isNull() | (cnt < 0)
        stop = state(acc["next"], F.lit(False), acc["heads"])
        head = F.shiftleft(i.cast("bigint"), 32) + cnt
        take = state(i + 1 + cnt * L.MEAS_WIDTH, F.lit(True), F.concat(acc["heads"], F.array(head)))
        return F.when(~at_head, acc).when(bad, stop).otherwise(take)

    def block(acc: Column, b: Column) -> Column:
        places = F.sequence(b * WALK_BLOCK, F.least((b + 1) * WALK_BLOCK, size) - 1)
        return F.aggregate(places, state(acc["next"], acc["ok"], none), step,
                           lambda own: state(own["next"], own["ok"], F.concat(acc["heads"], own["heads"])))

    def finish(acc: Column) -> Column:
        return F.struct(acc["next"].alias("next"), acc["ok"].alias("ok"), F.transform(acc["heads"], lambda h: F.struct(
            F.shiftright(h, 32).cast("int").alias("start"), h.bitwiseAND(0xFFFFFFFF).cast("int").alias("n"))).alias("spans"))

    # a payload has one token at least
    blocks = F.sequence(F.lit(0), F.greatest(F.floor((size - 1) / F.lit(float(WALK_BLOCK))), F.lit(0)).cast("int"))
    return F.aggregate(blocks, state(F.lit(0), F.lit(True), none), block, finish)


def walked(df: DataFrame, tokens: str = "_tokens") -> DataFrame:
    """``df`` with ``_walk``, the ``struct<ok, spans>`` of the walk over the column ``tokens``.

    The first ``WALK_FIRST`` reports are found by plain expressions, each count in a column of its own;
    only a payload with more takes the fold of ``report_walk``."""
    t, first = F.col(tokens), range(WALK_FIRST)
    others, size = df.columns, F.size(t)
    head, count = (lambda k: F.col(f"_h{k}")), (lambda k: F.col(f"_c{k}"))
    df = df.select(*others, F.lit(0).alias("_h0"), _count(t, F.lit(0)).alias("_c0"))
    for k in range(1, WALK_FIRST):
        have = [c for c in df.columns if c != f"_h{k}"]
        # null after a damaged count and after the payload's end
        df = df.select(*have, F.when(count(k - 1) >= 0, head(k - 1) + 1 + count(k - 1) * L.MEAS_WIDTH).alias(f"_h{k}"))
        df = df.select(*df.columns, F.when(head(k) < size, _count(t, head(k))).alias(f"_c{k}"))
    good = [F.coalesce(count(k) >= 0, F.lit(False)) for k in first]
    bad = [~good[0], *[F.coalesce(head(k) < size, F.lit(False)) & ~good[k] for k in first if k]]
    last = head(WALK_FIRST - 1) + 1 + count(WALK_FIRST - 1) * L.MEAS_WIDTH
    more = F.coalesce(good[-1] & (last < size), F.lit(False))
    found = F.array(*[F.struct(F.coalesce(head(k), F.lit(0)).alias("start"), F.coalesce(count(k), F.lit(0)).alias("n")) for k in first])
    n = sum((g.cast("int") for g in good[1:]), good[0].cast("int"))
    ok = ~bad[0]
    for b in bad[1:]:
        ok = ok & ~b
    few = F.struct(ok.alias("ok"), F.slice(found, F.lit(1), n).cast(SPAN_TYPE).alias("spans"))
    fold = F.when(more, report_walk(t))
    df = df.select(*others, few.alias("_few"), fold.alias("_fold"))
    return df.select(*others, F.when(F.col("_fold").isNotNull(), F.struct(F.col("_fold")["ok"].alias("ok"), F.col("_fold")["spans"].alias("spans")))
                     .otherwise(F.col("_few")).alias("_walk"))


def report_measurements(tokens: Column, spans: Column) -> Column:
    """Of each span its complete 4-token measurements (a truncated last one is ignored), as
    ``array<struct<f1, cell, rsrp_raw, rsrp, f4>>``: ``rsrp`` the number, if it is one (a cast alone would accept
    ``30d``)."""
    def meas(at: Column) -> Column:
        raw = F.get(tokens, at + (L.MEAS_RSRP - 1))
        return F.struct(F.get(tokens, at).alias("f1"), F.get(tokens, at + (L.MEAS_CELL - 1)).alias("cell"),
                        raw.alias("rsrp_raw"), number(raw).alias("rsrp"), F.get(tokens, at + 3).alias("f4"))

    def one(s: Column) -> Column:
        whole = F.least(s["n"], F.floor((F.size(tokens) - s["start"] - 1) / F.lit(float(L.MEAS_WIDTH))).cast("int"))
        last = s["start"] + 1 + (whole - 1) * L.MEAS_WIDTH
        places = F.when(whole > 0, F.sequence(s["start"] + 1, last, F.lit(L.MEAS_WIDTH))) \
            .otherwise(F.array().cast("array<int>"))
        return F.transform(places, meas)

    return F.transform(spans, one)


def usable(meas: Column) -> Column:
    """Those with a cell and a numeric RSRP
    (blank cell or blank RSRP: skipped; non-numeric RSRP: see ``bad_rsrp``)."""
    return F.filter(meas, lambda m: (m["cell"] != "") & m["rsrp"].isNotNull())


def bad_rsrp(meas: Column) -> Column:
    """Some non-blank RSRP is not a number."""
    return F.exists(meas, lambda m: (m["cell"] != "") & (m["rsrp_raw"] != "") & m["rsrp"].isNull())


def by_cell(meas: Column) -> Column:
    """Usable measurements ordered by cell, then by place in the report."""
    return F.sort_array(F.transform(meas, lambda m, i: F.struct(
        m["cell"].alias("cell"), i.alias("pos"), m["f1"].alias("f1"), m["rsrp"].alias("rsrp"),
        m["f4"].alias("f4"))))


def _bare(meas: Column) -> Column:
    return F.transform(meas, lambda m: F.struct(
        m["f1"].alias("f1"), m["cell"].alias("cell"), m["rsrp"].alias("rsrp"), m["f4"].alias("f4")))


def last_wins(use: Column, backwards: Column, cells: Column) -> Column:
    """Of usable measurements only each cell's last, in report order (in-row; no shuffle).  Blanks were
    removed before, so they never override.  ``backwards`` are the cells of ``use`` from the last on, in which a
    short report looks up its cells; a longer one is sorted (``cells``, its ``by_cell``; n log n).  Pass columns,
    not expressions: every element looks at others."""
    short = _bare(F.filter(use, lambda m, i: F.array_position(backwards, m["cell"]) == F.size(backwards) - i))
    last = F.filter(cells, lambda m, i: ~m["cell"].eqNullSafe(F.get(cells, i + 1)["cell"]))
    in_order = F.sort_array(F.transform(last, lambda m: F.struct(
        m["pos"].alias("pos"), m["f1"].alias("f1"), m["cell"].alias("cell"), m["rsrp"].alias("rsrp"),
        m["f4"].alias("f4"))))
    return F.when(F.size(use) <= SHORT_REPORT, short).otherwise(_bare(in_order))


def serving_value(meas: Column, serving: Column) -> Column:
    """RSRP of the serving cell inside one (deduplicated) report, or null."""
    return F.get(meas, F.array_position(meas["cell"], serving).cast("int") - 1)["rsrp"]


def offset_clamp(x: Column, offset: float, clamp: bool) -> Column:
    """``max(0, x + offset)`` with Python's NaN rule (``max(0, nan)`` is 0)."""
    y = x + F.lit(offset)
    if not clamp:
        return y
    return F.when(y > 0, y).otherwise(F.lit(0.0))


def valid_serving(s: Column) -> Column:
    """The canonical pair filter: server value ``> -0.001`` (drops the -1
    sentinel); NaN fails as in Python."""
    return (s > -0.001) & ~F.isnan(s)
