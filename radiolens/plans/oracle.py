"""Reference SQL (DuckDB dialect) for every query in ``plans.queries``.

Each string computes directly from the driver tables what the Spark query
computes by rendering and decoding records, so the check covers the whole
decode path.  Column names and types match the Spark side.
"""

from __future__ import annotations

CELL = "'001:01:' || lower(hex({}))"

# Every row as the call record it is rendered to (see sources/render.py).
RECORDS = f"""r AS (
  SELECT row_number() OVER () AS id, l_orderkey AS o, l_returnflag AS flag, l_linestatus AS ls,
         l_linenumber AS ln, l_partkey AS pk, l_quantity AS q, l_shipdate AS day0,
         {CELL.format('l_suppkey')} AS cell21, {CELL.format('l_suppkey + 1')} AS cell3,
         {CELL.format('l_partkey % 100 + 1')} AS cell131, l_partkey % 100 + 1 AS pn,
         greatest(coalesce(l_linenumber, 0) - 1, 0)::INTEGER AS nb,
         CASE WHEN (l_partkey % 100 + 1) % 11 = 5 THEN 0 ELSE l_linenumber - 1 END AS blocks,
         round(l_extendedprice * 100)::BIGINT AS cents
  FROM lineitem),
rb AS (
  SELECT *, CASE WHEN blocks < 1 THEN NULL WHEN flag = 'A' THEN cents WHEN flag = 'R' THEN cents % 4 END AS dl0,
         CASE WHEN blocks < 2 THEN NULL WHEN ls = 'F' THEN -1 ELSE cents + 1 END AS dl1
  FROM r)"""

C = "count(*)::DOUBLE"


def VAR(c: str, sxx: str, sx: str) -> str:
    """Population variance from sums, same arithmetic as the Spark side."""
    return f"greatest(({c} * {sxx} - {sx} * {sx}) / ({c} * {c}), 0.0::DOUBLE)"


def COV(c: str, sxy: str, sx: str, sy: str) -> str:
    return f"({c} * {sxy} - {sx} * {sy}) / ({c} * {c})"


def _measured(*, blank: bool = False, split: bool = False, window: str = "") -> str:
    """CTEs ``r, rb, m, d``: d(id, o, j, cell, v), a report's usable measurements."""
    reports = "1 + ln % 3" if split else "1"
    v = "q + k * 0.25::DOUBLE + j * 2.0::DOUBLE"
    if blank:
        v = f"CASE WHEN k = 1 AND flag = 'R' THEN NULL ELSE {v} END"
    return f"""{RECORDS},
m AS (
  SELECT id, o, j, k, {v} AS v,
         CASE WHEN k = 1 THEN cell21 WHEN k = 3 AND ls = 'F' THEN '' WHEN k = 3 THEN cell3 ELSE cell131 END AS cell
  FROM (SELECT *, unnest(range(2 + ln % 3)) AS k
        FROM (SELECT *, unnest(range({reports})) AS j FROM r WHERE ln <> 7 {window}))),
d AS (SELECT id, o, j, cell, arg_max(v, k) AS v FROM m WHERE cell <> '' AND v IS NOT NULL
      GROUP BY id, o, j, cell)"""


def _pairs(*, serving: str = "cell21", missing: str = "drop", first: bool = False, **kw) -> str:
    """CTEs of ``_measured`` and p(serving_cell, neighbor_cell, s, n, id)."""
    if missing == "drop":
        s, where = "sd.v", "sd.v IS NOT NULL AND sd.v > -0.001"
    elif missing == "sentinel":
        s, where = "coalesce(sd.v, -1.0::DOUBLE)", "true"
    else:
        s, where = "coalesce(sd.v, 0.0::DOUBLE)", "true"
    if first:
        where += " AND d.j = 0"
    extra = ""
    if missing == "zero":
        extra = f"""
  UNION ALL
  SELECT r.{serving}, r.{serving}, 0.0::DOUBLE, 0.0::DOUBLE, r.id
  FROM (SELECT DISTINCT id, j FROM d {"WHERE j = 0" if first else ""}) AS rep JOIN r ON r.id = rep.id
  WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.id = rep.id AND d.j = rep.j AND d.cell = r.{serving})"""
    return f"""{_measured(**kw)},
p AS (
  SELECT r.{serving} AS serving_cell, d.cell AS neighbor_cell, {s} AS s, d.v AS n, d.id
  FROM d JOIN r ON r.id = d.id
  LEFT JOIN d AS sd ON sd.id = d.id AND sd.j = d.j AND sd.cell = r.{serving}
  WHERE {where}{extra})"""


# The tabular form: report = order, cell = supplier, value = quantity; the
# serving cell is the report's first row, a cell's value its last.
TAB_PAIRS = f"""l AS (
  SELECT l_orderkey AS o, {CELL.format('l_suppkey')} AS cell, l_quantity AS q,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
  FROM lineitem),
srv AS (SELECT o, cell AS serving_cell FROM l WHERE rn = 1),
d AS (SELECT o, cell, arg_max(q, rn) AS v FROM l GROUP BY o, cell),
p AS (
  SELECT srv.serving_cell, d.cell AS neighbor_cell, sd.v AS s, d.v AS n
  FROM d JOIN srv ON d.o = srv.o JOIN d AS sd ON sd.o = d.o AND sd.cell = srv.serving_cell
  WHERE sd.v > -0.001)"""

STATS_COLS = ", ".join([
    f"sum(s) / {C} AS mean_s", f"sum(n) / {C} AS mean_n",
    f"{VAR(C, 'sum(s * s)', 'sum(s)')} AS var_s",
    f"{COV(C, 'sum(s * n)', 'sum(s)', 'sum(n)')} AS cov_sn",
    f"{VAR(C, 'sum(n * n)', 'sum(n)')} AS var_n", "count(*) AS cnt"])


def _stats_of(ctes: str, where: str = "") -> str:
    return (f"WITH {ctes}\nSELECT serving_cell, neighbor_cell, {STATS_COLS}\n"
            f"FROM p {where} GROUP BY serving_cell, neighbor_cell")


def _stats(**kw) -> str:
    return _stats_of(_pairs(**kw))


def _syn_pairs(offset: float, clamp: bool, source: str = "lineitem") -> str:
    """CTE ``p`` of the synthetic records: the first listed value is the server's."""
    def f(x):
        y = f"({x} + {offset}::DOUBLE)"
        return f"greatest({y}, 0.0::DOUBLE)" if clamp else y
    return f"""p AS (
  SELECT {CELL.format('l_suppkey')} AS serving_cell,
         CASE WHEN k = 1 THEN {CELL.format('l_suppkey')} ELSE {CELL.format('l_partkey % 100 + 1 + k')} END AS neighbor_cell,
         {f('l_quantity - 150.0::DOUBLE')} AS s, {f('(l_quantity - 150.0::DOUBLE + k * 0.25::DOUBLE)')} AS n
  FROM (SELECT *, unnest(range(2 + l_linenumber % 3)) AS k FROM {source}))"""


def _long(stats_cte: str, case_id: int, rnp: int) -> str:
    kinds = [("MeanServer", "mean_s - 140.0"), ("MeanNeighbor", "mean_n - 140.0"),
             ("VarianceServer", "var_s"), ("CovarianceNeighbor", "cov_sn"),
             ("VarianceNeighbor", "var_n")]
    return "\nUNION ALL\n".join(
        f"SELECT {case_id}::INTEGER AS case_id, {rnp}::INTEGER AS rnp_simulation_id, "
        f"'{k}' AS kind, serving_cell AS cell, serving_cell AS measured_cell_1, "
        f"neighbor_cell AS measured_cell_2, {expr} AS value, cnt FROM {stats_cte}"
        for k, expr in kinds)


GRAPH = f"""{TAB_PAIRS},
st AS (SELECT serving_cell, neighbor_cell, count(*) AS cnt FROM p GROUP BY serving_cell, neighbor_cell),
ns AS (SELECT serving_cell AS src, neighbor_cell AS dst, cnt,
              sum(cnt) OVER (PARTITION BY serving_cell) AS total
       FROM st WHERE serving_cell <> neighbor_cell),
e AS (SELECT src, dst, cnt, total::BIGINT AS total FROM ns
      WHERE cnt::DOUBLE > total::DOUBLE * 0.025::DOUBLE),
v AS (SELECT serving_cell AS node FROM st UNION SELECT neighbor_cell FROM st),
u AS (SELECT src AS a, dst AS b FROM e UNION SELECT dst, src FROM e),
reach(a, b) AS (SELECT node, node FROM v UNION SELECT reach.a, u.b FROM reach JOIN u ON reach.b = u.a),
comp AS (SELECT a AS node, min(b) AS component FROM reach GROUP BY a),
ue AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM e)"""


SQL: dict[str, str] = {}

SQL["pair_stats"] = _stats()
SQL["pair_stats_tabular"] = _stats_of(TAB_PAIRS)
SQL["pair_stats_hot_report"] = _stats_of(TAB_PAIRS.replace(
    "FROM lineitem", "FROM (SELECT * REPLACE (CASE WHEN l_partkey % 3 = 0 THEN -1 ELSE l_orderkey END AS l_orderkey) "
    "FROM lineitem)"))
SQL["pair_stats_blanks"] = _stats(blank=True)
SQL["pair_stats_sentinel"] = _stats(blank=True, missing="sentinel")
SQL["pair_stats_zero"] = _stats(serving="cell3", missing="zero", first=True, blank=True, split=True)
SQL["pair_stats_cell_field"] = _stats(serving="cell131", split=True)
SQL["pair_stats_multi_report"] = _stats(split=True)
SQL["synthetic_pairs"] = _stats_of(_syn_pairs(140.0, True), "WHERE s > -0.001")
SQL["synthetic_raw"] = _stats_of(_syn_pairs(0.0, False))
SQL["rollup_partials"] = _stats()
SQL["raw_moments"] = (
    f"WITH {_pairs()}\nSELECT serving_cell, neighbor_cell, "
    + ", ".join([f"sum({e}) / {C} AS mean_{k}" for k, e in
                 [("s", "s"), ("n", "n"), ("ss", "s * s"), ("sn", "s * n"), ("nn", "n * n")]]
                + ["count(*) AS cnt"])
    + "\nFROM p GROUP BY serving_cell, neighbor_cell")


def _field_stats(window: str = "") -> str:
    return f"""WITH {RECORDS}
SELECT cell131 AS key, sum(dl0)::DOUBLE / count(dl0)::DOUBLE AS mean,
       (sum(dl0::HUGEINT * dl0) / count(dl0)::DOUBLE)::FLOAT AS second_moment,
       var_pop(dl0::DOUBLE)::FLOAT AS var, count(dl0) AS cnt
FROM rb WHERE nb = 2 AND blocks = 2 {window} GROUP BY cell131"""


def _months(day: str) -> str:
    return (f"AND date_trunc('month', {day}) BETWEEN TIMESTAMP '1998-01-01 00:00:00' "
            "AND TIMESTAMP '1998-07-01 00:00:00'")


SQL["field_stats"] = _field_stats()
SQL["windowed_field_stats"] = _field_stats(_months("day0"))
SQL["windowed_stats"] = (f"WITH {_pairs(window=_months('day0'))},\nst AS (SELECT serving_cell, neighbor_cell, "
                         f"{STATS_COLS} FROM p GROUP BY serving_cell, neighbor_cell)\n" + _long("st", 1, 1))
SQL["windowed_synthetic"] = _stats_of(
    _syn_pairs(140.0, True, f"(SELECT * FROM lineitem WHERE true {_months('l_shipdate')})"), "WHERE s > -0.001")

SQL["damaged_records"] = """SELECT l_orderkey AS record_id,
       CASE WHEN l_orderkey % 7 IN (2, 4) THEN 0 ELSE 1 END::INTEGER AS n_reports,
       l_orderkey % 7 IN (1, 2, 3, 5) AS parse_error
FROM lineitem"""

SQL["windowed_damage"] = f"""SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS file_day, count(*) AS records,
       count(CASE WHEN l_orderkey % 7 IN (1, 2, 3, 5) THEN 1 END) AS damaged
FROM lineitem WHERE true {_months('l_shipdate')} GROUP BY 1"""

SQL["decode_fields"] = f"""WITH {RECORDS}
SELECT o AS record_id, 6::INTEGER AS version, cell3 AS serving_cell_v0,
       '+00:00' AS tz_offset, strftime(day0, '%m:%d') AS month_day,
       year(day0)::INTEGER AS year, ((pk * 60000) % 86400000)::BIGINT AS time_ms,
       cell21 AS serving_cell, cell131 AS cell_id, '' AS ue_location_capability,
       nb AS bearer_count
FROM r"""

SQL["measurements"] = f"""WITH {_measured(split=True)}
SELECT d.o AS record_id, d.j::INTEGER AS report_pos, d.cell, d.v AS rsrp, r.cell21 AS serving_cell,
       false AS parse_error
FROM d JOIN r ON r.id = d.id"""

SQL["bearers"] = f"""WITH {RECORDS},
b AS (SELECT *, unnest(range(blocks)) AS k FROM rb)
SELECT o AS record_id, k::INTEGER AS bearer_pos, nb AS bearer_count,
       'pgw-' || (pk + k) AS pgw_id, 'apn.' || lower(ls) AS apn,
       ln::INTEGER AS qci, (pk % 1000 + k)::BIGINT AS setup_duration,
       (5 + k)::INTEGER AS bearer_id, q::BIGINT AS ul_rlc_kbytes,
       (CASE WHEN k = 0 THEN dl0 WHEN ls = 'F' THEN -1 ELSE cents + k END)::BIGINT AS dl_rlc_bytes,
       0::INTEGER AS tertiary_count
FROM b"""

SQL["bearer_filters"] = f"""WITH {RECORDS}
SELECT o AS record_id, nb AS bearer_count, coalesce(dl0 > 1, false) AS first_dl_gt1,
       coalesce(nb = 2 AND dl1 >= 0, false) AS second_dl_ge0, nb = 3 AS three_bearers
FROM rb"""

_STATS_CTE = f"{TAB_PAIRS},\nst AS (SELECT serving_cell, neighbor_cell, {STATS_COLS} FROM p GROUP BY serving_cell, neighbor_cell)"

SQL["long_stats"] = f"WITH {_STATS_CTE}\n" + _long("st", 1, 1)

SQL["report_text"] = f"""WITH {_STATS_CTE}
SELECT serving_cell, neighbor_cell,
       printf('%-16s  %-16s   %10.2f%10.2f%10.2f%10.2f%10.2f%8d', serving_cell, neighbor_cell,
              mean_s, mean_n, var_s, cov_sn, var_n, cnt) AS line
FROM st"""

SQL["replace_partition"] = f"""WITH {_STATS_CTE},
{_syn_pairs(0.0, False).replace('p AS (', 'syn_p AS (', 1)},
syn AS (SELECT serving_cell, neighbor_cell, {STATS_COLS} FROM syn_p GROUP BY serving_cell, neighbor_cell)
{_long('syn', 1, 1)}
UNION ALL
{_long('st', 1, 2)}
UNION ALL
{_long('st', 1, 2)}
UNION ALL
{_long('st', 2, 1)}"""

SQL["edges"] = f"WITH RECURSIVE {GRAPH}\nSELECT src, dst, cnt, total FROM e"
SQL["nodes"] = f"WITH RECURSIVE {GRAPH}\nSELECT node FROM v"
SQL["components"] = f"WITH RECURSIVE {GRAPH}\nSELECT node, component FROM comp"
SQL["components_low_threshold"] = SQL["components"].replace("0.025::DOUBLE", "0.015::DOUBLE")
SQL["component_summary"] = f"""WITH RECURSIVE {GRAPH},
nn AS (SELECT component, count(*) AS n_nodes FROM comp GROUP BY component),
ec AS (SELECT comp.component, count(*) AS n_edges FROM ue JOIN comp ON ue.a = comp.node
       GROUP BY comp.component)
SELECT nn.component, nn.n_nodes, coalesce(ec.n_edges, 0)::BIGINT AS n_edges
FROM nn LEFT JOIN ec ON nn.component = ec.component"""
SQL["graph_counts"] = f"""WITH RECURSIVE {GRAPH}
SELECT 'nodes' AS metric, count(*) AS value FROM v
UNION ALL SELECT 'edges', count(*) FROM (SELECT DISTINCT src, dst FROM e)
UNION ALL SELECT 'components', count(DISTINCT component) FROM comp"""

SQL["file_window"] = """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props,
       strftime(date_trunc('hour', ts), '%Y-%m-%d.%H_%M') AS file_hour
FROM events
WHERE date_trunc('hour', ts) BETWEEN TIMESTAMP '2024-01-05 12:00:00'
                                 AND TIMESTAMP '2024-01-05 14:00:00'"""

SQL["scan_points"] = """SELECT c_acctbal / 100 AS lat, -c_custkey / 1000 AS lon, c_nationkey AS value
FROM customer"""

SQL["scan_json"] = """SELECT doc_id AS post_id, lang, 'u' || doc_id AS author,
       CASE WHEN n_chars % 2 = 0 THEN n_chars END AS mention_id,
       CASE WHEN n_chars % 2 = 0 THEN source END AS mention_name
FROM documents"""

SQL["scan_posts"] = """SELECT doc_id AS post_id, text, lang, 1400000000 + doc_id * 3600 AS created,
       n_chars % 7 AS retweet_count, n_chars % 5 AS favorite_count,
       '{"type":"Point","coordinates":[' || n_chars % 90 || ',' || n_chars % 180 || ']}' AS coordinates,
       doc_id AS user_id, 'u' || doc_id AS author, n_chars * 3 AS followers, lang AS user_lang,
       n_chars % 2 = 0 AS verified, CASE WHEN n_chars % 3 = 0 THEN 3600::BIGINT END AS utc_offset,
       CASE WHEN n_chars % 2 = 0 THEN '0-' || length(lang) || ':' || lang || ' 5-' || n_chars || ':' || source ELSE '' END AS hashtags,
       CASE WHEN n_chars % 3 = 0 THEN '1-2:' || source ELSE '' END AS user_mentions,
       CASE WHEN n_chars % 5 = 0 THEN n_chars || '-' || (n_chars + 1) || ':http://y.example/u' || doc_id ELSE '' END AS urls,
       CASE WHEN n_chars % 4 = 0 THEN doc_id END AS retweeted_id,
       CASE WHEN n_chars % 4 = 0 THEN 'orig' END AS retweeted_author,
       CASE WHEN n_chars % 4 = 0 THEN reverse(source) END AS retweeted_text
FROM documents WHERE doc_id % 13 <> 0"""

SQL["damaged_posts"] = """SELECT count(*) AS lines, count(CASE WHEN doc_id % 13 = 0 THEN 1 END) AS damaged,
       max(CASE WHEN doc_id % 13 <> 0 THEN doc_id END) AS last_post FROM documents"""

SQL["sorted_files"] = f"""WITH {_STATS_CTE}
SELECT serving_cell, neighbor_cell, cnt, row_number() OVER (ORDER BY serving_cell, neighbor_cell) AS place FROM st"""

SQL["stream_pair_sums"] = f"""WITH {_pairs()},
t AS (SELECT id, epoch(date_trunc('hour', day0 + to_milliseconds((pk * 60000) % 86400000)))::BIGINT AS window_start
      FROM r)
SELECT t.window_start, serving_cell, neighbor_cell, count(*) AS cnt, sum(s) AS sum_s, sum(n) AS sum_n,
       sum(s * s) AS sum_ss, sum(s * n) AS sum_sn, sum(n * n) AS sum_nn
FROM p JOIN t ON p.id = t.id
GROUP BY t.window_start, serving_cell, neighbor_cell"""

SQL["stream_with_batch"] = SQL["partial_store"] = _stats()
SQL["windowed_stats_by_name"] = _stats(window=_months("day0"))

# Files are months, a tenth of the rows in that of 18 months later; a micro-batch reads 12 files.  A row is judged
# against the watermark of the batch before its own, which has seen the batches before that.
SQL["stream_late_rows"] = f"""WITH {_pairs()},
f AS (SELECT id, day0 + to_milliseconds((pk * 60000) % 86400000) AS ts,
             date_trunc('month', day0) + CASE WHEN o % 10 = 0 THEN INTERVAL 18 MONTH ELSE INTERVAL 0 MONTH END AS file
      FROM r),
b AS (SELECT *, (dense_rank() OVER (ORDER BY file) - 1) // 12 AS batch FROM f),
seen AS (SELECT batch, max(ts) AS top FROM b WHERE id IN (SELECT id FROM p) GROUP BY batch),
t AS (SELECT id, date_trunc('hour', ts) AS window_start,
             (SELECT max(top) FROM seen WHERE seen.batch <= b.batch - 2) - INTERVAL 30 DAY AS mark FROM b)
SELECT epoch(window_start)::BIGINT AS window_start, serving_cell, neighbor_cell, count(*) AS cnt, sum(s) AS sum_s,
       sum(n) AS sum_n, sum(s * s) AS sum_ss, sum(s * n) AS sum_sn, sum(n * n) AS sum_nn
FROM p JOIN t ON p.id = t.id
WHERE mark IS NULL OR window_start + INTERVAL 1 HOUR > mark
GROUP BY t.window_start, serving_cell, neighbor_cell"""

# Variances do not change when all values move, so the expected ones come from the values as they are.
SQL["rollup_large_values"] = f"""WITH {TAB_PAIRS}
SELECT serving_cell, neighbor_cell, """ + ", ".join(
    f"floor({e} * 10 + 0.6180339887::DOUBLE)::BIGINT AS {k}" for k, e in [
        ("var_s", VAR(C, "sum(s * s)", "sum(s)")), ("cov_sn", COV(C, "sum(s * n)", "sum(s)", "sum(n)")),
        ("var_n", VAR(C, "sum(n * n)", "sum(n)"))]) + """, count(*) AS cnt
FROM p GROUP BY serving_cell, neighbor_cell"""

_Q = "''"   # one quote inside an SQL string literal
SQL["tuple_text"] = f"""WITH {_STATS_CTE},
lg AS ({_long('st', 1, 1)})
SELECT kind, measured_cell_1, measured_cell_2,
       '(' || case_id || ', ' || rnp_simulation_id || ', {_Q}' || kind || '{_Q}, {_Q}' || cell
       || '{_Q}, {_Q}' || measured_cell_1 || '{_Q}, {_Q}' || measured_cell_2 || '{_Q}, '
       || CASE WHEN regexp_matches(printf('%.12g', value), '[.en]') THEN printf('%.12g', value)
               ELSE printf('%.12g', value) || '.0' END || ', ' || cnt || ')' AS line
FROM lg"""

SQL["record_times"] = f"""WITH {RECORDS}
SELECT o AS record_id, (epoch_ms(day0) + (pk * 60000) % 86400000)::BIGINT AS event_ms
FROM r"""
