"""Fixed values of the per-call record formats.

These must equal the source format for correct decoding; they are stated
here once, as plain data.  Positions are 1-based, as in the format.
"""

from __future__ import annotations

# --- fixed values: real (version 6) call record -----------------------------
FIELD_SEP = ";"
PAYLOAD_START = "["
RECORD_END = "|"
MEAS_WIDTH = 4            # tokens per measurement: f1, cell, rsrp, f4
MEAS_CELL = 2             # position of the cell id inside a measurement
MEAS_RSRP = 3             # position of the RSRP inside a measurement
RSRP_MIN = -140.0         # RSRP index 0 corresponds to -140 dBm
SERVING_FIELD = 21        # serving cell of the canonical decoder
SERVING_FIELD_V0 = 3      # serving cell of the older first-report decoder
FIXED_FIELDS = 233        # fixed part = 233 + 36 * bearer_count fields
BEARER_COUNT_FIELD = 173
BEARER_FIRST_FIELD = 234
BEARER_WIDTH = 36
MIN_FIELDS_FIELD_STATS = 253
FILE_TIME_FORMAT = "yyyy-MM-dd.HH_mm"   # file name prefix, e.g. 2031-05-09.06_41

# Long export: statistic kinds in output order.
STAT_KINDS = ["MeanServer", "MeanNeighbor", "VarianceServer",
              "CovarianceNeighbor", "VarianceNeighbor"]

# Interference graph: share of a serving cell's non-self count (strict >).
EDGE_THRESHOLD = 0.09

# --- fixed values: synthetic record ------------------------------------------
SYN_SEP = ","
SYN_COUNT_INDEX = 3       # 0-based: serving, unused, unused, count, cell0, rsrp0, ...
SYN_FIRST_CELL_INDEX = 4

# --- field map of the real record: name -> (position, type) -----------------
# Positions from the format; names are ours.
FIELD_MAP: dict[str, tuple[int, str]] = {
    "version": (1, "int"),
    "serving_cell_v0": (3, "string"),
    "tz_offset": (4, "string"),
    "month_day": (5, "string"),
    "year": (6, "int"),
    "time_ms": (8, "bigint"),
    "serving_cell": (21, "string"),
    "cell_id": (131, "string"),
    "ue_location_capability": (158, "string"),
    "bearer_count": (173, "int"),
}

# Bearer block: name -> (offset from the block start, type); block k starts
# at field 234 + 36 * k.
BEARER_FIELDS: dict[str, tuple[int, str]] = {
    "pgw_id": (0, "string"),
    "apn": (1, "string"),
    "qci": (5, "int"),
    "setup_duration": (6, "bigint"),
    "bearer_id": (7, "int"),
    "ul_a": (14, "bigint"),
    "ul_b": (15, "bigint"),
    "ul_rlc_kbytes": (16, "bigint"),
    "dl_rlc_bytes": (17, "bigint"),
    "dl_b": (18, "bigint"),
    "dl_c": (19, "bigint"),
    "dl_d": (20, "bigint"),
    "tertiary_count": (31, "int"),
}


def bearer_field_position(name: str, k: int) -> int:
    """1-based position of a bearer field in block ``k`` (0-based)."""
    return BEARER_FIRST_FIELD + BEARER_WIDTH * k + BEARER_FIELDS[name][0]
