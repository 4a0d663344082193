"""Shared pieces: input columns, staged tables, batched byte and word work.

Every operator selects the columns it needs under private names first, so
extra columns of any name cannot clash with its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later uses read
    the table, and a lost executor loses none of it."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """Lower-case A-Z and nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda would
    otherwise compute what it refers to again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# --- batches of bytes in numpy ------------------------------------------------

CHUNK_BYTES = 4 << 20   # text handled at once inside a task: bounds its arrays

#: bytes that are part of a word: [^\x20\x09-\x0D]
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
#: bytes that are part of a word: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing A-Z
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LOW = np.arange(256, dtype=np.uint8)
_LOW[0x41:0x5B] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93                        # odd, so it has an inverse mod 2^64
INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept per worker and grown as needed."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 1 << 20, 0 if have is None else 2 * len(have)), base, np.uint64)
        p[0] = 1
        _POWERS[base] = have = np.multiply.accumulate(p)
    return have[:n]


def prefix_hash(buf: np.ndarray, lower: bool = True) -> np.ndarray:
    """S with S[j] - S[i] = sum of byte[k] * base^k for i <= k < j."""
    table = _BYTE[_LOW] if lower else _BYTE
    out = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(table[buf] * powers(_BASE, len(buf)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, equal for equal bytes at any place."""
    h = (prefix[ends] - prefix[starts]) * powers(INVERSE, len(prefix))[starts]
    return mix64(h + mix64((ends - starts).astype(np.uint64)))


def word_spans(buf: np.ndarray, offsets: np.ndarray, member: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, counts)``: words of all texts in order, and how many
    each text has; ``offsets`` bounds the texts in ``buf``."""
    inside = member[buf]
    edge = np.ones(len(buf) + 1, bool)
    edge[1:-1] = inside[1:] != inside[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    keep = inside[at[:-1]] if len(buf) else np.zeros(0, bool)
    starts, ends = at[:-1][keep], at[1:][keep]
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def ngram_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive word hashes (over the whole array; the
    caller drops those that cross texts)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[j:j + n]
    return mix64(out)


def text_chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES
                ) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """``(rows, bytes, offsets)`` for runs of texts of about ``limit`` bytes; a
    longer text is a run of its own.  Null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i, n = 0, len(texts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + limit, "right")) - 1)
        yield slice(i, j), whole[ends[i]:ends[j]], ends[i:j + 1] - ends[i]
        i = j


def packed(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary cells: consecutive runs of ``values``, ``counts`` long each."""
    width = values.dtype.itemsize
    offsets = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * width, out=offsets[1:])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts),
        [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def per_batch(fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]):
    """A mapInArrow function from one that handles a single batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield from fn(b)
    return run
