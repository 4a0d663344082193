"""Token identifiers in seekable zstandard files.

A file is a run of independent zstandard frames, a document table and a seek table:

* data frames: identifiers as little-endian unsigned 32-bit integers, about ``FRAME`` bytes each; a
  frame holds whole documents, a longer document fills frames of its own;
* a skippable frame with the document table: per document its identifier, its number of identifiers
  and whether the identifier is null, then a checksum of the table;
* a skippable frame with the seek table of the public zstandard seekable format: compressed size, size
  and checksum (low half of XXH64) of every frame, then their number, a flag byte and the magic.

Any zstandard decoder reads the whole file; a reader of single documents reads the tables
and decompresses only the frames that hold them.

Documents lie in ascending order of identifier over all files of a write.  Each task of a range
partitioning streams its documents into one file of the shared folder, under a name of its own attempt; only files
that the written table of files names are read, so a task that runs again or twice leaves nothing in the
result.  Executors reach the folder through Arrow's file systems.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staging_path
from .common import staged
from .word_chunks import ByteLevel, Remembered, give_back, loaded, segments, sums_by_text

FRAME = 1 << 18             # bytes of identifiers a frame holds before it is closed
END = 0                     # identifier appended to every document
WIDTH = 4
LEVEL = 3
FILE_BYTES = 128 << 20      # text for one file

# Fixed values of the public zstandard seekable format.
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
ENTRY, FOOTER, HEADER = struct.Struct("<III"), struct.Struct("<IBI"), struct.Struct("<II")
#: The document table is a skippable frame with a magic of its own.
TABLE_MAGIC = 0x184D2A50
ROW = np.dtype([("id", "<i8"), ("n", "<u8"), ("null", "u1")])


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or file name, and the name within it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Writer:
    """Streams documents into one file."""

    def __init__(self, path: str, frame: int):
        self.path, self.frame = path, frame
        system, name = file_system(path)
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(name, compression=None)   # the frames are our own
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.held, self.size, self.entries, self.rows = [], 0, [], []
        self.open = 0           # identifiers of the document being written

    def _close_frame(self) -> None:
        if self.size:
            data = b"".join(self.held)
            packed = self.zstd.compress(data)
            self.out.write(packed)
            self.entries.append((len(packed), len(data), checksum(data)))
            self.held, self.size = [], 0

    def add(self, ids: np.ndarray) -> None:
        """Identifiers of the current document, a run at a time."""
        data = ids.astype("<u4").tobytes()
        if self.size and self.size + len(data) > self.frame and not self.open:
            self._close_frame()
        self.open += len(ids)
        for at in range(0, len(data), self.frame):
            self.held.append(data[at:at + self.frame])
            self.size += len(self.held[-1])
            if self.size >= self.frame:
                self._close_frame()

    def end(self, doc_id: int | None) -> None:
        self.add(np.array([END], np.uint32))
        self.rows.append((doc_id or 0, self.open, doc_id is None))
        self.open = 0
        if self.size >= self.frame:
            self._close_frame()

    def close(self) -> int:
        """Write both tables; the file's size."""
        self._close_frame()
        table = np.array(self.rows, ROW).tobytes()
        table += struct.pack("<I", checksum(table))
        self.out.write(HEADER.pack(TABLE_MAGIC, len(table)) + table)
        # an empty frame to a decoder, so its size is 0 and its checksum that of nothing
        self.entries.append((HEADER.size + len(table), 0, checksum(b"")))
        seek = b"".join(ENTRY.pack(*e) for e in self.entries) + FOOTER.pack(len(self.entries), CHECKSUMS, SEEK_MAGIC)
        self.out.write(HEADER.pack(SKIPPABLE, len(seek)) + seek)
        n = self.out.tell()
        self.out.close()
        return n


class Reader:
    """Reads the tables of one file, then only the frames asked for."""

    def __init__(self, path: str):
        system, name = file_system(path)
        self.path, self.file = path, system.open_input_file(name)
        size = self.file.size()
        n, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEK_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"{path}: no seek table")
        raw = self._at(size - FOOTER.size - n * ENTRY.size, n * ENTRY.size)
        self.entries = np.frombuffer(raw, "<u4").reshape(n, 3).astype(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.entries[:, 0])])
        #: identifiers before each frame
        self.before = np.concatenate([[0], np.cumsum(self.entries[:, 1])]) // WIDTH
        table = self._at(int(self.offsets[n - 1]), int(self.entries[n - 1, 0]))[HEADER.size:]
        if checksum(table[:-4]) != struct.unpack("<I", table[-4:])[0]:
            raise ValueError(f"{path}: damaged document table")
        self.rows = np.frombuffer(table[:-4], ROW)
        ends = np.cumsum(self.rows["n"].astype(np.int64))
        self.starts, self.ends = ends - self.rows["n"].astype(np.int64), ends
        self.frames_read = 0

    def _at(self, offset: int, n: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(n)

    def frame(self, i: int) -> np.ndarray:
        """One frame's identifiers, decompressed and verified."""
        data = zstandard.ZstdDecompressor().decompress(self._at(int(self.offsets[i]), int(self.entries[i, 0])))
        if len(data) != self.entries[i, 1] or checksum(data) != self.entries[i, 2]:
            raise ValueError(f"{self.path}: damaged frame {i}")
        self.frames_read += 1
        return np.frombuffer(data, "<u4")

    def runs(self, place: int) -> Iterator[np.ndarray]:
        """The identifiers of the document at ``place``, a frame at a time."""
        lo, hi = int(self.starts[place]), int(self.ends[place])
        i = int(np.searchsorted(self.before, lo, "right")) - 1
        while lo < hi:
            ids = self.frame(i)
            first = int(self.before[i])
            yield ids[lo - first:hi - first]
            lo, i = first + len(ids), i + 1

    def documents(self) -> Iterator[tuple[int, np.ndarray, bool]]:
        """``(place, run, last)`` over the whole file, every frame decompressed once."""
        place, n = 0, len(self.rows)
        for i in range(len(self.entries) - 1):
            ids, first = self.frame(i), int(self.before[i])
            end = first + len(ids)
            while place < n and self.starts[place] < end:
                lo, hi = max(int(self.starts[place]), first), min(int(self.ends[place]), end)
                last = self.ends[place] <= end
                yield place, ids[lo - first:hi - first], bool(last)
                if not last:
                    break
                place += 1

    def close(self) -> None:
        self.file.close()


def write_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", frame: int = FRAME,
                files: int | None = None, specials_as_text: bool = False) -> DataFrame:
    """Write every text's identifiers and return the table of files:
    ``path, part, n_docs, n_ids, n_bytes``, parts in ascending order of the documents."""
    folder = staging_path(docs.sparkSession, "token-frames")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = loaded(ByteLevel, tokenizer, specials_as_text)
        known, out, n_ids = Remembered(lambda chunks: (*tok.encode(chunks), np.zeros((len(chunks), 0), np.int64), [])), None, 0
        part = TaskContext.get().partitionId()
        for b in batches:
            ids = b.column(0).to_pylist()
            for row, counts, codes, chunks, goes_on in segments(b.column(1), tok.cuts, fine=True, whole=tok.whole):
                if out is None:
                    out = Writer(f"{folder}/part-{part:06d}-{uuid.uuid4().hex[:12]}.zst", frame)
                places = known(chunks)[codes]
                flat, at = known.values(places), 0
                ends = np.cumsum(sums_by_text(known.lens[places], counts))
                for j, end in enumerate(ends.tolist()):
                    if end > at:
                        out.add(flat[at:end])
                    at = end
                    if j < len(ends) - 1 or not goes_on:
                        n_ids += out.open + 1
                        out.end(ids[row + j])
        if out is not None:
            known, docs_in = None, len(out.rows)
            give_back()
            size = out.close()
            yield pa.RecordBatch.from_pydict({"path": [out.path], "part": [part], "n_docs": [docs_in],
                                              "n_ids": [n_ids], "n_bytes": [size]}, schema=FILES)

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.withColumn("_h", F.xxhash64("_text"))
    if files is None:
        size = rows.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
        files = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // FILE_BYTES))
    # equal identifiers may be a large share of the rows: the text's hash cuts them too
    ordered = (rows.repartitionByRange(int(files), "_id", "_h").sortWithinPartitions("_id", "_h", "_text")
               .select("_id", "_text"))
    return staged(ordered.mapInArrow(run, "path string, part int, n_docs long, n_ids long, n_bytes long"), "token-file-list")


FILES = pa.schema([("path", pa.string()), ("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                   ("n_bytes", pa.int64())])
OUT = pa.schema([("_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            r = Reader(path)
            crc, crcs, done = 0, [], 0

            def rows(lo: int, hi: int) -> pa.RecordBatch:
                part = r.rows[lo:hi]
                return pa.RecordBatch.from_arrays(
                    [pa.array(part["id"], pa.int64(), mask=part["null"].astype(bool)), pa.array(before + r.starts[lo:hi]),
                     pa.array(part["n"].astype(np.int64)), pa.array(crcs, pa.int64())], schema=OUT)

            for place, run, last in r.documents():
                crc = zlib.crc32(run.tobytes(), crc)
                if last:
                    crcs.append(crc)
                    crc = 0
                    if len(crcs) == 4096:
                        yield rows(done, place + 1)
                        crcs, done = [], place + 1
            if crcs:
                yield rows(done, done + len(crcs))
            r.close()


def read_files(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files: id, ``start`` (identifiers of all documents before it), ``n_tokens`` and
    ``ids_crc32`` (of its identifiers), every frame verified."""
    # one row per file, the sums of a task each
    before = F.coalesce(F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0).cast("long"))
    placed = staged(files.select("path", before.alias("before")), "token-file-starts")
    n = max(1, placed.count())
    return placed.repartition(n).mapInArrow(_scan, "_id long, start long, n_tokens long, ids_crc32 long") \
        .withColumnRenamed("_id", id_col)


def fetch(files: DataFrame, ids: Sequence[int], id_col: str = "doc_id") -> DataFrame:
    """``id, ids`` of the documents asked for; of every file only the tables and the frames that hold
    them are read.  The list is the caller's and travels with the tasks."""
    wanted = np.unique(np.array(list(ids), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                r = Reader(path)
                for place in np.flatnonzero(np.isin(r.rows["id"], wanted) & (r.rows["null"] == 0)):
                    got = np.concatenate(list(r.runs(int(place))))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(r.rows["id"][place])]), pa.array([got.astype(np.int64)], pa.list_(pa.int64()))],
                        ["_id", "ids"])
                r.close()

    return files.select("path").mapInArrow(run, "_id long, ids array<bigint>").withColumnRenamed("_id", id_col)


def token_frames(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Write the texts to seekable files and read every document back from them.

    One row per input row.  A null text is empty, and an empty one is the end identifier alone;
    rows that repeat an identifier are documents of their own, ordered by text; null
    identifiers come first.  A table without rows writes no file and gives no rows.  Very long texts are
    encoded and written in pieces and fill several frames.  Only the two named columns are read,
    so others may have any name.
    """
    return read_files(write_files(docs, tokenizer, id_col, text_col, **options), id_col)
