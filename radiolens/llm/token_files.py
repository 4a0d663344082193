"""Token counts of documents in flat token files, by a separator scan.

A token file is a plain run of 16-bit token identifiers; every document ends with
the end-of-document identifier, and there is no index.  Files are stored as
consecutive blocks (file, block, bytes) of a fixed number of tokens, so documents
straddle blocks at will.

The scan finds the separators of each block with one vectorised comparison.  A block reports how
many documents end in it and how many tokens lie before its first and after its last
separator; a prefix scan over these small reports (within a file) says which document
each block starts in and how many of its tokens lie in earlier blocks.  The files are
read once, and only these reports are shuffled.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, text_chunks

BLOCK_TOKENS = 1 << 18
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256                      # fixed value: the identifier left free by that vocabulary
#: Fixed value: the vocabulary's published splitting pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Runs of white space (of the pattern's kind) too long for the pattern's matcher, which recurses over them.
LONG_BLANK = re.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]{4096,}")

_ENCODERS: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a rank file, loaded once per worker."""
    if path not in _ENCODERS:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path] = tiktoken.Encoding("flat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[path]


def encode(enc, text: str) -> list[int]:
    """The text's tokens.  A long run of white space is taken out as the pattern would take it: all of it at the
    end of the text, else all but its last character, which goes with what follows."""
    out, at = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        out += enc.encode_ordinary(text[at:run.start()])
        out += enc._encode_single_piece(text[run.start():end])
        at = end
    return out + enc.encode_ordinary(text[at:])


def write_token_files(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      tokenizer: str = TOKENIZER, block_tokens: int = BLOCK_TOKENS) -> tuple[DataFrame, DataFrame]:
    """``(blocks, manifest)``: ``file, block, data`` and ``file, place, _id``, both written to
    the shared folder.  A task's documents make one file, in the order it reads them; the manifest
    says which document is at which place, and nothing about lengths."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, held, n, block, place = encoder(tokenizer), [], 0, 0, 0

        def cells(ids: pa.Array | None, data: bytes | None) -> pa.RecordBatch:
            rows = 1 if ids is None else len(ids)
            nonlocal block, place
            out = pa.RecordBatch.from_arrays(
                [pa.array([block] * rows if ids is None else [None] * rows, pa.int64()),
                 pa.array([data] * rows, pa.binary()),
                 pa.array([None] * rows if ids is None else np.arange(place, place + rows), pa.int64()),
                 pa.nulls(rows, pa_kind) if ids is None else ids], ["block", "data", "place", "_id"])
            if ids is None:
                block += 1
            else:
                place += rows
            return out

        pa_kind = None
        for b in batches:
            pa_kind = b.column(0).type
            if len(b):
                yield cells(b.column(0), None)
            for _, buf, offsets in text_chunks(b.column(1)):
                raw = buf.tobytes()
                for lo, hi in zip(offsets[:-1], offsets[1:]):
                    t = encode(enc, raw[lo:hi].decode("utf-8", "replace"))
                    t.append(END)
                    held.append(np.array(t, np.uint16))
                    n += len(t)
                    while n >= block_tokens:
                        flat = np.concatenate(held)
                        yield cells(None, flat[:block_tokens].tobytes())
                        held, n = [flat[block_tokens:]], n - block_tokens
        if n:
            yield cells(None, np.concatenate(held).tobytes())

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, f"block long, data binary, place long, _id {kind}")
    # one write; the file's number is the writing task's
    all_ = staged(rows.withColumn("file", F.spark_partition_id()), "token-files")
    return (all_.where("block is not null").select("file", "block", "data"),
            all_.where("place is not null").select("file", "place", "_id"))


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        gaps, tail = [], []
        for cell in b.column(2):
            ids = np.frombuffer(cell.as_buffer(), np.uint16)
            at = np.flatnonzero(ids == END)
            gaps.append(np.diff(at, prepend=-1) - 1)
            tail.append(int(len(ids) - at[-1] - 1) if len(at) else len(ids))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(gaps, pa.list_(pa.int64())), pa.array(tail, pa.int64())],
            ["file", "block", "gaps", "tail"])


def scan_counts(blocks: DataFrame) -> DataFrame:
    """``file, place, n_tokens``: tokens of each document of the files, the separator not counted.
    Tokens after a file's last separator belong to no document."""
    reports = staged(blocks.mapInArrow(_reports, "file int, block long, gaps array<bigint>, tail long"), "reports")
    scan = reports.select("file", "block", "tail", F.size("gaps").alias("ends"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    # a block's first document began after the last separator before it: tokens carried over are
    # the tail of the latest block with a separator and all blocks since
    scan = scan.withColumns({
        "start": F.coalesce(F.sum("ends").over(before), zero),
        "since": F.coalesce(F.sum((F.col("ends") > 0).cast("int")).over(before), zero),
        "carried": F.coalesce(F.last(F.when(F.col("ends") > 0, F.col("tail")), ignorenulls=True).over(before), zero)})
    within = Window.partitionBy("file", "since").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    scan = scan.withColumn("open", F.col("carried") + F.coalesce(
        F.sum(F.when(F.col("ends") == 0, F.col("tail"))).over(within), zero))
    found = reports.select("file", "block", F.posexplode("gaps").alias("j", "gap"))
    return found.join(scan.select("file", "block", "start", "open"), ["file", "block"]).select(
        "file", (F.col("start") + F.col("j")).alias("place"),
        (F.col("gap") + F.when(F.col("j") == 0, F.col("open")).otherwise(0)).alias("n_tokens"))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = TOKENIZER, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per input row: id, ``n_tokens``.

    Null and empty texts have 0 tokens; repeated rows are documents of their own.  The
    texts are written as token files, and counted from those alone.  Very long texts straddle blocks; a long
    run of white space is one piece, as in the pattern.  An empty table gives no rows.
    """
    blocks, manifest = write_token_files(docs, id_col, text_col, tokenizer, block_tokens)
    return manifest.join(scan_counts(blocks), ["file", "place"]).select(F.col("_id").alias(id_col), "n_tokens")
