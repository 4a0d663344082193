"""Texts as runs of independent chunks, and tokenizers that encode each distinct chunk once.

A chunk starts before a space that stands between a character known not to be white space
and a byte above the space.  For the tokenizers here such a place is always a token boundary that
neither side sees across: the byte-level splitting pattern takes white space only at the start of a
piece and looks ahead only from white space, and no merge of the piece vocabulary puts its word
mark behind another character.  Both are checked when a tokenizer is loaded; one that fails the
check gets whole texts as chunks.  So the tokens of a text are the tokens of its chunks in a row,
and a task encodes each distinct chunk once.

A byte-level vocabulary may also be cut finely: between letters, digits and other signs of ASCII (not
after an apostrophe, which may start a contraction), and round a single line end between
other characters.  The splitting pattern has a border at each of these places too, and a piece
vocabulary allows those between signs that none of its pieces holds side by side.  Special tokens that
a tokenizer recognises in texts are never cut.

Very long texts come in several segments of about ``SEGMENT`` bytes.  A stretch without a cut is
one chunk however long, so its tokens are held at once.
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

from .common import text_chunks

SEGMENT = 1 << 20          # text bytes handled at once: bounds the arrays of a task
KEPT_CHUNKS = 200_000      # distinct chunks and bytes of them a task remembers before it starts anew
KEPT_BYTES = 16 << 20
LINE = 1 << 12             # bytes of chunks that are encoded as one text

_LEAD2 = np.zeros(256, bool)
_LEAD2[0xC3:0xE0] = True               # two-byte characters but U+0080..U+00BF
_LEAD3 = np.zeros(256, bool)
_LEAD3[[0xE0, *range(0xE4, 0xF0)]] = True   # three-byte ones but those blocks that hold spaces


#: classes of ASCII signs: 1 letter, 2 digit, 3 other; 0 white space, control and bytes beyond ASCII
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1


def _fine_places(buf: np.ndarray) -> np.ndarray:
    """Further positions at which a finely cut chunk may start."""
    kind = _CLASS[buf]
    # letters U+00C0..U+00FF (but the signs for times and divided) by their second byte
    second = np.flatnonzero(buf[:-1] == 0xC3) + 1
    kind[second[(buf[second] != 0x97) & (buf[second] != 0xB7)]] = 1
    ascii_ = buf < 0x80
    signs = (kind[1:] != kind[:-1]) & (kind[:-1] > 0) & (kind[1:] > 0) & ascii_[1:] & (buf[:-1] != 0x27)
    line = np.flatnonzero(buf[1:-1] == 0x0A) + 1
    line = line[kind[line - 1] > 0]
    after = line[(kind[line + 1] > 0) & ascii_[line + 1]] + 1
    return np.concatenate([np.flatnonzero(signs) + 1, line, after])


def _outside(at: np.ndarray, buf: np.ndarray, whole: tuple[bytes, ...]) -> np.ndarray:
    """The positions that do not lie inside one of the ``whole`` strings."""
    raw = buf.tobytes() if whole else b""
    for w in whole:
        i = raw.find(w)
        while i >= 0:
            at = at[(at <= i) | (at >= i + len(w))]
            i = raw.find(w, i + 1)
    return at


def cut_places(buf: np.ndarray, fine: bool = False, whole: tuple[bytes, ...] = (),
               joined: np.ndarray | None = None) -> np.ndarray:
    """Positions in ``buf`` at which a chunk may start, its own start not among them, in order.  ``joined``
    tells which bytes may not be parted."""
    at = _word_places(buf)
    if fine and len(buf) > 2:
        at = np.sort(np.concatenate([at, _fine_places(buf)]))
        at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
        if joined is not None:
            at = at[~joined[buf[at - 1], buf[at]]]
    return _outside(at, buf, whole) if fine else at


def _word_places(buf: np.ndarray) -> np.ndarray:
    n = len(buf)
    if n < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(buf[1:-1] == 0x20) + 1
    at = at[buf[at + 1] > 0x20]
    before = buf[at - 1]
    high = before >= 0x80
    # padding in front: a character that starts before the buffer is not known
    pad = np.concatenate([np.zeros(4, np.uint8), buf])
    wide = high & (_LEAD2[pad[at + 2]] | (_LEAD3[pad[at + 1]] & (pad[at + 2] >= 0x80)) | (pad[at] >= 0xF0))
    return at[((before > 0x20) & (before < 0x7F)) | wide]


def _pieces(buf: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """A long text in runs of about ``limit`` bytes, cut where a chunk may start."""
    while len(buf) > limit:
        reach = limit
        while True:
            at = cut_places(buf[:reach])
            if len(at) or reach >= len(buf):
                break
            reach *= 2
        if not len(at):
            break
        yield buf[:at[-1]]
        buf = buf[at[-1]:]
    yield buf


def segments(texts: pa.Array, cut: bool = True, limit: int | None = None, fine: bool = False,
             whole: tuple[bytes, ...] = (), joined: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes], bool]]:
    """``(row, counts, codes, chunks, open)``: from ``row`` on, how many chunks each text has here, the
    chunks of all of them in order as places in the distinct ``chunks``, and whether the last
    text goes on in the next segment.  Null counts as empty."""
    limit = limit or SEGMENT
    for rows, buf, offsets in text_chunks(texts, limit):
        parts = [(buf, offsets)]
        if len(offsets) == 2 and cut and len(buf) > limit:
            parts = ((p, np.array([0, len(p)], np.int64)) for p in _pieces(buf, limit))
        left = len(buf)
        for part, bounds in parts:
            left -= len(part)
            starts = bounds[:-1][np.diff(bounds) > 0]
            if cut:
                # a text's last space starts no chunk, and no place is judged by the text before
                at = cut_places(part, fine, whole, joined)
                text = np.searchsorted(bounds, at, "right")
                at = at[((bounds[text] > at + 1) | (part[at] != 0x20)) & (bounds[text - 1] < at)]
                if fine:
                    # a line end at the end of a text, or right after its start, was seen with its neighbours
                    at = at[(part[at - 1] != 0x0A) | (at - bounds[np.searchsorted(bounds, at, "right") - 1] > 1)]
                starts = np.sort(np.concatenate([starts, at]), kind="stable")     # two sorted runs
            ends = np.append(starts, len(part)).astype(np.int64)
            counts = np.diff(np.searchsorted(starts, bounds))
            cells = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(part))])
            d = cells.dictionary_encode()
            yield rows.start, counts, d.indices.to_numpy(zero_copy_only=False), d.dictionary.to_pylist(), left > 0


class Remembered:
    """What ``make`` gives for chunks, made once per task for each distinct one and kept as arrays.

    ``make(chunks)`` returns ``(lens, flat, fixed, notes)``: a run of values per chunk, its runs one after the
    other in ``flat``, a row of whole numbers per chunk, and an object per chunk.
    """

    def __init__(self, make):
        self.make = make
        self._forget()

    def _forget(self) -> None:
        self.known, self.held, self.notes = {}, 0, []
        self.lens = self.starts = np.zeros(0, np.int64)
        self.flat = self.fixed = None
        self.met_again = np.zeros(0, bool)

    def _thin(self) -> None:
        """Keep the chunks that came again; if those are most, start anew."""
        keep = np.flatnonzero(self.met_again)
        chunks = list(self.known)              # in the order of their places
        size = sum(len(chunks[i]) for i in keep.tolist())
        if len(keep) > KEPT_CHUNKS // 2 or size > KEPT_BYTES // 2:
            return self._forget()
        flat, lens = self.values(keep), self.lens[keep]
        self.notes = [self.notes[i] for i in keep.tolist()] if self.notes else []
        self.known = {chunks[k]: i for i, k in enumerate(keep.tolist())}
        self.held, self.flat, self.lens, self.fixed = size, flat, lens, self.fixed[keep]
        self.starts, self.met_again = np.cumsum(lens) - lens, np.zeros(len(keep), bool)

    def __call__(self, chunks: list[bytes]) -> np.ndarray:
        """The place of each chunk in ``lens``, ``starts``, ``fixed`` and ``notes``; good until the next call."""
        if len(self.known) > KEPT_CHUNKS or self.held > KEPT_BYTES:
            self._thin()
        at = np.fromiter(map(self.known.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(at < 0)
        self.met_again[at[at >= 0]] = True
        if len(new) or self.flat is None:
            asked = [chunks[i] for i in new.tolist()]
            lens, flat, fixed, notes = self.make(asked)
            at[new] = len(self.lens) + np.arange(len(new))
            self.known.update(zip(asked, at[new].tolist()))
            self.held += sum(map(len, asked))
            self.flat = flat if self.flat is None else np.concatenate([self.flat, flat])
            self.fixed = fixed if self.fixed is None else np.concatenate([self.fixed, fixed])
            self.lens = np.concatenate([self.lens, lens])
            self.starts = np.cumsum(self.lens) - self.lens
            self.met_again = np.concatenate([self.met_again, np.zeros(len(new), bool)])
            self.notes.extend(notes)
        return at

    def values(self, places: np.ndarray) -> np.ndarray:
        """The runs of the chunks at ``places``, one after the other."""
        return self.flat[runs(self.starts[places], self.lens[places])]


def _byte_alphabet() -> dict[str, int]:
    """Characters of byte-level vocabularies and the bytes they stand for: printable
    bytes stand for themselves, the rest for the characters from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level vocabulary of the tokenizers library."""

    def __init__(self, path: str, specials_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # a task has one core
        from tokenizers import Tokenizer
        import json
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = specials_as_text
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, extra = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
        self.cuts = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex", True))
                     and not pre.get("add_prefix_space") and not spec.get("post_processor") and not any(
                         t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in extra))
        #: special tokens recognised in texts
        self.whole = () if specials_as_text else tuple(t["content"].encode() for t in extra)
        alphabet, special = _byte_alphabet(), {t["id"] for t in extra}
        size = self.tok.get_vocab_size()
        names = [self.tok.id_to_token(i) or "" for i in range(size)]
        self.token_bytes = [n.encode() if i in special else bytes(alphabet[c] for c in n) for i, n in enumerate(names)]
        self.lens = np.fromiter(map(len, self.token_bytes), np.int64, size)

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(lens, ids)``: how many identifiers each chunk has, and all of them in order.

        A text costs much beside its words, so chunks that may stand side by side (a text would be cut between
        them) are encoded as one text, and its tokens' bytes tell whose they are."""
        if not self.cuts or len(chunks) < 2:
            return self._texts(chunks)
        text, size = b"".join(chunks), np.fromiter(map(len, chunks), np.int64, len(chunks))
        ends = np.cumsum(size)
        may = np.zeros(len(text) + 1, bool)
        may[cut_places(np.frombuffer(text, np.uint8), True, self.whole)] = True
        line = np.flatnonzero(~may[ends] | (ends // LINE != (ends - size) // LINE))     # the last chunks of lines
        stops = ends[line]
        n, ids = self._texts([text[lo:hi] for lo, hi in zip([0, *stops[:-1].tolist()], stops.tolist())])
        reach = np.concatenate([[0], np.cumsum(self.lens[ids])])
        at = np.searchsorted(reach, ends)
        if (reach[np.cumsum(n)] != stops).any() or (reach[at] != ends).any():
            return self._texts(chunks)      # tokens that are not their text's bytes
        return np.diff(at, prepend=0), ids

    def _texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        got = self.tok.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return _flat([e.ids for e in got])


class Pieces:
    """A sentencepiece model that puts a word mark before a text; here the texts' first space is that mark."""

    AFTER = "\n"      # no piece holds it with another sign, so what follows it is encoded as it stands

    def __init__(self, path: str):
        import sentencepiece
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = range(self.sp.get_piece_size())
        names = [self.sp.id_to_piece(i) for i in size]
        #: last and first bytes of characters that stand side by side in some piece
        self.joined = np.zeros((256, 256), bool)
        for i, n in enumerate(names):
            if not (self.sp.is_byte(i) or self.sp.is_control(i) or self.sp.is_unknown(i)):
                signs = [c.encode() for c in n.replace("▁", " ")]
                for x, y in zip(signs, signs[1:]):
                    self.joined[x[-1], y[0]] = True
        end = ord(self.AFTER)
        self.cuts = not (self.joined[:32, 32].any() or self.joined[33:, 32].any()
                         or self.joined[end].any() or self.joined[:, end].any())
        self.skip = len(self.sp.encode(self.AFTER))
        self.token_bytes = [bytes([int(n[3:5], 16)]) if self.sp.is_byte(i) else n.replace("▁", " ").encode()
                            for i, n in enumerate(names)]

    def encode(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """As ``ByteLevel.encode``."""
        texts = [c.decode("utf-8", "replace") for c in chunks]
        if not self.cuts:
            return _flat(self.sp.encode([t[1:] for t in texts], num_threads=1))
        return _flat([ids[self.skip:] for ids in self.sp.encode([self.AFTER + t for t in texts], num_threads=1)])


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lens = np.fromiter(map(len, lists), np.int64, len(lists))
    return lens, np.fromiter(chain.from_iterable(lists), np.int64, int(lens.sum()))


def give_back() -> None:
    """Return freed memory to the system at the end of a task: an idle worker would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass                    # a C library without it


_LOADED: dict[tuple, object] = {}


def loaded(kind, *args):
    """A tokenizer, loaded once per worker."""
    key = (kind, *args)
    if key not in _LOADED:
        _LOADED[key] = kind(*args)
    return _LOADED[key]


def runs(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of runs, one after the other."""
    before = np.cumsum(lens) - lens
    return np.repeat(starts - before, lens) + np.arange(int(lens.sum()))


def sums_by_text(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of consecutive runs of ``values``, ``counts`` long each."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
