"""Seekable token files, tokenizer alignment and centroid clustering against brute force, on tables with nulls,
empty and long texts, repeated rows, ties and clashing names, and on empty tables."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from radiolens.llm import alignment, centroids, perfect_hash, queries, seekable, word_chunks

A, B = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")
RND = random.Random(5)
PROSE = " ".join(RND.choice("the of data Straße été naïve don't it's 12 3.5 (x) co-op 数据 ключ".split()) for _ in range(900))
TEXTS = [
    (0, PROSE), (1, PROSE[:60]), (2, None), (3, ""), (4, " "), (5, "  \n\t "), (6, "one two"), (7, "one  two "),
    (8, " lead"), (9, "tail "), (10, "a b　c  d  e\u0085 f"), (11, "▁marked ▁text"), (12, "<s> x</s> <0x41> <unk>"),
    (13, "say <|endoftext|> now<|endoftext|>"), (14, "nul \x00 byte"), (15, "数据数据 数据。 日本語のテキスト ありがとう"),
    (16, "🙂 🙂🙂 x 🙂"), (17, " " * 3000 + "x"), (18, "a" * 4000), (19, "line\nline two\r\n\tindented  code {\n    x = 1;\n}"),
    (20, "n" + "̃" + " ﬁ ½"), (21, (PROSE + "\n") * 4), (6, "one two"), (6, "one two three"), (None, "one two"), (None, None),
    (22, "word" + " " * 5), (23, "\n"), (24, "café café café"), (25, "'s 'll I'll  'twas")]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 7, 1) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, _text string, _id int, part int").repartition(5)


def whole_ids_a(text, specials_as_text):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = specials_as_text
    return t.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("segment", [1 << 20, 700])
def test_chunks_encode_as_whole_texts(monkeypatch, segment):
    import sentencepiece
    from tokenizers import Tokenizer
    monkeypatch.setattr(word_chunks, "SEGMENT", segment)
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    texts = [t for _, t in TEXTS] + ["".join(RND.choice(" ab's\né数▁0.,×́") for _ in range(RND.randrange(60))) for _ in range(3000)]
    texts += ["".join(RND.choice(["a", " ", "\n", "<|endoftext|>", "!", "7", "|>", "'s"]) for _ in range(12)) for _ in range(800)]
    one = Tokenizer.from_file(A)
    whole = lambda t: one.encode(t, add_special_tokens=False).ids
    a, b = word_chunks.ByteLevel(A, False), word_chunks.Pieces(B)
    for kind, tok, want, how in (("a", a, whole, {}), ("a", a, whole, {"fine": True, "whole": a.whole}),
                                 ("b", b, sp.encode, {}), ("b", b, sp.encode, {"fine": True, "joined": b.joined})):
        assert tok.cuts
        column = pa.array([(" " + t if kind == "b" and t else t) for t in texts], pa.string())
        got = [[] for _ in texts]
        for row, counts, codes, chunks, _ in word_chunks.segments(column, **how):
            (lens, ids), at = tok.encode(chunks), 0
            ends = np.cumsum(lens)
            for j, c in enumerate(counts):
                for code in codes[at:at + c]:
                    got[row + j] += ids[ends[code] - lens[code]:ends[code]].tolist()
                at += c
        for t, g in zip(texts, got):
            assert g == want(t or ""), repr(t)


@pytest.mark.parametrize("frame,files", [(1 << 18, 3), (64, 2), (256, 9)])
def test_seekable_files(spark, docs, frame, files):
    table = seekable.write_files(docs, A, frame=frame, files=files).cache()
    got = [tuple(r) for r in seekable.read_files(table).collect()]
    ids = {t: whole_ids_a(t or "", False) + [0] for _, t in TEXTS}
    want, start = [], 0
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        want.append((i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())))
    assert Counter((r[0], *r[2:]) for r in got) == Counter(want)
    for r in sorted(got, key=lambda r: r[1]):                   # gapless, in order of identifier
        assert r[1] == start
        start += r[2]
    order = [r[0] for r in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    # any decoder reads a file; the tables are frames it passes over
    paths = [r.path for r in table.orderBy("part").collect()]
    flat = b""
    for p in paths:
        with open(p, "rb") as f:
            flat += zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
    assert len(flat) == 4 * start
    # single documents: the frames that hold them and no others
    fetched = {(r.doc_id, tuple(r.ids)) for r in seekable.fetch(table, [0, 6, 999]).collect()}
    assert fetched == {(i, tuple(ids[t])) for i, t in TEXTS if i in (0, 6)}
    r = seekable.Reader(paths[-1])
    list(r.runs(0))
    covering = np.searchsorted(r.before, r.ends[0] - 1, "right") - np.searchsorted(r.before, r.starts[0], "right") + 1
    assert r.frames_read == covering <= len(r.entries) - 1
    # a changed byte in a frame is found
    with open(paths[-1], "rb") as f:
        raw = bytearray(f.read())
    raw[int(r.offsets[0]) + int(r.entries[0, 0]) // 2] ^= 1
    bad = paths[-1] + ".bad"
    with open(bad, "wb") as f:
        f.write(raw)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        seekable.Reader(bad).frame(0)


def test_seekable_files_empty_and_long(spark, docs):
    assert seekable.token_frames(docs.limit(0), A).count() == 0
    text = ("wort " * 400_000) + "x" * 300_000 + " " * 1_000_000
    out = seekable.token_frames(spark.createDataFrame([(1, text)], "doc_id long, text string"), A).collect()
    ids = whole_ids_a(text, False) + [0]
    assert [tuple(r) for r in out] == [(1, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))]


def aligned_by_hand(rows):
    """The alignment of every text, straight from its definition."""
    import sentencepiece
    from tokenizers import Tokenizer
    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    alphabet = word_chunks._byte_alphabet()

    def piece(i):
        p = sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if sp.is_byte(i) else p.replace("▁", " ").encode()

    per, df = [], Counter()
    for _, t in rows:
        if not t:
            per.append(None)
            continue
        ids_a, ids_b = one.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)
        bytes_a = [bytes(alphabet[c] for c in one.id_to_token(i)) for i in ids_a]
        bytes_b = [piece(i) for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            per.append(None)
            continue
        spans = []
        for tokens in (bytes_a, bytes_b):
            ends = np.cumsum([len(x) for x in tokens]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends)))
        links = [(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(spans[0]) for j, (u, v) in enumerate(spans[1]) if s < v and u < e]
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        texts, lo = [], 0
        for c in common:
            texts.append(",".join(str(i) for i, (s, e) in zip(ids_a, spans[0]) if lo <= s and e <= c) + "|"
                         + ",".join(str(i) for i, (s, e) in zip(ids_b, spans[1]) if lo <= s and e <= c))
            lo = c
        per.append((len(ids_a), len(ids_b), len(common), links, hashlib.sha256(";".join(texts).encode()).hexdigest()))
        df.update(set(links))
    top = {}
    for (a, _), n in df.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for (i, _), p in zip(rows, per):
        out.append((i, 0, 0, 0, 0, 0, 0, "") if p is None else (
            i, p[0], p[1], p[2], len(p[3]), sum(df[x] == top[x[0]] for x in p[3]), sum(df[x] for x in p[3]), p[4]))
    return out, len(df)


SMALL = [(i, t if t is None or len(t) < 2500 else t[:600] + t[-40:]) for i, t in TEXTS]


@pytest.mark.parametrize("segment,fan,part", [(1 << 20, 16, 1 << 21), (300, 2, 100)])
def test_alignment(spark, monkeypatch, segment, fan, part):
    monkeypatch.setattr(alignment, "FAN", fan)
    monkeypatch.setattr(alignment, "PART_PAIRS", part)
    monkeypatch.setattr(alignment, "MERGE_AT", 200)
    monkeypatch.setattr(word_chunks, "SEGMENT", segment)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in SMALL], "doc_id long, text string, _text string, shard int").repartition(5)
    want, _ = aligned_by_hand(SMALL)
    got = alignment.align_tokenizers(docs, A, B).collect()
    assert Counter(map(tuple, got)) == Counter(want)
    assert alignment.align_tokenizers(docs.limit(0), A, B).count() == 0


def test_alignment_of_a_text_over_many_segments(monkeypatch):
    """Document counts and sums of a text that is cut into segments equal those of the text in one."""
    text = (PROSE + " ") * 3
    for fan in (2, 16):
        monkeypatch.setattr(alignment, "FAN", fan)
        results = []
        for segment in (1 << 20, 400):
            monkeypatch.setattr(word_chunks, "SEGMENT", segment)
            al = alignment.Aligner(A, B, texts=False)
            known, keys = word_chunks.Remembered(al), []
            numbers = np.zeros(4, np.int64)
            for _, counts, codes, chunks, _ in word_chunks.segments(pa.array([" " + text]), **al.how):
                places = known(chunks)
                k, _, found = alignment._document_pairs(counts, codes, known, places)
                keys.append(k[found])
                numbers += known.fixed[places[codes], :4].sum(axis=0)
            results.append((sorted(set(np.concatenate(keys).tolist())), numbers.tolist()))
        assert results[0] == results[1]


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 62, 20_000).astype(np.uint64))
    slots = perfect_hash.Slots(*perfect_hash.build(keys))
    assert sorted(slots(keys).tolist()) == list(range(len(keys)))
    ordered = perfect_hash.in_slot_order(keys, slots)
    alignment.verified_slots(slots, ordered, keys[::7])
    with pytest.raises(ValueError):
        alignment.verified_slots(slots, ordered, np.array([1 << 63], np.uint64))
    assert perfect_hash.build(keys[:0]) == ([], b"")


def clusters_by_hand(rows, k, rounds):
    kept = [(i, [int(np.floor(np.float64(x) * 64)) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    h = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest())
    cents = [v for _, v in sorted(kept, key=lambda r: (h(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        for n, vs in groups.items():
            cents[n] = [sum(x) // len(vs) for x in zip(*vs)]
    out = [(i, *nearest(v)) for i, v in kept]
    per = Counter()
    for _, d, n in out:
        per[n] += d
    return Counter((i, n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest())
                   for i, d, n in out)


def vectors(kind, n):
    rng = np.random.default_rng(7)
    if kind == "ties":            # few distinct values, so distances tie often
        m = rng.integers(-1, 2, (n, 64)) / 64
    elif kind == "same":
        m = np.zeros((n, 64))
    elif kind == "wide":
        m = rng.normal(0, 1, (n, 64)) * 10.0 ** rng.integers(-3, 6, (n, 1))
    else:
        m = rng.normal(0, 1, (8, 64))[rng.integers(0, 8, n)] + rng.normal(0, .2, (n, 64))
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(m)]
    rows += [(n, None), (n + 1, []), (n + 2, [0.5] * 63), (n + 3, [0.5] * 65), (n + 4, [0.5] * 63 + [None]),
             (n + 5, [0.5] * 63 + [float("nan")]), (n + 6, [float("inf")] + [0.5] * 63), rows[0], rows[0], (0, rows[1][1]),
             (None, rows[2][1]), (None, [0.25] * 64)]
    return rows


@pytest.mark.parametrize("kind,n,k", [("ties", 120, 16), ("same", 40, 16), ("wide", 90, 16), ("groups", 200, 16),
                                      ("groups", 3, 16), ("groups", 150, 1)])
def test_centroids(spark, kind, n, k):
    rows = vectors(kind, n)
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows],
                               "vec_id long, embedding array<float>, _v int, cluster int, n int").repartition(4)
    got, _ = centroids.centroid_clusters(df, k=k)
    assert Counter(map(tuple, got.collect())) == clusters_by_hand(rows, k, 3)
    assert centroids.centroid_clusters(df.limit(0))[0].count() == 0


def test_threshold_stops_early_and_exactly():
    """Far centroids are left out; the nearest is that of all distances, ties to the smaller number."""
    rng = np.random.default_rng(1)
    cents = rng.integers(-40, 40, (300, 64)) + np.repeat(np.arange(300), 1)[:, None] * 50
    cents[200] = cents[10]
    x = cents[rng.integers(0, 300, 400)] + rng.integers(-3, 4, (400, 64))
    who, dist, computed = centroids.Lists(cents).nearest(x)
    full = ((x[:, None, :] - cents[None]) ** 2).sum(2)
    assert (who == full.argmin(1)).all() and (dist == full.min(1)).all()
    assert computed < 0.2 * full.size


def test_component_too_large_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        centroids.centroid_clusters(df)


def test_chunks_share_texts(monkeypatch):
    """Chunks that may stand side by side go to the tokenizer as one text, with the same identifiers."""
    for specials_as_text in (False, True):
        a = word_chunks.ByteLevel(A, specials_as_text)
        texts = [t for _, t in TEXTS] + ["".join(RND.choice(["a", " ", "\n", "<|endoftext|>", "!", "7", "|>", "<|", "'s", "é"])
                                                 for _ in range(12)) for _ in range(800)]
        asked, alone = [], a._texts
        monkeypatch.setattr(a, "_texts", lambda texts: asked.append(len(texts)) or alone(texts))
        for _, _, _, chunks, _ in word_chunks.segments(pa.array(texts, pa.string()), fine=True, whole=a.whole):
            lens, ids = a.encode(chunks)
            want_lens, want_ids = alone(chunks)
            assert (lens == want_lens).all() and (ids == want_ids).all()
            assert len(asked) == 1 and asked.pop() < len(chunks) / 2


def test_distinct():
    for values in ([], [3], [5, 1, 5, 2, 1]):
        assert alignment.distinct(np.array(values, np.int64)).tolist() == sorted(set(values))
