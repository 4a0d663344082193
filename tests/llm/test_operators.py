"""Every operator on a small table with nulls, empty and long texts, repeated rows, ties and clashing
column names, against brute force; and on an empty table."""

import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from radiolens.llm import (decontaminate, exact_dedup, hilbert, hmm, line_dedup, mixing, ngram_join, suffix_dedup,
                           token_files, toxicity)

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BASE = "alpha Beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(3000))
TEXTS = [
    (0, BASE), (1, BASE.upper()), (2, BASE + " phi"), (3, None), (4, ""), (5, "  \n\t"), (6, "one two"), (7, "ONE two"),
    (8, LONG), (9, LONG + " tail"), (10, "first line\nsecond line\nthird"), (11, "x\nfirst line \nsecond line\ny"),
    (12, "é" * 60 + " " + BASE), (13, "a" * 200), (13, "a" * 200), (14, "b " * 100), (15, "second line\nfirst line"),
    (None, BASE), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][n % 3], ["s1", "s2", "s3", None][n % 4], len(t or ""), "x", 7)
            for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       "_id string, score long")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, BASE), (2, "one two"), (3, None), (4, "b " * 12), (10, "nothing of this kind at all here")],
                                 "item_id long, text string")


def words(t):
    return WORD.findall((t or "").translate(LOW))


def test_exact_dedup(docs, empty):
    groups = {}
    for i, t in TEXTS:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    got = exact_dedup.exact_dedup(docs).collect()
    assert len(got) == len(TEXTS)
    sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in got:
        ids = sha[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max(x for x in ids if x is not None)
        assert r.kept == (r.doc_id == r.keep_id)
    assert exact_dedup.exact_dedup(empty).count() == 0
    assert {r.keep_id for r in exact_dedup.exact_dedup(docs, keep="min").collect()} >= {0, 6}


@pytest.mark.parametrize("small", [1, 4096])
def test_ngram_components(docs, empty, monkeypatch, small):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in
           ngram_join.ngram_components(docs, 3, (90, 100), slot_bits=16).collect()}

    def shingles(t):
        w = words(t)
        return {tuple(w[j:j + 3]) for j in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in TEXTS]
    label = list(range(len(TEXTS)))
    for a in range(len(TEXTS)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 90 * len(sets[a] | sets[b]):
                label = [label[b] if x == label[a] else x for x in label]
    want = set()
    for n, (i, _) in enumerate(TEXTS):
        ids = [TEXTS[m][0] for m in range(len(TEXTS)) if label[m] == label[n] and TEXTS[m][0] is not None]
        want.add((i, len(sets[n]), min(ids) if ids else None))
    assert got == want
    assert ngram_join.ngram_components(empty, 3, (90, 100), slot_bits=16).count() == 0


def test_ngram_template_with_one_own_word_each(spark, monkeypatch):
    """Copies of a template that link to it but not to each other, more of them than a set has shingles."""
    monkeypatch.setattr(ngram_join, "SMALL", 1)
    rows = []
    for g in range(3):
        template = " ".join(f"t{g}x{j}" for j in range(12))
        rows += [(100 * g + n, template + ("" if n == 20 else f" own{g}x{n}")) for n in range(30)]
    out = ngram_join.ngram_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, (90, 100), slot_bits=16)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in out.collect()} == {
        (i, 10 if i % 100 == 20 else 11, i // 100 * 100) for i, _ in rows}


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_suffix_dedup(docs, empty, shard_bytes):
    last = 1 << 62
    raw = [(last if i is None else i, (t or "").encode()) for i, t in TEXTS]
    first = {}
    for i, b in raw:
        for j in range(len(b) - 49):
            first[b[j:j + 50]] = min(i, first.get(b[j:j + 50], last))
    want = []
    for (i, b), (doc, _) in zip(raw, TEXTS):
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j:j + 50]] < i:
                gone[j:j + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        want.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs, shard_bytes=shard_bytes).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_decontaminate(docs, items, empty):
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOW))
    windows = {}
    for i, t in [(1, BASE), (2, "one two"), (4, "b " * 12), (10, "nothing of this kind at all here")]:
        w = split(t)
        n = min(10, len(w))
        for j in range(len(w) - n + 1):
            windows.setdefault(tuple(w[j:j + n]), set()).add(i)
    want = []
    for i, t in TEXTS:
        w, hit, named = split(t), set(), set()
        for j in range(len(w)):
            for n in range(1, 11):
                for it in windows.get(tuple(w[j:j + n]) if j + n <= len(w) else (), ()):
                    hit |= set(range(j, j + n))
                    named.add(it)
        digest = hashlib.sha256(",".join(sorted(map(str, named))).encode()).hexdigest()
        want.append((i, len(w), len(hit), len(named), digest, bool(hit)))
    got = [tuple(r) for r in decontaminate.decontaminate(docs, items).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert not any(r.contaminated for r in decontaminate.decontaminate(docs, items.limit(0)).collect())
    assert decontaminate.decontaminate(empty, items).count() == 0


def test_line_dedup(docs, empty):
    order = sorted({(i is None, i or 0, t) for i, t in TEXTS if t is not None})
    first, kept = {}, {}
    lines = {k: [(n, x.strip(" \t\n\v\f\r")) for n, x in enumerate(k[2].split("\n"))] for k in order}
    grams = {k: [(a, b) for a, b in zip(full, full[1:])] for k in order for full in [[x for x in lines[k] if x[1]]]}
    for k in order:
        gone = set()
        for (n1, a), (n2, b) in grams[k]:
            if (a, b) in first:
                gone |= {n1, n2}
            first.setdefault((a, b), k)
        kept[k] = (len(gone), "\n".join(x for n, x in enumerate(k[2].split("\n")) if n not in gone))
    got = line_dedup.drop_repeated_lines(docs).collect()
    assert len(got) == len(TEXTS)
    want = [(i, *(kept[(i is None, i or 0, t)] if t is not None else (0, ""))) for i, t in TEXTS]
    assert sorted(((r.doc_id, r.n_removed, r.kept_text) for r in got), key=repr) == sorted(want, key=repr)
    assert line_dedup.drop_repeated_lines(empty).count() == 0


def test_mix(docs, empty):
    got = mixing.mix(docs, block=4, shard_words=500).collect()
    assert len(got) == len(TEXTS)
    total = sum(r.size for r in got)
    assert total == sum(len(WORD.findall(t or "")) for _, t in TEXTS)
    assert all(0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert abs(sum(t for _, t in by) - 1.5 * total) < 1e-6 * total
    assert all(abs(sum(v) - t) <= 4 * 8 for (_, t), v in by.items())
    assert sorted(map(repr, mixing.mix(docs, block=4, shard_words=500).collect())) == sorted(map(repr, got))
    once = docs.where("doc_id <> 13")
    taken = mixing.mix(once, block=4, shard_words=500)
    rows = mixing.mixed_rows(once, taken)
    assert sum(len(WORD.findall(r.text)) for r in rows.collect()) == sum(r.taken for r in taken.collect())
    assert mixing.mix(empty).count() == 0


def test_hilbert_shards(docs, empty):
    got = hilbert.shard(docs, 5).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted(
        (len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in TEXTS)
    sizes = {}
    for r in got:
        sizes.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in sizes.values())
    assert max(map(len, sizes.values())) - min(map(len, sizes.values())) <= 1 and set(sizes) == set(range(5))
    assert hilbert.shard(empty, 5).count() == 0
    assert {r.shard for r in hilbert.shard(docs.limit(2), 24).collect()} <= set(range(24))


def test_token_counts_of_straddling_documents(docs, empty):
    enc = token_files.encoder(token_files.TOKENIZER)
    want = sorted(((i, len(enc.encode_ordinary(t or ""))) for i, t in TEXTS), key=repr)
    for block in (7, 1 << 18):
        got = [tuple(r) for r in token_files.token_counts(docs, block_tokens=block).collect()]
        assert sorted(got, key=repr) == want
    assert token_files.token_counts(empty).count() == 0


def test_language_model(docs, empty):
    from collections import Counter
    from math import log10
    held = F.pmod(toxicity.crc_of(F.col("doc_id")), F.lit(7)) == 2
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in TEXTS]
    toks = [words(t) + [None] for _, t in TEXTS]
    c = Counter(w for t, h in zip(toks, out) if not h for w in t)
    n, v = sum(c.values()), len(c)
    want = [(i, h, len(t), sum(w in c for w in t), n, round(sum(log10((c[w] + 1) / (n + v + 1)) for w in t), 6))
            for (i, _), h, t in zip(TEXTS, out, toks)]
    got = hmm.language_scores(docs, held).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got),
                  key=repr) == sorted(want, key=repr)
    assert all(r.score < 0 for r in got)
    assert hmm.language_scores(empty, held).count() == 0


def test_forward_is_exact():
    import itertools

    import numpy as np
    rng = np.random.default_rng(0)
    emit = rng.random((hmm.CLASSES + 1, hmm.STATES))
    move = rng.random((hmm.STATES, hmm.STATES))
    m = hmm.Model(np.full(hmm.STATES, 1 / hmm.STATES), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    seq = np.array([5, 9, hmm.UNKNOWN, 5 | hmm.ONCE, 1])
    got = hmm.log10_forward(m, seq, np.array([3, 2]))
    for lo, hi, g in ((0, 3, got[0]), (3, 5, got[1])):
        rows = [hmm.CLASSES if x == hmm.UNKNOWN else x & (hmm.CLASSES - 1) for x in seq[lo:hi]]
        p = sum(m.start[s[0]] * m.emit[rows[0], s[0]] * np.prod([m.move[a, b] * m.emit[r, b] for a, b, r in
                                                                  zip(s, s[1:], rows[1:])])
                for s in itertools.product(range(hmm.STATES), repeat=len(rows)))
        assert abs(np.log10(p) - g) < 1e-9


def test_toxicity(spark, docs, empty):
    good = [(i, f"plain words number {i} about w{i % 13} and w{i % 7}", 0) for i in range(400)]
    bad = [(1000 + i, f"plain words number {i} you vile{i % 5} rotter w{i % 13}", 1) for i in range(100)]
    d = spark.createDataFrame(good + bad + [(5000, None, None), (None, "x", 1)], "doc_id long, text string, toxic int")
    weights = toxicity.learned(d.select("doc_id", "text"), d.select("doc_id", "toxic"), learn=F.col("doc_id") % 4 != 0)
    got = {r.doc_id: r for r in toxicity.toxicity(d, weights).collect()}
    assert all(0 <= r.score <= 1 for r in got.values()) and len(got) == 502
    held = [(i, y) for i, _, y in good + bad if i % 4 == 0]
    assert sum(got[i].predicted == y for i, y in held) >= 0.97 * len(held)
    none = toxicity.learned(docs, d.limit(0))
    assert toxicity.toxicity(docs, none).where("predicted = 1").count() == 0
    assert toxicity.toxicity(empty, none).count() == 0
    assert toxicity.without_toxic(d, weights).columns == d.columns


def test_token_counts_of_long_blanks(spark):
    """Runs of white space beyond what the splitting pattern's matcher can take."""
    texts = [" " * 1_000_000, "x" + "\n" * 200_000 + " y", "a" + " " * 5000, "z " * 5000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in token_files.token_counts(rows).collect()}
    from tokenizers import Tokenizer
    from radiolens.llm.queries import vocabulary
    same = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))       # the same vocabulary
    assert got == {i: len(same.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_decontamination_of_long_texts(spark):
    """A long item and a long document: the shared stretch is hit, and time stays in proportion to the length."""
    import time
    item = [f"i{n * 7919 % 60013}" for n in range(60_000)]
    doc = [f"d{n}" for n in range(20_000)] + item[30_000:30_400] + [f"e{n}" for n in range(20_000)]
    docs = spark.createDataFrame([(1, " ".join(doc)), (2, " ".join(doc[:9]))], "doc_id long, text string")
    its = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    t0 = time.time()
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in decontaminate.decontaminate(docs, its).collect()}
    assert got == {1: (40_400, 400, 1), 2: (9, 0, 0)}
    assert time.time() - t0 < 60


def test_suffix_dedup_moves_little(docs):
    """A pick travels as 4 bytes and its document's key, once per document; a hash in pieces is that of the whole;
    the texts go through one exchange for both joins."""
    import numpy as np
    import pyarrow as pa

    t = LONG.encode()
    buf, offsets = np.frombuffer(t + t[:400] * 2, np.uint8), np.array([0, len(t), len(t) + 800])
    _, _, pick, text = suffix_dedup.picks(buf, offsets)
    batch = pa.RecordBatch.from_arrays([pa.array([5, 6]), pa.array([t.decode(), (t[:400] * 2).decode()])], ["_key", "_text"])
    for bits in (0, 3):
        got = [r for b in suffix_dedup._announce(bits)(iter([batch])) for r in b.to_pylist()]
        pairs = [(r["shard"] << 32 | c, k) for r in got for c, k in
                 zip(np.frombuffer(r["codes"], np.uint32).tolist(), np.frombuffer(r["keys"], np.int64).tolist())]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {(int(p) >> (32 - bits), 5 + int(d)) for p, d in zip(pick, text)}
    begin = np.arange(0, 3 * suffix_dedup.PIECE, 70)
    many = np.frombuffer(np.random.default_rng(1).bytes(int(begin[-1]) + 70), np.uint8)
    whole = suffix_dedup.span_hash(suffix_dedup.prefix_hash(many, lower=False), begin, begin + 70)
    assert (suffix_dedup.stretch_hash(many, begin, np.full(len(begin), 70)) == whole).all()


def test_suffix_dedup_rows_follow_pieces(spark):
    """What shards send back is one row per piece, not per document; copies are announced and compared once per piece;
    shards are alike in size."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    words = rng.permutation(90000).astype(str)
    texts = [" ".join(words[i * 300:(i + 1) * 300]) for i in range(300)]
    both = " ".join(words[:200])
    piece = pa.table({"_key": pa.array(range(300)), "_id": pa.array(range(300)), "_text": [both + " " + x for x in texts]})
    bits = 4
    told = [suffix_dedup._announce_piece(bits)((pa.scalar(p),), piece) for p in (0, 1)]
    sizes = [len(x) // 4 for x in told[0]["codes"].to_pylist()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * min(sizes)
    alone = [suffix_dedup._shared((pa.scalar(s),), told[0].slice(s, 1)) for s in range(16)]
    assert [len(x) for x in alone] == [1] * 16                       # 300 documents share picks
    shared = pa.concat_tables(alone)
    sent = suffix_dedup._stretches(bits)((pa.scalar(0),), piece, shared)
    _, _, pick, _ = suffix_dedup.picks(np.frombuffer(both.encode(), np.uint8), np.array([0, len(both)]))
    n = sum(sent["n"].to_pylist())
    assert len(sent) == 16 and len(pick) <= n < len(pick) + 2 * 300 + 100     # 300 copies once, their ends apart
    ids, start, code, count, text = suffix_dedup._unpacked(*(sent[c][0].as_py() for c in ("n", "size")), sent["packed"][0])
    assert (np.diff(start) > 0).all() and (np.diff(ids) >= 0).all() and len(text) == (count + 49).sum()


def test_suffix_dedup_covered_bytes():
    """Bits of all stretches at once, as byte by byte."""
    import time

    import numpy as np

    rng = np.random.default_rng(4)
    start, mask = rng.choice(4900, 60, replace=False), rng.integers(0, 1 << 35, 60).astype(np.uint64)
    want = np.zeros(5000, bool)
    for s, m in zip(start.tolist(), mask.tolist()):
        for j in range(35):
            if m >> j & 1:
                want[s + j:s + j + 50] = True
    assert (suffix_dedup.covered_bytes(5000, start, mask) == want).all()
    many = np.arange(0, 3_000_000, 40)
    t0 = time.time()
    assert suffix_dedup.covered_bytes(3_000_200, many, np.full(len(many), 1, np.uint64)).sum() == 2999960 + 50
    assert time.time() - t0 < 5


def test_suffix_dedup_among_pieces(spark):
    """Copies, near copies, equal identifiers and repeated rows in several pieces, against brute force."""
    import numpy as np

    rng = np.random.default_rng(5)
    parts = ["".join(rng.choice(list("ab cdé"), 90)) for _ in range(12)]
    rows = [(int(i) if i else None, "".join(parts[k] for k in rng.integers(0, 12, 4)) + str(n % 7))
            for n, i in enumerate(rng.integers(0, 40, 60))]
    rows += rows[:5] + [(-3, parts[0])]
    last, first = 1 << 62, {}
    raw = [(last if i is None else i, t.encode()) for i, t in rows]
    for i, b in raw:
        for j in range(len(b) - 49):
            first[b[j:j + 50]] = min(i, first.get(b[j:j + 50], last))
    want = []
    for (i, b), (doc, _) in zip(raw, rows):
        gone = bytearray(len(b))
        for j in range(len(b) - 49):
            if first[b[j:j + 50]] < i:
                gone[j:j + 50] = b"\1" * 50
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        want.append((doc, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for shard_bytes in (1 << 20, 3000):
        got = [tuple(r) for r in suffix_dedup.suffix_dedup(docs, shard_bytes=shard_bytes).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_suffix_dedup_hot_pick_in_bounded_memory(monkeypatch):
    """One pick in many different surroundings, some windows of which repeat: the bits are those of brute force, and the
    arrays do not hold a suffix array over all of them."""
    import tracemalloc

    import numpy as np

    abc = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", np.uint8)

    def stretches(n, ends):
        rng = np.random.default_rng(6)
        side = [abc[rng.integers(0, 27, (ends, 32))][rng.integers(0, ends, n)] for _ in "lr"]
        text = np.concatenate([side[0], np.tile(abc[:20], (n, 1)), side[1]], axis=1).ravel()
        return np.full(n, 9, np.uint64), np.arange(n), rng.integers(0, n // 2, n), np.full(n, 35), text

    pick, key, doc, count, text = stretches(400, 30)
    least = {}
    for i in range(400):
        for j in range(35):
            w = text[84 * i + j:84 * i + j + 50].tobytes()
            least[w] = min(doc[i], least.get(w, 400))
    want = [sum(int(least[text[84 * i + j:84 * i + j + 50].tobytes()] < doc[i]) << j for j in range(35)) for i in range(400)]
    assert suffix_dedup.covered(pick, key, doc, count, text).tolist() == want
    for block in (1 << 7, 1 << 12):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        assert suffix_dedup.covered(pick, key, doc, count, text).tolist() == want
    monkeypatch.undo()
    many = stretches(30000, 700)
    tracemalloc.start()
    suffix_dedup.covered(*many)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 50 * len(many[-1])
