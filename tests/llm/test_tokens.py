"""Packing, BPE codec and token files against the libraries' plain results."""
import functools
import hashlib
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from pkgsync.llm import bpe_codec, packing, token_files
from pkgsync.llm.queries import vocabulary
from pkgsync.llm.wavelet import WaveletMatrix

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ids(rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return [e.ids for e in t.encode_batch([x or "" for _, x in rows], add_special_tokens=False)]


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


def test_pack(docs, rows, ids, empty):
    for capacity in (2048, 64):
        want = Counter()
        for (doc_id, _), x in zip(rows, ids, strict=True):
            x = [*x, 0]
            start, piece, length = 0, 0, len(x) % capacity or capacity
            while start < len(x):
                want[doc_id, piece, start, length, crc(x[start:start + length])] += 1
                start, piece, length = start + length, piece + 1, capacity
        got = packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=capacity, keep_ids=True).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
        assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
        bins = {}
        for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
            assert bins.get(r.sequence_id, 0) == r.offset
            bins[r.sequence_id] = r.offset + r.length
        assert max(bins.values()) <= capacity
        assert len(bins) <= -(-sum(r.length for r in got) // capacity) * 1.05 + 1
    assert packing.pack(empty, vocabulary("byte_bpe_50k.json")).count() == 0


def test_bin_completion_beats_best_fit_decreasing_or_equals_it():
    r = random.Random(2)
    better = 0
    for _ in range(25):
        counts = Counter(r.randint(300, 1100) for _ in range(r.randint(1, 60)))
        plan = packing.bin_completion(dict(counts))
        packed = Counter()
        for n, items in plan:
            assert sum(items) <= packing.CAPACITY
            for x in items:
                packed[x] += n
        assert packed == counts
        size, first = sum(n for n, _ in plan), sum(n for n, _ in packing.best_fit_decreasing(dict(counts), packing.CAPACITY))
        assert packing.lower_bound(dict(counts), packing.CAPACITY) <= size <= first
        better += size < first
    assert better
    assert packing.bin_completion({}) == [] and packing.bin_completion({2048: 3}) == [(3, (2048,))]


def packed(plan, capacity=packing.CAPACITY):
    assert all(n > 0 and sum(items) <= capacity for n, items in plan)
    got = Counter()
    for n, items in plan:
        for x in items:
            got[x] += n
    return got


def test_bin_completion_fills_with_many_short_pieces():
    # more than 13 pieces a sequence; best-fit decreasing needs one sequence more than the bound on some of them
    r = random.Random(5)
    better = 0
    for k in range(30):
        lengths = range(20, 201) if k % 2 else r.sample(range(20, 201), 6)
        counts = Counter(r.choice(lengths) for _ in range(r.choice([400, 2000, 3000])))
        plan = packing.bin_completion(dict(counts))
        assert packed(plan) == counts
        size, least = sum(n for n, _ in plan), packing.lower_bound(dict(counts), packing.CAPACITY)
        first = sum(n for n, _ in packing.best_fit_decreasing(dict(counts), packing.CAPACITY))
        assert size == least
        better += size < first
    assert better >= 3


def test_fillings_are_all_undominated_ones():
    r = random.Random(3)
    for _ in range(150):
        lengths = sorted(r.sample(range(2, 30), r.randint(1, 6)))
        counts, room = {x: r.randint(1, 4) for x in lengths}, r.randint(30, 60)
        want = set()
        for copies in itertools.product(*(range(counts[x] + 1) for x in lengths)):
            waste = room - sum(x * m for x, m in zip(lengths, copies, strict=True))
            over = [x for x, m in zip(lengths, copies, strict=True) if m < counts[x]]
            under = [0, *(x for x, m in zip(lengths, copies, strict=True) if m)]
            if 0 <= waste <= 9 and not any(y < z <= y + waste for z in over for y in under):
                want.add((waste, tuple((x, m) for x, m in zip(reversed(lengths), reversed(copies), strict=True) if m)))
        got = list(packing.fillings(counts, lengths, room, 9, [10**6]))
        assert set(got) == want and len(got) == len(want) and [w for w, _ in got] == sorted(w for w, _ in got)


def test_bin_completion_finds_the_optimum():
    @functools.cache
    def optimum(pieces, rooms):
        if not pieces:
            return len(rooms)
        x, best = pieces[0], optimum(pieces[1:], tuple(sorted((*rooms, 40 - pieces[0]))))
        for k, room in enumerate(rooms):
            if room >= x and room not in rooms[:k]:
                best = min(best, optimum(pieces[1:], tuple(sorted((*rooms[:k], room - x, *rooms[k + 1:])))))
        return best

    r = random.Random(8)
    for _ in range(60):
        pieces = tuple(sorted((r.randint(5, 24) for _ in range(r.randint(3, 9))), reverse=True))
        plan = packing.bin_completion(Counter(pieces), 40, 10**6)
        assert packed(plan, 40) == Counter(pieces) and sum(n for n, _ in plan) == optimum(pieces, ())


def test_bpe(docs, rows, empty):
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    enc = bpe_codec.encoding(path, P.PATTERN)
    want = []
    for doc_id, t in rows:
        x = enc.encode_ordinary(t or "")
        want.append((doc_id, len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = [tuple(r) for r in bpe_codec.bpe_roundtrip(docs, path, P.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert bpe_codec.bpe_roundtrip(empty, path, P.PATTERN).count() == 0
    for long in (1, 7, 50):
        for _, t in rows[:70]:
            cut = list(bpe_codec.parts(t or "", long))
            assert "".join(cut) == (t or "") and [i for c in cut for i in enc.encode_ordinary(c)] == enc.encode_ordinary(t or "")


def test_token_files(spark, docs, rows, ids, empty, tmp_path):
    out = f"file://{tmp_path}/tokens"
    token_files.write_tokens(docs, out, vocabulary("byte_bpe_50k.json"), end_id=2, shard_tokens=3000)
    got = token_files.read_tokens(spark, out, with_ids=True).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(x) + 1, crc([*x, 2])) for (i, _), x in zip(rows, ids, strict=True))
    start, last = 0, -1
    for r in got:
        assert r.start == start and (r.doc_id is None or r.doc_id >= last)
        start, last = start + r.n_tokens, 2**62 if r.doc_id is None else r.doc_id
    shard = spark.read.parquet(out).orderBy("first_sid", "seq").first()
    w, first = token_files.open_shard(shard), np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u4")[:shard.n_tokens]
    assert (w.access(np.arange(len(first))) == first).all() and w.count(2) == (first == 2).sum()
    assert (w.select(2, np.arange(w.count(2))) == np.flatnonzero(first == 2)).all()
    token_files.write_tokens(empty, out + "0", vocabulary("byte_bpe_50k.json"))
    assert token_files.read_tokens(spark, out + "0").count() == 0


def test_wavelet():
    a = np.random.default_rng(1).integers(0, 60_000, 3000).astype(np.uint16)
    planes, zeros = WaveletMatrix.pack(a, 16)
    w, i = WaveletMatrix.unpack(planes, zeros, len(a)), np.arange(0, 3000, 7)
    assert (WaveletMatrix.decode(planes, zeros, len(a)) == a).all() and (w.access(i) == a[i]).all()
    assert w.rank(a[i].astype(int), i).tolist() == [(a[:j] == a[j]).sum() for j in i]
