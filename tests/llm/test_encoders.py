"""Prefix BPE against the tokenizers library; alignment against brute force over all documents."""
import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pkgsync.llm import alignment, prefix_bpe
from pkgsync.llm.queries import vocabulary
from pkgsync.llm.segments import segments

pytest.importorskip("public_tokenizers")
ODD = ["a", "aa", "the", "b", " ", "  ", "\n", "\t", "é", "𝄞", "<|endoftext|>", "<s>", "<0x41>", "▁", "'s", "1", "123", "...", "x" * 50, " ", "　", "\x1c", "\x00",
       "中文", "A", "--", "word", "unbelievable", "́", "ﬁ"]


def odd_texts(n, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) + r.choice(["", " "]) for _ in range(r.randint(0, 25))) for _ in range(n)] + ["", "   ", " x ", "́ a"]


@pytest.fixture(scope="module")
def bpe():
    return prefix_bpe.vocabulary(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))


def test_segments_join_to_the_text():
    for t in odd_texts(300):
        for step in (1, 7, 1000):
            assert " ".join(s for some in segments(t, step) for s in some) == t


def test_prefix_bpe_is_the_library(bpe, library, monkeypatch):
    for t in odd_texts(1500):
        assert bpe.encode(t) == library.encode(t, add_special_tokens=False).ids
    r = random.Random(5)
    for _ in range(1500):
        t = "".join(r.choice("abcdee aab=-_ 0011") for _ in range(r.randint(0, 60)))
        assert bpe.encode(t) == library.encode(t, add_special_tokens=False).ids
    for _ in range(1000):
        ids = [r.randrange(50257) for _ in range(6)]
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)
    long = "x" * 20_000 + " a" * 600_000
    assert bpe.encode(long) == library.encode(long, add_special_tokens=False).ids
    # full caches start anew
    monkeypatch.setattr(prefix_bpe, "REMEMBERED", 3)
    for t in odd_texts(200, 6):
        assert bpe.encode(t) == library.encode(t, add_special_tokens=False).ids


def test_the_automaton_finds_every_token_that_ends_at_a_byte():
    r = random.Random(1)
    strings = {k: s for k, s in enumerate({bytes(r.choice(b"abc") for _ in range(r.randint(1, 6))) for _ in range(120)})}
    auto = prefix_bpe.SuffixAutomaton(strings)
    text, v, size = bytes(r.choice(b"abcd") for _ in range(3000)), 0, 0
    for i, c in enumerate(text):
        while v >= 0 and c not in auto.next[v]:
            v = auto.link[v]
            size = auto.length[v] if v >= 0 else 0
        v, size = (auto.next[v][c], size + 1) if v >= 0 else (0, 0)
        got, u = set(), v
        while u >= 0:
            got |= {t for n, t in auto.tokens[u] if n <= size}
            u = auto.up[u]
        assert got == {k for k, s in strings.items() if text[:i + 1].endswith(s)}


def test_roundtrip(docs, rows, empty, library):
    path = vocabulary("byte_bpe_50k.json")
    got = prefix_bpe.roundtrip(docs, path, with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), tuple(ids), text))
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids), r.decoded) for r in got) == Counter(want)
    assert prefix_bpe.roundtrip(empty, path).count() == 0


# --- alignment ----------------------------------------------------------------------------

@pytest.fixture(scope="module")
def pair():
    return alignment.tokenizers(vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def brute_document(text, pair):
    """Ids' numbers, links and groups of one text, each overlap looked for by itself."""
    if not text:
        return None
    a, b, whole = pair.a.encode(" " + text, add_special_tokens=False).ids, pair.b.encode(text), (" " + text).encode()
    if b"".join(pair.bytes_a[i] for i in a) != whole or b"".join(pair.bytes_b[i] for i in b) != whole:
        return None
    ea, eb = np.cumsum([0] + [len(pair.bytes_a[i]) for i in a]), np.cumsum([0] + [len(pair.bytes_b[i]) for i in b])
    links = [(a[i], b[j]) for i in range(len(a)) for j in np.flatnonzero(np.maximum(ea[i], eb[:-1]) < np.minimum(ea[i + 1], eb[1:]))]
    cuts = [0, *sorted(set(ea[1:].tolist()) & set(eb[1:].tolist()))]
    inside = [([], []) for _ in cuts]
    for side, ids, stops in ((0, a, ea), (1, b, eb)):
        for t, e in zip(ids, stops[1:].tolist()):
            inside[bisect.bisect_left(cuts, e)][side].append(str(t))
    groups = ";".join(",".join(x) + "|" + ",".join(y) for x, y in inside[1:])
    return len(a), len(b), len(cuts) - 1, links, groups


def brute(texts, pair):
    found = [brute_document(t, pair) for t in texts]
    counts, most = Counter(), Counter()
    for x in found:
        counts.update(set(x[3]) if x else ())
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [(*x[:3], len(x[3]), sum(counts[p] == most[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) if x else (0, 0, 0, 0, 0, 0, "") for x in found]


def test_pieces_do_not_matter(pair):
    texts = odd_texts(150) + [None]
    want = brute(texts, pair)
    assert 0 < sum(w[0] == 0 for w in want) < len(want)
    for piece in (1, 2, 3, 7, 10**6):
        row = alignment.aligned_chunk(0, list(enumerate(texts)), pair, True, piece)
        own = np.frombuffer(row["own"], "<i8").reshape(-1, 4).tolist()
        assert [(*o, g) for o, g in zip(own, row["groups"])] == [(*w[:4], w[6]) for w in want]


def test_merge_path_splits_any_two_lists():
    r = np.random.default_rng(2)
    for _ in range(60):
        a, b = (np.unique(r.integers(0, 40, r.integers(0, 30))) for _ in range(2))
        merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
        k = np.arange(len(merged) + 1)
        assert alignment.merge_path(a, b, k).tolist() == [sum(w == 0 for _, w in merged[:n]) for n in k]


def test_align(spark, docs, rows, empty, pair, monkeypatch):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    want = Counter((i, *w[:6], hashlib.sha256(w[6].encode()).hexdigest() if w[0] else "", w[6]) for (i, _), w in zip(rows, brute([t for _, t in rows], pair)))
    got = alignment.align(docs, *paths, with_groups=True).collect()
    assert Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups) for r in got) == want
    assert alignment.align(empty, *paths).count() == 0


def test_counts_go_over_all_chunks(spark, docs, rows, pair):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    from pkgsync.session import scratch_path

    out = scratch_path(spark, "chunks")
    alignment.write_chunks(docs, out, *paths, chunk=500)
    chunks = spark.read.schema(alignment.CHUNKS).parquet(out)
    assert chunks.count() > 20
    counts = Counter()
    for _, t in rows:
        x = brute_document(t, pair)
        counts.update(set(x[3]) if x else ())
    got = {(r.code >> 16, r.code & 65535): (r.n, r.best) for r in alignment.pair_counts(chunks).collect()}
    assert {k: n for k, (n, _) in got.items()} == counts
    assert all(best == (n == max(m for (a2, _), m in counts.items() if a2 == a)) for (a, _), (n, best) in got.items())


def test_a_large_chunk_is_many_rows(spark, docs, rows):
    from pkgsync.session import scratch_path

    out = scratch_path(spark, "chunks")
    alignment.write_chunks(docs, out, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"), block=1000)
    table = spark.read.schema(alignment.CHUNKS).parquet(out)
    assert table.selectExpr("max(length(bytes))").first()[0] == 1000
    assert table.where("block > 0 and codes is not null").count() == 0 < table.where("block > 10").count()
    batches = table.orderBy("chunk", "block").toArrow().to_batches(7)
    none = np.empty(0, np.int64)
    found = [i for t in alignment.each_chunk(batches) for i in alignment.finished_chunk(b"".join(t["bytes"].to_pylist()), none, False)["doc_id"].to_pylist()]
    assert Counter(found) == Counter(i for i, _ in rows)


def test_chunks_are_finished_where_they_are_stored_or_a_few_to_a_task(spark, rows, monkeypatch):
    paths = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(7)
    out = alignment.align(docs, *paths, with_groups=True)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()  # no chunk travels
    want = Counter(map(tuple, out.collect()))
    monkeypatch.setattr(alignment, "MOST", 0)
    monkeypatch.setattr(alignment, "TOGETHER", 1)
    out = alignment.align(docs, *paths, with_groups=True)
    assert out.rdd.getNumPartitions() == 7  # a chunk of each partition of the documents
    assert Counter(map(tuple, out.collect())) == want
