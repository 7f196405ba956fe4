"""Line, word-window, byte-string and exact dedup against brute force."""
import hashlib
from collections import defaultdict

from pkgsync.llm import exact_dedup, fm_dedup, line_dedup, suffix_dedup

BIG = 2**62
sha = lambda b: hashlib.sha256(b).hexdigest()
SPACE = " \t\n\x0b\x0c\r"


def order(row):
    return BIG if row[0] is None else row[0]


def masked(n, starts, width):
    m = bytearray(n)
    for p in starts:
        m[p:p + width] = b"\1" * width
    return m


def test_suffix_dedup(docs, rows, empty):
    for width, gram in ((100, 32), (20, 8)):
        seen = {}
        for row in rows:
            raw = (row[1] or "").encode()
            for p in range(len(raw) - width + 1):
                w = raw[p:p + width]
                seen[w] = min(seen.get(w, (2**63, 0)), (order(row), p))
        want = []
        for row in rows:
            raw = (row[1] or "").encode()
            m = masked(len(raw), [p for p in range(len(raw) - width + 1) if seen[raw[p:p + width]] < (order(row), p)], width)
            runs = sum(1 for i in range(len(m)) if m[i] and not (i and m[i - 1]))
            want.append((row[0], len(raw), sum(m), runs, sha(bytes(c for c, g in zip(raw, m, strict=True) if not g))))
        got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, width, gram=gram).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert any(w[2] for w in want)
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_suffix_dedup_of_windows_of_hot_keys(docs, monkeypatch):
    from pkgsync.llm import anchors

    want = sorted(suffix_dedup.remove_repeats(docs, 20, gram=8).drop("kept").collect(), key=str)
    monkeypatch.setattr(anchors, "HOT", 1)
    assert sorted(suffix_dedup.remove_repeats(docs, 20, gram=8).drop("kept").collect(), key=str) == want


def test_fm_dedup(docs, rows, empty, monkeypatch):
    from pkgsync.llm import anchors

    for width, gram, hot in ((50, 16, 20_000), (8, 4, 20_000), (8, 4, 1)):
        monkeypatch.setattr(anchors, "HOT", hot)
        first = {}
        for row in rows:
            w = (row[1] or "").encode().split()
            for p in range(len(w) - width + 1):
                k = tuple(w[p:p + width])
                first[k] = min(first.get(k, 2**63), order(row))
        want = []
        for row in rows:
            w = (row[1] or "").encode().split()
            m = masked(len(w), [p for p in range(len(w) - width + 1) if first[tuple(w[p:p + width])] < order(row)], width)
            want.append((row[0], len(w), sum(m), sha(b" ".join(a for a, g in zip(w, m, strict=True) if not g))))
        got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in fm_dedup.remove_repeats(docs, width, gram=gram).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
        assert any(w[2] for w in want)
    assert fm_dedup.remove_repeats(empty).count() == 0


def test_exact_dedup(docs, rows, empty):
    groups = defaultdict(list)
    norm = lambda t: "".join(c for c in t or "" if c not in SPACE).encode()
    for row in rows:
        groups[norm(row[1])].append(row)
    want = []
    for row in rows:
        group = groups[norm(row[1])]
        keep = min(group, key=lambda x: (-len(x[1] or ""), order(x)))
        want.append((row[0], keep[0], len(group), row[0] == keep[0], sha(norm(row[1]))))
    for rounds in (None, 3):
        got = [tuple(r) for r in exact_dedup.exact_groups(docs, rounds=rounds).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_dedup.exact_groups(empty).count() == 0
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns and kept.count() == len(groups) == kept.select(exact_dedup.normalised(kept.text)).fillna("").distinct().count()


def test_line_dedup(docs, rows, empty):
    key = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s.strip(SPACE))
    found = defaultdict(set)
    for row in rows:
        for line in (row[1] or "").split("\n"):
            found[key(line)].add((order(row), row[1] if row[0] is None else 0))
    want = []
    for row in rows:
        lines = (row[1] or "").split("\n")
        stay = [x for x in lines if not key(x) or len(found[key(x)]) < 10]
        want.append((row[0], len(lines), len(lines) - len(stay), "\n".join(stay)))
    got = [(r.doc_id, r.llm_n_lines, r.llm_n_dropped, r.text) for r in line_dedup.drop_lines(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(w[2] for w in want) and line_dedup.drop_lines(empty).count() == 0


def test_exact_dedup_keeps_other_texts_of_a_repeated_id(spark):
    from conftest import frame

    rows = [(1, "alpha beta"), (7, "alpha beta"), (7, "only here"), (3, "x y z"), (3, "p q"), (8, "x y z"), (9, "p q"), (3, "x y z")]
    kept = exact_dedup.drop_copies(frame(spark, rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "alpha beta"), (3, "p q"), (3, "x y z"), (7, "only here")]
