"""Quality rules, toxicity and the Jaccard join against brute force or held-out labels; the pipeline end to end."""
import random
import zlib
from collections import Counter

import numpy as np

from pkgsync.llm import jaccard_join, quality_rules, toxicity
from pkgsync.llm.label_model import LabelModel
from pkgsync.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def brute_counts(text):
    w = (text or "").encode().split()
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {i + k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(WHITE)]
    return (len(w), sum(c not in WHITE for c in text or ""), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))


def test_quality_counts(docs, rows, empty):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in quality_rules.posterior_quality(docs).collect())
    want = Counter()
    for i, t in rows:
        c = brute_counts(t)
        want[(i, *c, c[0] < 50 or 100 * c[4] > 50 * c[0])] += 1
    assert got == want
    assert quality_rules.posterior_quality(empty).count() == 0
    kept = quality_rules.drop_low_quality(docs)
    assert kept.columns == docs.columns and 0 < kept.count() < len(rows)


def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").withColumnRenamed("quality", "good")
    rows = LLM_QUERIES["op3_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed").collect()
    assert sum(r.kept == (r.good == 1) for r in rows) >= 0.97 * len(rows)


def test_label_model_finds_accuracies():
    r = np.random.default_rng(0)
    y, right = r.random(4000) < 0.3, (0.95, 0.8, 0.7)
    votes = np.stack([np.where(r.random(4000) < a, np.where(y, 1, -1), np.where(y, -1, 1)) * (r.random(4000) < 0.8) for a in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = LabelModel(patterns, counts, np.where(patterns.sum(axis=1) > 0, 0.8, 0.2), rounds=200)
    assert np.abs(model.accuracy() - right).max() < 0.06 and abs(model.prior - 0.3) < 0.06


def test_toxicity(spark, docs, rows, empty):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = LLM_QUERIES["op8_toxicity"](spark, sf).cache()
    for r in out.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = out.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.9 * len(held)  # some labels of the small table are noise
    some = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, some).count() == len(rows)
    assert toxicity.score(docs, some.limit(0)).count() == len(rows)
    assert toxicity.score(empty, some).count() == 0


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        least[x] = min(least.get(x, 2**64), 2**64 if i is None else i)
    return [(i, len(s), i if not s else None if least[x] == 2**64 else least[x]) for (i, _), s, x in zip(rows, sets, label, strict=True)]


def near_copies(seed):
    r = random.Random(seed)
    base, rows = [str(r.randrange(400)) for _ in range(120)], []
    for i in range(80):
        t = list(base) if i % 2 else [str(r.randrange(400)) for _ in range(r.randint(1, 60))] + base[:r.randint(0, 60)]
        for _ in range(r.randint(0, 4)):
            t[r.randrange(len(t))] = str(r.randrange(10_000))
        rows.append((i, " ".join(t)))
    return rows


def test_jaccard_join(spark, docs, rows, empty, monkeypatch):
    from conftest import frame

    def check(frame, rows, size, percent):
        got = [(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.near_duplicates(frame, size, percent).collect()]
        assert Counter(got) == Counter(brute_components(rows, size, percent))

    check(docs, rows, 3, 90)
    many = near_copies(1)
    # every token that repeats often is frequent, every entry large, blocks tiny
    monkeypatch.setattr(jaccard_join, "FREQUENT", 3)
    monkeypatch.setattr(jaccard_join, "SMALL", 2)
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    check(frame(spark, many), many, 3, 90)
    check(frame(spark, many), many, 1, 80)
    assert jaccard_join.near_duplicates(empty).count() == 0


def unlinked_copies(n, seed=9):
    """Copies of 200 words with four changed: alike, but most pairs are below 0.8 in five-word shingles."""
    r = random.Random(seed)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(n):
        t = list(words)
        for k in r.sample(range(200), r.choice([2, 4, 4, 4])):
            t[k] = f"x{r.randrange(10**9)}"
        rows.append((i, " ".join(t)))
    return rows


def test_pairs_that_do_not_link_are_verified_in_their_part(spark, monkeypatch):
    from conftest import frame

    rows = unlinked_copies(90)
    want = Counter(brute_components(rows, 5, 80))
    assert len({c for _, _, c in want}) > 5
    for block, tokens in ((512, 4_000_000), (16, 4_000_000), (512, 3_000)):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        monkeypatch.setattr(jaccard_join, "TOKENS", tokens)
        got = jaccard_join.near_duplicates(frame(spark, rows), 5, 80).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component) for r in got) == want
    # what a part gives back is a forest, however many pairs are alike
    sets = [jaccard_join.shingles(t, 5) for _, t in unlinked_copies(300)]
    order = sorted(range(300), key=lambda k: len(sets[k]))
    sets = [sets[k] for k in order]
    n, h = np.array([len(x) for x in sets]), np.stack([jaccard_join.histogram(x, jaccard_join.SKETCH) for x in sets]).astype(np.int16)
    links = jaccard_join.joining_links(sets, n, h, np.arange(300), 80)
    assert len(jaccard_join.plausible(n, h, 80)[0]) > 10_000 and len(links) < 300
    assert all(len(np.intersect1d(sets[x], sets[y])) * 100 >= 80 * len(np.union1d(sets[x], sets[y])) for x, y in links)


def test_pipeline(spark):
    import corpus_pipeline as C

    docs, sizes = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs.columns
    for _, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        sizes.append(docs.count())
    assert 200 > sizes[0] > sizes[1] >= sizes[2] == sizes[3] > 0
    packed = C.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == sizes[3]
