"""Ids may be any long; a missing id is told by its null.  Column names of a caller can't clash, cuts keep characters."""
from pyspark.sql import functions as F

from pkgsync.llm import exact_dedup, jaccard_join, quality_rules, suffix_dedup, token_files
from pkgsync.llm.queries import vocabulary

TEXT = " ".join(f"word{i}" for i in range(60))
#: Large and negative ids, rows without an id, copies of one text under each.
IDS = [(2**62 + 6, TEXT), (2**62 + 5, TEXT), (None, TEXT), (2**63 - 1, "alone here"), (None, "no id"), (None, "no id"), (-3, "below zero"), (7, "below zero"), (2**62 + 9, "no id")]


def test_large_ids_and_missing_ones(spark):
    docs = spark.createDataFrame(IDS, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(docs).collect())
    want = [(-3, -3, 2, True), (0, 2**62 + 5, 3, False), (0, 2**62 + 9, 3, False), (0, 2**62 + 9, 3, False), (7, -3, 2, False),
            (2**62 + 5, 2**62 + 5, 3, True), (2**62 + 6, 2**62 + 5, 3, False), (2**62 + 9, 2**62 + 9, 3, True), (2**63 - 1, 2**63 - 1, 1, True)]
    assert got == sorted(want)
    kept = {-3, 2**62 + 5, 2**62 + 9, 2**63 - 1}
    assert {r.doc_id for r in exact_dedup.drop_copies(docs).collect()} == kept
    near = jaccard_join.near_duplicates(docs, 3, 90).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in near) == sorted((i, k) for i, k, _, _ in want)
    assert {r.doc_id for r in jaccard_join.drop_near_duplicates(docs, 3, 90).collect()} == kept


def test_token_files_order_large_ids_before_missing_ones(spark, tmp_path):
    docs = spark.createDataFrame(IDS, "doc_id long, text string").repartition(3)
    out = f"file://{tmp_path}/tokens"
    token_files.write_tokens(docs, out, vocabulary("byte_bpe_50k.json"), shard_tokens=5)
    got = token_files.read_tokens(spark, out).orderBy("start").collect()
    ids = [r.doc_id for r in got]
    assert ids == [*sorted(i for i, _ in IDS if i is not None), None, None, None]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:k]) for k in range(len(got))]
    shards = spark.read.parquet(out)
    assert shards.count() > 3
    key = ["first_missing", "first_sid", "seq"]
    rows = lambda n: token_files.shard_starts(shards, n).orderBy(*key).collect()
    assert rows(2) == rows(100_000) == rows(1)


def test_names_of_a_caller_do_not_clash(spark):
    names = ["sid", "missing", "row", "body", "digest", "spans", "__llm_key", "__llm_sid", "__llm_to", "__llm_lost", "a.b"]
    docs = spark.createDataFrame([(i, TEXT if i < 3 else f"{TEXT} {i}") for i in range(6)], "doc_id long, text string")
    docs = docs.select("doc_id", *[F.lit(n).alias(n) for n in names], "text")
    for stage in (exact_dedup.drop_copies, jaccard_join.drop_near_duplicates, suffix_dedup.drop_repeats, quality_rules.drop_low_quality):
        out = stage(docs)
        assert out.columns == docs.columns
        assert all(tuple(r)[1:-1] == tuple(names) for r in out.collect())


def test_cuts_keep_whole_characters(spark):
    # the first two texts share 214 bytes whose ends fall inside characters: é is C3 A9, è is C3 A8, ɩ is C9 A9
    shared = "".join(chr(0x4E00 + i) for i in range(70))
    rows = [(1, "aé" + shared + "é!"), (2, "bɩ" + shared + "è?"), (3, None), (4, ""), (5, "€" * 100)]
    out = {r.doc_id: r.text for r in suffix_dedup.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: rows[0][1], 2: "bɩè?", 3: None, 4: "", 5: "€"}
    assert suffix_dedup.cut("xéy".encode(), [{"first": 1, "n": 1}], 1, whole=True) == ("xéy".encode(), 0, 0)
