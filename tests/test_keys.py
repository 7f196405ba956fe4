"""Joins are sorted by a hash of their key and meet as by the key; documents and paths are gone through once."""

import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pkgsync.functions import json_text as JT
from pkgsync.functions import paths as P
from pkgsync.operators import ledger as LG
from pkgsync.operators import reconcile as R

SF = "/root/testdata/sf0.001"
LED = "repository string, package string, version string, published int, publish_failed int, publish_error string"


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["plan_summary", "migration_actions", "post_check", "repository_plan", "version_state", "resume_plan", "package_source",
                                  "ledger_add_versions", "ledger_mark_fetched"])
def test_joins_on_names_are_sorted_by_the_hash(spark, no_broadcast, name):
    joins = [x for x in _physical(E.queries()[name](spark, SF)).splitlines() if "SortMergeJoin" in x and "repository" in x and "package" in x]
    assert joins and all("SortMergeJoin [_key" in x for x in joins), joins


def test_rows_meet_by_the_key_with_nulls_and_copies(spark):
    led = spark.createDataFrame([("r", "a", "1", 1, 0, ""), ("r", "a", "1", 0, 0, ""), ("r", None, "1", 1, 0, ""), (None, "a", "1", 0, 0, "")], LED)
    new = spark.createDataFrame([("r", "a", "1"), ("r", "a", "2"), ("r", "a", "2"), ("r", None, "1"), (None, "a", "1")], "repository string, package string, version string")
    added = LG.add_versions(led, new)
    assert added.columns == led.columns
    assert sorted(map(str, added.exceptAll(led).select("repository", "package", "version").collect())) == sorted(
        map(str, new.distinct().where("version = '2' or package is null or repository is null").collect()))
    marked = LG.mark_failed(led, new)
    assert marked.columns == led.columns
    assert [r.publish_failed for r in marked.orderBy("repository", "package", "published").collect()] == [0, 0, 1, 1]
    flagged = R.mark_ledger_published(new, led).orderBy("repository", "package", "version")
    assert flagged.columns == [*new.columns, "ledger_published"]
    assert [r.ledger_published for r in flagged.collect()] == [False, False, True, False, False]


def test_state_of_versions_by_the_target_key(spark):
    v = spark.createDataFrame([("r", "maven", "a/b/c", "1"), ("r", "maven", "a/b/c", "1"), ("r", "npm", "@s/n", "2"), ("r", "pypi", "X_y", "3"), ("r", "pypi", None, "3")],
                              "repository string, package_type string, package string, version string")
    t = spark.createDataFrame([("r", "maven", "a.b", "c", "1", "Unfinished"), ("r", "npm", "s", "n", "2", "Published"), ("r", "npm", "s", "n", "2", "Unfinished"),
                               ("r", "pypi", None, "x-y", "3", "Published"), ("r", "pypi", None, None, "3", "Published")],
                              "repository string, format string, namespace string, package string, version string, status string")
    out = R.version_state(v, t)
    assert "_key" not in out.columns
    assert sorted((r.package or "", r.state_code) for r in out.collect()) == [("", 1), ("@s/n", 0), ("X_y", 0), ("a/b/c", 2), ("a/b/c", 2)]


def test_a_document_is_edited_once(spark):
    for name in ("npm_missing_metadata", "npm_document"):
        assert _physical(E.queries()[name](spark, SF)).count("ArrowEvalPython [") == 1


def test_no_decoder_is_made_for_a_value(monkeypatch):
    def refused(*a, **k):
        raise AssertionError("made again")

    monkeypatch.setattr(json, "JSONDecoder", refused)
    text = '{"versions":{"1":{"dist":{"tarball":"x"},"n":1.50,"i":' + "9" * 5000 + "}}}"
    assert JT.publish_parts(text, "1", "u")[4] is None
    assert JT.publish_parts('{"versions":{"1":{"n":NaN}}}', "1", "u")[4] == "invalid_json"


def test_parts_of_paths_as_splitting_gave_them(spark):
    uris = ["/a/b/c", "a/b/c", "/a/b", "a", "", None, "/a//b", "//a//b//", "/ä/b\n/c\n", "/x/y/z/", "/𝄞/é/f.jar", "/", "//", "///", "/-/", "/a/-/b/-/c", "@s/n", "/-/-/"]
    df, s, split = spark.createDataFrame([(u,) for u in uris], "u string"), P.strip_leading_slash("u"), F.split_part
    both = [(P.basename("u"), split("u", F.lit("/"), F.lit(-1))), (P.path_version("u"), split("u", F.lit("/"), F.lit(-2))),
            (P.npm_package_from_path("u"), split(s, F.lit("/-/"), F.lit(1))), (P.path_package("u").isNotNull(), F.coalesce(P.path_segment_count("u") > 2, F.lit(False)))]
    for r in df.select("u", *[F.array(a, b).alias(f"p{i}") for i, (a, b) in enumerate(both)]).collect():
        assert all(a == b for a, b in r[1:]), r
