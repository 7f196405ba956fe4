"""Costly columns are worked out once per row, and stored rows are not worked out again."""

import time

from pyspark.sql import functions as F

from pkgsync.functions import paths as P
from pkgsync.operators import inventory as INV
from pkgsync.plans import migration as M
from pkgsync.session import FILE_CLEANUP, stored
from pkgsync.sources import pages as PG
from pkgsync.sources.fixtures import FIXTURES, Fixtures

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_coordinates_are_in_no_filter_or_join_condition(spark):
    fx = Fixtures(spark, SF)
    inv = M.in_scope(INV.inventory(fx.fx_files, fx.fx_repositories), fx.fx_repositories)
    lines = _plan(INV.versions(inv)).splitlines()
    assert not [x for x in lines if ("Filter" in x or "Join" in x) and "split" in x.lower()]
    assert sum("-beta-2" in x for x in lines) == 1


def test_a_page_is_parsed_once_for_its_row_and_once_for_its_reject(spark):
    pages = spark.createDataFrame([("1", "r", '{"format":"npm","package":"a","versions":[]}')], "page string, repository string, doc string")
    dump = PG.target_versions(pages)
    assert _plan(dump.rows).count("from_json(") == 1
    assert _plan(dump.rejects).count("from_json(") == 2  # the digests and the rejects


def test_rejects_of_equal_pages_and_of_null_repositories(spark):
    good, cut = '{"format":"npm","package":"a","versions":[{"version":"1","status":"Published"}]}', '{"format":"npm"'
    rows = [("1", "r", good), ("2", "r", good), ("2", "r", good), ("3", None, good), ("4", None, good), ("5", "q", good), ("6", "r", cut), ("7", "r", cut),
            ("8", "r", None), ("9", "r", "{}")]
    dump = PG.target_versions(spark.createDataFrame(rows, "page string, repository string, doc string"))
    got = sorted((r["page"], r["repository"], r["reason"], r["_corrupt_record"]) for r in dump.rejects.collect())
    assert got == [("2", "r", "repeated", None), ("2", "r", "repeated", None), ("4", None, "repeated", None), ("6", "r", "malformed", cut),
                   ("7", "r", "malformed", cut), ("8", "r", "empty", None), ("9", "r", "incomplete", None)]


def test_requested_plan_reads_the_files_once(spark):
    fx = Fixtures(spark, SF)
    inv = INV.inventory(fx.fx_files, fx.fx_repositories)
    plan = _plan(M.requested_plan(M.Inputs(inv, fx.fx_repositories, fx.fx_target, fx.fx_ledger_versions, fx.fx_ledger_packages), fx.fx_requests))
    assert plan.count(".tgz") == 0  # the paths are built and cut up only before the stored rows


def test_base_rows_are_those_of_the_shared_text(spark):
    fx = Fixtures(spark, SF)
    shared = spark.sql(fx._sql(FIXTURES["fx_base"][0])) if fx.fx_base is not None else None
    assert fx.fx_base.schema == shared.schema
    assert fx.fx_base.exceptAll(shared).count() == 0 == shared.exceptAll(fx.fx_base).count()


def test_package_and_namespace_of_paths_as_the_patterns_gave_them(spark):
    uris = ["/a/b/c", "a/b/c", "/a/b", "a", "", None, "/a//b", "//a//b//", "/ä/b\n/c\n", "/x/y/z/", "x/y/z/w", "/𝄞/é/f.jar"]
    df = spark.createDataFrame([(u,) for u in uris], "u string")
    s = P.strip_leading_slash("u")
    old_package = F.when(P.path_segment_count("u") > 2, F.regexp_replace(s, r"/[^/]*/[^/]*$", ""))
    old_namespace = F.when(F.col("u").contains("/"), F.regexp_replace("u", r"/[^/]*$", "")).otherwise("")
    for r in df.select("u", P.path_package("u").alias("p"), old_package.alias("op"), P.maven_namespace("u").alias("n"), old_namespace.alias("on")).collect():
        assert (r.p, r.n) == (r.op, r.on), r.u


def test_rows_of_requested_packages_travel_once(spark):
    files = spark.createDataFrame([("r", f"/a/b/p{k % 3}/1.{k}/p-1.{k}.jar", 5) for k in range(9)] + [(None, "/a/b/p0/1.0/p.jar", 1)], "repository string, uri string, size_bytes long")
    catalogue = spark.createDataFrame([("r", "LOCAL", "Maven")], "repo_key string, repo_type string, package_type string")
    versions = spark.createDataFrame([("r", "a/b/p1", "1.4", 1), ("r", "a/b/p2", "9", None), ("r", None, "1", 1)], "repository string, package string, version string, published int")
    packages = spark.createDataFrame([("r", "a/b/p2", 1, 0), ("r", None, 1, 1)], "repository string, package string, all_versions_fetched int, all_versions_published int")
    requests = spark.createDataFrame([(1, "r", "a/b/p0 a/b/p1:1.4 a/b/p1:1.4"), (2, "r", "a/b/p2 a/b/none a/b/none:1"), (3, None, "a/b/p0")], "request_id long, repository string, packages string")
    inputs = M.Inputs(INV.inventory(files, catalogue), catalogue, None, versions, packages)
    wanted = M.wanted_versions(inputs, requests)
    assert wanted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 1  # files, ledger, packages and entries, to their package's task
    got = sorted((r.package, r.version, r.n_files, r.copy_bytes, r.ledger_published, r.by_name, r.by_package) for r in wanted.collect())
    assert got == [("a/b/p0", "1.0", 1, 5, False, False, True), ("a/b/p0", "1.3", 1, 5, False, False, True), ("a/b/p0", "1.6", 1, 5, False, False, True),
                   ("a/b/p1", "1.4", 1, 5, True, True, False), ("a/b/p2", "9", 0, 0, False, False, True)]


def test_stored_rows_leave_no_shuffle_files(spark):
    def shuffled():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
        return {b for b in blocks.split() if b.startswith("shuffle_")}

    before = shuffled()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert stored(rows, "rows").exceptAll(rows).count() == 0 and spark.conf.get(FILE_CLEANUP) == "false"
    before |= shuffled()  # those of the comparison
    stored(rows, "rows")
    end = time.time() + 20
    while shuffled() - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffled() - before


def test_a_stored_base_gives_the_same_fixtures(spark):
    plain, fx = Fixtures(spark, SF), Fixtures(spark, SF)
    fx.store("fx_base")
    fx.store("fx_base")
    for name in ("fx_files", "fx_target", "fx_ledger_packages", "fx_requests"):
        assert fx[name].schema == plain[name].schema
        assert fx[name].exceptAll(plain[name]).count() == 0 == plain[name].exceptAll(fx[name]).count()
        assert "lineitem" not in "".join(fx[name].inputFiles())
