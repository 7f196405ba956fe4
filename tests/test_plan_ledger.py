"""Properties and hand cases of the plan, waves and ledger."""

from pyspark.sql import functions as F

from pkgsync.operators import inventory as INV
from pkgsync.operators import ledger as LG
from pkgsync.operators import reconcile as R
from pkgsync.operators.ranking import index_within
from pkgsync.plans import migration as M
from pkgsync.sources.fixtures import Fixtures

SF = "/root/testdata/sf0.001"


def _inputs(spark):
    fx = Fixtures(spark, SF)
    inv = INV.inventory(fx.fx_files.select("repository", "uri", "size_bytes"), fx.fx_repositories)
    return fx, M.Inputs(inv, fx.fx_repositories, fx.fx_target, fx.fx_ledger_versions, fx.fx_ledger_packages,
                        fx.fx_ledger_repositories)


def test_plan_is_a_partition(spark):
    _, inputs = _inputs(spark)
    plan = M.plan(inputs)
    vers = INV.versions(M.in_scope(inputs.inventory, inputs.repositories))
    assert plan.count() == vers.count()
    assert plan.select("repository", "package", "version").distinct().count() == plan.count()
    assert {r[0] for r in plan.select("decision").distinct().collect()} <= set(R.DECISIONS)


def test_resume_after_applying_plan_is_empty(spark):
    fx, inputs = _inputs(spark)
    first = M.resume_plan(inputs)
    assert first.where(F.col("decision") != "reject").count() > 0
    done = first.where(F.col("decision").isin("publish", "wipe_publish"))
    # apply: every copied version shows Published in the target and in the ledger
    tgt_add = INV.with_target_coordinates(done.select("repository", "package_type", "package", "version")).select(
        "repository", F.col("package_type").alias("format"), F.col("target_namespace").alias("namespace"),
        F.col("target_package").alias("package"), "version", F.lit("Published").alias("status"))
    inputs.target_versions = inputs.target_versions.unionByName(tgt_add)
    inputs.ledger_versions = LG.upsert_published(inputs.ledger_versions, done)
    left = M.resume_plan(inputs)
    # only versions refused by name stay open
    assert left.where(F.col("decision") != "reject").count() == 0
    assert left.count() == first.where(F.col("decision") == "reject").count()


def test_reject_before_wipe(spark):
    # 2.14 #8: unfinished version with a refused name is rejected, not wiped
    st = spark.createDataFrame([("r", "pypi", "p", "1.0+b1", 2)],
                               "repository string, package_type string, package string, version string, state_code int")
    assert R.decide(st).first()["decision"] == "reject"


def test_waves_at_most_procs(spark):
    _, inputs = _inputs(spark)
    pk = INV.packages(M.in_scope(inputs.inventory, inputs.repositories))
    w = R.migration_waves(pk, 3)
    sizes = w.groupBy("repository", "wave").count().agg(F.max("count")).first()[0]
    assert sizes <= 3
    assert w.count() == pk.count()


def test_index_within_matches_row_number_under_skew(spark):
    # one group holds most rows, spread over many range partitions
    rows = [("hot", f"p{i:05d}") for i in range(3000)] + [(f"g{i % 7}", f"q{i:04d}") for i in range(200)]
    df = spark.createDataFrame(rows, "g string, k string")
    got = index_within(df, ["g"], ["k"], "idx", num_partitions=16)
    from pyspark.sql import Window

    want = df.withColumn("idx", (F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).cast("bigint"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_version_lookup_uses_full_key(spark):
    # 2.14 #16: same version in two packages of one repository
    led = spark.createDataFrame([("r", "a", "1.0", 1, 0, "")], LG.LEDGER_VERSIONS)
    new = spark.createDataFrame([("r", "b", "1.0")], "repository string, package string, version string")
    out = LG.add_versions(led, new)
    assert out.count() == 2
    assert LG.known(new, led, LG.VER_KEY).count() == 0


def test_ledger_updates_idempotent(spark):
    led = spark.createDataFrame([("r", "a", "1.0", 0, 0, ""), ("r", "a", "2.0", 0, 0, "")], LG.LEDGER_VERSIONS)
    pub = spark.createDataFrame([("r", "a", "1.0"), ("r", "b", "3.0")], "repository string, package string, version string")
    once = LG.upsert_published(led, pub)
    twice = LG.upsert_published(once, pub)
    assert sorted(once.collect()) == sorted(twice.collect())
    got = {(r["package"], r["version"]): r["published"] for r in once.collect()}
    assert got == {("a", "1.0"): 1, ("a", "2.0"): 0, ("b", "3.0"): 1}


def test_rollup_counts_null_as_unpublished_and_all_packages(spark):
    led = spark.createDataFrame(
        [("r", "a", "1", 1, 0, ""), ("r", "a", "2", None, 0, ""), ("r", "b", "1", 1, 0, ""), ("s", "c", "1", 1, 0, "")],
        LG.LEDGER_VERSIONS)
    pr = {r["package"]: r["all_published"] for r in LG.package_rollup(led).collect()}
    assert pr == {"a": False, "b": True, "c": True}
    rr = {r["repository"]: r["all_published"] for r in LG.repository_rollup(LG.package_rollup(led)).collect()}
    assert rr == {"r": False, "s": True}   # 2.14 #13: over all packages, not the last wave


def test_publish_errors_fixed_order_and_quotes(spark):
    rs = spark.createDataFrame(
        [(2, "r", "p", "1", "b.jar", 500, "Err", "it's"), (1, "r", "p", "1", "a.pom", 409, "Conflict", "x"),
         (3, "r", "p", "1", "c.jar", 200, "OK", "")],
        "upload_id bigint, repository string, package string, version string, file_name string, status_code int, "
        "reason string, body string")
    r = LG.publish_errors(rs).first()
    assert r["error_text"] == '409, Conflict, x -- 500, Err, it"s' and r["n_failed"] == 2


def test_ledger_current_latest_run(spark):
    snaps = spark.createDataFrame(
        [("r", "a", "1", 0, 0, "", 1), ("r", "a", "1", 1, 0, "", 2), ("r", "b", "1", 0, 1, "e", 1)],
        "repository string, package string, version string, published int, publish_failed int, publish_error string, run_id int")
    got = {r["package"]: (r["published"], r["run_id"]) for r in LG.current(snaps, LG.VER_KEY).collect()}
    assert got == {"a": (1, 2), "b": (0, 1)}


def test_ledger_create_clean_and_snapshot(spark):
    from pkgsync.session import scratch_path

    root = scratch_path(spark, "ledger")
    LG.create_if_absent(spark, root)                       # A10
    assert spark.read.parquet(f"{root}/versions").count() == 0
    led = spark.createDataFrame([("r", "a", "1", 1, 0, ""), ("s", "b", "2", 0, 1, "e")], LG.LEDGER_VERSIONS)
    led.write.mode("overwrite").parquet(f"{root}/versions")
    LG.create_if_absent(spark, root)                       # existing tables are kept
    assert spark.read.parquet(f"{root}/versions").count() == 2
    snap = f"{root}/snap-1"
    LG.write_snapshot(led, snap)
    back = spark.read.parquet(snap).select(*[f.name for f in LG.LEDGER_VERSIONS.fields])
    assert sorted(back.collect()) == sorted(led.collect())
    LG.clean(spark, root)                                  # A11
    assert all(spark.read.parquet(f"{root}/{k}").count() == 0 for k in LG.SCHEMAS)


def test_strict_requests_raise(spark):
    import pytest

    fx, inputs = _inputs(spark)
    ok = fx.fx_requests.where(~F.col("packages").contains(":")).where(~F.col("packages").contains(" "))
    M.requested_plan(inputs, ok, strict=True).count()          # every entry valid and known
    bad_repo = ok.limit(1).withColumn("repository", F.lit("no-such-repo"))
    with pytest.raises(ValueError, match="unknown repositories"):
        M.requested_plan(inputs, bad_repo, strict=True)
    with pytest.raises(ValueError, match="malformed"):
        M.requested_plan(inputs, fx.fx_requests, strict=True)
    missing = ok.limit(1).withColumn("packages", F.lit("no-such-package"))
    with pytest.raises(ValueError, match="not found"):
        M.requested_plan(inputs, missing, strict=True)


def test_plan_modes(spark):
    import pytest

    fx, inputs = _inputs(spark)
    full = M.plan_mode(inputs, "all")
    assert full.count() == M.plan(inputs).count()
    some = M.plan_mode(inputs, "repositories", repositories=["repo-0", "repo-1"])
    assert {r[0] for r in some.select("repository").distinct().collect()} <= {"repo-0", "repo-1"}
    assert some.count() == full.where(F.col("repository").isin("repo-0", "repo-1")).count()
    assert M.plan_mode(inputs, "packages", requests=fx.fx_requests).count() > 0
    with pytest.raises(ValueError, match="unknown"):
        M.plan_mode(inputs, "repositories", repositories=["nope"], strict=True)
    resumed = M.plan_mode(inputs, "repositories", repositories=["repo-1"], resume=True)
    assert resumed.where(F.col("repository") != "repo-1").count() == 0


def test_waves_split_a_hot_repository(spark):
    """One repository holding a third of all packages (all maven packages of the
    sf0.01 fixture, re-keyed): the wave index equals row_number, and the range
    partitions it runs on stay balanced, i.e. the hot repository is split."""
    from pyspark.sql import Window

    fx = Fixtures(spark, "/root/testdata/sf0.01")
    inv = INV.inventory(fx.fx_files.select("repository", "uri", "size_bytes"), fx.fx_repositories)
    maven = F.col("package_type") == "maven"
    pk = INV.packages(M.in_scope(inv, fx.fx_repositories)).select(
        F.when(maven, F.lit("hot")).otherwise(F.col("repository")).alias("repository"),
        F.when(maven, F.concat_ws("/", "repository", "package")).otherwise(F.col("package")).alias("package"),
    )
    n = pk.count()
    hot = pk.where(F.col("repository") == "hot").count()
    assert hot * 3 >= n
    got = R.migration_waves(pk, 4)
    want = pk.withColumn("position", (F.row_number().over(Window.partitionBy("repository").orderBy("package")) - 1)
                         .cast("bigint"))
    assert sorted(got.select("repository", "package", "position").collect()) == sorted(want.collect())
    sizes = [r["count"] for r in pk.repartitionByRange(8, "repository", "package")
             .groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert max(sizes) < 1.5 * n / 8          # no task holds the hot repository whole


def test_plan_files_spread_a_hot_version(spark):
    """A version holding a third of all copy files: the same rows as a plain join, spread over the slots, and the plan
    reads each table no more often than the plain join."""
    fx = Fixtures(spark, "/root/testdata/sf0.01")
    inv = INV.inventory(fx.fx_files.select("repository", "uri", "size_bytes"), fx.fx_repositories)
    mv = F.col("package_type") == "maven"
    inv = inv.select(F.when(mv, F.lit("repo-0")).otherwise(F.col("repository")).alias("repository"), "package_type",
                     F.when(mv, F.concat_ws("/", "repository", "uri")).otherwise(F.col("uri")).alias("uri"),
                     "size_bytes", "file_name",
                     F.when(mv, F.lit("org/hot/lib")).otherwise(F.col("package")).alias("package"),
                     F.when(mv & F.col("version").isNotNull(), F.lit("1.0")).otherwise(F.col("version")).alias("version"),
                     "copy")
    inputs = M.Inputs(inv, fx.fx_repositories, fx.fx_target)
    plan = M.plan(inputs)
    scoped = M.in_scope(inv, fx.fx_repositories)
    cols = ["repository", "package", "version", "uri", "decision"]
    plain = INV.version_files(scoped).join(R.to_copy(plan).select("repository", "package", "version", "decision"), ["repository", "package", "version"])
    a = sorted(plain.select(*cols).collect())
    assert sorted(M.plan_files(plan, scoped).select(*cols).collect()) == a
    hot_rows = [r for r in a if r["package"] == "org/hot/lib"]
    assert len(hot_rows) * 3 >= len(a)
    # as at scale (no broadcast of the plan side, no coalescing): the hot version's
    # files land in several join partitions
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        parts = (M.plan_files(plan, scoped).where(F.col("package") == "org/hot/lib").groupBy(F.spark_partition_id().alias("p"))
                 .count().collect())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(parts) == 8 and max(r["count"] for r in parts) < 0.25 * len(hot_rows)
    # the plan row is repeated at most once per file
    rows = plan.where(F.col("n_files") > 0).select(F.bit_count("slots").alias("slots"), "n_files").collect()
    assert all(1 <= r["slots"] <= min(r["n_files"], INV.SLOTS) for r in rows)


def test_requested_plan_holds_each_version_once(spark):
    """Also where a third of the requests ask for one package, by name and as a whole; the links lead to all of them."""
    fx, inputs = _inputs(spark)
    hot = fx.fx_ledger_packages.where("all_versions_fetched = 1 and all_versions_published = 0").orderBy("repository", "package").first()
    many = fx.fx_requests.unionByName(spark.range(3000).select(
        (-1 - F.col("id")).alias("request_id"), F.lit(hot["repository"]).alias("repository"), F.lit(hot["package"]).alias("packages")))
    plan = M.requested_plan(inputs, many).cache()
    assert plan.count() == plan.select("repository", "package", "version").distinct().count()
    links = M.request_links(plan, many)
    ledger = fx.fx_ledger_versions.where((F.col("repository") == hot["repository"]) & (F.col("package") == hot["package"])).select("version")
    got = links.where(F.col("request_id") == -1).select("version")
    assert sorted(got.collect()) == sorted(ledger.collect())                     # K6: from the ledger, not the listing
    assert links.join(plan, ["repository", "package", "version"], "left_anti").count() == 0
    done = fx.fx_ledger_packages.where("all_versions_published = 1").select("repository", "package")
    assert done.count() > 0 and plan.where("by_package").join(done, ["repository", "package"], "left_semi").count() == 0   # K12


def test_requests_and_responses_hold_every_type_with_the_ledger_key(spark):
    fx, _ = _inputs(spark)
    rows = fx.fx_base.count()
    assert fx.fx_requests.count() == fx.fx_responses.count() == rows
    failed = fx.fx_responses.where("status_code >= 400").select("repository", "package", "version", "file_name")
    kinds = {(r[0].startswith("@"), "/" in r[0]) for r in failed.select("package").distinct().collect()}
    assert kinds == {(True, True), (False, True), (False, False)}      # npm, maven, pypi
    keys = failed.select("repository", "package", "version").distinct()
    assert keys.join(fx.fx_ledger_versions, ["repository", "package", "version"], "left_semi").count() > 0
    assert fx.fx_requests.where(F.col("packages").startswith("@")).count() > 0


def test_ledger_marks_meet_rows_and_clean_wipes_what_was_written(spark, monkeypatch):
    from pkgsync import queries as Q

    fx, _ = _inputs(spark)
    marked = Q.QUERIES["ledger_mark_errors"](spark, SF)
    assert marked.where(F.col("publish_error").contains(", order ")).count() > 0
    left = lambda: Q.QUERIES["ledger_clean"](spark, SF).where("moment = 'after'").first()["n_versions"]
    assert left() == 0
    monkeypatch.setattr(Q.LG, "clean", lambda *_: None)                # without the wipe the ledger is still there
    assert left() == fx.fx_ledger_versions.count()
