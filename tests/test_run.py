"""End-to-end run: plan, copy, post-check, ledger snapshot; then a resumed run."""

import os

from pyspark.sql import functions as F

from pkgsync.operators import inventory as INV
from pkgsync.plans import migration as M
from pkgsync.plans import run as RUN
from pkgsync.session import local_dir, scratch_path

FILES = [
    ("mvn", "/org/x/lib/1.0/lib-1.0.jar"),
    ("mvn", "/org/x/lib/1.0/lib-1.0.pom"),
    ("mvn", "/org/x/lib/2.0/lib-2.0.jar"),
    ("mvn", "/org/x/lib/1.0/maven-metadata.xml"),
    ("mvn", "/org/x/lib/maven-metadata.xml"),
    ("py", "/tool/0.1/tool-0.1.tar.gz"),
    ("py", "/tool/0.2+b1/tool-0.2+b1.whl"),      # refused name
    ("npmr", "/@s/pkg/-/@s/pkg-3.0.0.tgz"),
]


def _setup(spark):
    src = local_dir(scratch_path(spark, "src"))
    for repo, uri in FILES:
        p = src + "/" + repo + uri
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as f:
            f.write((repo + uri).encode() * 3)
    listing = spark.createDataFrame([(r, u, 3 * len(r + u)) for r, u in FILES], "repository string, uri string, size_bytes bigint")
    cat = spark.createDataFrame([("mvn", "LOCAL", "Maven"), ("py", "LOCAL", "Pypi"), ("npmr", "LOCAL", "Npm"),
                                 ("TOTAL", "NA", None)], "repo_key string, repo_type string, package_type string")
    # target: lib 2.0 already published, pkg 3.0.0 present but unfinished
    target = spark.createDataFrame([("mvn", "maven", "org.x", "lib", "2.0", "Published"),
                                    ("npmr", "npm", "s", "pkg", "3.0.0", "Unfinished")],
                                   "repository string, format string, namespace string, package string, version string, status string")
    inv = INV.inventory(listing, cat)
    return src, M.Inputs(inv, cat, target), target


def test_migrate_end_to_end_and_resume(spark):
    src, inputs, target = _setup(spark)
    dst = local_dir(scratch_path(spark, "dst"))
    work = scratch_path(spark, "work")

    dry = RUN.migrate(spark, inputs, work_root=work, run_id="dry", dry_run=True)
    assert dry.copies is None and spark.read.parquet(dry.plan).count() == 5

    # after the copy the target shows lib 1.0 and tool 0.1 published; pkg 3.0.0 is still unfinished
    def fresh():
        return target.unionByName(spark.createDataFrame(
            [("mvn", "maven", "org.x", "lib", "1.0", "Published"), ("py", "pypi", "", "tool", "0.1", "Published")],
            target.schema))

    res = RUN.migrate(spark, inputs, work_root=work, run_id="1", src_root=src, dst_root=dst, dry_run=False,
                      fresh_target=fresh)
    copies = {r["dst_path"]: r["status"] for r in spark.read.parquet(res.copies).collect()}
    assert sorted(p[len(dst):] for p in copies) == sorted(
        ["/mvn/org/x/lib/1.0/lib-1.0.jar", "/mvn/org/x/lib/1.0/lib-1.0.pom", "/py/tool/0.1/tool-0.1.tar.gz",
         "/npmr/@s/pkg/-/@s/pkg-3.0.0.tgz"])
    assert set(copies.values()) == {"copied"}
    for p in copies:
        with open(p, "rb") as f, open(src + p[len(dst):], "rb") as g:
            assert f.read() == g.read()

    led = RUN.read_ledger(spark, res.ledger)
    v = {(r["package"], r["version"]): (r["published"], r["publish_failed"], r["publish_error"])
         for r in led["versions"].collect()}
    assert v[("org/x/lib", "1.0")][:2] == (1, 0)
    assert v[("org/x/lib", "2.0")][:2] == (1, 0)          # already published in the target
    assert v[("tool", "0.1")][:2] == (1, 0)
    assert v[("tool", "0.2+b1")][:2] == (0, 1) and "refuses" in v[("tool", "0.2+b1")][2]      # refused, not attempted
    assert v[("@s/pkg", "3.0.0")][:2] == (0, 1) and "not found with status Published" in v[("@s/pkg", "3.0.0")][2]
    p = {r["package"]: r["all_versions_published"] for r in led["packages"].collect()}
    assert p == {"org/x/lib": 1, "tool": 0, "@s/pkg": 0}
    rp = {r["repository"]: (r["all_versions_published"], r["publish_failed"]) for r in led["repositories"].collect()}
    assert rp == {"mvn": (1, 0), "py": (0, 1), "npmr": (0, 1)}
    outcome = {(r["package"], r["version"]): r["outcome"] for r in spark.read.parquet(res.outcome).collect()}
    assert outcome == {("org/x/lib", "1.0"): "published", ("org/x/lib", "2.0"): "already_published", ("tool", "0.1"): "published",
                       ("tool", "0.2+b1"): "rejected", ("@s/pkg", "3.0.0"): "not_published"}
    # the maven version's metadata file arrives after its files; wipes come before, status changes after
    assert [(r["version"], r["status"]) for r in spark.read.parquet(res.metadata).collect()] == [("1.0", "copied")]
    with open(dst + "/mvn/org/x/lib/1.0/maven-metadata.xml", "rb") as f:
        assert f.read() == b"mvn/org/x/lib/1.0/maven-metadata.xml" * 3
    box = {k: [(r["package"], r["version"], r["action"]) for r in spark.read.parquet(f"{res.outbox}/{k}").collect()] for k in ("before", "after")}
    assert box == {"before": [("@s/pkg", "3.0.0", "wipe")], "after": [("org/x/lib", "1.0", "set_status")]}

    # resume from the new ledger against the fresh target: only pkg 3.0.0 (unfinished) and the refused name stay
    inputs2 = M.Inputs(inputs.inventory, inputs.repositories, fresh(), led["versions"], led["packages"], led["repositories"])
    left = {(r["package"], r["version"]): r["decision"] for r in M.resume_plan(inputs2).collect()}
    assert left == {("@s/pkg", "3.0.0"): "wipe_publish", ("tool", "0.2+b1"): "reject"}

    # a second run copies nothing new; it plans with the store's ledger
    res2 = RUN.migrate(spark, inputs2, work_root=work, run_id="2", src_root=src, dst_root=dst, dry_run=False,
                       fresh_target=fresh)
    st = [r["status"] for r in spark.read.parquet(res2.copies).collect()]
    assert st == ["skipped"]
    assert spark.read.parquet(res2.plan).where(F.col("decision") == "skip_ledger").count() == 3


def test_restart_same_run_id(spark):
    src, inputs, target = _setup(spark)
    dst = local_dir(scratch_path(spark, "dst"))
    work = scratch_path(spark, "work")
    first = RUN.migrate(spark, inputs, work_root=work, run_id="7", src_root=src, dst_root=dst, dry_run=False,
                        fresh_target=lambda: target)
    again = RUN.migrate(spark, inputs, work_root=work, run_id="7", src_root=src, dst_root=dst, dry_run=False,
                        fresh_target=lambda: target)
    assert again.ledger == first.ledger
    assert {r["status"] for r in spark.read.parquet(again.copies).collect()} == {"skipped"}
    assert RUN.read_ledger(spark, again.ledger)["versions"].count() == 5


def test_modes_and_resume(spark):
    """The three modes, and resume, against one ledger store."""
    src, inputs, target = _setup(spark)
    dst, work = local_dir(scratch_path(spark, "dst")), scratch_path(spark, "work")
    shown = [target]

    def fresh():
        return shown[0]

    def run(run_id, **how):
        res = RUN.migrate(spark, inputs, work_root=work, run_id=run_id, src_root=src, dst_root=dst, dry_run=False, fresh_target=fresh, **how)
        return {(r["package"], r["version"]): r["outcome"] for r in spark.read.parquet(res.outcome).collect()}, RUN.read_ledger(spark, res.ledger)

    requests = spark.createDataFrame([(1, "py", "tool:0.1 nope:1"), (2, "py", "tool:0.1")], "request_id long, repository string, packages string")
    got, led = run("1", mode="packages", requests=requests)
    assert got == {("tool", "0.1"): "not_published"}
    assert [tuple(r) for r in led["packages"].collect()] == [("py", "tool", 0, 0)]       # one version named: not fetched
    shown[0] = target.unionByName(spark.createDataFrame([("py", "pypi", "", "tool", "0.1", "Published")], target.schema))
    got, led = run("2", mode="repositories", repositories=["py"])
    assert got == {("tool", "0.1"): "published", ("tool", "0.2+b1"): "rejected"}
    row = led["versions"].where("version = '0.1'").first()
    assert (row["published"], row["publish_failed"], row["publish_error"]) == (1, 0, "")      # the old failure is over
    got, led = run("3", resume=True)
    assert got == {("org/x/lib", "1.0"): "not_published", ("@s/pkg", "3.0.0"): "not_published", ("tool", "0.2+b1"): "rejected"}
    assert led["versions"].count() == 4                                                   # lib 2.0 is published at the target, not open
    # a version whose files vanish from the source is a failure with text, as is one without files
    os.remove(src + "/npmr/@s/pkg/-/@s/pkg-3.0.0.tgz")
    os.remove(dst + "/npmr/@s/pkg/-/@s/pkg-3.0.0.tgz")
    inputs.inventory = inputs.inventory.withColumn("copy", F.col("copy") & (F.col("package") != "org/x/lib"))
    got, led = run("4", resume=True)
    assert got == {("org/x/lib", "1.0"): "no_files", ("@s/pkg", "3.0.0"): "copy_failed", ("tool", "0.2+b1"): "rejected"}
    errors = {r["package"]: r["publish_error"] for r in led["versions"].where("publish_failed = 1").collect()}
    assert "has no file" in errors["org/x/lib"] and "missing_source" in errors["@s/pkg"] and "not found with status" in errors["@s/pkg"]
