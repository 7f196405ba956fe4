"""One migration run end to end (L1, L5 with copy, L6, J-rows), as a sequence of Spark jobs.

plan -> write plan (A12) -> actions in order: ``wipe`` rows to the outbox, files copied (A9), for maven the metadata file
copied, ``set_status`` rows to the outbox -> the fresh target stored -> outcome of every version (L6) -> the ledger's
delta (D6, J-rows, E3-E6) appended to its store.

The outbox holds what an outside tool has to apply at the target's service; everything else happens here.  Every stage
boundary is a written table under ``work_root`` (a shared folder), which cuts lineage: a lost executor re-runs only the
stage it belonged to, the side-effecting copy is never evaluated twice, and all ledger writes read one stored outcome
however the target moves meanwhile.  A run restarted with the same ``run_id`` (driver lost) rewrites only its own folder:
the copy skips files already verified, and the ledger gets a delta without rows it has already.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths as P
from ..operators import inventory as INV
from ..operators import ledger as LG
from ..operators import ranged as RG
from ..operators import reconcile as R
from ..operators import transfer as TR
from ..operators.ledger_store import LedgerStore
from . import migration as M

OK_STATUSES = ("copied", "skipped")
REFUSED_ERROR = "Package {package} {version} was not uploaded: its name or version has characters that the target refuses."
NO_FILES_ERROR = "Package {package} {version} was not uploaded: the source has no file of it to copy."


@dataclass
class RunResult:
    plan: str
    copies: str | None = None
    metadata: str | None = None
    outbox: str | None = None
    outcome: str | None = None
    ledger: str | None = None


def _join_path(root_col_prefix: str, *cols) -> F.Column:
    return F.concat(F.lit(root_col_prefix.rstrip("/") + "/"), *cols)


def _text(template: str) -> F.Column:
    return F.replace(F.replace(F.lit(template), F.lit("{package}"), F.col("package")), F.lit("{version}"), F.col("version"))


def copy_responses(copies: DataFrame) -> DataFrame:
    """Copy results in the shape of upload responses (C15, E6 input)."""
    ok = F.col("status").isin(*OK_STATUSES)
    return copies.select(
        F.xxhash64("dst_path").alias("upload_id"), "repository", "package", "version",
        F.element_at(F.split("dst_path", "/"), -1).alias("file_name"),
        F.when(ok, F.lit(200)).otherwise(F.lit(500)).alias("status_code"),
        F.col("status").alias("reason"),
        F.coalesce("error", F.lit("")).alias("body"),
    )


def copied_versions(responses: DataFrame) -> DataFrame:
    """Per version with copied files: ``n_copied``, ``n_failed`` and the failures' text."""
    counts = responses.groupBy(*LG.VER_KEY).agg(
        F.count_if(F.col("status_code") < 400).cast("bigint").alias("n_copied"), F.count_if(F.col("status_code") >= 400).cast("bigint").alias("n_failed"))
    return counts.join(LG.publish_errors(responses).drop("n_failed"), LG.VER_KEY, "left")


def metadata_plan(plan_df: DataFrame, files: DataFrame, responses: DataFrame, src_root: str, dst_root: str) -> DataFrame:
    """The ``copy_metadata`` actions: the metadata file beside a maven version's files (B9), once all of them are copied."""
    whole = responses.groupBy(*LG.VER_KEY).agg(F.bool_and(F.col("status_code") < 400).alias("ok")).where("ok").select(*LG.VER_KEY)
    due = M.actions(plan_df).where(F.col("action") == "copy_metadata").select(*LG.VER_KEY).join(whole, LG.VER_KEY, "left_semi")
    uri = P.maven_metadata_uri("uri").alias("uri")
    beside = files.where(F.col("package_type") == "maven").select(*LG.VER_KEY, uri).distinct().join(due, LG.VER_KEY, "left_semi")
    return beside.select(_join_path(src_root, F.col("repository"), F.col("uri")).alias("src_path"),
                         _join_path(dst_root, F.col("repository"), F.col("uri")).alias("dst_path"), *LG.VER_KEY)


def outcomes(plan_df: DataFrame, copies: DataFrame, metadata: DataFrame, fresh_target: DataFrame | None) -> DataFrame:
    """What became of every planned version, one row each.

    ``outcome``: ``skipped`` (the ledger says published), ``already_published``, ``rejected``, ``no_files``,
    ``copy_failed``, ``metadata_failed`` (a metadata file that the source lacks is no failure), ``not_published`` (copied,
    but the fresh target does not show it published), ``published``, or ``copied`` where no fresh target was given.
    ``publish_failed`` and ``publish_error`` (copy errors first, then the target's) are what the ledger stores.
    """
    done = copied_versions(copy_responses(copies))
    bad = copy_responses(metadata.where(F.col("status") != "missing_source"))
    meta = LG.publish_errors(bad).select(*LG.VER_KEY, F.col("error_text").alias("_meta"))
    rows = plan_df.join(done, LG.VER_KEY, "left").join(meta, LG.VER_KEY, "left").drop("state_code", "state")
    if fresh_target is not None:
        rows = R.version_state(rows, fresh_target)
        shown = F.col("state_code") == R.STATE_PUBLISHED
    else:
        shown = F.lit(None).cast("boolean")
    d, tried = F.col("decision"), F.col("decision").isin("publish", "wipe_publish")
    outcome = (
        F.when(d == "skip_ledger", "skipped").when(d == "skip_published", "already_published").when(d == "reject", "rejected")
        .when(F.col("n_copied").isNull(), "no_files").when(F.col("n_failed") > 0, "copy_failed").when(F.col("_meta").isNotNull(), "metadata_failed")
        .when(shown.isNull(), "copied").when(shown, "published").otherwise("not_published")
    )
    failed = F.col("outcome").isin("rejected", "no_files", "copy_failed", "metadata_failed", "not_published")
    parts = F.array_compact(F.array(
        F.when(F.col("outcome") == "rejected", _text(REFUSED_ERROR)), F.when(F.col("outcome") == "no_files", _text(NO_FILES_ERROR)),
        F.col("error_text"), F.col("_meta"), F.when(tried & ~shown, _text(LG.MISSING_ERROR))))
    return rows.withColumn("outcome", outcome).select(
        *LG.VER_KEY, "package_type", "namespace", "target_package", "decision", "n_files", F.coalesce("n_copied", F.lit(0)).cast("bigint").alias("n_copied"),
        "outcome", failed.cast("int").alias("publish_failed"), F.when(failed, P.normalise_quotes(F.array_join(parts, " -- "))).otherwise("").alias("publish_error"))


def update_ledger(inputs: M.Inputs, plan_df: DataFrame, outcome: DataFrame, whole_packages: DataFrame,
                  whole_repositories: DataFrame | None) -> dict[str, DataFrame]:
    """New ledger tables after a run, all from its stored outcome.

    * every planned version and package is in the ledger (D6);
    * versions the target shows published -- found so by the plan or by the post-check -- are published (J7), and what
      failed earlier for them is over;
    * failed versions get publish_failed and the error text (J8, J9, B16), their repositories the flag (E5);
    * packages of which the run saw all versions (``whole_packages``) are fetched (J5), and published when all their
      versions are (E3, J6); repositories seen whole are fetched (J10), and published when all their packages are (E4, J11).
    """
    spark = plan_df.sparkSession
    lv = inputs.ledger_versions if inputs.ledger_versions is not None else LG.empty_table(spark, "versions")
    lp = inputs.ledger_packages if inputs.ledger_packages is not None else LG.empty_table(spark, "packages")
    lr = inputs.ledger_repositories if inputs.ledger_repositories is not None else LG.empty_table(spark, "repositories")

    published = outcome.where(F.col("outcome").isin("published", "already_published"))
    failed = outcome.where(F.col("publish_failed") == 1)
    lv = LG.upsert_published(LG.add_versions(lv, plan_df), published)
    lv = LG.set_flag(lv, LG.VER_KEY, published, "publish_failed", 0)
    lv = LG.mark_errors(LG.mark_failed(lv, failed), failed.select(*LG.VER_KEY, F.col("publish_error").alias("error_text")).unionByName(
        published.select(*LG.VER_KEY, F.lit("").alias("error_text"))))

    lp = LG.mark_packages_fetched(LG.add_packages(lp, plan_df), whole_packages)
    rollup = LG.package_rollup(lv).join(lp.where(F.col("all_versions_fetched") == 1), LG.PKG_KEY, "left_semi")
    lp = LG.mark_packages_published(lp, rollup)
    lr = LG.mark_repositories_failed(LG.add_repositories(lr, plan_df), failed)
    if whole_repositories is not None:
        lr = LG.mark_repositories_fetched(lr, whole_repositories)
    done = lp.groupBy("repository").agg(F.bool_and(F.col("all_versions_published") == 1).alias("all_published"))
    lr = LG.mark_repositories_published(lr, done.join(lr.where(F.col("all_versions_fetched") == 1), "repository", "left_semi"))
    return {"versions": lv, "packages": lp, "repositories": lr}


def migrate(spark: SparkSession, inputs: M.Inputs, *, work_root: str, run_id: str, src_root: str | None = None, dst_root: str | None = None,
            dry_run: bool = True, fresh_target: Callable[[], DataFrame] | None = None, mode: str = "all", repositories: list[str] | None = None,
            requests: DataFrame | None = None, resume: bool = False, strict: bool = False, ledger_root: str | None = None) -> RunResult:
    """One run, in any mode of ``migration.plan_mode``.

    ``dry_run`` writes the plan only (nothing is copied, the ledger is untouched).  Otherwise files are copied from
    ``src_root/<repository><uri>`` to ``dst_root/<repository><uri>``, ``fresh_target()`` is read once after the copy, and
    the changed ledger rows are appended to the store at ``ledger_root`` (``work_root/ledger``).  A store that exists is
    the ledger; otherwise that of ``inputs`` begins it.
    """
    base = f"{work_root.rstrip('/')}/run={run_id}"
    store = LedgerStore(spark, ledger_root or f"{work_root.rstrip('/')}/ledger")
    now = store.snapshot()
    if now:
        inputs = _with_ledger(inputs, store.read(now))
    plan_path = f"{base}/plan"
    planned = M.plan_mode(inputs, mode, repositories, requests, resume, strict)
    M.write_plan(M.with_endpoint(planned, inputs.endpoints), plan_path)
    result = RunResult(plan=plan_path)
    if dry_run:
        return result
    if src_root is None or dst_root is None:
        raise ValueError("src_root and dst_root are needed unless dry_run")
    if not now:
        given = {"versions": inputs.ledger_versions, "packages": inputs.ledger_packages, "repositories": inputs.ledger_repositories}
        store.create_if_absent({k: t for k, t in given.items() if t is not None})
        inputs = _with_ledger(inputs, store.read())
    plan_df = spark.read.parquet(plan_path)

    def written(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    steps = M.actions(plan_df)
    outbox = ["repository", "package_type", "package", "version", "seq", "action"]
    written("outbox/before", steps.where(F.col("action") == "wipe").select(*outbox))
    result.outbox = f"{base}/outbox"

    # a restarted run overwrites its own results; finished copies then read "skipped"
    files = M.plan_files(plan_df, inputs.inventory)
    cost = R.to_copy(plan_df).agg(F.sum(F.col("copy_bytes") + F.col("n_files") * RG.FILE_COST).alias("n")).first()["n"]
    copies = written("copies", RG.copy_artifacts(files.select(
        _join_path(src_root, F.col("repository"), F.col("uri")).alias("src_path"),
        _join_path(dst_root, F.col("repository"), F.col("uri")).alias("dst_path"), F.col("size_bytes").alias("length"), *LG.VER_KEY),
        f"{base}/ranges", keep=LG.VER_KEY, cost=cost or 0))
    metadata = written("metadata", TR.copy_artifacts(metadata_plan(plan_df, files, copy_responses(copies), src_root, dst_root), keep=LG.VER_KEY))
    result.copies, result.metadata = f"{base}/copies", f"{base}/metadata"

    target = written("target", fresh_target()) if fresh_target is not None else None
    outcome = written("outcome", outcomes(plan_df, copies, metadata, target))
    result.outcome = f"{base}/outcome"
    sent = outcome.where(F.col("outcome").isin("published", "copied", "not_published"))
    written("outbox/after", steps.where(F.col("action") == "set_status").join(sent.select(*LG.VER_KEY), LG.VER_KEY, "left_semi").select(*outbox))

    whole = plan_df.where("by_package") if mode == "packages" else plan_df
    seen = None if mode == "packages" else plan_df.select("repository").distinct()
    store.append(update_ledger(inputs, plan_df, outcome, whole.select(*LG.PKG_KEY).distinct(), seen))
    result.ledger = store.root
    return result


def _with_ledger(inputs: M.Inputs, tables: dict[str, DataFrame]) -> M.Inputs:
    return replace(inputs, ledger_versions=tables["versions"], ledger_packages=tables["packages"], ledger_repositories=tables["repositories"])


def read_ledger(spark: SparkSession, ledger_path: str) -> dict[str, DataFrame]:
    """The three ledger tables of a store's current snapshot."""
    return LedgerStore(spark, ledger_path).read()


__all__ = ["RunResult", "copied_versions", "copy_responses", "metadata_plan", "migrate", "outcomes", "read_ledger", "update_ledger"]
