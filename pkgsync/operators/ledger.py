"""Ledger of earlier runs: reads, snapshot updates, roll-ups.

Three tables replace the single-row SQL / key-value updates of the source tool:

* ``ledger_repositories``: repository, all_versions_fetched, all_versions_published, publish_failed
* ``ledger_packages``:     repository, package, all_versions_fetched, all_versions_published
* ``ledger_versions``:     repository, package, version, published, publish_failed, publish_error

Flags are INT 0/1.  Every update is a bulk join that yields a **new** table;
``write_snapshot`` stores it under a new directory (plain Parquet has no UPDATE
or MERGE, and a path being read is never overwritten).  Keys are always the
full key -- repository, package and version -- also where the source tool
looked a version up without its package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import filters as C
from ..functions import paths as P
from .joins import KEY_HASH, bounded_broadcast, hashed

REPO_KEY = ["repository"]
PKG_KEY = ["repository", "package"]
VER_KEY = ["repository", "package", "version"]

LEDGER_REPOSITORIES = T.StructType([
    T.StructField("repository", T.StringType()),
    T.StructField("all_versions_fetched", T.IntegerType()),
    T.StructField("all_versions_published", T.IntegerType()),
    T.StructField("publish_failed", T.IntegerType()),
])
LEDGER_PACKAGES = T.StructType([
    T.StructField("repository", T.StringType()),
    T.StructField("package", T.StringType()),
    T.StructField("all_versions_fetched", T.IntegerType()),
    T.StructField("all_versions_published", T.IntegerType()),
])
LEDGER_VERSIONS = T.StructType([
    T.StructField("repository", T.StringType()),
    T.StructField("package", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("published", T.IntegerType()),
    T.StructField("publish_failed", T.IntegerType()),
    T.StructField("publish_error", T.StringType()),
])
SCHEMAS = {"repositories": LEDGER_REPOSITORIES, "packages": LEDGER_PACKAGES, "versions": LEDGER_VERSIONS}

# Post-check failure text stored for a version the target does not show published.
MISSING_ERROR = (
    "Package {package} {version} was not found with status Published in the target after upload; "
    "the version may not be valid for the target's format."
)


# --- create / clean (A10, A11) ------------------------------------------------------

def empty_table(spark: SparkSession, kind: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[kind])


def create_if_absent(spark: SparkSession, root: str) -> None:
    """A10: write empty ledger tables where none exist (``mode("ignore")``)."""
    for kind in SCHEMAS:
        empty_table(spark, kind).write.mode("ignore").parquet(f"{root}/{kind}")


def clean(spark: SparkSession, root: str) -> None:
    """Wipe the ledger -- every table becomes the empty table."""
    for kind in SCHEMAS:
        empty_table(spark, kind).write.mode("overwrite").parquet(f"{root}/{kind}")


def write_snapshot(df: DataFrame, path: str, partition_by_repository: bool = True,
                   mode: str = "errorifexists") -> None:
    """Store an updated table under a new path (never over the one being read;
    ``mode="overwrite"`` only for a path owned by the same run, as on a restart).

    Repository folders keep per-repository reads (K8 pruning,
    ``repository_plan``) cheap; rebalancing on the repository first
    (``writes.by_repository``) means no task writes into every folder and a
    repository holding most rows is written by many tasks."""
    if partition_by_repository:
        from .writes import by_repository

        keys = [c for c in ("repository", "package", "version") if c in df.columns]
        w = by_repository(df, keys).write.mode(mode).partitionBy("repository")
    else:
        w = df.write.mode(mode)
    w.parquet(path)


# --- inserts if absent (D6a-c, J2-J4) ----------------------------------------------

def add_repositories(ledger: DataFrame, repositories: DataFrame) -> DataFrame:
    """New repositories with all flags 0."""
    new = (
        repositories.select("repository").distinct()
        .join(ledger.select("repository"), "repository", "left_anti")
        .select("repository", F.lit(0).alias("all_versions_fetched"), F.lit(0).alias("all_versions_published"),
                F.lit(0).alias("publish_failed"))
    )
    return ledger.unionByName(new)


def add_packages(ledger: DataFrame, packages: DataFrame) -> DataFrame:
    """New package root rows with flags 0."""
    new = (
        hashed(packages.select(*PKG_KEY), PKG_KEY).distinct()
        .join(hashed(ledger.select(*PKG_KEY), PKG_KEY), [KEY_HASH, *PKG_KEY], "left_anti")
        .select(*PKG_KEY, F.lit(0).alias("all_versions_fetched"), F.lit(0).alias("all_versions_published"))
    )
    return ledger.unionByName(new)


def add_versions(ledger: DataFrame, versions: DataFrame) -> DataFrame:
    """New version rows, not published, not failed, no error."""
    new = (
        hashed(versions.select(*VER_KEY), VER_KEY).distinct()
        .join(hashed(ledger.select(*VER_KEY), VER_KEY), [KEY_HASH, *VER_KEY], "left_anti")
        .select(*VER_KEY, F.lit(0).alias("published"), F.lit(0).alias("publish_failed"), F.lit("").alias("publish_error"))
    )
    return ledger.unionByName(new)


# --- flag updates (J1, J5-J11) --------------------------------------------------------

def set_flag(table: DataFrame, keys: list[str], which: DataFrame, flag: str, value: int = 1) -> DataFrame:
    """Generic update: ``flag = value`` on the rows whose key is in ``which``.

    Left join to the distinct keys + CASE; rows and columns otherwise unchanged.
    """
    hit = hashed(which.select(*keys), keys).distinct().withColumn("_hit", F.lit(True))
    cols = [F.when(F.col("_hit"), F.lit(value)).otherwise(F.col(flag)).cast("int").alias(flag) if c == flag else F.col(c)
            for c in table.columns]
    return hashed(table, keys).join(hit, [KEY_HASH, *keys], "left").select(*cols)


def refresh_repositories(ledger_repositories: DataFrame, repositories: DataFrame) -> DataFrame:
    """A refresh resets fetched and published of the named repositories."""
    out = set_flag(ledger_repositories, REPO_KEY, repositories, "all_versions_fetched", 0)
    return set_flag(out, REPO_KEY, repositories, "all_versions_published", 0)


def mark_packages_fetched(ledger_packages: DataFrame, listed_packages: DataFrame) -> DataFrame:
    """Every package whose versions were listed is fetched."""
    return set_flag(ledger_packages, PKG_KEY, listed_packages, "all_versions_fetched")


def mark_packages_published(ledger_packages: DataFrame, rollup: DataFrame) -> DataFrame:
    """Packages whose versions are all published."""
    return set_flag(ledger_packages, PKG_KEY, rollup.where("all_published"), "all_versions_published")


def mark_repositories_fetched(ledger_repositories: DataFrame, repositories: DataFrame) -> DataFrame:
    """J10."""
    return set_flag(ledger_repositories, REPO_KEY, repositories, "all_versions_fetched")


def mark_repositories_published(ledger_repositories: DataFrame, repo_rollup: DataFrame) -> DataFrame:
    """Repositories whose packages are all published."""
    return set_flag(ledger_repositories, REPO_KEY, repo_rollup.where("all_published"), "all_versions_published")


def upsert_published(ledger_versions: DataFrame, published: DataFrame) -> DataFrame:
    """Set ``published = 1``; versions absent from the ledger are inserted.

    One full outer join on the full key; the other columns keep their value or
    get the defaults of a new row.
    """
    pub = published.select(*VER_KEY).distinct().withColumn("_pub", F.lit(True))
    j = ledger_versions.join(pub, VER_KEY, "full_outer")
    return j.select(
        *VER_KEY,
        F.when(F.col("_pub"), F.lit(1)).otherwise(F.col("published")).cast("int").alias("published"),
        F.coalesce("publish_failed", F.lit(0)).cast("int").alias("publish_failed"),
        F.coalesce("publish_error", F.lit("")).alias("publish_error"),
    )


def mark_failed(ledger_versions: DataFrame, failed_versions: DataFrame) -> DataFrame:
    """J8 (version part): ``publish_failed = 1``."""
    return set_flag(ledger_versions, VER_KEY, failed_versions, "publish_failed")


def mark_repositories_failed(ledger_repositories: DataFrame, failed_versions: DataFrame) -> DataFrame:
    """J8 (repository part) / E5: a repository with a failed version is failed."""
    return set_flag(ledger_repositories, REPO_KEY, failed_versions, "publish_failed")


def mark_errors(ledger_versions: DataFrame, errors: DataFrame) -> DataFrame:
    """Store the error text of each version (E6 output: VER_KEY + error_text)."""
    e = errors.select(*VER_KEY, F.col("error_text").alias("_err"))
    j = ledger_versions.join(e, VER_KEY, "left")
    return j.select(*[F.coalesce("_err", F.col(c)).alias(c) if c == "publish_error" else F.col(c)
                      for c in ledger_versions.columns])


# --- roll-ups (E3-E6) ----------------------------------------------------------------

def package_rollup(ledger_versions: DataFrame) -> DataFrame:
    """A package is done when all its versions are published.

    ``published`` NULL counts as not published (``bool_and`` would skip it).
    Partial + final aggregation: a huge package is combined map-side.
    """
    pub = F.coalesce(F.col("published") == 1, F.lit(False))
    return ledger_versions.groupBy(*PKG_KEY).agg(
        F.bool_and(pub).alias("all_published"),
        F.count(F.lit(1)).alias("n_versions"),
        F.count_if(pub).cast("bigint").alias("n_published"),
        F.bool_or(F.coalesce(F.col("publish_failed") == 1, F.lit(False))).alias("any_failed"),
    )


def repository_rollup(pkg_rollup: DataFrame) -> DataFrame:
    """A repository is done when all its packages are done (over all
    packages, not the last wave only)."""
    return pkg_rollup.groupBy("repository").agg(
        F.bool_and("all_published").alias("all_published"),
        F.count(F.lit(1)).alias("n_packages"),
        F.count_if("all_published").cast("bigint").alias("n_packages_published"),
    )


def repository_failures(ledger_versions: DataFrame) -> DataFrame:
    """E5: repository failed when any version failed."""
    return ledger_versions.groupBy("repository").agg(
        F.coalesce(F.max("publish_failed"), F.lit(0)).cast("int").alias("publish_failed")
    )


def response_message(df: DataFrame) -> F.Column:
    """``<status>, <reason>, <body>`` of one response."""
    return F.concat_ws(", ", F.col("status_code").cast("string"), F.col("reason"), F.col("body"))


def publish_errors(responses: DataFrame) -> DataFrame:
    """Per version, the messages of all failed uploads joined with `` -- ``
    in a fixed order (file name, then upload id), quotes normalised (B16)."""
    failed = responses.where(C.is_failed_response("status_code")).select(
        *VER_KEY, "file_name", "upload_id", response_message(responses).alias("msg")
    )
    agg = failed.groupBy(*VER_KEY).agg(
        F.array_sort(F.collect_list(F.struct("file_name", "upload_id", "msg"))).alias("_m"),
        F.count(F.lit(1)).alias("n_failed"),
    )
    text = F.array_join(F.transform("_m", lambda x: x["msg"]), " -- ")
    return agg.select(*VER_KEY, "n_failed", P.normalise_quotes(text).alias("error_text"))


# --- append-only form (F2) ----------------------------------------------------------

def current(snapshots: DataFrame, keys: list[str], order_col: str = "run_id") -> DataFrame:
    """latest row per key of an append-only ledger.

    ``max_by`` in a hash aggregate (partial + final) rather than a window, so a
    key with many runs is combined map-side.
    """
    value_cols = [c for c in snapshots.columns if c not in keys]
    latest = snapshots.groupBy(*keys).agg(F.max_by(F.struct(*value_cols), order_col).alias("_r"))
    return latest.select(*keys, *[F.col("_r")[c].alias(c) for c in value_cols])


# --- reads (K1-K14) -------------------------------------------------------------------

def known(df: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """K1 / K2 / K4: rows of ``df`` the ledger knows (left semi join on the full key)."""
    return df.join(ledger.select(*keys).distinct(), keys, "left_semi")


def with_flag(ledger: DataFrame, flag: str, value: int = 1) -> DataFrame:
    """Ledger rows with a flag set (or not)."""
    return ledger.where(F.col(flag) == value)


def open_repositories(repositories: DataFrame, ledger_repositories: DataFrame) -> DataFrame:
    """K8: repositories not yet marked all-published (whole repositories pruned
    by a broadcast anti join; the repository ledger has one row per repository)."""
    done = ledger_repositories.where(F.col("all_versions_published") == 1).select("repository").distinct()
    return repositories.join(bounded_broadcast(done), "repository", "left_anti")


def failed_versions(ledger_versions: DataFrame) -> DataFrame:
    """Versions not published with a failure, with their error text."""
    return ledger_versions.where((F.col("published") == 0) & (F.col("publish_failed") == 1))


def failure_report(ledger_versions: DataFrame) -> DataFrame:
    """Failed versions with the advice the operator gets."""
    f = failed_versions(ledger_versions)
    msg = F.concat(
        F.lit("Repository "), F.col("repository"), F.lit(" package "), F.col("package"), F.lit(" version "),
        F.col("version"), F.lit(" failed to publish earlier: "), F.col("publish_error"),
        F.lit(" -- fix the package, then request this version by name and version."),
    )
    return f.select(*VER_KEY, "publish_error", msg.alias("advice"))
