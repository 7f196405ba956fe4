"""Reconcile source with target: repository checks, version state, decisions, waves.

Every step is a bulk join or aggregate; the source tool's one-call-per-version
checks become one equi-join each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import filters as C
from .inventory import VERSION_KEY, catalogue, with_target_coordinates
from .joins import KEY_HASH, bounded_broadcast, hashed
from .once import evaluated_once
from .ranking import index_within

# Version state codes (fixed values of the source tool).
STATE_PUBLISHED = 0
STATE_MISSING = 1
STATE_UNFINISHED = 2
PUBLISHED_STATUS = "Published"

TARGET_KEY = ("repository", "package_type", "target_namespace", "target_package", "version")


# --- repositories -----------------------------------------------------------------

def local_repositories(repositories: DataFrame) -> DataFrame:
    """LOCAL repositories of the catalogue (the TOTAL row is not one)."""
    return catalogue(repositories).where(C.is_local_repository("repo_type", "repository"))


def supported_repositories(repositories: DataFrame) -> DataFrame:
    """C1 + C2 with the rejects kept: ``supported`` flag and a ``reason``."""
    cat = catalogue(repositories)
    reason = (
        F.when(F.col("repository") == "TOTAL", F.lit("total_row"))
        .when(F.col("repo_type") != "LOCAL", F.lit("not_local"))
        .when(~C.is_supported_type("package_type") | F.col("package_type").isNull(), F.lit("unsupported_type"))
    )
    return cat.withColumn("reason", reason).withColumn("supported", F.col("reason").isNull())


def check_requested_repositories(requested: DataFrame, repositories: DataFrame) -> DataFrame:
    """Every requested repository with ``known`` (present in the catalogue)."""
    cat = bounded_broadcast(catalogue(repositories).select("repository").distinct().withColumn("known", F.lit(True)))
    out = requested.select("repository").distinct().join(cat, "repository", "left")
    return out.withColumn("known", F.coalesce("known", F.lit(False)))


def refuse_rows(rows: DataFrame, what: str, shown: int = 20) -> None:
    """Raise when there are any rows: the message tells how many and shows the first values of the only column."""
    n = rows.count()
    if n:
        some = ", ".join(sorted(str(r[0]) for r in rows.take(shown)))
        raise ValueError(f"{what}: {some}" + (f" and {n - shown} more" if n > shown else ""))


def require_known(checked: DataFrame) -> None:
    """Strict mode of D1: raise when a requested repository is unknown (the source tool aborted the run)."""
    refuse_rows(checked.where(~F.col("known")).select("repository"), "unknown repositories")


def all_repositories_known(checked: DataFrame) -> DataFrame:
    """One row, ``all_known`` = every requested repository is in the catalogue."""
    return checked.agg(F.coalesce(F.bool_and("known"), F.lit(True)).alias("all_known"))


def repositories_to_create(source_repositories: DataFrame, target_repositories: DataFrame) -> DataFrame:
    """D3: source repositories absent from the target -> ``create_repository`` actions."""
    tgt = target_repositories.select(F.col("name").alias("repository")).distinct()
    return (
        source_repositories.select("repository").distinct()
        .join(tgt, "repository", "left_anti")
        .withColumn("action", F.lit("create_repository"))
    )


# --- version state ----------------------------------------------------------------

def target_state_table(target_versions: DataFrame) -> DataFrame:
    """Target states keyed like the source versions; one row per key.

    The pre-aggregation is on the join key itself, so the join reuses its
    partitioning (no extra exchange) and duplicate target rows cannot fan out.
    """
    states = target_versions.select(
        "repository",
        F.col("format").alias("package_type"),
        F.coalesce("namespace", F.lit("")).alias("target_namespace"),
        F.col("package").alias("target_package"),
        "version",
        (F.col("status") == PUBLISHED_STATUS).alias("_published"),
    )
    return hashed(states, TARGET_KEY).groupBy(KEY_HASH, *TARGET_KEY).agg(F.bool_or("_published").alias("target_published"))


def version_state(versions: DataFrame, target_versions: DataFrame) -> DataFrame:
    """State of each source version in the target.

    ``state_code`` 1 = missing, 2 = present but not published, 0 = published;
    ``state`` is the name.  Left join on the five-column key (sort-merge at scale;
    the key includes the version, so no single key is hot).
    """
    v = hashed(evaluated_once(with_target_coordinates(versions), **{c: F.col(c) for c in ("namespace", "target_namespace", "target_package")}), TARGET_KEY)
    tgt = target_state_table(target_versions)
    j = v.join(tgt, [KEY_HASH, *TARGET_KEY], "left").drop(KEY_HASH)
    code = (
        F.when(F.col("target_published").isNull(), F.lit(STATE_MISSING))
        .when(F.col("target_published"), F.lit(STATE_PUBLISHED))
        .otherwise(F.lit(STATE_UNFINISHED))
    )
    name = F.when(code == STATE_MISSING, "missing").when(code == STATE_PUBLISHED, "published").otherwise("unfinished")
    return j.withColumn("state_code", code).withColumn("state", name).drop("target_published")


def published_in_ledger(ledger_versions: DataFrame) -> DataFrame:
    """Version keys the ledger marks published."""
    return ledger_versions.where(F.col("published") == 1).select(*VERSION_KEY).distinct()


def pending_versions(versions: DataFrame, ledger_versions: DataFrame) -> DataFrame:
    """Versions not yet published according to the ledger (left anti join)."""
    return versions.join(published_in_ledger(ledger_versions), list(VERSION_KEY), "left_anti")


# --- decisions ----------------------------------------------------------------------

DECISIONS = ("skip_ledger", "skip_published", "reject", "wipe_publish", "publish")


def mark_ledger_published(versions: DataFrame, ledger_versions: DataFrame | None) -> DataFrame:
    """D5 as a flag: ``ledger_published`` = the ledger marks the version published.

    Left join on (repository, package, version); the ledger side is reduced to
    distinct published keys first, on the same key, so both sides of the join
    are partitioned alike.
    """
    if ledger_versions is None:
        return versions.withColumn("ledger_published", F.lit(False))
    key = [KEY_HASH, *VERSION_KEY]
    led = hashed(ledger_versions.where(F.col("published") == 1), VERSION_KEY).select(*key).distinct().withColumn("_led", F.lit(True))
    out = (versions if KEY_HASH in versions.columns else hashed(versions, VERSION_KEY)).join(led, key, "left")
    return out.withColumn("ledger_published", F.coalesce("_led", F.lit(False))).drop("_led", KEY_HASH)


def decide(state: DataFrame, ledger_versions: DataFrame | None = None) -> DataFrame:
    """L1: one decision per version.

    * ``skip_ledger``    -- the ledger says published (no target look-up needed);
    * ``skip_published`` -- the target has it published;
    * ``reject``         -- forbidden character in package or version; decided
      *before* any wipe, so an unfinished version with a refused name is kept;
    * ``wipe_publish``   -- present but unfinished: delete, then publish;
    * ``publish``        -- missing.

    ``state`` carries ``ledger_published`` already (``mark_ledger_published``)
    unless ``ledger_versions`` is given here.
    """
    out = state
    if ledger_versions is not None or "ledger_published" not in state.columns:
        out = mark_ledger_published(out.drop("ledger_published") if "ledger_published" in out.columns else out,
                                    ledger_versions)
    out = out.withColumn("forbidden", C.is_forbidden_name("package", "version"))
    decision = (
        F.when(F.col("ledger_published"), F.lit("skip_ledger"))
        .when(F.col("state_code") == STATE_PUBLISHED, F.lit("skip_published"))
        .when(F.col("forbidden"), F.lit("reject"))
        .when(F.col("state_code") == STATE_UNFINISHED, F.lit("wipe_publish"))
        .otherwise(F.lit("publish"))
    )
    return out.withColumn("decision", decision)


def to_copy(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("decision").isin("publish", "wipe_publish"))


# --- waves ------------------------------------------------------------------------

def migration_waves(packages: DataFrame, procs: int = 4) -> DataFrame:
    """sorted packages of each repository cut into waves of ``procs``.

    ``wave`` = floor(position / procs), 0-based; the last wave may be short and
    ``procs=1`` gives waves of one.  Position is computed skew-safe
    (``ranking.index_within``), never with a window over a whole repository.
    """
    if procs < 1:
        raise ValueError("procs must be >= 1")
    ranked = index_within(packages.select("repository", "package").distinct(), ["repository"], ["package"], "position")
    return ranked.withColumn("wave", F.floor(F.col("position") / F.lit(procs)).cast("bigint"))
