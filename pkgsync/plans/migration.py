"""Migration plan: which versions to publish, wipe, reject or skip, and which files to copy.

``plan`` is lazy; nothing runs until a sink (``write_plan``) or an action.
Scope: ``None`` = every supported LOCAL repository, or a list or table of repository names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import filters as C
from ..functions import paths as P
from ..operators import inventory as INV
from ..operators import reconcile as R
from ..operators.joins import KEY_HASH, bounded_broadcast, hashed
from ..session import stored

DRYRUN_HOST = "dryrun-endpoint.invalid"


@dataclass
class Inputs:
    """Tables a plan reads.  ``inventory`` is the stored listing with coordinates."""

    inventory: DataFrame
    repositories: DataFrame
    target_versions: DataFrame
    ledger_versions: DataFrame | None = None
    ledger_packages: DataFrame | None = None
    ledger_repositories: DataFrame | None = None
    endpoints: DataFrame | None = None  # repository, endpoint


def scope_repositories(repositories: DataFrame, scope: list[str] | DataFrame | None = None) -> DataFrame:
    """Supported LOCAL repositories in scope (C1, C2; D1 for a list or a table of names, column ``repository``)."""
    # Plain predicates on non-key columns only: Catalyst then sees a selective
    # filter and prunes the repository partitions of the inventory dynamically
    # (a predicate on the key itself, such as ``repository <> 'TOTAL'``, is
    # copied onto the scan and stops that).  The synthetic TOTAL row drops out
    # anyway: its type is not LOCAL and it has no package type.
    cat = INV.catalogue(repositories)
    rep = cat.where((F.col("repo_type") == "LOCAL") & C.is_supported_type("package_type"))
    rep = rep.select("repository", "package_type")
    if isinstance(scope, DataFrame):
        rep = rep.join(scope.select("repository"), "repository", "left_semi")
    elif scope is not None:
        rep = rep.where(F.col("repository").isin(list(scope)))
    return rep


def in_scope(inv: DataFrame, repositories: DataFrame, scope: list[str] | DataFrame | None = None,
             scope_df: DataFrame | None = None) -> DataFrame:
    """Inventory rows of in-scope repositories (small broadcast semi join; with a
    partitioned inventory and a literal list the filter also prunes directories).
    ``scope_df``: an already size-checked scope table to reuse."""
    if isinstance(scope, list):
        inv = inv.where(F.col("repository").isin(scope))
    reps = scope_df if scope_df is not None else bounded_broadcast(scope_repositories(repositories, scope))
    return inv.join(reps.select("repository"), "repository", "left_semi")


def versions_with_stats(inv: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """E2 plus per-version file counts and bytes in **one** aggregation, so the
    files are reduced to versions map-side before anything is shuffled.

    With ``types`` (repository -> package_type, one row per repository,
    already size-checked for broadcast by the caller) the
    aggregation key is exactly (repository, package, version) -- the ledger's
    key, behind its hash (``KEY_HASH``, kept) -- so the ledger join that follows
    reuses this partitioning instead of re-shuffling every version; the type
    comes back through a broadcast join, which keeps the partitioning.  Without it the type is a grouping key.
    """
    copy = F.col("copy")
    stats = [
        F.count_if(copy).cast("bigint").alias("n_files"),
        F.coalesce(F.sum(F.when(copy, F.col("size_bytes"))), F.lit(0)).cast("bigint").alias("copy_bytes"),
        INV.slots_of().alias("slots"),
    ]
    v = INV.with_slot(inv).where(F.col("version").isNotNull())
    if types is None:
        return v.groupBy("repository", "package_type", "package", "version").agg(*stats)
    agg = hashed(v, VERSION_KEY).groupBy(KEY_HASH, *VERSION_KEY).agg(*stats)
    return agg.join(types.select("repository", "package_type"), "repository", "inner").select(
        KEY_HASH, "repository", "package_type", "package", "version", "n_files", "copy_bytes", "slots")


def with_endpoint(df: DataFrame, endpoints: DataFrame | None, host: str = DRYRUN_HOST) -> DataFrame:
    """Endpoint per repository (dry-run form when no endpoint table is given)."""
    if endpoints is None:
        return df.withColumn("endpoint", P.dryrun_endpoint("repository", host))
    return df.join(bounded_broadcast(endpoints.select("repository", "endpoint")), "repository", "left")


def plan(inputs: Inputs, scope: list[str] | DataFrame | None = None, use_ledger: bool = True) -> DataFrame:
    """One row per version in scope with its state and decision.

    Order of the joins: versions (aggregated on the ledger key) -> ledger
    (co-partitioned, no exchange on the version side) -> target state (one
    shuffle on the five-column target key) -> decision.
    """
    scope_df = bounded_broadcast(scope_repositories(inputs.repositories, scope))
    inv = in_scope(inputs.inventory, inputs.repositories, scope, scope_df)
    vers = versions_with_stats(inv, scope_df)
    ledger = inputs.ledger_versions if use_ledger else None
    marked = R.mark_ledger_published(vers, ledger)
    return R.decide(R.version_state(marked, inputs.target_versions))


def plan_files(plan_df: DataFrame, inv: DataFrame) -> DataFrame:
    """Files to copy for each version the plan publishes.

    Inner equi-join on (repository, package, version, slot).  A version of very many files would be a hot key, so each
    file carries a slot (a stored column of the inventory, by a hash of its path) and the plan's own aggregate has noted
    which slots a version's files fall into (``slots``, the bits of a long).  The plan row is repeated once for each of
    them: never more often than the version has files, and a hot version's files spread over up to ``INV.SLOTS`` keys.
    No size decides anything, and nothing is counted for it.
    """
    keys = ["repository", "package", "version", "slot"]
    slots = F.filter(F.sequence(F.lit(0), F.lit(INV.SLOTS - 1)), lambda i: F.getbit("slots", i) == 1)
    todo = R.to_copy(plan_df).select(
        "repository", "package", "version", "decision", "namespace", "target_package", F.explode(slots.cast("array<tinyint>")).alias("slot"))
    return INV.version_files(INV.with_slot(inv), "slot").join(todo, keys, "inner").drop("slot")


def plan_summary(plan_df: DataFrame) -> DataFrame:
    """Versions, files and bytes by repository, type and decision."""
    return plan_df.groupBy("repository", "package_type", "decision").agg(
        F.count(F.lit(1)).alias("n_versions"),
        F.sum("n_files").cast("bigint").alias("n_files"),
        F.sum("copy_bytes").cast("bigint").alias("total_bytes"),
    )


def write_plan(plan_df: DataFrame, path: str) -> None:
    """Dry-run sink -- the plan is recorded, nothing else is touched.

    Rebalanced on the repository before the write (``writes.by_repository``):
    a task writes one repository folder, a repository holding most versions is
    split over many tasks by AQE, and the plan is computed once (no sampling
    pass as a range partitioning would need)."""
    from ..operators.writes import by_repository

    (by_repository(plan_df, ["repository", "package", "version"])
     .write.mode("overwrite").partitionBy("repository").parquet(path))


# --- actions (L1) -----------------------------------------------------------------------

def actions(plan_df: DataFrame) -> DataFrame:
    """L1: the plan as ordered action rows (``seq`` 0-based per version).

    skip_ledger -> skip; skip_published -> set_published (ledger catches up);
    reject -> reject; wipe_publish -> wipe, publish; publish -> publish.
    Maven publishes add copy_metadata and set_status (the metadata file and
    the status change that make a maven version Published).
    """
    d, t = F.col("decision"), F.col("package_type")
    maven_tail = F.when(t == "maven", F.array(F.lit("copy_metadata"), F.lit("set_status"))).otherwise(F.array().cast("array<string>"))
    steps = (
        F.when(d == "skip_ledger", F.array(F.lit("skip")))
        .when(d == "skip_published", F.array(F.lit("set_published")))
        .when(d == "reject", F.array(F.lit("reject")))
        .when(d == "wipe_publish", F.concat(F.array(F.lit("wipe"), F.lit("publish")), maven_tail))
        .otherwise(F.concat(F.array(F.lit("publish")), maven_tail))
    )
    return plan_df.select(
        "repository", "package_type", "package", "version", "decision",
        F.posexplode(steps).alias("seq", "action"),
    ).withColumn("seq", F.col("seq").cast("int"))


# --- requests (L2) -------------------------------------------------------------------------

def require_valid_requests(inputs: Inputs, requests: DataFrame) -> None:
    """Strict mode of L2 (2.14 #26): raise on an unknown repository, a
    malformed or blank-version entry, or a package found neither in the ledger
    nor in the source -- the cases where the source tool aborted.  Without it
    such entries are rows with a ``kind`` / ``found`` flag.  The message tells how many there are and names a few."""
    from ..operators import requests as RQ

    R.require_known(R.check_requested_repositories(requests, inputs.repositories))
    parsed = RQ.parse_requests(requests)
    R.refuse_rows(parsed.where(F.col("kind").isin("malformed", "blank_version")).select(F.concat_ws(":", "request_id", "token")), "malformed requests")
    asked = parsed.where(F.col("kind") != "empty")
    m = RQ.match_requests(asked, inputs.ledger_packages, INV.packages(inputs.inventory))
    R.refuse_rows(m.where(~F.col("found")).select(F.concat_ws("/", "repository", "package")), "packages not found")


# --- versions by key: listing, ledger and requests in one aggregate -------------------------

VERSION_KEY = ["repository", "package", "version"]


PACKAGE_FLAGS = ["package_in_ledger", "fetched", "done", "whole"]


def version_facts(inv: DataFrame, ledger_versions: DataFrame | None = None, *more: DataFrame, together: list[str] | None = None) -> DataFrame:
    """What is known of each (repository, package, version), by one aggregate over the rows of all sides.

    Files (``in_source``, ``n_files``, ``copy_bytes``, ``slots``) and ledger rows (``in_ledger``, ``ledger_published``) are
    put under one another and grouped once: one shuffle, files combined before it, no join between the sides.  Files
    without a version have a row with version NULL, which tells that the source knows the package.  ``more``: rows with
    the key and any of the flags ``named`` and ``PACKAGE_FLAGS``, those of whole packages with version NULL.
    ``together``: columns of the key whose rows are brought together by that shuffle, so that a step by these columns
    needs no other; then files are combined after it.  A row carries its flags as the bits of one number.
    """
    flags = ["copy", "in_source", "in_ledger", "ledger_published", *(["named", *PACKAGE_FLAGS] if more else [])]

    def side(df, size=F.lit(None), slot=F.lit(None), **known):
        bits = [F.when(known[f], F.lit(1 << k)).otherwise(F.lit(0)) for k, f in enumerate(flags) if f in known]
        return df.select(*VERSION_KEY, size.cast("bigint").alias("size_bytes"), slot.cast("tinyint").alias("slot"),
                         reduce(lambda a, b: a.bitwiseOR(b), bits).alias("marks"))

    yes, copy = F.lit(True), F.col("copy")
    rows = side(INV.with_slot(inv).where(F.col("package").isNotNull()), F.when(copy, F.col("size_bytes")), F.when(copy, F.col("slot")), copy=copy, in_source=yes)
    if ledger_versions is not None:
        rows = rows.unionByName(side(ledger_versions, in_ledger=yes, ledger_published=F.col("published") == 1))
    for df in more:
        rows = rows.unionByName(side(df, **{f: F.col(f) for f in flags if f in df.columns}))
    if together:
        rows = rows.repartition(*together)
    copy = F.getbit("marks", F.lit(0)) == 1
    facts = rows.groupBy(*VERSION_KEY).agg(
        F.count_if(copy).cast("bigint").alias("n_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("copy_bytes"),
        INV.slots_of(copy).alias("slots"),
        F.bit_or("marks").alias("marks"),
    )
    return facts.select(*VERSION_KEY, "n_files", "copy_bytes", "slots",
                        *[(F.getbit("marks", F.lit(k)) == 1).alias(f) for k, f in enumerate(flags) if f != "copy"])


def wanted_versions(inputs: Inputs, requests: DataFrame) -> DataFrame:
    """The versions that ``requested_plan`` plans, with their facts.

    The rows of files, ledger, the ledger's packages and the entries travel once, to the task of their package: there
    they are grouped to versions (``version_facts``), and windows over the package tell what holds for it.
    """
    from ..operators import requests as RQ

    scope = bounded_broadcast(scope_repositories(inputs.repositories))
    no, kind = F.lit(False), F.col("kind")
    entries = RQ.parse_requests(requests).where(kind.isin("one_version", "all_versions"))
    more = [entries.select(*VERSION_KEY, (kind == "one_version").alias("named"), (kind == "all_versions").alias("whole"))]
    if inputs.ledger_packages is not None:
        more.append(inputs.ledger_packages.select(
            "repository", "package", F.lit(None).cast("string").alias("version"), F.lit(True).alias("package_in_ledger"),
            F.coalesce(F.col("all_versions_fetched") == 1, no).alias("fetched"), F.coalesce(F.col("all_versions_published") == 1, no).alias("done")))
    package = ["repository", "package"]
    facts = version_facts(in_scope(inputs.inventory, inputs.repositories, scope_df=scope), inputs.ledger_versions, *more, together=package)
    same = Window.partitionBy(KEY_HASH, *package)
    facts = hashed(facts.where(F.col("package").isNotNull()), package).select(
        "*", *[F.bool_or(f).over(same).alias(f"_{f}") for f in ("in_source", *PACKAGE_FLAGS)])
    by_package = F.col("_whole") & ~F.col("_done") & F.when(F.col("_fetched"), F.col("in_ledger")).otherwise(F.col("in_source"))
    wanted = (facts.where("version is not null and (_in_source or _package_in_ledger)")
              .withColumn("by_package", by_package).withColumnRenamed("named", "by_name").where("by_name or by_package"))
    return wanted.join(scope, "repository", "inner").select(
        *VERSION_KEY, "package_type", "n_files", "copy_bytes", "slots", "ledger_published", "by_name", "by_package")


def requested_plan(inputs: Inputs, requests: DataFrame, strict: bool = False) -> DataFrame:
    """L2: plan for user requests (B17 -> D7 -> versions -> L1), each version once however many requests ask for it.

    ``by_name`` / ``by_package`` tell whether some entry names the version or asks for all versions of its package;
    ``request_links`` leads from requests to versions.  An entry counts when the ledger or the source knows its package
    (D7).  All versions of a package are those of the ledger where it has fetched them all (K6) and none where it has
    published them all (K12), else those of the listing.

    The versions (``wanted_versions``) are stored on the shared scratch root before they meet the target, so that the
    shuffle files behind them are gone by then.  Nothing is hinted or counted beforehand.
    """
    if strict:
        require_valid_requests(inputs, requests)
    rows = stored(wanted_versions(inputs, requests), "requested-versions")
    return R.decide(R.version_state(rows, inputs.target_versions))


def request_links(plan_df: DataFrame, requests: DataFrame) -> DataFrame:
    """From each request entry to the versions that ``requested_plan`` plans for it: ``request_id``, ``pos`` and the key."""
    from ..operators import requests as RQ

    parsed = RQ.parse_requests(requests)
    named = parsed.where(F.col("kind") == "one_version").join(plan_df.where("by_name").select(*VERSION_KEY), VERSION_KEY, "inner")
    whole = (parsed.where(F.col("kind") == "all_versions").drop("version")
             .join(plan_df.where("by_package").select(*VERSION_KEY), ["repository", "package"], "inner"))
    columns = ["request_id", "pos", *VERSION_KEY]
    return named.select(*columns).unionByName(whole.select(*columns))


# --- resume (L7) ---------------------------------------------------------------------------

def _package_flags() -> list[F.Column]:
    return [F.bool_or(F.col("all_versions_fetched") == 1).alias("fetched"), F.bool_or(F.col("all_versions_published") == 1).alias("done")]


def package_flags(ledger_packages: DataFrame) -> DataFrame:
    """One row per ledger package: ``fetched`` (K6) and ``done``."""
    return ledger_packages.groupBy("repository", "package").agg(*_package_flags())


def sourced_versions(inputs: Inputs, inv: DataFrame, scope: DataFrame) -> DataFrame:
    """H2: each version with its ``source``: the ledger for packages it marks fetched (K6), the listing for others.

    In a repository that the ledger marks fetched (K7) only the ledger's packages count.  One aggregate over files and
    ledger rows (``version_facts``), then the package and repository flags.  ``done``: the package is all-published (K12).
    ``scope``: in-scope repositories with their package type (one row per repository, size-checked).
    """
    facts = version_facts(inv, inputs.ledger_versions).where(F.col("version").isNotNull())
    rows = facts.join(scope.select("repository", "package_type"), "repository", "inner")
    if inputs.ledger_packages is None or inputs.ledger_versions is None:
        return rows.where("in_source").withColumn("source", F.lit("listing")).withColumn("done", F.lit(False))
    keys = ["repository", "package"]
    flags = hashed(inputs.ledger_packages, keys).groupBy(KEY_HASH, *keys).agg(*_package_flags(), F.lit(True).alias("_known"))
    rows = hashed(rows, keys).join(flags, [KEY_HASH, *keys], "left").drop(KEY_HASH)
    if inputs.ledger_repositories is not None:
        listed = inputs.ledger_repositories.where(F.col("all_versions_fetched") == 1).select("repository").distinct().withColumn("_listed", F.lit(True))
        rows = rows.join(bounded_broadcast(listed), "repository", "left").where(F.col("_known") | F.col("_listed").isNull())
    fetched = F.coalesce(F.col("fetched"), F.lit(False))
    return (rows.where(F.when(fetched, F.col("in_ledger")).otherwise(F.col("in_source")))
            .withColumn("source", F.when(fetched, F.lit("ledger")).otherwise(F.lit("listing")))
            .withColumn("done", F.coalesce("done", F.lit(False))))


def version_source(inputs: Inputs, inv: DataFrame, scope: DataFrame) -> DataFrame:
    """H2 as a table: ``repository, package_type, package, version, source``."""
    return sourced_versions(inputs, inv, scope).select("repository", "package_type", "package", "version", "source")


def resume_plan(inputs: Inputs, scope: list[str] | DataFrame | None = None) -> DataFrame:
    """Only the work still open after earlier runs, in one pass over the inventory.

    K8 drops repositories the ledger marks all-published before the scan (their folders are pruned); then one aggregate
    gives listing and ledger versions with their files (H2, K6, K7), packages marked all-published (K12) and versions
    published in the ledger (D5) drop out, and what is left is planned against the target; only open decisions are kept.
    """
    from ..operators import ledger as LG

    reps = scope_repositories(inputs.repositories, scope)
    if inputs.ledger_repositories is not None:
        reps = LG.open_repositories(reps, inputs.ledger_repositories)
    reps = bounded_broadcast(reps)
    inv = in_scope(inputs.inventory, inputs.repositories, scope if isinstance(scope, list) else None, reps)
    src = sourced_versions(inputs, inv, reps).where(~F.col("done") & ~F.col("ledger_published")).select(
        "repository", "package_type", "package", "version", "source", "n_files", "copy_bytes", "slots")
    planned = R.decide(R.version_state(R.mark_ledger_published(src, None), inputs.target_versions))
    return planned.where(F.col("decision") != "skip_published")


# --- post-check (L6) ------------------------------------------------------------------------

def post_check(plan_df: DataFrame, fresh_target: DataFrame) -> DataFrame:
    """After the copy, a published version must show Published in a fresh
    target snapshot; otherwise it is a failure with the missing-version text.
    The result feeds the ledger (J7 for published, J8/J9 for failures)."""
    from ..operators import ledger as LG

    tried = R.to_copy(plan_df).select("repository", "package_type", "package", "version")
    st = R.version_state(tried, fresh_target)
    ok = F.col("state_code") == R.STATE_PUBLISHED
    text = F.replace(
        F.replace(F.lit(LG.MISSING_ERROR), F.lit("{package}"), F.col("package")), F.lit("{version}"), F.col("version")
    )
    return st.select(
        "repository", "package_type", "package", "version",
        ok.alias("published"),
        F.when(ok, F.lit(0)).otherwise(F.lit(1)).alias("publish_failed"),
        F.when(ok, F.lit("")).otherwise(text).alias("publish_error"),
    )


def with_waves(plan_df: DataFrame, waves: DataFrame) -> DataFrame:
    """F1 on the plan: wave number of each version's package."""
    return plan_df.join(waves.select("repository", "package", "wave"), ["repository", "package"], "left")


def plan_mode(inputs: Inputs, mode: str = "all", repositories: list[str] | None = None,
              requests: DataFrame | None = None, resume: bool = False, strict: bool = False) -> DataFrame:
    """L5 mode selection, as the source tool's entry point offers it.

    * ``all``          -- every supported LOCAL repository;
    * ``repositories`` -- the named repositories (unknown names: ``strict``
      raises, otherwise they simply plan nothing);
    * ``packages``     -- the ``requests`` table (``repository, packages``).
    ``resume`` keeps only open work (L7) for the first two modes.
    """
    if mode == "packages":
        if requests is None:
            raise ValueError("mode 'packages' needs a requests table")
        return requested_plan(inputs, requests, strict=strict)
    if mode == "repositories":
        if not repositories:
            raise ValueError("mode 'repositories' needs repository names")
        if strict:
            spark = inputs.repositories.sparkSession
            named = spark.createDataFrame([(r,) for r in repositories], "repository string")
            R.require_known(R.check_requested_repositories(named, inputs.repositories))
        if resume:
            return resume_plan(inputs, scope=list(repositories))
        return plan(inputs, scope=list(repositories))
    if mode == "all":
        return resume_plan(inputs) if resume else plan(inputs)
    raise ValueError(f"mode must be 'all', 'repositories' or 'packages', not {mode!r}")
