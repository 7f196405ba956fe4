"""Registered queries: ``name -> callable(spark, sf_dir) -> DataFrame``.

Each callable builds its inputs from the fixtures over the driver's tables (the
stand-ins for catalogue, listing, target and ledger dumps) and runs the
library's operator on them over the whole tables.  Column names equal the
oracle's (``oracle_sql.py``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import filters as C
from .functions import paths as P
from .operators import documents as DOC
from .operators import inventory as INV
from .operators import ledger as LG
from .operators import ranged as RG
from .operators import reconcile as R
from .operators import requests as RQ
from .operators import transfer as TR
from .operators.joins import bounded_broadcast
from .operators.ledger_store import LedgerStore
from .plans import migration as M
from .session import apply_conf, scratch_path
from .sources import dumps as DU
from .sources import pages as PG
from .sources.fixtures import Fixtures

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the registered queries (fixed, documented; never tuned per check).
PROCS = 4
# A line of the tables becomes ten times its size in paths and names; the partial aggregates of a split must fit its task.
SPLIT_BYTES = "16m"
SOURCE_PROTOCOL, SOURCE_HOST, SOURCE_PREFIX = "https", "source.invalid", "mirror"


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


class Ctx:
    """Per-call inputs: fixtures plus the derived inventory."""

    def __init__(self, spark: SparkSession, sf_dir: str, match: str = "contains"):
        apply_conf(spark)
        spark.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
        self.spark = spark
        self.fx = Fixtures(spark, sf_dir)
        self.match = match
        self._inv: DataFrame | None = None

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self.fx[name]
        raise AttributeError(name)

    def listing(self) -> DataFrame:
        """The recursive listing as the source returns it: no package type."""
        return self.fx.fx_files.select("repository", "uri", "size_bytes")

    def inventory(self) -> DataFrame:
        if self._inv is None:
            self._inv = INV.inventory(self.listing(), self.fx.fx_repositories, self.match)
        return self._inv

    def scoped(self) -> DataFrame:
        return M.in_scope(self.inventory(), self.fx.fx_repositories)

    def inputs(self, with_ledger: bool = True, whole: bool = False) -> M.Inputs:
        """``whole``: target and ledger with every repository."""
        fx, end = self.fx, "_all" if whole else ""
        return M.Inputs(
            inventory=self.inventory(),
            repositories=fx.fx_repositories,
            target_versions=fx[f"fx_target{end}"],
            ledger_versions=fx[f"fx_ledger_versions{end}"] if with_ledger else None,
            ledger_packages=fx[f"fx_ledger_packages{end}"] if with_ledger else None,
            ledger_repositories=fx[f"fx_ledger_repositories{end}"] if with_ledger else None,
        )

    def plan(self) -> DataFrame:
        return M.plan(self.inputs())


def _ctx(spark, sf_dir, match="contains") -> Ctx:
    return Ctx(spark, sf_dir, match)


PLAN_COLS = ["repository", "package_type", "package", "version", "namespace", "target_namespace", "target_package",
             "n_files", "copy_bytes", "state_code", "state", "forbidden", "ledger_published", "decision"]


# === 2.1 scans, sources, sinks =============================================================

@query("src_repositories")
def q_src_repositories(spark, sf_dir):
    """A1: catalogue documents (one per row, as text) parsed and exploded."""
    c = _ctx(spark, sf_dir)
    docs = c.fx_repositories.select(
        F.to_json(F.struct(F.array(F.struct(
            F.col("repo_key").alias("repoKey"), F.col("repo_type").alias("repoType"),
            F.col("package_type").alias("packageType"))).alias("repositoriesSummaryList"))).alias("doc")
    )
    return DU.parse_catalogue(docs)


@query("src_files")
def q_src_files(spark, sf_dir):
    """A2: the listing stored as JSON Lines per repository and read back with a schema."""
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "listing")
    DU.write_listing_lines(c.listing(), path)
    return DU.read_listing_lines(spark, path)


@query("package_files")
def q_package_files(spark, sf_dir):
    """All files of each package (no extension filter)."""
    return INV.package_files(_ctx(spark, sf_dir).scoped())


@query("requests_found")
def q_requests_found(spark, sf_dir):
    """Requested packages known in the ledger or the source."""
    c = _ctx(spark, sf_dir)
    parsed = RQ.parse_requests(c.fx_requests)
    m = RQ.match_requests(parsed, c.fx_ledger_packages, INV.packages(c.scoped()))
    return m.select("request_id", "pos", "repository", "package", "kind", "found_in", "found")


@query("tgt_repositories")
def q_tgt_repositories(spark, sf_dir):
    """A5: target repository list documents parsed (every page)."""
    c = _ctx(spark, sf_dir)
    docs = c.fx_target_all.select("repository").distinct().select(
        F.to_json(F.struct(F.array(F.struct(F.col("repository").alias("name"),
                                            F.lit("dom").alias("domainName"))).alias("repositories"))).alias("doc"))
    return DU.parse_target_repositories(docs)


@query("tgt_versions")
def q_tgt_versions(spark, sf_dir):
    """Target version states written as JSON Lines and read back as one bulk table."""
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "target")
    DU.write_target_versions(c.fx_target_all, path)
    return DU.read_target_versions(spark, path)


def _target_pages(c: Ctx):
    """Pages of 20 versions of a package as a crawl leaves them: some are fetched twice, some also cut off or blank."""
    name = ["repository", "format", "namespace", "package"]
    at = F.row_number().over(Window.partitionBy(*name).orderBy("version")) - 1
    v = F.array_sort(F.collect_list(F.struct("version", "status"))).alias("versions")
    n = (F.col("at") / 20).cast("int")
    whole = c.fx_target.withColumn("at", at).groupBy(*name, n.alias("n")).agg(v)
    doc = F.to_json(F.struct("format", "namespace", "package", "versions"))
    page = F.concat_ws("/", *name, F.col("n").cast("string"))
    size = F.length(page)
    kind = F.explode(F.array(F.lit("a"), F.when(size % 3 == 0, "repeated").when(size % 3 == 1, "cut").otherwise("blank")))
    pages = whole.select(page.alias("p"), "repository", doc.alias("whole"), kind.alias("kind"))
    return pages.select(F.concat_ws("/", "p", "kind").alias("page"), "repository",
                        F.when(F.col("kind") == "cut", F.expr("left(whole, length(whole) - 2)")).when(F.col("kind") == "blank", " ").otherwise(F.col("whole")).alias("doc"))


def _stored_target_pages(spark, sf_dir):
    path = scratch_path(spark, "target-pages")
    _target_pages(_ctx(spark, sf_dir)).write.parquet(path)
    return PG.target_versions(spark.read.parquet(path))


@query("target_pages")
def q_target_pages(spark, sf_dir):
    """Version states read from a crawl's pages; damaged and repeated pages change nothing."""
    return _stored_target_pages(spark, sf_dir).rows


@query("target_page_rejects")
def q_target_page_rejects(spark, sf_dir):
    """The side table of pages that are cut off, blank or repeated."""
    return _stored_target_pages(spark, sf_dir).rejects.select("page", "repository", "reason", "length", "_corrupt_record")


@query("npm_documents")
def q_npm_documents(spark, sf_dir):
    """Npm metadata parsed; name, number of versions, wanted version present."""
    c = _ctx(spark, sf_dir)
    p = DOC.parse_npm(c.fx_npm_metadata)
    return p.select(
        "doc_id", "repository", "package", "version",
        F.col("_doc.name").alias("doc_name"),
        F.size("_doc.versions").cast("int").alias("n_versions"),
        F.element_at("_doc.versions", F.col("version")).isNotNull().alias("has_version"),
    )


def _document_paths(spark, c: Ctx):
    """Artifact files for A8/A9, one per document (text + newline) on the shared scratch root, as the path table that the
    writing tasks returned: ``doc_id``, ``path``, ``length``."""
    root, table = scratch_path(spark, "artifacts"), scratch_path(spark, "artifact-paths")
    text = F.concat(F.coalesce("text", F.lit("")), F.lit("\n"))
    rows = c.fx.table("documents").select(F.concat(F.lit("doc-"), F.col("doc_id"), F.lit(".txt")).alias("name"), text.cast("binary").alias("content"))
    RG.write_artifacts(rows, root).write.parquet(table)
    return spark.read.parquet(table).select(F.regexp_extract("name", r"^doc-(.*)\.txt$", 1).cast("bigint").alias("doc_id"), "path", "length")


@query("artifact_checksums")
def q_artifact_checksums(spark, sf_dir):
    """Artifact bytes read by the path table; SHA-256 and length per file on the JVM."""
    paths = _document_paths(spark, _ctx(spark, sf_dir))
    read = RG.read_contents(paths).select("path", F.octet_length("content").cast("bigint").alias("length"), F.sha2("content", 256).alias("sha256"))
    return paths.select("doc_id", "path").join(read, "path").select("doc_id", "length", "sha256")


@query("artifact_checksums_streamed")
def q_artifact_checksums_streamed(spark, sf_dir):
    """A8 for large artifacts: bytes hashed in chunks in tasks, by the path table."""
    paths = _document_paths(spark, _ctx(spark, sf_dir))
    out = TR.streaming_checksums(paths.select("path"))
    local = F.regexp_replace("path", "^file:", "")
    return paths.select("doc_id", local.alias("path")).join(out, "path").select("doc_id", out["length"], "sha256")


@query("copy_artifacts")
def q_copy_artifacts(spark, sf_dir):
    """Copy every artifact file to a second root; one row per file.

    ``ok`` is true for ``copied`` and ``skipped`` alike, so the result is the same
    however often the DataFrame is evaluated; length and SHA-256 are of the bytes copied."""
    paths = _document_paths(spark, _ctx(spark, sf_dir))
    dst = F.concat(F.lit(scratch_path(spark, "copied") + "/"), F.substring_index("path", "/", -2))
    plan = paths.select(F.col("path").alias("src_path"), dst.alias("dst_path"), "length", F.col("doc_id").cast("string").alias("doc_id"))
    out = RG.copy_artifacts(plan, scratch_path(spark, "copy-parts"), keep=["doc_id"])
    return out.select(F.col("doc_id").cast("bigint").alias("doc_id"), "length", "sha256", F.col("status").isin("copied", "skipped").alias("ok"))


@query("ledger_clean")
def q_ledger_clean(spark, sf_dir):
    """Versions per repository in the written ledger, and all that is left of them after the wipe."""
    c = _ctx(spark, sf_dir)
    root, before = scratch_path(spark, "ledger"), scratch_path(spark, "ledger-before")
    LG.write_snapshot(c.fx_ledger_versions, f"{root}/versions")
    read = lambda: spark.read.schema(LG.LEDGER_VERSIONS).parquet(f"{root}/versions")
    read().groupBy(F.lit("before").alias("moment"), "repository").agg(F.count(F.lit(1)).alias("n_versions")).write.parquet(before)
    LG.clean(spark, root)
    after = read().agg(F.lit("after").alias("moment"), F.lit("").alias("repository"), F.count(F.lit(1)).alias("n_versions"))
    return spark.read.parquet(before).unionByName(after)


def _store_after_failures(spark, sf_dir):
    """A store whose first snapshot is the fixture's ledger and whose second has the failed uploads, and that snapshot."""
    c = _ctx(spark, sf_dir)
    store = LedgerStore(spark, scratch_path(spark, "store"))
    store.create_if_absent({"versions": c.fx_ledger_versions, "packages": c.fx_ledger_packages, "repositories": c.fx_ledger_repositories})
    old, errors = store.read(), LG.publish_errors(c.fx_responses)
    return store, store.append({
        "versions": LG.mark_errors(LG.mark_failed(old["versions"], errors), errors),
        "packages": LG.mark_packages_published(old["packages"], LG.package_rollup(old["versions"])),
        "repositories": LG.mark_repositories_failed(old["repositories"], errors),
    })


@query("ledger_delta")
def q_ledger_delta(spark, sf_dir):
    """what a run appends to the ledger store: only the version rows that it changed."""
    store, snap = _store_after_failures(spark, sf_dir)
    return store.part(snap.deltas[-1], "versions")


@query("ledger_merged")
def q_ledger_merged(spark, sf_dir):
    """A10 / F2: the versions table read as base and delta merged."""
    store, snap = _store_after_failures(spark, sf_dir)
    return store.read(snap)["versions"]


@query("migration_plan")
def q_migration_plan(spark, sf_dir):
    """The full plan (with endpoint and wave) written by the dry-run sink, read back."""
    c = _ctx(spark, sf_dir)
    plan = c.plan()
    waves = R.migration_waves(INV.packages(c.scoped()), PROCS)
    full = M.with_endpoint(M.with_waves(plan, waves), None).select(*PLAN_COLS, "endpoint", "wave")
    path = scratch_path(spark, "plan")
    M.write_plan(full, path)
    return spark.read.parquet(path).select(*PLAN_COLS, "endpoint", "wave")


# === 2.2 projections =======================================================================

@query("path_basename")
def q_path_basename(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return c.fx_files.select("repository", "uri", P.basename("uri").alias("file_name"))


@query("npm_package_from_path")
def q_npm_package_from_path(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.fx_files.where((F.col("package_type") == "npm") & ~C.is_npm_metadata_path("uri"))
    return f.select("repository", "uri", P.npm_package_from_path("uri").alias("package"))


@query("path_package")
def q_path_package(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.fx_files.where(F.col("package_type").isin("maven", "pypi") & ~C.is_maven_metadata("uri"))
    return f.select("repository", "uri", P.path_package("uri").alias("package"))


@query("npm_version_from_path")
def q_npm_version_from_path(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.fx_files.where((F.col("package_type") == "npm") & ~C.is_npm_metadata_path("uri"))
    f = f.withColumn("package", P.npm_package_from_path("uri"))
    return f.select("repository", "uri", "package",
                    P.npm_version_from_file(P.basename("uri"), F.col("package")).alias("version"))


@query("path_version")
def q_path_version(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.fx_files.where(F.col("package_type").isin("maven", "pypi") & C.is_discoverable("uri"))
    return f.select("repository", "uri", P.path_version("uri").alias("version"))


@query("maven_namespace")
def q_maven_namespace(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    pk = INV.packages(c.scoped()).where(F.col("package_type") == "maven")
    return pk.select("repository", "package", P.maven_namespace("package").alias("namespace"))


@query("target_coordinates")
def q_target_coordinates(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    v = INV.with_target_coordinates(INV.versions(c.scoped()))
    return v.select("repository", "package_type", "package", "version", "namespace", "target_namespace", "target_package")


@query("download_uri")
def q_download_uri(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    storage = F.concat(F.lit(f"{SOURCE_PROTOCOL}://{SOURCE_HOST}/{SOURCE_PREFIX}/api/storage/"), F.col("repository"), F.col("uri"))
    return c.fx_files.select("repository", "uri", storage.alias("storage_uri"), P.download_uri(storage).alias("download_uri"))


@query("maven_metadata_uri")
def q_maven_metadata_uri(spark, sf_dir):
    """One metadata URI per maven version to copy (DISTINCT over its files)."""
    c = _ctx(spark, sf_dir)
    f = INV.version_files(c.scoped()).where(F.col("package_type") == "maven")
    return f.select("repository", "package", "version", P.maven_metadata_uri("uri").alias("metadata_uri")).distinct()


@query("upload_url")
def q_upload_url(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = M.with_endpoint(INV.version_files(c.scoped()), None)
    return f.select("repository", "package_type", "package", "version", "file_name",
                    P.upload_url("package_type", "endpoint", "package", "version", "file_name").alias("upload_url"))


@query("source_url")
def q_source_url(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    path = F.concat(F.lit("/"), F.col("repository"), F.col("uri"))
    return c.fx_files.select("repository", "uri",
                             P.source_url(path, SOURCE_PROTOCOL, SOURCE_HOST, SOURCE_PREFIX).alias("source_url"),
                             P.dryrun_endpoint("repository", M.DRYRUN_HOST).alias("endpoint"))


@query("staging_name")
def q_staging_name(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    v = INV.with_target_coordinates(INV.versions(c.scoped()))
    return v.select("repository", "package", "version",
                    P.staging_name("repository", "namespace", "package", "version").alias("staging_name"),
                    F.when(F.col("package_type") == "npm", P.npm_tarball_name("package", "version")).alias("tarball_name"))


@query("entity_keys")
def q_entity_keys(spark, sf_dir):
    """SHA-384 keys; compared through counts (the oracle engine lacks SHA-384)."""
    c = _ctx(spark, sf_dir)
    lv = c.fx_ledger_versions.select(
        P.entity_key("repository", "package").alias("package_key"),
        P.version_entity_key("repository", "package", "version").alias("version_key"),
        P.entity_key("repository").alias("repository_key"),
    )
    return lv.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("package_key").alias("n_package_keys"),
        F.countDistinct("version_key").alias("n_version_keys"),
        F.countDistinct("repository_key").alias("n_repository_keys"),
        F.min(F.length("version_key")).cast("int").alias("key_length"),
    )


@query("repository_package")
def q_repository_package(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return c.fx_ledger_packages_all.select("repository", "package", P.repository_package("repository", "package").alias("repository_package"))


@query("error_text")
def q_error_text(spark, sf_dir):
    """Failed responses as stored error text (quotes normalised)."""
    c = _ctx(spark, sf_dir)
    r = c.fx_responses.where(C.is_failed_response())
    return r.select("upload_id", P.normalise_quotes(LG.response_message(r)).alias("error_text"))


@query("requests_parsed")
def q_requests_parsed(spark, sf_dir):
    return RQ.parse_requests(_ctx(spark, sf_dir).fx_requests)


# === 2.3 filters ===========================================================================

@query("local_repositories")
def q_local_repositories(spark, sf_dir):
    return R.local_repositories(_ctx(spark, sf_dir).fx_repositories)


@query("supported_repositories")
def q_supported_repositories(spark, sf_dir):
    return R.supported_repositories(_ctx(spark, sf_dir).fx_repositories)


@query("npm_files")
def q_npm_files(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return c.fx_files.where((F.col("package_type") == "npm") & ~C.is_npm_metadata_path("uri")).select("repository", "uri")


@query("maven_files")
def q_maven_files(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return c.fx_files.where((F.col("package_type") == "maven") & ~C.is_maven_metadata("uri")).select("repository", "uri")


@query("discoverable_files")
def q_discoverable_files(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.fx_files.where(F.col("package_type").isin("maven", "pypi"))
    return f.where(C.is_discoverable("uri", "contains")).select("repository", "uri")


@query("discoverable_files_suffix")
def q_discoverable_files_suffix(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.fx_files.where(F.col("package_type").isin("maven", "pypi"))
    return f.where(C.is_discoverable("uri", "suffix")).select("repository", "uri")


def _version_files(spark, sf_dir, t, match="contains"):
    c = _ctx(spark, sf_dir, match)
    return INV.version_files(c.scoped()).where(F.col("package_type") == t).select("repository", "package", "version", "uri")


@query("pypi_version_files")
def q_pypi_version_files(spark, sf_dir):
    return _version_files(spark, sf_dir, "pypi")


@query("maven_version_files")
def q_maven_version_files(spark, sf_dir):
    return _version_files(spark, sf_dir, "maven")


@query("maven_version_files_suffix")
def q_maven_version_files_suffix(spark, sf_dir):
    return _version_files(spark, sf_dir, "maven", "suffix")


@query("npm_version_files")
def q_npm_version_files(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    f = c.scoped().where((F.col("package_type") == "npm") & F.col("version").isNotNull())
    f = f.where(C.is_npm_version_file("uri", "package", "version"))
    return f.select("repository", "package", "version", "uri")


@query("forbidden_names")
def q_forbidden_names(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return INV.versions(c.scoped()).where(C.is_forbidden_name("package", "version")).select("repository", "package", "version")


@query("failed_uploads")
def q_failed_uploads(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return c.fx_responses.where(C.is_failed_response()).select("upload_id", "repository", "package", "version", "status_code", "reason")


# === 2.4 joins =============================================================================

def _requested_repositories(c: Ctx) -> DataFrame:
    """Repositories named by the requests, plus each name in upper case (a typo
    the catalogue does not know)."""
    r = c.fx_requests.select("repository").distinct()
    return r.unionByName(r.select(F.upper("repository").alias("repository")))


@query("unknown_repositories")
def q_unknown_repositories(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return R.check_requested_repositories(_requested_repositories(c), c.fx_repositories).where(~F.col("known"))


@query("repositories_known")
def q_repositories_known(spark, sf_dir):
    """Are all requested repositories known (one row)?"""
    c = _ctx(spark, sf_dir)
    return R.all_repositories_known(R.check_requested_repositories(_requested_repositories(c), c.fx_repositories))


@query("files_with_type")
def q_files_with_type(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return INV.files_with_type(c.listing(), c.fx_repositories).select("repository", "uri", "package_type", "repo_type")


@query("repositories_to_create")
def q_repositories_to_create(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    tgt = c.fx_target.select(F.col("repository").alias("name")).distinct()
    return R.repositories_to_create(M.scope_repositories(c.fx_repositories), tgt)


@query("version_state")
def q_version_state(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    st = R.version_state(M.versions_with_stats(c.scoped()), c.fx_target)
    return st.select("repository", "package_type", "package", "version", "namespace", "target_namespace",
                     "target_package", "n_files", "copy_bytes", "state_code", "state")


@query("pending_versions")
def q_pending_versions(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return R.pending_versions(INV.versions(c.scoped()), c.fx_ledger_versions)


@query("ledger_add_packages")
def q_ledger_add_packages(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.add_packages(c.fx_ledger_packages, INV.packages(c.scoped()))


@query("ledger_add_versions")
def q_ledger_add_versions(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.add_versions(c.fx_ledger_versions, INV.versions(c.scoped()))


@query("ledger_add_repositories")
def q_ledger_add_repositories(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.add_repositories(c.fx_ledger_repositories, M.scope_repositories(c.fx_repositories))


@query("npm_missing_metadata")
def q_npm_missing_metadata(spark, sf_dir):
    return DOC.npm_missing_metadata(M.with_endpoint(_ctx(spark, sf_dir).fx_npm_metadata, None))


@query("publish_failures")
def q_publish_failures(spark, sf_dir):
    """Failed versions with error text and advice."""
    return LG.failure_report(_ctx(spark, sf_dir).fx_ledger_versions)


@query("plan_files")
def q_plan_files(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return M.plan_files(c.plan(), c.scoped()).select(
        "repository", "package_type", "package", "version", "decision", "uri", "file_name", "size_bytes")


# === 2.5 aggregations ======================================================================

@query("packages")
def q_packages(spark, sf_dir):
    return INV.packages(_ctx(spark, sf_dir).scoped())


@query("versions")
def q_versions(spark, sf_dir):
    return INV.versions(_ctx(spark, sf_dir).scoped())


@query("package_rollup")
def q_package_rollup(spark, sf_dir):
    return LG.package_rollup(_ctx(spark, sf_dir).fx_ledger_versions)


@query("repository_rollup")
def q_repository_rollup(spark, sf_dir):
    return LG.repository_rollup(LG.package_rollup(_ctx(spark, sf_dir).fx_ledger_versions))


@query("repository_failures")
def q_repository_failures(spark, sf_dir):
    return LG.repository_failures(_ctx(spark, sf_dir).fx_ledger_versions)


@query("publish_errors")
def q_publish_errors(spark, sf_dir):
    return LG.publish_errors(_ctx(spark, sf_dir).fx_responses)


@query("plan_summary")
def q_plan_summary(spark, sf_dir):
    return M.plan_summary(_ctx(spark, sf_dir).plan())


# === 2.6 windows ===========================================================================

@query("migration_waves")
def q_migration_waves(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return R.migration_waves(INV.packages(c.scoped()), PROCS)


def _ledger_runs(c: Ctx) -> DataFrame:
    """Two append-only runs: run 1 = the ledger; run 2 = the versions that
    failed uploads (failed, with their error text)."""
    run1 = c.fx_ledger_versions.withColumn("run_id", F.lit(1))
    err = LG.publish_errors(c.fx_responses)
    run2 = err.select("repository", "package", "version", F.lit(0).alias("published"), F.lit(1).alias("publish_failed"),
                      F.col("error_text").alias("publish_error"), F.lit(2).alias("run_id"))
    return run1.unionByName(run2)


@query("ledger_current")
def q_ledger_current(spark, sf_dir):
    return LG.current(_ledger_runs(_ctx(spark, sf_dir)), LG.VER_KEY, "run_id")


# === 2.8 set operations ====================================================================

@query("package_source")
def q_package_source(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return M.version_source(c.inputs(), c.scoped(), bounded_broadcast(M.scope_repositories(c.fx_repositories)))


# === 2.9 arrays, maps, JSON ================================================================

@query("form_fields")
def q_form_fields(spark, sf_dir):
    return DOC.form_fields(_ctx(spark, sf_dir).fx_form_metadata)


@query("form_rejects")
def q_form_rejects(spark, sf_dir):
    """Forms that are missing, cut off or no object."""
    return DOC.form_rejects(_ctx(spark, sf_dir).fx_form_metadata)


@query("npm_publish_doc")
def q_npm_publish_doc(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return DOC.npm_drop_rev(c.fx_npm_metadata).select("doc_id", "publish_doc")


@query("npm_single_version")
def q_npm_single_version(spark, sf_dir):
    """I4: the text of ``versions`` with the one version, all its fields kept."""
    c = _ctx(spark, sf_dir)
    return DOC.npm_single_version(M.with_endpoint(c.fx_npm_metadata, None)).select("doc_id", "version", "versions_kept")


@query("npm_tarball")
def q_npm_tarball(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    d = DOC.npm_set_tarball(M.with_endpoint(c.fx_npm_metadata, None))
    return d.select("doc_id", "version", F.get_json_object("version_spec", "$.dist.tarball").alias("tarball"))


@query("npm_document")
def q_npm_document(spark, sf_dir):
    """Whole publish documents, the tarball's bytes (here a short text) attached, or the reason there is none."""
    c = _ctx(spark, sf_dir)
    d = M.with_endpoint(c.fx_npm_metadata, None).withColumn("content", F.encode(F.concat("package", F.lit(" "), "version"), "UTF-8"))
    return DOC.npm_publish_document(d, "content").select("doc_id", "document", "reason")


@query("npm_attachment")
def q_npm_attachment(spark, sf_dir):
    """Each document's bytes as an npm attachment (base64 on one line)."""
    c = _ctx(spark, sf_dir)
    docs = c.fx.table("documents").select("doc_id", "text")
    content = F.encode(F.col("text"), "UTF-8")
    att = DOC.npm_attachment(content)
    return docs.select("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".tgz")).alias("attachment"),
                       att["content_type"].alias("content_type"), att["data"].alias("data"), att["length"].alias("length"))


# === 2.10 ledger writes ====================================================================

@query("ledger_refresh")
def q_ledger_refresh(spark, sf_dir):
    """Refresh the repositories named in requests."""
    c = _ctx(spark, sf_dir)
    led = c.fx_ledger_repositories_all
    return LG.refresh_repositories(LG.mark_repositories_fetched(led, led), c.fx_requests.select("repository"))


@query("ledger_mark_fetched")
def q_ledger_mark_fetched(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    led = LG.add_packages(c.fx_ledger_packages, INV.packages(c.scoped()))
    listed = INV.packages(c.scoped().where(F.col("version").isNotNull()))
    return LG.mark_packages_fetched(led, listed)


@query("ledger_mark_package_published")
def q_ledger_mark_package_published(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.mark_packages_published(c.fx_ledger_packages, LG.package_rollup(c.fx_ledger_versions))


@query("ledger_upsert_published")
def q_ledger_upsert_published(spark, sf_dir):
    """Versions the target shows published are set published (inserted if new)."""
    c = _ctx(spark, sf_dir)
    st = R.version_state(INV.versions(c.scoped()), c.fx_target)
    return LG.upsert_published(c.fx_ledger_versions, st.where(F.col("state_code") == R.STATE_PUBLISHED))


@query("ledger_mark_failed")
def q_ledger_mark_failed(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    failed = c.fx_responses.where(C.is_failed_response())
    return LG.mark_failed(c.fx_ledger_versions, failed)


@query("ledger_mark_repo_failed")
def q_ledger_mark_repo_failed(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    failed = c.fx_responses.where(C.is_failed_response())
    return LG.mark_repositories_failed(c.fx_ledger_repositories, failed)


@query("ledger_mark_errors")
def q_ledger_mark_errors(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.mark_errors(c.fx_ledger_versions, LG.publish_errors(c.fx_responses))


@query("ledger_mark_repo_fetched")
def q_ledger_mark_repo_fetched(spark, sf_dir):
    """Repositories whose packages are all fetched."""
    c = _ctx(spark, sf_dir)
    lp = c.fx_ledger_packages
    done = lp.groupBy("repository").agg(F.bool_and(F.col("all_versions_fetched") == 1).alias("ok")).where("ok")
    return LG.mark_repositories_fetched(c.fx_ledger_repositories, done)


@query("ledger_mark_repo_published")
def q_ledger_mark_repo_published(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    roll = LG.repository_rollup(LG.package_rollup(c.fx_ledger_versions))
    return LG.mark_repositories_published(c.fx_ledger_repositories, roll)


# === 2.11 ledger reads =====================================================================

@query("known_packages")
def q_known_packages(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.known(INV.packages(c.scoped()), c.fx_ledger_packages, LG.PKG_KEY)


@query("known_versions")
def q_known_versions(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.known(INV.versions(c.scoped()), c.fx_ledger_versions_all, LG.VER_KEY)


@query("known_repositories")
def q_known_repositories(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    return LG.known(M.scope_repositories(c.fx_repositories), c.fx_ledger_repositories, LG.REPO_KEY)


@query("failed_repositories")
def q_failed_repositories(spark, sf_dir):
    return LG.with_flag(_ctx(spark, sf_dir).fx_ledger_repositories, "publish_failed").select("repository")


@query("fetched_packages")
def q_fetched_packages(spark, sf_dir):
    return LG.with_flag(_ctx(spark, sf_dir).fx_ledger_packages, "all_versions_fetched").select("repository", "package")


@query("fetched_repositories")
def q_fetched_repositories(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    led = LG.mark_repositories_fetched(c.fx_ledger_repositories_all, c.fx_requests.select("repository"))
    return LG.with_flag(led, "all_versions_fetched").select("repository")


@query("open_repositories")
def q_open_repositories(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    led = LG.mark_repositories_published(
        c.fx_ledger_repositories,
        c.fx_ledger_repositories.where(F.col("publish_failed") == 0).select("repository", F.lit(True).alias("all_published")))
    return LG.open_repositories(M.scope_repositories(c.fx_repositories), led)


@query("ledger_packages")
def q_ledger_packages(spark, sf_dir):
    return _ctx(spark, sf_dir).fx_ledger_packages_all.select("repository", "package").distinct()


@query("ledger_versions")
def q_ledger_versions(spark, sf_dir):
    return _ctx(spark, sf_dir).fx_ledger_versions_all.select("repository", "package", "version").distinct()


@query("published_packages")
def q_published_packages(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    led = LG.mark_packages_published(c.fx_ledger_packages, LG.package_rollup(c.fx_ledger_versions))
    return LG.with_flag(led, "all_versions_published").select("repository", "package")


@query("published_versions")
def q_published_versions(spark, sf_dir):
    return LG.with_flag(_ctx(spark, sf_dir).fx_ledger_versions, "published").select(*LG.VER_KEY)


@query("unpublished_versions")
def q_unpublished_versions(spark, sf_dir):
    return LG.with_flag(_ctx(spark, sf_dir).fx_ledger_versions, "published", 0).select(*LG.VER_KEY)


# === 2.12 jobs =============================================================================

@query("migration_actions")
def q_migration_actions(spark, sf_dir):
    return M.actions(_ctx(spark, sf_dir).plan())


REQUESTED_COLS = [*PLAN_COLS, "by_name", "by_package"]


@query("requested_plan")
def q_requested_plan(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    c.fx.store("fx_base")  # files, target, ledger and requests are all made of it
    return M.requested_plan(c.inputs(), c.fx_requests).select(*REQUESTED_COLS)


@query("request_links")
def q_request_links(spark, sf_dir):
    """L2: from each request entry to the versions planned for it."""
    c = _ctx(spark, sf_dir)
    path = scratch_path(spark, "requested")
    M.write_plan(M.requested_plan(c.inputs(), c.fx_requests), path)
    return M.request_links(spark.read.parquet(path), c.fx_requests)


@query("repository_plan")
def q_repository_plan(spark, sf_dir):
    """L4: plan for the repositories named in requests (a table of names)."""
    c = _ctx(spark, sf_dir)
    return M.plan(c.inputs(whole=True), scope=c.fx_requests.select("repository").distinct()).select(*PLAN_COLS)


@query("post_check")
def q_post_check(spark, sf_dir):
    """Check the plan's published versions against a fresh target snapshot."""
    c = _ctx(spark, sf_dir)
    return M.post_check(c.plan(), c.fx_fresh_target)


@query("resume_plan")
def q_resume_plan(spark, sf_dir):
    c = _ctx(spark, sf_dir)
    p = M.resume_plan(c.inputs())
    return p.select("repository", "package_type", "package", "version", "source", "n_files", "copy_bytes",
                    "state_code", "state", "decision")
