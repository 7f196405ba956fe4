"""Inventory: files with their package coordinates; packages; versions; files per version.

The coordinates (package, version, copy flag) are derived **once** per file and
meant to be stored with the listing (``store_inventory``): filters on derived
expressions cannot reach the Parquet reader, stored columns can, and Catalyst
would otherwise inline the derivation into every join that uses it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import filters as C
from ..functions import paths as P
from .joins import bounded_broadcast
from .once import evaluated_once

INVENTORY_COLUMNS = ("repository", "package_type", "uri", "size_bytes", "file_name", "package", "version", "copy", "slot")
# A file's slot, by a hash of its path: a key to spread the files of one version (one bit each of a long).
SLOTS = 64
VERSION_KEY = ("repository", "package", "version")


def catalogue(repositories: DataFrame) -> DataFrame:
    """Catalogue rows as ``repository, repo_type, package_type`` (type lower case, B15)."""
    return repositories.select(
        F.col("repo_key").alias("repository"),
        F.col("repo_type"),
        F.lower("package_type").alias("package_type"),
    )


def files_with_type(files: DataFrame, repositories: DataFrame) -> DataFrame:
    """Attach each file's package type from the catalogue.

    The catalogue has one row per repository, so it is broadcast behind a size
    check and the listing is never shuffled for this join.
    """
    cat = catalogue(repositories).select("repository", "package_type", "repo_type")
    listing = files.drop("package_type") if "package_type" in files.columns else files
    return listing.join(bounded_broadcast(cat), "repository", "inner")


def derive_coordinates(files: DataFrame, match: str = "contains") -> DataFrame:
    """Per file: ``file_name``, ``package``, ``version`` and ``copy``.

    * npm: files under ``/.npm/`` have no package; the package is the path
      before ``/-/``; only ``<basename>-<version>.tgz`` names carry a version.
    * maven / pypi: ``maven-metadata.xml`` and paths with fewer than three
      segments have no package; the package is the path minus its last two
      segments; a discoverable file (C6) carries the segment before the file
      name as version.
    * ``copy``: the file is one of the files uploaded for its version
      (C7 pypi, C8 maven, C9 npm).
    Other package types get NULL coordinates.
    """
    t = F.col("package_type")
    uri = F.col("uri")
    file_name = P.basename(uri)
    npm_pkg = F.when(~C.is_npm_metadata_path(uri), P.npm_package_from_path(uri))
    mp_pkg = F.when(~C.is_maven_metadata(uri), P.path_package(uri))
    package = F.when(t == "npm", npm_pkg).when(t.isin("maven", "pypi"), mp_pkg)

    out = evaluated_once(files, file_name=file_name, package=package)
    pkg = F.col("package")
    version = (
        F.when((t == "npm") & pkg.isNotNull(), P.npm_version_from_file("file_name", pkg))
        .when(t.isin("maven", "pypi") & pkg.isNotNull() & C.is_discoverable(uri, match), P.path_version(uri))
    )
    out = evaluated_once(out, version=version)
    v = F.col("version")
    copy = (
        F.when(t == "npm", v.isNotNull())
        .when(t == "pypi", v.isNotNull() & C.is_pypi_version_file(uri, match))
        .when(t == "maven", v.isNotNull() & C.is_maven_version_file(uri, match))
        .otherwise(F.lit(False))
    )
    return out.withColumn("copy", copy).withColumn("slot", slot())


def slot(uri: str = "uri") -> F.Column:
    return F.pmod(F.xxhash64(uri), F.lit(SLOTS)).cast("tinyint")


def with_slot(inv: DataFrame) -> DataFrame:
    """The inventory with its slots, also one stored before there were any."""
    return inv if "slot" in inv.columns else inv.withColumn("slot", slot())


def slots_of(copy: str | F.Column = "copy") -> F.Column:
    """Aggregate: the slots that a version's files to copy fall into, as the bits of a long."""
    return F.coalesce(F.bit_or(F.when(F.col(copy) if isinstance(copy, str) else copy, F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").cast("int")))), F.lit(0).cast("bigint"))


def inventory(files: DataFrame, repositories: DataFrame | None = None, match: str = "contains") -> DataFrame:
    """Listing -> inventory with coordinates (types from the catalogue when given)."""
    typed = files_with_type(files, repositories) if repositories is not None else files
    return derive_coordinates(typed, match).select(*INVENTORY_COLUMNS)


def store_inventory(inv: DataFrame, path: str) -> None:
    """Write the inventory once, partitioned by repository.

    Rebalanced on the repository first (``writes.by_repository``): a task
    writes one repository folder, a very large repository is split by AQE
    over many tasks, and each file is sorted by package and version (tight
    min/max statistics; a package's files sit together, so the version
    aggregate reduces map-side to about one row per version)."""
    from .writes import by_repository

    (by_repository(inv, ["repository", "package", "version"])
     .write.mode("overwrite").partitionBy("repository").parquet(path))


def packages(inv: DataFrame) -> DataFrame:
    """Distinct packages per repository."""
    return inv.where(F.col("package").isNotNull()).select("repository", "package_type", "package").distinct()


def versions(inv: DataFrame) -> DataFrame:
    """Distinct versions per package (partial + final hash aggregate)."""
    return (
        inv.where(F.col("version").isNotNull())
        .select("repository", "package_type", "package", "version")
        .distinct()
    )


def with_target_coordinates(df: DataFrame) -> DataFrame:
    """Source namespace (maven) and the target's namespace and package name."""
    t, p = F.col("package_type"), F.col("package")
    return (
        df.withColumn("namespace", F.when(t == "maven", P.maven_namespace(p)).otherwise(F.lit("")))
        .withColumn("target_namespace", P.target_namespace(t, p))
        .withColumn("target_package", P.target_package(t, p))
    )


def package_files(inv: DataFrame, package_type: str | None = None) -> DataFrame:
    """All files of each package (no extension filter), from the stored
    inventory -- the second per-package search of the source tool becomes a filter."""
    out = inv.where(F.col("package").isNotNull())
    if package_type:
        out = out.where(F.col("package_type") == package_type)
    return out.select("repository", "package_type", "package", "uri", "file_name", "size_bytes")


def version_files(inv: DataFrame, *more: str) -> DataFrame:
    """A3 with a version: the files uploaded for each version."""
    return inv.where(F.col("copy")).select(
        "repository", "package_type", "package", "version", "uri", "file_name", "size_bytes", *more
    )
