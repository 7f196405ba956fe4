"""Readers for the service dumps a migration starts from (all with explicit schemas).

Two shapes are accepted for each input:

* the service's own document (``repositoriesSummaryList``, ``files``,
  ``repositories``, ``packageVersion``) as a JSON text column or file, parsed
  with ``from_json`` and exploded (I7);
* JSON Lines with one record per row, which Spark splits across tasks -- the
  form to use for listings of very large repositories (a single listing
  document is one row and cannot be split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CATALOGUE_DOC = "struct<repositoriesSummaryList: array<struct<repoKey: string, repoType: string, packageType: string>>>"
LISTING_DOC = "struct<uri: string, files: array<struct<uri: string, size: bigint, folder: boolean>>>"
LISTING_LINE = "repository string, uri string, size bigint, folder boolean"
TARGET_REPOS_DOC = "struct<repositories: array<struct<name: string, domainName: string>>>"
TARGET_VERSION_LINE = (
    "repository string, format string, namespace string, package string, "
    "packageVersion struct<version: string, status: string>"
)


# --- catalogue (A1) --------------------------------------------------------------------

def parse_catalogue(docs: DataFrame, col: str = "doc") -> DataFrame:
    """A1: catalogue documents -> ``repo_key, repo_type, package_type``."""
    d = F.from_json(F.col(col), CATALOGUE_DOC)
    return docs.select(F.explode(d["repositoriesSummaryList"]).alias("r")).select(
        F.col("r.repoKey").alias("repo_key"), F.col("r.repoType").alias("repo_type"),
        F.col("r.packageType").alias("package_type"),
    )


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """A1 from files holding whole catalogue documents."""
    return parse_catalogue(spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc"))


# --- listings (A2) -----------------------------------------------------------------------

def parse_listing(docs: DataFrame, repository_col: str = "repository", col: str = "doc") -> DataFrame:
    """A2: listing documents (one per repository) -> file rows; folders dropped."""
    d = F.from_json(F.col(col), LISTING_DOC)
    return (
        docs.select(F.col(repository_col).alias("repository"), F.explode(d["files"]).alias("f"))
        .where(~F.coalesce(F.col("f.folder"), F.lit(False)))
        .select("repository", F.col("f.uri").alias("uri"), F.col("f.size").alias("size_bytes"))
    )


def read_listing_lines(spark: SparkSession, path: str) -> DataFrame:
    """A2 from JSON Lines (``repository`` from the record or from a
    ``repository=<name>`` directory); splittable, folders dropped."""
    df = spark.read.schema(LISTING_LINE).json(path)
    return df.where(~F.coalesce(F.col("folder"), F.lit(False))).select(
        "repository", "uri", F.col("size").alias("size_bytes")
    )


def write_listing_lines(files: DataFrame, path: str) -> None:
    """Store a listing as JSON Lines, one directory per repository (rebalanced on
    the repository first: one folder per task, big repositories split by AQE)."""
    from ..operators.writes import by_repository

    (by_repository(files.select("repository", "uri", F.col("size_bytes").alias("size"), F.lit(False).alias("folder")))
     .write.mode("overwrite").partitionBy("repository").json(path))


# --- target (A5, A6) ---------------------------------------------------------------------

def parse_target_repositories(docs: DataFrame, col: str = "doc") -> DataFrame:
    """A5: repository list documents -> ``name`` (every page, not the first only)."""
    d = F.from_json(F.col(col), TARGET_REPOS_DOC)
    return docs.select(F.explode(d["repositories"]).alias("r")).select(F.col("r.name").alias("name"))


def read_target_versions(spark: SparkSession, path: str) -> DataFrame:
    """Target version states as one bulk table; a missing namespace is ''."""
    df = spark.read.schema(TARGET_VERSION_LINE).json(path)
    return df.select(
        "repository", "format", F.coalesce("namespace", F.lit("")).alias("namespace"), "package",
        F.col("packageVersion.version").alias("version"), F.col("packageVersion.status").alias("status"),
    )


def write_target_versions(target: DataFrame, path: str) -> None:
    (target.select("repository", "format", F.when(F.col("namespace") != "", F.col("namespace")).alias("namespace"),
                   "package", F.struct("version", "status").alias("packageVersion"))
     .write.mode("overwrite").json(path))
