"""Service responses kept as JSON pages, and a side table of the pages that can't be used.

A crawl leaves one document per page: a file each (``read_pages``) or a row each of a table (``page``, ``doc``).  Pages
may be cut off, blank, of another shape, or fetched twice, and neighbouring pages may overlap when the service's list
moved between two calls.  Nothing is half read: a page that can't be parsed whole gives no rows, only a reject with its
text, and rows that several pages hold count once, as the last page (in the order of ``page``) has them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.once import evaluated_once
from .dumps import LISTING_DOC, TARGET_REPOS_DOC

VERSIONS_DOC = "struct<format: string, namespace: string, package: string, versions: array<struct<version: string, status: string>>>"
NPM_DOC = "struct<name: string>"
CORRUPT = "_corrupt_record"


class Dump(NamedTuple):
    """``rows`` of the pages that parse; ``rejects``: ``page``, ``reason``, ``length``, ``sha256`` and ``_corrupt_record``."""

    rows: DataFrame
    rejects: DataFrame


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Every file below ``path`` as ``page`` (its path) and ``doc`` (its text), beside columns of ``name=value`` folders.

    Spark's file sources pass over files without a single byte, so these give neither rows nor a reject.
    """
    df = spark.read.text(path, wholetext=True).withColumnRenamed("value", "doc")
    return df.select(F.col("_metadata.file_path").alias("page"), *df.columns)


def judged(pages: DataFrame, schema: str, needed: str) -> DataFrame:
    """The pages with ``_doc`` (parsed) and ``_reason``: null, or why the page can't be used.

    ``empty``: blank or null; ``malformed``: no JSON object of the schema (cut off, or a value of another type);
    ``incomplete``: well formed, without the field ``needed``.
    """
    with_corrupt = schema[:-1] + f", {CORRUPT}: string>"
    parsed = evaluated_once(pages, _doc=F.from_json("doc", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}))
    reason = (F.when(F.trim(F.regexp_replace(F.coalesce("doc", F.lit("")), r"\s", "")) == "", "empty")
              .when(F.col("_doc").isNull() | F.col(f"_doc.{CORRUPT}").isNotNull(), "malformed")
              .when(F.col(f"_doc.{needed}").isNull(), "incomplete"))
    return parsed.withColumn("_reason", reason)


def rejects(pages: DataFrame, own: list[str]) -> DataFrame:
    """Side table of judged pages: those with a reason, and ``repeated`` ones, whose text (and ``own`` columns) a page
    before them has too; these do no harm and carry no text.

    Only a digest of each page is grouped, with partial aggregates, so one text fetched very often is no hot group; the
    pages are gone through once for the digests and once for the rejects.
    """
    text = F.coalesce("doc", F.lit(""))
    slim = pages.select("page", *own, "_reason", F.octet_length(text).cast("long").alias("length"), F.sha2(text, 256).alias("sha256"),
                        F.when(F.col("_reason") == "malformed", F.col("doc")).alias(CORRUPT))
    good = slim.where(F.col("_reason").isNull())
    twice = good.groupBy("sha256", *own).agg(F.min("page").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    twice = twice.withColumnsRenamed({c: f"_{c}" for c in ["sha256", *own]})
    on = F.col("_reason").isNull() & (F.col("page") > F.col("_first"))
    for c in ["sha256", *own]:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    reason = F.coalesce("_reason", F.when(F.col("_first").isNotNull(), "repeated"))
    return (slim.join(twice, on, "left").select("page", *own, reason.alias("reason"), "length", "sha256", CORRUPT)
            .where(F.col("reason").isNotNull()))


def last_of(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """One row per key, with the values that the last page gives."""
    last = F.max(F.struct("page", *values))
    return rows.groupBy(*keys).agg(last.alias("_last")).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def elements(pages: DataFrame, own: list[str], needed: str, *others: Column) -> DataFrame:
    """Elements (``e``) of the list ``needed`` of every usable page."""
    return pages.where(F.col("_reason").isNull()).select("page", *own, *others, F.explode(f"_doc.{needed}").alias("e")).where(F.col("e").isNotNull())


def target_repositories(pages: DataFrame) -> Dump:
    """A5: names of the target's repositories from all pages of its list; elements without a name are left out."""
    p = judged(pages, TARGET_REPOS_DOC, "repositories")
    rows = elements(p, [], "repositories").select(F.col("e.name").alias("name")).where(F.col("name").isNotNull()).distinct()
    return Dump(rows, rejects(p, []))


def target_versions(pages: DataFrame) -> Dump:
    """States of versions from pages of (``page``, ``repository``, ``doc``), a package's versions in any number of
    pages; a missing namespace is ''."""
    p = judged(pages, VERSIONS_DOC, "versions")
    p = p.withColumn("_reason", F.when(F.col("_reason").isNull() & F.col("_doc.package").isNull(), "incomplete").otherwise(F.col("_reason")))
    rows = elements(p, ["repository"], "versions", F.col("_doc.format").alias("format"), F.coalesce("_doc.namespace", F.lit("")).alias("namespace"),
                    F.col("_doc.package").alias("package"))
    rows = rows.select("page", "repository", "format", "namespace", "package", F.col("e.version").alias("version"), F.col("e.status").alias("status"))
    keys = ["repository", "format", "namespace", "package", "version"]
    return Dump(last_of(rows.where(F.col("version").isNotNull()), keys, ["status"]), rejects(p, ["repository"]))


def listing(pages: DataFrame) -> Dump:
    """A2: files from pages of (``page``, ``repository``, ``doc``), folders left out; a repository's list may be cut into
    any number of pages."""
    p = judged(pages, LISTING_DOC, "files")
    rows = elements(p, ["repository"], "files").where(~F.coalesce("e.folder", F.lit(False)) & F.col("e.uri").isNotNull())
    return Dump(last_of(rows.select("page", "repository", "e.uri", F.col("e.size").alias("size_bytes")), ["repository", "uri"], ["size_bytes"]),
                rejects(p, ["repository"]))


def npm_metadata(pages: DataFrame) -> Dump:
    """Npm metadata from pages of (``page``, ``repository``, ``doc``): ``repository``, ``package`` (the document's
    name) and ``metadata``, its text unchanged."""
    p = judged(pages, NPM_DOC, "name")
    rows = p.where(F.col("_reason").isNull()).select("page", "repository", F.col("_doc.name").alias("package"), F.col("doc").alias("metadata"))
    return Dump(last_of(rows, ["repository", "package"], ["metadata"]), rejects(p, ["repository"]))
