"""User package requests: ``name[:version] name[:version] ...`` per repository.

Bad entries get a ``kind`` instead of aborting the whole run:
``one_version``, ``all_versions``, ``blank_version`` (``name:``),
``malformed`` (more than one ``:``), ``empty`` (double space).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def parse_requests(requests: DataFrame) -> DataFrame:
    """One row per requested entry, with its 0-based position ``pos``."""
    exploded = requests.select(
        "request_id", "repository", F.posexplode(F.split(F.col("packages"), " ")).alias("pos", "token")
    )
    tok = F.col("token")
    n_colons = F.length(tok) - F.length(F.replace(tok, F.lit(":"), F.lit("")))
    kind = (
        F.when(tok == "", F.lit("empty"))
        .when(n_colons == 0, F.lit("all_versions"))
        .when(n_colons > 1, F.lit("malformed"))
        .when(F.split_part(tok, F.lit(":"), F.lit(2)) == "", F.lit("blank_version"))
        .otherwise(F.lit("one_version"))
    )
    return exploded.select(
        "request_id", "repository", F.col("pos").cast("int").alias("pos"), "token",
        F.split_part(tok, F.lit(":"), F.lit(1)).alias("package"),
        F.when(kind == "one_version", F.split_part(tok, F.lit(":"), F.lit(2))).alias("version"),
        kind.alias("kind"),
    )


def match_requests(parsed: DataFrame, ledger_packages: DataFrame | None, source_packages: DataFrame) -> DataFrame:
    """Is the requested package known -- in the ledger first, in the
    source second?  ``found_in`` = 'ledger' | 'source' | NULL; ``found`` flag."""
    src = source_packages.select("repository", "package").distinct().withColumn("_src", F.lit(True))
    out = parsed.join(src, ["repository", "package"], "left")
    if ledger_packages is not None:
        led = ledger_packages.select("repository", "package").distinct().withColumn("_led", F.lit(True))
        out = out.join(led, ["repository", "package"], "left")
    else:
        out = out.withColumn("_led", F.lit(None).cast("boolean"))
    found_in = F.when(F.col("_led"), F.lit("ledger")).when(F.col("_src"), F.lit("source"))
    return out.withColumn("found_in", found_in).withColumn("found", found_in.isNotNull()).drop("_src", "_led")


def requested_versions(matched: DataFrame, versions: DataFrame, repositories: DataFrame) -> DataFrame:
    """L2: versions a request asks for.

    ``one_version`` entries name their version; ``all_versions`` entries expand
    to every listed version of the package (equi-join on repository, package).
    Only found packages of supported repositories; the package type comes from
    ``repositories`` (the caller's size-checked scope table).
    """
    ok = matched.where(F.col("found"))
    one = ok.where(F.col("kind") == "one_version").select("request_id", "repository", "package", "version")
    allv = (
        ok.where(F.col("kind") == "all_versions").select("request_id", "repository", "package")
        .join(versions.select("repository", "package", "version"), ["repository", "package"], "inner")
    )
    req = one.unionByName(allv.select("request_id", "repository", "package", "version"))
    return req.join(repositories, "repository", "inner")
