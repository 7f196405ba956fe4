"""Column expressions on file paths, package coordinates and URLs.

All built-in Spark expressions (whole-stage codegen, no Python per row).
Spark's ``split`` takes a regex, so literal delimiters go through
``split_part`` / ``replace`` / ``contains`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(s: str) -> Column:
    return F.lit(s)


def basename(c: ColumnOrName) -> Column:
    """B1: last path segment."""
    return F.substring_index(_c(c), "/", -1)


def strip_leading_slash(c: ColumnOrName) -> Column:
    c = _c(c)
    return F.when(c.startswith("/"), F.substring(c, 2, 1 << 30)).otherwise(c)


def npm_package_from_path(uri: ColumnOrName) -> Column:
    """B2: npm package = path without its leading '/', text before '/-/'."""
    return F.substring_index(strip_leading_slash(uri), "/-/", 1)


def path_segment_count(uri: ColumnOrName) -> Column:
    """Number of '/'-separated segments after the leading '/' (C5 helper)."""
    stripped = strip_leading_slash(uri)
    return F.length(stripped) - F.length(F.replace(stripped, _lit("/"), _lit(""))) + 1


def path_package(uri: ColumnOrName) -> Column:
    """maven/pypi package = path minus its last two segments; needs > 2 segments."""
    stripped = strip_leading_slash(uri)
    last_two = F.substring_index(stripped, "/", -2)
    longer = F.octet_length(last_two) < F.octet_length(stripped)
    return F.when(longer, F.left(stripped, F.length(stripped) - F.length(last_two) - 1))


def npm_version_from_file(file_name: ColumnOrName, package: ColumnOrName) -> Column:
    """Version of an npm tarball ``<basename(package)>-<version>.tgz``.

    The prefix is stripped by *length*, not by splitting on the package name,
    so a version that repeats the name (``a-1.0.0-beta-2``) stays whole.  Only
    names that end in ``.tgz`` and start with ``<basename>-`` carry a version.
    """
    f = _c(file_name)
    base = basename(package)
    prefix_len = F.length(base) + 1
    ok = f.endswith(".tgz") & f.startswith(F.concat(base, _lit("-"))) & (F.length(f) > prefix_len + 4)
    return F.when(ok, f.substr(prefix_len + 1, F.length(f) - prefix_len - 4))


def path_version(uri: ColumnOrName) -> Column:
    """maven/pypi version = the segment before the file name."""
    # The slash before it gives a path of one segment an empty one, as splitting does.
    return F.substring_index(F.substring_index(F.concat(_lit("/"), _c(uri)), "/", -2), "/", 1)


def maven_namespace(package: ColumnOrName) -> Column:
    """All but the last segment of a maven package ('' when there is none).

    Drops the *last* segment (the source tool removed the first segment equal to
    the last one, so ``foo/bar/foo`` became ``bar/foo``).
    """
    p = _c(package)
    return F.when(p.contains("/"), F.left(p, F.length(p) - F.length(F.substring_index(p, "/", -1)) - 1)).otherwise(_lit(""))


def target_namespace(package_type: ColumnOrName, package: ColumnOrName) -> Column:
    """B7 (namespace part): npm scope without '@'; maven dotted group; pypi ''."""
    t, p = _c(package_type), _c(package)
    npm_ns = F.when(p.contains("/"), F.replace(F.substring_index(p, "/", 1), _lit("@"), _lit(""))).otherwise(_lit(""))
    return (
        F.when(t == "npm", npm_ns)
        .when(t == "maven", F.replace(maven_namespace(p), _lit("/"), _lit(".")))
        .otherwise(_lit(""))
    )


def target_package(package_type: ColumnOrName, package: ColumnOrName) -> Column:
    """B7 (name part): npm/maven last segment; pypi lower case with '_' -> '-'."""
    t, p = _c(package_type), _c(package)
    return F.when(t == "pypi", F.replace(F.lower(p), _lit("_"), _lit("-"))).otherwise(basename(p))


def download_uri(uri: ColumnOrName) -> Column:
    """Storage-API URI -> download URI."""
    return F.replace(_c(uri), _lit("api/storage/"), _lit(""))


def maven_metadata_uri(uri: ColumnOrName) -> Column:
    """Sibling ``maven-metadata.xml`` of a file (same folder)."""
    return F.regexp_replace(_c(uri), r"/[^/]*$", "/maven-metadata.xml")


def endpoint_folder(endpoint: ColumnOrName) -> Column:
    """The endpoint with exactly one '/' at its end, so that a path can follow."""
    return F.concat(F.regexp_replace(_c(endpoint), "/+$", ""), _lit("/"))


def upload_url(package_type: ColumnOrName, endpoint: ColumnOrName, package: ColumnOrName,
               version: ColumnOrName, file_name: ColumnOrName) -> Column:
    """Upload URL by format."""
    t, e, p = _c(package_type), _c(endpoint), _c(package)
    return (
        F.when(t == "maven", F.concat(endpoint_folder(e), p, _lit("/"), _c(version), _lit("/"), _c(file_name)))
        .when(t == "pypi", e)
        .when(t == "npm", F.concat(endpoint_folder(e), F.replace(p, _lit("/"), _lit("%2f"))))
    )


def dryrun_endpoint(repository: ColumnOrName, host: str = "dryrun-endpoint.invalid") -> Column:
    """Endpoint used in dry-run plans: ``<host>/<repository>``."""
    return F.concat(_lit(host + "/"), _c(repository))


def source_url(path: ColumnOrName, protocol: str, host: str, prefix: str | None = None) -> Column:
    """``<protocol>://<host>[/<prefix>]<path>`` for a path starting with '/'."""
    pre = f"/{prefix}" if prefix else ""
    return F.concat(_lit(f"{protocol}://{host}{pre}"), _c(path))


def staging_name(repository: ColumnOrName, namespace: ColumnOrName, package: ColumnOrName,
                 version: ColumnOrName) -> Column:
    """Staging key ``basename-version``, qualified by repository and namespace.

    The bare ``basename-version`` collides for equal names from different
    namespaces; the qualified key does not.
    """
    return F.concat_ws("/", _c(repository), _c(namespace), F.concat(basename(package), _lit("-"), _c(version)))


def npm_tarball_name(package: ColumnOrName, version: ColumnOrName) -> Column:
    """Attachment name ``<package>-<version>.tgz``."""
    return F.concat(_c(package), _lit("-"), _c(version), _lit(".tgz"))


def entity_key(*parts: ColumnOrName, sep: str = "/") -> Column:
    """SHA-384 entity key of the joined parts (hex, as hashlib gives)."""
    return F.sha2(F.concat_ws(sep, *[_c(p) for p in parts]), 384)


def version_entity_key(repository: ColumnOrName, package: ColumnOrName, version: ColumnOrName) -> Column:
    """Key of a version row: ``repo/package:version``."""
    return F.sha2(F.concat(_c(repository), _lit("/"), _c(package), _lit(":"), _c(version)), 384)


def repository_package(repository: ColumnOrName, package: ColumnOrName) -> Column:
    """``repository/package``."""
    return F.concat(_c(repository), _lit("/"), _c(package))


def normalise_quotes(text: ColumnOrName) -> Column:
    """Single quotes become double quotes in stored error text."""
    return F.replace(_c(text), _lit("'"), _lit('"'))
