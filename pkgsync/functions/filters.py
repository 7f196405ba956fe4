"""Predicates on repositories, paths, names and responses (all built-in expressions).

``match`` selects how file extensions are tested:

* ``"contains"`` (default) reproduces the source tool: the extension may occur
  anywhere in the path, so checksum side files such as ``x.jar.sha1`` or
  ``x.tar.gz.sha256`` pass too;
* ``"suffix"`` anchors the extension at the end of the path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import ColumnOrName, _c

# Fixed values that must equal the source tool's for equal results.
SUPPORTED_TYPES = ("maven", "pypi", "npm")
DISCOVERY_EXTENSIONS = (".pom", ".jar", ".tar.gz", ".whl", ".egg")
PYPI_FILE_EXTENSIONS = (".tar.gz", ".whl", ".egg")
MAVEN_FILE_EXTENSIONS = (".pom", ".jar", ".tar.gz")
MAVEN_METADATA = "maven-metadata.xml"
NPM_METADATA_PREFIX = "/.npm/"
# Characters the target refuses in a package name or version.
FORBIDDEN_CHARS = r"""[$&+,:;=?#|'<>^*()%!"\s\[\]]"""
# Java regex; (?U) makes \s Unicode-aware like Python's re.
FORBIDDEN_REGEX = "(?U)" + FORBIDDEN_CHARS


def _any(preds) -> Column:
    return reduce(lambda a, b: a | b, preds)


def has_extension(uri: ColumnOrName, extensions, match: str = "contains") -> Column:
    """C6-C8 building block."""
    u = _c(uri)
    if match == "contains":
        return _any([u.contains(e) for e in extensions])
    if match == "suffix":
        return _any([u.endswith(e) for e in extensions])
    raise ValueError(f"match must be 'contains' or 'suffix', not {match!r}")


def is_local_repository(repo_type: ColumnOrName = "repo_type", repo_key: ColumnOrName = "repo_key") -> Column:
    """LOCAL repositories, not the synthetic TOTAL row."""
    return (_c(repo_type) == "LOCAL") & (_c(repo_key) != "TOTAL")


def is_supported_type(package_type: ColumnOrName = "package_type") -> Column:
    """Package type the migration handles (compares lower-case)."""
    return F.lower(_c(package_type)).isin(*SUPPORTED_TYPES)


def is_npm_metadata_path(uri: ColumnOrName) -> Column:
    """Files under the npm metadata folder ``/.npm/``."""
    return _c(uri).startswith(NPM_METADATA_PREFIX)


def is_maven_metadata(uri: ColumnOrName) -> Column:
    """C4: ``maven-metadata.xml`` files."""
    return _c(uri).contains(MAVEN_METADATA)


def has_min_segments(uri: ColumnOrName, n: int = 3) -> Column:
    """At least ``n`` path segments."""
    from .paths import path_segment_count

    return path_segment_count(uri) >= n


def is_discoverable(uri: ColumnOrName, match: str = "contains") -> Column:
    """A maven/pypi file that reveals a version."""
    return has_extension(uri, DISCOVERY_EXTENSIONS, match)


def is_pypi_version_file(uri: ColumnOrName, match: str = "contains") -> Column:
    """A pypi file copied for its version."""
    return has_extension(uri, PYPI_FILE_EXTENSIONS, match)


def is_maven_version_file(uri: ColumnOrName, match: str = "contains") -> Column:
    """A maven file copied for its version (never maven-metadata.xml)."""
    return ~is_maven_metadata(uri) & has_extension(uri, MAVEN_FILE_EXTENSIONS, match)


def is_npm_version_file(uri: ColumnOrName, package: ColumnOrName, version: ColumnOrName) -> Column:
    """``<basename>-<version>.tgz`` occurs in the path."""
    from .paths import basename

    return _c(uri).contains(F.concat(basename(package), F.lit("-"), _c(version), F.lit(".tgz")))


def is_forbidden_name(*cols: ColumnOrName) -> Column:
    """Any of the columns contains a character the target refuses."""
    return _any([F.coalesce(_c(c).rlike(FORBIDDEN_REGEX), F.lit(False)) for c in cols])


def is_failed_response(status_code: ColumnOrName = "status_code") -> Column:
    """HTTP outcome not ok."""
    return _c(status_code) >= 400
