"""DuckDB oracle SQL for every registered query.

The oracle side sees only the driver's Parquet views, so each statement starts
with the fixture SQL (same text as on Spark) and shared derived CTEs, chained in
dependency order by ``build``.  The SQL restates the semantics independently of
the DataFrame code it checks.
"""

from __future__ import annotations

from .sources.fixtures import FIXTURES

FORBIDDEN = """'[$&+,:;=?#|''<>^*()%!"\\s\\[\\]]'"""
DRYRUN_HOST = "dryrun-endpoint.invalid"
SOURCE_BASE = "https://source.invalid/mirror"

DISCOVER = (".pom", ".jar", ".tar.gz", ".whl", ".egg")
PYPI = (".tar.gz", ".whl", ".egg")
MAVEN = (".pom", ".jar", ".tar.gz")


def _ext(exts, match: str, col: str = "uri") -> str:
    fn = "contains" if match == "contains" else "suffix"
    return "(" + " OR ".join(f"{fn}({col}, '{e}')" for e in exts) + ")"


def _inv1(match: str, src: str) -> str:
    return f"""SELECT *,
       CASE WHEN package_type = 'npm' AND package IS NOT NULL AND suffix(file_name, '.tgz')
                 AND starts_with(file_name, split_part(package, '/', -1) || '-')
                 AND length(file_name) > length(split_part(package, '/', -1)) + 5
              THEN substr(file_name, length(split_part(package, '/', -1)) + 2,
                          length(file_name) - length(split_part(package, '/', -1)) - 5)
            WHEN package_type IN ('maven', 'pypi') AND package IS NOT NULL AND {_ext(DISCOVER, match)}
              THEN split_part(uri, '/', -2)
       END AS version
FROM {src}"""


def _inv(match: str, src: str) -> str:
    return f"""SELECT repository, package_type, uri, size_bytes, file_name, package, version,
       CASE WHEN package_type = 'npm' THEN version IS NOT NULL
            WHEN package_type = 'pypi' THEN version IS NOT NULL AND {_ext(PYPI, match)}
            WHEN package_type = 'maven' THEN version IS NOT NULL AND NOT contains(uri, 'maven-metadata.xml') AND {_ext(MAVEN, match)}
            ELSE false END AS copy
FROM {src}"""


def _vers(src: str) -> str:
    return f"""SELECT repository, package_type, package, version,
       count(*) FILTER (WHERE copy) AS n_files,
       CAST(coalesce(sum(CASE WHEN copy THEN size_bytes END), 0) AS BIGINT) AS copy_bytes
FROM {src} WHERE version IS NOT NULL
GROUP BY repository, package_type, package, version"""


def _vcoord(src: str) -> str:
    return f"""SELECT *,
       CASE WHEN package_type = 'maven' AND contains(package, '/') THEN regexp_replace(package, '/[^/]*$', '') ELSE '' END AS namespace,
       CASE WHEN package_type = 'npm' THEN CASE WHEN contains(package, '/') THEN replace(split_part(package, '/', 1), '@', '') ELSE '' END
            WHEN package_type = 'maven' THEN CASE WHEN contains(package, '/') THEN replace(regexp_replace(package, '/[^/]*$', ''), '/', '.') ELSE '' END
            ELSE '' END AS target_namespace,
       CASE WHEN package_type = 'pypi' THEN replace(lower(package), '_', '-') ELSE split_part(package, '/', -1) END AS target_package
FROM {src}"""


def _state(src: str, tgt: str = "tgt") -> str:
    return f"""SELECT v.*,
       CASE WHEN t.target_published IS NULL THEN 1 WHEN t.target_published THEN 0 ELSE 2 END AS state_code,
       CASE WHEN t.target_published IS NULL THEN 'missing' WHEN t.target_published THEN 'published' ELSE 'unfinished' END AS state
FROM {src} v LEFT JOIN {tgt} t
  ON v.repository = t.repository AND v.package_type = t.package_type AND v.target_namespace = t.target_namespace
 AND v.target_package = t.target_package AND v.version = t.version"""


def _plan(src: str, ledger: bool = True, led: str = "led_pub") -> str:
    forb = f"(regexp_matches(s.package, {FORBIDDEN}) OR regexp_matches(s.version, {FORBIDDEN}))"
    if ledger:
        join = f"LEFT JOIN {led} l ON s.repository = l.repository AND s.package = l.package AND s.version = l.version"
        lp = "l.repository IS NOT NULL"
    else:
        join, lp = "", "false"
    return f"""SELECT s.*, {forb} AS forbidden, {lp} AS ledger_published,
       CASE WHEN {lp} THEN 'skip_ledger'
            WHEN s.state_code = 0 THEN 'skip_published'
            WHEN {forb} THEN 'reject'
            WHEN s.state_code = 2 THEN 'wipe_publish'
            ELSE 'publish' END AS decision
FROM {src} s {join}"""


PARSED = """SELECT request_id, repository, CAST(pos AS INTEGER) AS pos, token,
       split_part(token, ':', 1) AS package,
       CASE WHEN token <> '' AND length(token) - length(replace(token, ':', '')) = 1 AND split_part(token, ':', 2) <> ''
            THEN split_part(token, ':', 2) END AS version,
       CASE WHEN token = '' THEN 'empty'
            WHEN length(token) - length(replace(token, ':', '')) = 0 THEN 'all_versions'
            WHEN length(token) - length(replace(token, ':', '')) > 1 THEN 'malformed'
            WHEN split_part(token, ':', 2) = '' THEN 'blank_version'
            ELSE 'one_version' END AS kind
FROM (SELECT request_id, repository, unnest(string_split(packages, ' ')) AS token,
             unnest(range(len(string_split(packages, ' ')))) AS pos FROM fx_requests)"""

# name -> (sql, deps)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "cat": (
        "SELECT repo_key AS repository, repo_type, lower(package_type) AS package_type FROM fx_repositories",
        ("fx_repositories",),
    ),
    "scope_reps": (
        "SELECT repository, package_type FROM cat WHERE repo_type = 'LOCAL' AND repository <> 'TOTAL' "
        "AND package_type IN ('maven', 'pypi', 'npm')",
        ("cat",),
    ),
    "inv0": (
        """SELECT f.repository, c.package_type, f.uri, f.size_bytes,
       split_part(f.uri, '/', -1) AS file_name,
       CASE WHEN c.package_type = 'npm' AND f.uri NOT LIKE '/.npm/%'
              THEN split_part(regexp_replace(f.uri, '^/', ''), '/-/', 1)
            WHEN c.package_type IN ('maven', 'pypi') AND NOT contains(f.uri, 'maven-metadata.xml')
                 AND length(regexp_replace(f.uri, '^/', '')) - length(replace(regexp_replace(f.uri, '^/', ''), '/', '')) + 1 > 2
              THEN regexp_replace(regexp_replace(f.uri, '^/', ''), '/[^/]*/[^/]*$', '')
       END AS package
FROM fx_files f JOIN cat c ON f.repository = c.repository""",
        ("fx_files", "cat"),
    ),
    "inv1": (_inv1("contains", "inv0"), ("inv0",)),
    "inv": (_inv("contains", "inv1"), ("inv1",)),
    "inv1_suffix": (_inv1("suffix", "inv0"), ("inv0",)),
    "inv_suffix": (_inv("suffix", "inv1_suffix"), ("inv1_suffix",)),
    "inv_scope": ("SELECT * FROM inv WHERE repository IN (SELECT repository FROM scope_reps)", ("inv", "scope_reps")),
    "inv_scope_suffix": (
        "SELECT * FROM inv_suffix WHERE repository IN (SELECT repository FROM scope_reps)",
        ("inv_suffix", "scope_reps"),
    ),
    "pkgs": ("SELECT DISTINCT repository, package_type, package FROM inv_scope WHERE package IS NOT NULL", ("inv_scope",)),
    "vers0": (
        "SELECT DISTINCT repository, package_type, package, version FROM inv_scope WHERE version IS NOT NULL",
        ("inv_scope",),
    ),
    "vers": (_vers("inv_scope"), ("inv_scope",)),
    "vcoord": (_vcoord("vers"), ("vers",)),
    "tgt": (
        """SELECT repository, format AS package_type, coalesce(namespace, '') AS target_namespace, package AS target_package, version,
       bool_or(status = 'Published') AS target_published
FROM fx_target GROUP BY ALL""",
        ("fx_target",),
    ),
    "state": (_state("vcoord"), ("vcoord", "tgt")),
    "led_pub": (
        "SELECT DISTINCT repository, package, version FROM fx_ledger_versions WHERE published = 1",
        ("fx_ledger_versions",),
    ),
    "plan": (_plan("state"), ("state", "led_pub")),
    "parsed": (PARSED, ("fx_requests",)),
    "pr": (
        """SELECT repository, package, bool_and(coalesce(published = 1, false)) AS all_published, count(*) AS n_versions,
       count(*) FILTER (WHERE coalesce(published = 1, false)) AS n_published,
       bool_or(coalesce(publish_failed = 1, false)) AS any_failed
FROM fx_ledger_versions GROUP BY repository, package""",
        ("fx_ledger_versions",),
    ),
    "rr": (
        """SELECT repository, bool_and(all_published) AS all_published, count(*) AS n_packages,
       count(*) FILTER (WHERE all_published) AS n_packages_published
FROM pr GROUP BY repository""",
        ("pr",),
    ),
    "errs": (
        """SELECT repository, package, version, count(*) AS n_failed,
       replace(string_agg(CAST(status_code AS VARCHAR) || ', ' || reason || ', ' || body, ' -- ' ORDER BY file_name, upload_id), '''', '"') AS error_text
FROM fx_responses WHERE status_code >= 400 GROUP BY repository, package, version""",
        ("fx_responses",),
    ),
    "fetched": (
        "SELECT DISTINCT repository, package FROM fx_ledger_packages WHERE all_versions_fetched = 1",
        ("fx_ledger_packages",),
    ),
    "npm_states": (
        f"""SELECT *, '{DRYRUN_HOST}/' || repository || '/' || package || '/' || split_part(package || '-' || version || '.tgz', '/', -1) AS tarball,
       CASE WHEN metadata IS NULL THEN 'no_metadata' WHEN NOT json_valid(metadata) THEN 'invalid_json'
            WHEN coalesce(CAST(json_extract(metadata, '$.versions."' || version || '"') AS VARCHAR), '{{}}') = '{{}}' THEN 'missing_from_metadata'
            WHEN json_extract(metadata, '$.versions."' || version || '".dist') IS NULL THEN 'no_dist' END AS reason
FROM fx_npm_metadata""",
        ("fx_npm_metadata",),
    ),
    "waves": (
        """SELECT repository, package,
       CAST(row_number() OVER (PARTITION BY repository ORDER BY package) - 1 AS BIGINT) AS position,
       CAST(floor((row_number() OVER (PARTITION BY repository ORDER BY package) - 1) / 4) AS BIGINT) AS wave
FROM (SELECT DISTINCT repository, package FROM pkgs)""",
        ("pkgs",),
    ),
}

CTES |= {f"{n}_all": (CTES[n][0].replace(src, f"{src}_all"), (f"{src}_all",)) for n, src in (("tgt", "fx_target"), ("led_pub", "fx_ledger_versions"))}


def _closure(names) -> list[str]:
    order: list[str] = []
    seen: set[str] = set()

    def add(n: str) -> None:
        if n in seen:
            return
        deps = FIXTURES[n][1] if n in FIXTURES else CTES[n][1]
        for d in deps:
            add(d)
        seen.add(n)
        order.append(n)

    for n in names:
        add(n)
    return order


def build(select: str, *needs: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH <fixtures and CTEs needed, in order>[, extra...] <select>``."""
    items = []
    for n in _closure(needs):
        sql = FIXTURES[n][0] if n in FIXTURES else CTES[n][0]
        items.append(f"{n} AS ({sql.strip()})")
    for name, sql in extra:
        items.append(f"{name} AS ({sql.strip()})")
    if not items:
        return select.strip()
    return "WITH " + ",\n".join(items) + "\n" + select.strip()


ORACLES: dict[str, str] = {}


def oracle(name: str, select: str, *needs: str, extra: tuple[tuple[str, str], ...] = ()) -> None:
    ORACLES[name] = build(select, *needs, extra=extra)


PLAN_COLS = ("repository, package_type, package, version, namespace, target_namespace, target_package, "
             "n_files, copy_bytes, state_code, state, forbidden, ledger_published, decision")
VER = "repository, package, version"

# === 2.1 scans, sources, sinks =============================================================
oracle("src_repositories", "SELECT repo_key, repo_type, package_type FROM fx_repositories", "fx_repositories")
oracle("src_files", "SELECT repository, uri, size_bytes FROM fx_files", "fx_files")
oracle("package_files",
       "SELECT repository, package_type, package, uri, file_name, size_bytes FROM inv_scope WHERE package IS NOT NULL",
       "inv_scope")
oracle(
    "requests_found",
    """SELECT p.request_id, p.pos, p.repository, p.package, p.kind,
       CASE WHEN l.repository IS NOT NULL THEN 'ledger' WHEN s.repository IS NOT NULL THEN 'source' END AS found_in,
       (l.repository IS NOT NULL OR s.repository IS NOT NULL) AS found
FROM parsed p
LEFT JOIN (SELECT DISTINCT repository, package FROM pkgs) s ON p.repository = s.repository AND p.package = s.package
LEFT JOIN (SELECT DISTINCT repository, package FROM fx_ledger_packages) l ON p.repository = l.repository AND p.package = l.package""",
    "parsed", "pkgs", "fx_ledger_packages",
)
oracle("tgt_repositories", "SELECT DISTINCT repository AS name FROM fx_target_all", "fx_target_all")
oracle("tgt_versions", "SELECT repository, format, namespace, package, version, status FROM fx_target_all", "fx_target_all")
oracle("target_pages", "SELECT repository, format, namespace, package, version, status FROM fx_target", "fx_target")
oracle(
    "target_page_rejects",
    """SELECT page || '/' || kind AS page, repository, CASE kind WHEN 'cut' THEN 'malformed' WHEN 'blank' THEN 'empty' ELSE 'repeated' END AS reason,
       CAST(CASE kind WHEN 'blank' THEN 1 WHEN 'cut' THEN strlen(doc) - 2 ELSE strlen(doc) END AS BIGINT) AS length,
       CASE kind WHEN 'cut' THEN left(doc, length(doc) - 2) END AS _corrupt_record
FROM (SELECT *, CASE length(page) % 3 WHEN 0 THEN 'repeated' WHEN 1 THEN 'cut' ELSE 'blank' END AS kind
      FROM (SELECT repository, concat_ws('/', repository, format, namespace, package, CAST(n AS VARCHAR)) AS page,
                   '{"format":"' || format || '","namespace":"' || namespace || '","package":"' || package || '","versions":['
                   || string_agg('{"version":"' || version || '","status":"' || status || '"}', ',' ORDER BY version) || ']}' AS doc
            FROM (SELECT *, (row_number() OVER (PARTITION BY repository, format, namespace, package ORDER BY version) - 1) // 20 AS n FROM fx_target)
            GROUP BY repository, format, namespace, package, n))""",
    "fx_target",
)
oracle(
    "npm_documents",
    """SELECT doc_id, repository, package, version, json_extract_string(j, '$.name') AS doc_name,
       CAST(len(json_keys(j, '$.versions')) AS INTEGER) AS n_versions,
       coalesce(list_contains(json_keys(j, '$.versions'), version), false) AS has_version
FROM (SELECT *, CASE WHEN json_valid(metadata) THEN metadata END AS j FROM fx_npm_metadata)""",
    "fx_npm_metadata",
)
oracle(
    "artifact_checksums",
    "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length, sha256(text || chr(10)) AS sha256 FROM documents",
)
oracle(
    "copy_artifacts",
    "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length, sha256(text || chr(10)) AS sha256, true AS ok FROM documents",
)
oracle(
    "artifact_checksums_streamed",
    "SELECT doc_id, CAST(strlen(text) + 1 AS BIGINT) AS length, sha256(text || chr(10)) AS sha256 FROM documents",
)
oracle(
    "ledger_clean",
    """SELECT 'before' AS moment, repository, count(*) AS n_versions FROM fx_ledger_versions GROUP BY repository
UNION ALL SELECT 'after', '', 0""",
    "fx_ledger_versions",
)
MERGED = ("merged", """SELECT l.repository, l.package, l.version, l.published, CASE WHEN e.repository IS NOT NULL THEN 1 ELSE l.publish_failed END AS publish_failed,
       coalesce(e.error_text, l.publish_error) AS publish_error
FROM fx_ledger_versions l LEFT JOIN errs e ON l.repository = e.repository AND l.package = e.package AND l.version = e.version""")
oracle("ledger_merged", "SELECT * FROM merged", "fx_ledger_versions", "errs", extra=(MERGED,))
oracle("ledger_delta", "SELECT * FROM merged EXCEPT ALL SELECT * FROM fx_ledger_versions", "fx_ledger_versions", "errs", extra=(MERGED,))
oracle(
    "migration_plan",
    f"""SELECT {', '.join('p.' + c.strip() for c in PLAN_COLS.split(','))},
       '{DRYRUN_HOST}/' || p.repository AS endpoint, w.wave
FROM plan p LEFT JOIN waves w ON p.repository = w.repository AND p.package = w.package""",
    "plan", "waves",
)

# === 2.2 projections =======================================================================
oracle("path_basename", "SELECT repository, uri, split_part(uri, '/', -1) AS file_name FROM fx_files", "fx_files")
oracle(
    "npm_package_from_path",
    """SELECT repository, uri, split_part(regexp_replace(uri, '^/', ''), '/-/', 1) AS package
FROM fx_files WHERE package_type = 'npm' AND uri NOT LIKE '/.npm/%'""",
    "fx_files",
)
oracle(
    "path_package",
    """SELECT repository, uri,
       CASE WHEN length(regexp_replace(uri, '^/', '')) - length(replace(regexp_replace(uri, '^/', ''), '/', '')) + 1 > 2
            THEN regexp_replace(regexp_replace(uri, '^/', ''), '/[^/]*/[^/]*$', '') END AS package
FROM fx_files WHERE package_type IN ('maven', 'pypi') AND NOT contains(uri, 'maven-metadata.xml')""",
    "fx_files",
)
oracle(
    "npm_version_from_path",
    """SELECT repository, uri, package,
       CASE WHEN suffix(file_name, '.tgz') AND starts_with(file_name, split_part(package, '/', -1) || '-')
                 AND length(file_name) > length(split_part(package, '/', -1)) + 5
            THEN substr(file_name, length(split_part(package, '/', -1)) + 2,
                        length(file_name) - length(split_part(package, '/', -1)) - 5) END AS version
FROM (SELECT repository, uri, split_part(uri, '/', -1) AS file_name,
             split_part(regexp_replace(uri, '^/', ''), '/-/', 1) AS package
      FROM fx_files WHERE package_type = 'npm' AND uri NOT LIKE '/.npm/%')""",
    "fx_files",
)
oracle(
    "path_version",
    f"""SELECT repository, uri, split_part(uri, '/', -2) AS version FROM fx_files
WHERE package_type IN ('maven', 'pypi') AND {_ext(DISCOVER, 'contains')}""",
    "fx_files",
)
oracle(
    "maven_namespace",
    """SELECT repository, package, CASE WHEN contains(package, '/') THEN regexp_replace(package, '/[^/]*$', '') ELSE '' END AS namespace
FROM pkgs WHERE package_type = 'maven'""",
    "pkgs",
)
oracle(
    "target_coordinates",
    "SELECT repository, package_type, package, version, namespace, target_namespace, target_package FROM vcoord",
    "vcoord",
)
oracle(
    "download_uri",
    f"""SELECT repository, uri, storage_uri, replace(storage_uri, 'api/storage/', '') AS download_uri
FROM (SELECT repository, uri, '{SOURCE_BASE}/api/storage/' || repository || uri AS storage_uri FROM fx_files)""",
    "fx_files",
)
oracle(
    "maven_metadata_uri",
    """SELECT DISTINCT repository, package, version, regexp_replace(uri, '/[^/]*$', '/maven-metadata.xml') AS metadata_uri
FROM inv_scope WHERE copy AND package_type = 'maven'""",
    "inv_scope",
)
oracle(
    "upload_url",
    f"""SELECT repository, package_type, package, version, file_name,
       CASE package_type WHEN 'maven' THEN endpoint || '/' || package || '/' || version || '/' || file_name
                         WHEN 'pypi' THEN endpoint
                         WHEN 'npm' THEN endpoint || '/' || replace(package, '/', '%2f') END AS upload_url
FROM (SELECT *, '{DRYRUN_HOST}/' || repository AS endpoint FROM inv_scope WHERE copy)""",
    "inv_scope",
)
oracle(
    "source_url",
    f"""SELECT repository, uri, '{SOURCE_BASE}/' || repository || uri AS source_url, '{DRYRUN_HOST}/' || repository AS endpoint
FROM fx_files""",
    "fx_files",
)
oracle(
    "staging_name",
    """SELECT repository, package, version,
       concat_ws('/', repository, namespace, split_part(package, '/', -1) || '-' || version) AS staging_name,
       CASE WHEN package_type = 'npm' THEN package || '-' || version || '.tgz' END AS tarball_name
FROM (SELECT *, CASE WHEN package_type = 'maven' AND contains(package, '/') THEN regexp_replace(package, '/[^/]*$', '') ELSE '' END AS namespace
      FROM vers0)""",
    "vers0",
)
oracle(
    "entity_keys",
    """SELECT count(*) AS n_rows,
       count(DISTINCT repository || '/' || package) AS n_package_keys,
       count(DISTINCT repository || '/' || package || ':' || version) AS n_version_keys,
       count(DISTINCT repository) AS n_repository_keys,
       CAST(96 AS INTEGER) AS key_length
FROM fx_ledger_versions""",
    "fx_ledger_versions",
)
oracle(
    "repository_package",
    "SELECT repository, package, repository || '/' || package AS repository_package FROM fx_ledger_packages_all",
    "fx_ledger_packages_all",
)
oracle(
    "error_text",
    """SELECT upload_id, replace(CAST(status_code AS VARCHAR) || ', ' || reason || ', ' || body, '''', '"') AS error_text
FROM fx_responses WHERE status_code >= 400""",
    "fx_responses",
)
oracle("requests_parsed", "SELECT request_id, repository, pos, token, package, version, kind FROM parsed", "parsed")

# === 2.3 filters ===========================================================================
oracle(
    "local_repositories",
    "SELECT repository, repo_type, package_type FROM cat WHERE repo_type = 'LOCAL' AND repository <> 'TOTAL'",
    "cat",
)
oracle(
    "supported_repositories",
    """SELECT repository, repo_type, package_type, reason, reason IS NULL AS supported
FROM (SELECT *, CASE WHEN repository = 'TOTAL' THEN 'total_row'
                     WHEN repo_type <> 'LOCAL' THEN 'not_local'
                     WHEN package_type IS NULL OR package_type NOT IN ('maven', 'pypi', 'npm') THEN 'unsupported_type' END AS reason
      FROM cat)""",
    "cat",
)
oracle("npm_files", "SELECT repository, uri FROM fx_files WHERE package_type = 'npm' AND uri NOT LIKE '/.npm/%'", "fx_files")
oracle(
    "maven_files",
    "SELECT repository, uri FROM fx_files WHERE package_type = 'maven' AND NOT contains(uri, 'maven-metadata.xml')",
    "fx_files",
)
oracle(
    "discoverable_files",
    f"SELECT repository, uri FROM fx_files WHERE package_type IN ('maven', 'pypi') AND {_ext(DISCOVER, 'contains')}",
    "fx_files",
)
oracle(
    "discoverable_files_suffix",
    f"SELECT repository, uri FROM fx_files WHERE package_type IN ('maven', 'pypi') AND {_ext(DISCOVER, 'suffix')}",
    "fx_files",
)
oracle("pypi_version_files", "SELECT repository, package, version, uri FROM inv_scope WHERE copy AND package_type = 'pypi'", "inv_scope")
oracle("maven_version_files", "SELECT repository, package, version, uri FROM inv_scope WHERE copy AND package_type = 'maven'", "inv_scope")
oracle(
    "maven_version_files_suffix",
    "SELECT repository, package, version, uri FROM inv_scope_suffix WHERE copy AND package_type = 'maven'",
    "inv_scope_suffix",
)
oracle(
    "npm_version_files",
    """SELECT repository, package, version, uri FROM inv_scope
WHERE package_type = 'npm' AND version IS NOT NULL AND contains(uri, split_part(package, '/', -1) || '-' || version || '.tgz')""",
    "inv_scope",
)
oracle(
    "forbidden_names",
    f"""SELECT repository, package, version FROM vers0
WHERE regexp_matches(package, {FORBIDDEN}) OR regexp_matches(version, {FORBIDDEN})""",
    "vers0",
)
oracle(
    "failed_uploads",
    "SELECT upload_id, repository, package, version, status_code, reason FROM fx_responses WHERE status_code >= 400",
    "fx_responses",
)

# === 2.4 joins =============================================================================
REQ_REPOS = ("req_repos", """SELECT DISTINCT repository FROM (
    SELECT repository FROM fx_requests
    UNION ALL SELECT upper(repository) FROM (SELECT DISTINCT repository FROM fx_requests))""")
REQ_KNOWN = ("req_known", """SELECT repository, repository IN (SELECT repository FROM cat) AS known FROM req_repos""")
oracle("unknown_repositories", "SELECT repository, known FROM req_known WHERE NOT known", "fx_requests", "cat",
       extra=(REQ_REPOS, REQ_KNOWN))
oracle("repositories_known", "SELECT coalesce(bool_and(known), true) AS all_known FROM req_known", "fx_requests", "cat",
       extra=(REQ_REPOS, REQ_KNOWN))
oracle(
    "files_with_type",
    "SELECT f.repository, f.uri, c.package_type, c.repo_type FROM fx_files f JOIN cat c ON f.repository = c.repository",
    "fx_files", "cat",
)
oracle(
    "repositories_to_create",
    """SELECT DISTINCT repository, 'create_repository' AS action FROM scope_reps
WHERE repository NOT IN (SELECT repository FROM fx_target)""",
    "scope_reps", "fx_target",
)
oracle(
    "version_state",
    """SELECT repository, package_type, package, version, namespace, target_namespace, target_package,
       n_files, copy_bytes, state_code, state FROM state""",
    "state",
)
oracle(
    "pending_versions",
    """SELECT v.* FROM vers0 v
WHERE NOT EXISTS (SELECT 1 FROM led_pub l WHERE l.repository = v.repository AND l.package = v.package AND l.version = v.version)""",
    "vers0", "led_pub",
)
oracle(
    "ledger_add_packages",
    """SELECT * FROM fx_ledger_packages
UNION ALL
SELECT repository, package, 0, 0 FROM (SELECT DISTINCT repository, package FROM pkgs) n
WHERE NOT EXISTS (SELECT 1 FROM fx_ledger_packages l WHERE l.repository = n.repository AND l.package = n.package)""",
    "fx_ledger_packages", "pkgs",
)
oracle(
    "ledger_add_versions",
    """SELECT * FROM fx_ledger_versions
UNION ALL
SELECT repository, package, version, 0, 0, '' FROM (SELECT DISTINCT repository, package, version FROM vers0) n
WHERE NOT EXISTS (SELECT 1 FROM fx_ledger_versions l
                  WHERE l.repository = n.repository AND l.package = n.package AND l.version = n.version)""",
    "fx_ledger_versions", "vers0",
)
oracle(
    "ledger_add_repositories",
    """SELECT * FROM fx_ledger_repositories
UNION ALL
SELECT repository, 0, 0, 0 FROM (SELECT DISTINCT repository FROM scope_reps) n
WHERE repository NOT IN (SELECT repository FROM fx_ledger_repositories)""",
    "fx_ledger_repositories", "scope_reps",
)
oracle(
    "npm_missing_metadata",
    """SELECT doc_id, repository, package, version, 400 AS status_code, reason FROM npm_states WHERE reason IS NOT NULL""",
    "npm_states",
)
oracle(
    "publish_failures",
    """SELECT repository, package, version, publish_error,
       'Repository ' || repository || ' package ' || package || ' version ' || version || ' failed to publish earlier: '
       || publish_error || ' -- fix the package, then request this version by name and version.' AS advice
FROM fx_ledger_versions WHERE published = 0 AND publish_failed = 1""",
    "fx_ledger_versions",
)
oracle(
    "plan_files",
    """SELECT i.repository, i.package_type, i.package, i.version, p.decision, i.uri, i.file_name, i.size_bytes
FROM inv_scope i JOIN plan p ON i.repository = p.repository AND i.package = p.package AND i.version = p.version
WHERE i.copy AND p.decision IN ('publish', 'wipe_publish')""",
    "inv_scope", "plan",
)

# === 2.5 aggregations ======================================================================
oracle("packages", "SELECT * FROM pkgs", "pkgs")
oracle("versions", "SELECT * FROM vers0", "vers0")
oracle("package_rollup", "SELECT * FROM pr", "pr")
oracle("repository_rollup", "SELECT * FROM rr", "rr")
oracle(
    "repository_failures",
    "SELECT repository, CAST(coalesce(max(publish_failed), 0) AS INTEGER) AS publish_failed FROM fx_ledger_versions GROUP BY repository",
    "fx_ledger_versions",
)
oracle("publish_errors", "SELECT * FROM errs", "errs")
oracle(
    "plan_summary",
    """SELECT repository, package_type, decision, count(*) AS n_versions,
       CAST(sum(n_files) AS BIGINT) AS n_files, CAST(sum(copy_bytes) AS BIGINT) AS total_bytes
FROM plan GROUP BY repository, package_type, decision""",
    "plan",
)

# === 2.6 windows ===========================================================================
oracle("migration_waves", "SELECT repository, package, position, wave FROM waves", "waves")
RUNS = ("runs", """SELECT repository, package, version, published, publish_failed, publish_error, 1 AS run_id FROM fx_ledger_versions
UNION ALL SELECT repository, package, version, 0, 1, error_text, 2 FROM errs""")
oracle(
    "ledger_current",
    """SELECT repository, package, version, arg_max(published, run_id) AS published,
       arg_max(publish_failed, run_id) AS publish_failed, arg_max(publish_error, run_id) AS publish_error,
       max(run_id) AS run_id
FROM runs GROUP BY repository, package, version""",
    "fx_ledger_versions", "errs", extra=(RUNS,),
)

# === 2.8 set operations ====================================================================
oracle(
    "package_source",
    """SELECT DISTINCT * FROM (
  SELECT repository, package_type, package, version, 'listing' AS source FROM vers0 v
  WHERE NOT EXISTS (SELECT 1 FROM fetched f WHERE f.repository = v.repository AND f.package = v.package) AND (repository NOT IN (SELECT repository FROM fx_ledger_repositories WHERE all_versions_fetched = 1)
    OR EXISTS (SELECT 1 FROM fx_ledger_packages p WHERE p.repository = v.repository AND p.package = v.package))
  UNION ALL
  SELECT l.repository, s.package_type, l.package, l.version, 'ledger' AS source
  FROM fx_ledger_versions l JOIN scope_reps s ON l.repository = s.repository
  WHERE EXISTS (SELECT 1 FROM fetched f WHERE f.repository = l.repository AND f.package = l.package))""",
    "vers0", "fetched", "fx_ledger_versions", "fx_ledger_packages", "fx_ledger_repositories", "scope_reps",
)

# === 2.9 arrays, maps, JSON ================================================================
FORMS_OK = ("forms_ok", "SELECT * FROM fx_form_metadata WHERE json_valid(form) AND json_type(form) = 'OBJECT'")
oracle(
    "form_fields",
    """SELECT doc_id, unnest([':action', 'protocol_version', 'name', 'version', 'metadata_version', 'yanked', 'maintainer', 'classifiers', 'classifiers',
                       'gpg_signature', 'content', 'requires']) AS key,
       unnest(['file_upload', '1', package, version, '2.1', 'false', NULL, json_extract_string(form, '$.classifiers[0]'), NULL,
               '["a","b"]', 'whole', '{"python":">=3"}']) AS value
FROM forms_ok""",
    "fx_form_metadata", extra=(FORMS_OK,),
)
oracle(
    "form_rejects",
    """SELECT doc_id, CASE WHEN form IS NULL THEN 'no_form' WHEN json_valid(form) THEN 'not_an_object' ELSE 'invalid_json' END AS reason
FROM fx_form_metadata WHERE form IS NULL OR NOT json_valid(form) OR json_type(form) <> 'OBJECT'""",
    "fx_form_metadata",
)
oracle(
    "npm_publish_doc",
    """SELECT doc_id, CASE WHEN json_valid(metadata) THEN regexp_replace(metadata, '"_rev":"r[0-9]+",', '') END AS publish_doc FROM fx_npm_metadata""",
    "fx_npm_metadata",
)
oracle(
    "npm_single_version",
    """SELECT doc_id, version,
       CASE WHEN reason IS NULL
            THEN replace(regexp_extract(metadata, '"versions":(.*),"time"', 1), '"0.0.0":{"dist":{"tarball":"http://old/0"}},', '') END AS versions_kept
FROM npm_states""",
    "npm_states",
)
oracle("npm_tarball", "SELECT doc_id, version, CASE WHEN reason IS NULL THEN tarball END AS tarball FROM npm_states", "npm_states")
oracle(
    "npm_document",
    """SELECT doc_id, reason,
       CASE WHEN reason IS NULL THEN substr(d, 1, length(d) - 1) || ',"_attachments":{"' || package || '-' || version
            || '.tgz":{"content_type":"application/octet-stream","data":"' || to_base64(encode(package || ' ' || version))
            || '","length":"' || CAST(strlen(package || ' ' || version) AS VARCHAR) || '"}}}' END AS document
FROM (SELECT *, replace(replace(replace(regexp_replace(metadata, '"_rev":"r[0-9]+",', ''), '"0.0.0":{"dist":{"tarball":"http://old/0"}},', ''),
                        '"http://old/' || version || '"', '"' || tarball || '"'), ',"_attachments":{}', '') AS d FROM npm_states)""",
    "npm_states",
)
oracle(
    "npm_attachment",
    """SELECT doc_id, 'doc-' || CAST(doc_id AS VARCHAR) || '.tgz' AS attachment, 'application/octet-stream' AS content_type,
       to_base64(encode(text)) AS data, CAST(octet_length(encode(text)) AS VARCHAR) AS length
FROM documents""",
)

# === 2.10 ledger writes ====================================================================
oracle(
    "ledger_refresh",
    """SELECT repository,
       CASE WHEN repository IN (SELECT repository FROM fx_requests) THEN 0 ELSE 1 END AS all_versions_fetched,
       CASE WHEN repository IN (SELECT repository FROM fx_requests) THEN 0 ELSE all_versions_published END AS all_versions_published,
       publish_failed
FROM fx_ledger_repositories_all""",
    "fx_ledger_repositories_all", "fx_requests",
)
LED_PK = ("led_pk", """SELECT * FROM fx_ledger_packages
UNION ALL
SELECT repository, package, 0, 0 FROM (SELECT DISTINCT repository, package FROM pkgs) n
WHERE NOT EXISTS (SELECT 1 FROM fx_ledger_packages l WHERE l.repository = n.repository AND l.package = n.package)""")
oracle(
    "ledger_mark_fetched",
    """SELECT repository, package,
       CASE WHEN (repository, package) IN (SELECT repository, package FROM inv_scope WHERE version IS NOT NULL AND package IS NOT NULL)
            THEN 1 ELSE all_versions_fetched END AS all_versions_fetched,
       all_versions_published
FROM led_pk""",
    "fx_ledger_packages", "pkgs", "inv_scope", extra=(LED_PK,),
)
oracle(
    "ledger_mark_package_published",
    """SELECT repository, package, all_versions_fetched,
       CASE WHEN (repository, package) IN (SELECT repository, package FROM pr WHERE all_published) THEN 1 ELSE all_versions_published END
         AS all_versions_published
FROM fx_ledger_packages""",
    "fx_ledger_packages", "pr",
)
oracle(
    "ledger_upsert_published",
    """SELECT coalesce(l.repository, p.repository) AS repository, coalesce(l.package, p.package) AS package,
       coalesce(l.version, p.version) AS version,
       CASE WHEN p.repository IS NOT NULL THEN 1 ELSE l.published END AS published,
       coalesce(l.publish_failed, 0) AS publish_failed, coalesce(l.publish_error, '') AS publish_error
FROM fx_ledger_versions l
FULL OUTER JOIN (SELECT DISTINCT repository, package, version FROM state WHERE state_code = 0) p
  ON l.repository = p.repository AND l.package = p.package AND l.version = p.version""",
    "fx_ledger_versions", "state",
)
oracle(
    "ledger_mark_failed",
    """SELECT repository, package, version, published,
       CASE WHEN (repository, package, version) IN (SELECT repository, package, version FROM fx_responses WHERE status_code >= 400)
            THEN 1 ELSE publish_failed END AS publish_failed,
       publish_error
FROM fx_ledger_versions""",
    "fx_ledger_versions", "fx_responses",
)
oracle(
    "ledger_mark_repo_failed",
    """SELECT repository, all_versions_fetched, all_versions_published,
       CASE WHEN repository IN (SELECT repository FROM fx_responses WHERE status_code >= 400) THEN 1 ELSE publish_failed END AS publish_failed
FROM fx_ledger_repositories""",
    "fx_ledger_repositories", "fx_responses",
)
oracle(
    "ledger_mark_errors",
    """SELECT l.repository, l.package, l.version, l.published, l.publish_failed, coalesce(e.error_text, l.publish_error) AS publish_error
FROM fx_ledger_versions l LEFT JOIN errs e ON l.repository = e.repository AND l.package = e.package AND l.version = e.version""",
    "fx_ledger_versions", "errs",
)
oracle(
    "ledger_mark_repo_fetched",
    """SELECT repository,
       CASE WHEN repository IN (SELECT repository FROM fx_ledger_packages GROUP BY repository HAVING bool_and(all_versions_fetched = 1))
            THEN 1 ELSE all_versions_fetched END AS all_versions_fetched,
       all_versions_published, publish_failed
FROM fx_ledger_repositories""",
    "fx_ledger_repositories", "fx_ledger_packages",
)
oracle(
    "ledger_mark_repo_published",
    """SELECT repository, all_versions_fetched,
       CASE WHEN repository IN (SELECT repository FROM rr WHERE all_published) THEN 1 ELSE all_versions_published END
         AS all_versions_published,
       publish_failed
FROM fx_ledger_repositories""",
    "fx_ledger_repositories", "rr",
)

# === 2.11 ledger reads =====================================================================
oracle(
    "known_packages",
    "SELECT * FROM pkgs p WHERE EXISTS (SELECT 1 FROM fx_ledger_packages l WHERE l.repository = p.repository AND l.package = p.package)",
    "pkgs", "fx_ledger_packages",
)
oracle(
    "known_versions",
    """SELECT * FROM vers0 v WHERE EXISTS (SELECT 1 FROM fx_ledger_versions_all l
   WHERE l.repository = v.repository AND l.package = v.package AND l.version = v.version)""",
    "vers0", "fx_ledger_versions_all",
)
oracle(
    "known_repositories",
    "SELECT * FROM scope_reps WHERE repository IN (SELECT repository FROM fx_ledger_repositories)",
    "scope_reps", "fx_ledger_repositories",
)
oracle("failed_repositories", "SELECT repository FROM fx_ledger_repositories WHERE publish_failed = 1", "fx_ledger_repositories")
oracle("fetched_packages", "SELECT repository, package FROM fx_ledger_packages WHERE all_versions_fetched = 1", "fx_ledger_packages")
oracle(
    "fetched_repositories",
    """SELECT repository FROM fx_ledger_repositories_all
WHERE repository IN (SELECT repository FROM fx_requests) OR all_versions_fetched = 1""",
    "fx_ledger_repositories_all", "fx_requests",
)
oracle(
    "open_repositories",
    """SELECT * FROM scope_reps WHERE repository NOT IN
  (SELECT repository FROM fx_ledger_repositories WHERE publish_failed = 0 OR all_versions_published = 1)""",
    "scope_reps", "fx_ledger_repositories",
)
oracle("ledger_packages", "SELECT DISTINCT repository, package FROM fx_ledger_packages_all", "fx_ledger_packages_all")
oracle("ledger_versions", f"SELECT DISTINCT {VER} FROM fx_ledger_versions_all", "fx_ledger_versions_all")
oracle(
    "published_packages",
    """SELECT repository, package FROM fx_ledger_packages
WHERE all_versions_published = 1 OR (repository, package) IN (SELECT repository, package FROM pr WHERE all_published)""",
    "fx_ledger_packages", "pr",
)
oracle("published_versions", f"SELECT {VER} FROM fx_ledger_versions WHERE published = 1", "fx_ledger_versions")
oracle("unpublished_versions", f"SELECT {VER} FROM fx_ledger_versions WHERE published = 0", "fx_ledger_versions")

# === 2.12 jobs =============================================================================
oracle(
    "migration_actions",
    """SELECT repository, package_type, package, version, decision,
       CAST(unnest(range(len(steps))) AS INTEGER) AS seq, unnest(steps) AS action
FROM (SELECT *, CASE decision
          WHEN 'skip_ledger' THEN ['skip']
          WHEN 'skip_published' THEN ['set_published']
          WHEN 'reject' THEN ['reject']
          WHEN 'wipe_publish' THEN list_concat(['wipe', 'publish'], tail)
          ELSE list_concat(['publish'], tail) END AS steps
      FROM (SELECT *, CASE WHEN package_type = 'maven' THEN ['copy_metadata', 'set_status'] ELSE []::VARCHAR[] END AS tail FROM plan))""",
    "plan",
)
RQ_CTES = (
    ("rq_pkg", """SELECT repository, package, bool_or(all_versions_fetched = 1) AS fetched, bool_or(all_versions_published = 1) AS done
FROM fx_ledger_packages GROUP BY repository, package"""),
    ("rq_found", """SELECT p.* FROM parsed p
WHERE EXISTS (SELECT 1 FROM pkgs s WHERE s.repository = p.repository AND s.package = p.package)
   OR EXISTS (SELECT 1 FROM fx_ledger_packages l WHERE l.repository = p.repository AND l.package = p.package)"""),
    ("rq_whole", """SELECT w.repository, w.package, v.version
FROM (SELECT DISTINCT repository, package FROM rq_found WHERE kind = 'all_versions') w
LEFT JOIN rq_pkg f ON w.repository = f.repository AND w.package = f.package
JOIN (SELECT repository, package, version, false AS from_ledger FROM vers0
      UNION ALL SELECT repository, package, version, true FROM fx_ledger_versions) v
  ON w.repository = v.repository AND w.package = v.package AND v.from_ledger = coalesce(f.fetched, false)
WHERE NOT coalesce(f.done, false)"""),
    ("rq_keys", """SELECT repository, package, version, bool_or(n) AS by_name, bool_or(NOT n) AS by_package
FROM (SELECT repository, package, version, true AS n FROM rq_found WHERE kind = 'one_version'
      UNION ALL SELECT *, false FROM rq_whole) GROUP BY repository, package, version"""),
    ("rq_vers", """SELECT k.repository, s.package_type, k.package, k.version, by_name, by_package, coalesce(v.n_files, 0) AS n_files, coalesce(v.copy_bytes, 0) AS copy_bytes
FROM rq_keys k JOIN scope_reps s ON k.repository = s.repository
LEFT JOIN vers v ON k.repository = v.repository AND k.package = v.package AND k.version = v.version"""),
    ("rq_vcoord", _vcoord("rq_vers")),
    ("rq_state", _state("rq_vcoord")),
    ("rq_plan", _plan("rq_state")),
)
RQ_NEEDS = ("parsed", "pkgs", "fx_ledger_packages", "fx_ledger_versions", "vers0", "vers", "scope_reps", "tgt", "led_pub")
oracle("requested_plan", f"SELECT {PLAN_COLS}, by_name, by_package FROM rq_plan", *RQ_NEEDS, extra=RQ_CTES)
oracle(
    "request_links",
    """SELECT f.request_id, f.pos, k.repository, k.package, k.version FROM rq_found f JOIN rq_vers k
  ON f.repository = k.repository AND f.package = k.package
 AND CASE f.kind WHEN 'one_version' THEN f.version = k.version WHEN 'all_versions' THEN k.by_package ELSE false END""",
    *RQ_NEEDS, extra=RQ_CTES,
)
REPO_CTES = (
    ("rp_inv", "SELECT * FROM inv_scope WHERE repository IN (SELECT repository FROM fx_requests)"),
    ("rp_vers", _vers("rp_inv")),
    ("rp_vcoord", _vcoord("rp_vers")),
    ("rp_state", _state("rp_vcoord", "tgt_all")),
    ("rp_plan", _plan("rp_state", led="led_pub_all")),
)
oracle("repository_plan", f"SELECT {PLAN_COLS} FROM rp_plan", "inv_scope", "fx_requests", "tgt_all", "led_pub_all", extra=REPO_CTES)
PC_CTES = (
    ("tgt_fresh", """SELECT repository, format AS package_type, namespace AS target_namespace, package AS target_package, version,
       bool_or(status = 'Published') AS target_published
FROM fx_fresh_target GROUP BY ALL"""),
    ("pc_tried", """SELECT repository, package_type, package, version, target_namespace, target_package FROM plan
WHERE decision IN ('publish', 'wipe_publish')"""),
    ("pc_state", _state("pc_tried", "tgt_fresh")),
)
oracle(
    "post_check",
    """SELECT repository, package_type, package, version, state_code = 0 AS published,
       CASE WHEN state_code = 0 THEN 0 ELSE 1 END AS publish_failed,
       CASE WHEN state_code = 0 THEN '' ELSE 'Package ' || package || ' ' || version
            || ' was not found with status Published in the target after upload; the version may not be valid for the target''s format.'
       END AS publish_error
FROM pc_state""",
    "plan", "fx_fresh_target", extra=PC_CTES,
)
RESUME_CTES = (
    ("rs_scope", """SELECT * FROM scope_reps
WHERE repository NOT IN (SELECT repository FROM fx_ledger_repositories WHERE all_versions_published = 1)"""),
    ("rs_inv", "SELECT * FROM inv WHERE repository IN (SELECT repository FROM rs_scope)"),
    ("rs_vers0", "SELECT DISTINCT repository, package_type, package, version FROM rs_inv WHERE version IS NOT NULL"),
    ("rs_src", """SELECT DISTINCT * FROM (
  SELECT repository, package_type, package, version, 'listing' AS source FROM rs_vers0 v
  WHERE NOT EXISTS (SELECT 1 FROM fetched f WHERE f.repository = v.repository AND f.package = v.package)
    AND (repository NOT IN (SELECT repository FROM fx_ledger_repositories WHERE all_versions_fetched = 1)
         OR EXISTS (SELECT 1 FROM fx_ledger_packages p WHERE p.repository = v.repository AND p.package = v.package))
  UNION ALL
  SELECT l.repository, s.package_type, l.package, l.version, 'ledger' AS source
  FROM fx_ledger_versions l JOIN rs_scope s ON l.repository = s.repository
  WHERE EXISTS (SELECT 1 FROM fetched f WHERE f.repository = l.repository AND f.package = l.package))"""),
    ("rs_src2", """SELECT * FROM rs_src s
WHERE NOT EXISTS (SELECT 1 FROM fx_ledger_packages p WHERE p.all_versions_published = 1
                  AND p.repository = s.repository AND p.package = s.package)
  AND NOT EXISTS (SELECT 1 FROM led_pub l WHERE l.repository = s.repository AND l.package = s.package AND l.version = s.version)"""),
    ("rs_stats", _vers("rs_inv")),
    ("rs_vers", """SELECT s.*, coalesce(t.n_files, 0) AS n_files, coalesce(t.copy_bytes, 0) AS copy_bytes
FROM rs_src2 s LEFT JOIN rs_stats t ON s.repository = t.repository AND s.package_type = t.package_type
 AND s.package = t.package AND s.version = t.version"""),
    ("rs_vcoord", _vcoord("rs_vers")),
    ("rs_state", _state("rs_vcoord")),
    ("rs_plan", _plan("rs_state", ledger=False)),
)
oracle(
    "resume_plan",
    """SELECT repository, package_type, package, version, source, n_files, copy_bytes, state_code, state, decision
FROM rs_plan WHERE decision <> 'skip_published'""",
    "scope_reps", "fx_ledger_repositories", "inv", "fetched", "fx_ledger_versions", "fx_ledger_packages", "led_pub", "tgt",
    extra=RESUME_CTES,
)
