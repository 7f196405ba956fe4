"""Inventory-shaped fixtures derived from the driver's test tables.

Every fixture is one SQL text that runs unchanged on Spark and on DuckDB, so the
oracle side can chain the very same text as CTEs.  Fixtures stand for the inputs
a migration reads (catalogue, listings, target states, ledger, requests, upload
responses, npm and form metadata).  The modulo terms shape the data (which
versions are unfinished, which requests malformed, ...).  Requests and responses
hold every row; target and ledger hold no docker rows (t = 3), a type that the
source tool refuses, and the metadata of a format only the rows of that type.
Requests of what the source has no file of (docker, and rows that are only
metadata) name a version, so that whole-package requests are of known packages.
The target lacks one repository and the ledger another; the ledger has two
repositories all published and one of them marked so, some packages fetched or
done, and only some repositories with a failure.  ``fx_scope`` names a third of
the repositories, ``fx_fresh_target`` is the target after a run.  The tables
named ``..._all`` lack no repository.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import stored

# Base tables each fixture reads.
BASE_TABLES = ("nation", "lineitem", "part", "documents")

# name -> (sql, dependencies).  Order of the dict is a valid build order.
FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_repositories": (
        """
SELECT concat('repo-', CAST(n_nationkey AS STRING)) AS repo_key,
       CASE WHEN n_nationkey % 6 = 5 THEN 'REMOTE' ELSE 'LOCAL' END AS repo_type,
       CASE n_nationkey % 4 WHEN 0 THEN 'Maven' WHEN 1 THEN 'Pypi' WHEN 2 THEN 'Npm' ELSE 'Docker' END AS package_type
FROM nation
UNION ALL SELECT 'TOTAL', 'NA', CAST(NULL AS STRING)
""",
        (),
    ),
    "fx_base": (
        """
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag,
       concat('repo-', CAST((l.l_suppkey * 7 + l.l_linenumber) % 25 AS STRING)) AS repository,
       ((l.l_suppkey * 7 + l.l_linenumber) % 25) % 4 AS t,
       concat('com/', lower(p.p_type)) AS grp,
       lower(replace(p.p_brand, '#', '')) AS scope,
       concat(replace(p.p_name, ' ', CASE WHEN p.p_partkey % 5 = 0 THEN '_' ELSE '-' END), '-', CAST(p.p_partkey AS STRING)) AS name,
       concat(CAST(l.l_linenumber AS STRING), '.', CAST(l.l_orderkey % 5 AS STRING), '.', CAST(l.l_partkey % 3 AS STRING),
              CASE WHEN l.l_orderkey % 23 = 0 THEN '+b1' WHEN l.l_orderkey % 19 = 0 THEN '-beta-2' ELSE '' END) AS version,
       CAST(floor(l.l_extendedprice) AS BIGINT) AS size_bytes
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""",
        (),
    ),
    "fx_files": (
        """
SELECT repository, CASE t WHEN 0 THEN 'maven' WHEN 1 THEN 'pypi' WHEN 2 THEN 'npm' ELSE 'docker' END AS package_type,
       CASE t
         WHEN 0 THEN CASE WHEN l_orderkey % 97 = 0 THEN concat('/', grp, '/', name, '/maven-metadata.xml')
                     ELSE concat('/', grp, '/', name, '/', version, '/', name, '-', version,
                          CASE l_returnflag WHEN 'A' THEN '.jar' WHEN 'N' THEN '.pom' ELSE '.jar.sha1' END) END
         WHEN 1 THEN concat('/', name, '/', version, '/', name, '-', version,
                          CASE l_returnflag WHEN 'A' THEN '.tar.gz' WHEN 'N' THEN '.whl' ELSE '.tar.gz.sha256' END)
         WHEN 2 THEN CASE WHEN l_orderkey % 97 = 0 THEN concat('/.npm/@', scope, '/', name, '/package.json')
                     ELSE concat('/@', scope, '/', name, '/-/@', scope, '/', name, '-', version, '.tgz') END
         ELSE concat('/', name, '/', version, '/manifest.json') END AS uri,
       size_bytes
FROM fx_base
""",
        ("fx_base",),
    ),
    "fx_target": (
        """
SELECT repository, format, namespace, package, version,
       CASE WHEN min(l_orderkey) % 4 = 0 THEN 'Unfinished' ELSE 'Published' END AS status
FROM (SELECT repository, version, l_orderkey,
        CASE t WHEN 0 THEN 'maven' WHEN 1 THEN 'pypi' ELSE 'npm' END AS format,
        CASE t WHEN 0 THEN replace(grp, '/', '.') WHEN 2 THEN scope ELSE '' END AS namespace,
        CASE t WHEN 1 THEN replace(lower(name), '_', '-') ELSE name END AS package
      FROM fx_base WHERE t <> 3 AND l_orderkey % 3 <> 0 AND repository <> 'repo-8') x
GROUP BY repository, format, namespace, package, version
""",
        ("fx_base",),
    ),
    "fx_fresh_target": (
        """
SELECT repository, format, namespace, package, version,
       CASE WHEN min(l_orderkey) % 5 = 2 THEN 'Unfinished' ELSE 'Published' END AS status
FROM (SELECT repository, version, l_orderkey,
        CASE t WHEN 0 THEN 'maven' WHEN 1 THEN 'pypi' ELSE 'npm' END AS format,
        CASE t WHEN 0 THEN replace(grp, '/', '.') WHEN 2 THEN scope ELSE '' END AS namespace,
        CASE t WHEN 1 THEN replace(lower(name), '_', '-') ELSE name END AS package
      FROM fx_base WHERE t <> 3 AND l_orderkey % 7 <> 0) x
GROUP BY repository, format, namespace, package, version
""",
        ("fx_base",),
    ),
    "fx_scope": (
        """
SELECT concat('repo-', CAST(n_nationkey AS STRING)) AS repository FROM nation WHERE n_nationkey % 3 = 0
""",
        (),
    ),
    "fx_ledger_versions": (
        """
SELECT repository, package, version,
       CASE WHEN repository IN ('repo-4', 'repo-13') THEN 1 WHEN min(l_orderkey) % 5 IN (0, 1) THEN 0 ELSE 1 END AS published,
       CASE WHEN repository IN ('repo-4', 'repo-13') THEN 0 WHEN min(l_orderkey) % 5 = 0 THEN 1 ELSE 0 END AS publish_failed,
       CASE WHEN repository IN ('repo-4', 'repo-13') THEN '' WHEN min(l_orderkey) % 5 = 0 THEN '400, Bad Request, rejected' ELSE '' END AS publish_error
FROM (SELECT repository, version, l_orderkey,
        CASE t WHEN 0 THEN concat(grp, '/', name) WHEN 2 THEN concat('@', scope, '/', name) ELSE name END AS package
      FROM fx_base WHERE t <> 3 AND l_orderkey % 2 = 0 AND repository <> 'repo-12') x
GROUP BY repository, package, version
""",
        ("fx_base",),
    ),
    "fx_ledger_packages": (
        """
SELECT repository, package,
       CASE WHEN repository IN ('repo-4', 'repo-9') OR length(package) % 3 <> 0 THEN 1 ELSE 0 END AS all_versions_fetched,
       CASE WHEN length(package) % 2 = 0 THEN min(published) ELSE 0 END AS all_versions_published
FROM fx_ledger_versions GROUP BY repository, package
""",
        ("fx_ledger_versions",),
    ),
    "fx_ledger_repositories": (
        """
SELECT repository, CASE WHEN repository IN ('repo-1', 'repo-4') THEN 1 ELSE 0 END AS all_versions_fetched,
       CASE WHEN repository = 'repo-4' THEN 1 ELSE 0 END AS all_versions_published, max(publish_failed) AS publish_failed
FROM fx_ledger_versions GROUP BY repository
""",
        ("fx_ledger_versions",),
    ),
    "fx_requests": (
        """
SELECT request_id, repository,
       concat(package,
              CASE WHEN t = 3 OR t <> 1 AND l_orderkey % 97 = 0 THEN concat(':', version) WHEN l_orderkey % 5 = 0 THEN ''
                   WHEN l_orderkey % 5 = 1 THEN ':' WHEN l_orderkey % 5 = 2 THEN concat(':', version, ':x') ELSE concat(':', version) END,
              CASE WHEN l_orderkey % 7 = 0 THEN concat(' ', scope, '-extra') ELSE '' END) AS packages
FROM (SELECT l_orderkey * 10 + l_linenumber AS request_id, repository, t, l_orderkey, scope, version,
        CASE t WHEN 0 THEN concat(grp, '/', name) WHEN 2 THEN concat('@', scope, '/', name) ELSE name END AS package
      FROM fx_base) x
""",
        ("fx_base",),
    ),
    "fx_responses": (
        """
SELECT l_orderkey * 10 + l_linenumber AS upload_id, repository,
       CASE t WHEN 0 THEN concat(grp, '/', name) WHEN 2 THEN concat('@', scope, '/', name) ELSE name END AS package, version,
       concat(name, '-', version, CASE t
         WHEN 0 THEN CASE l_returnflag WHEN 'A' THEN '.jar' WHEN 'N' THEN '.pom' ELSE '.war' END
         WHEN 1 THEN CASE l_returnflag WHEN 'A' THEN '.tar.gz' WHEN 'N' THEN '.whl' ELSE '.zip' END
         WHEN 2 THEN '.tgz' ELSE '.json' END) AS file_name,
       CASE WHEN l_orderkey % 11 = 0 THEN 409 WHEN l_orderkey % 13 = 0 THEN 503 ELSE 200 END AS status_code,
       CASE WHEN l_orderkey % 11 = 0 THEN 'Conflict' WHEN l_orderkey % 13 = 0 THEN 'Service Unavailable' ELSE 'OK' END AS reason,
       concat('order ', CAST(l_orderkey AS STRING)) AS body
FROM fx_base
""",
        ("fx_base",),
    ),
    "fx_npm_metadata": (
        """
SELECT l_orderkey * 10 + l_linenumber AS doc_id, repository, concat('@', scope, '/', name) AS package, version,
       CASE WHEN l_orderkey % 29 = 0 THEN concat('{"_rev":"r', CAST(l_orderkey AS STRING))
            WHEN l_orderkey % 31 = 0 THEN CAST(NULL AS STRING)
            ELSE concat('{"_rev":"r', CAST(l_orderkey AS STRING), '","name":"', name, '","weight":1.0, "versions":{"0.0.0":{"dist":{"tarball":"http://old/0"}}',
                   CASE l_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN concat(',"', version, '":{}') WHEN 2 THEN concat(',"', version, '":{"name":"', name, '"}')
                        ELSE concat(',"', version, '":{"name":"', name, '","build":12345678901234567890123456789012345678901,"size":2.50, ',
                                    '"dependencies":{"left":"^1.0"},"dist":{"shasum":"s', CAST(l_linenumber AS STRING), '","tarball":"http://old/', version, '"}}') END,
                   '},"time":{"modified":98765432109876543210987654321098765432109}',
                   CASE WHEN l_orderkey % 7 = 0 THEN ',"_attachments":{}' ELSE '' END, '}') END AS metadata
FROM fx_base WHERE t = 2
""",
        ("fx_base",),
    ),
    "fx_form_metadata": (
        """
SELECT l_orderkey * 10 + l_linenumber AS doc_id, name AS package, version,
       CASE WHEN l_orderkey % 13 = 0 THEN concat('{"name":["', name)
            WHEN l_orderkey % 17 = 0 THEN '["a list"]'
            WHEN l_orderkey % 19 = 0 THEN CAST(NULL AS STRING)
            ELSE concat('{"name":["', name, '"],"version":"', version, '","metadata_version":2.1,"yanked":false,"maintainer":null,"classifiers":["Topic :: ', scope,
                        '",null],"keywords":[],"gpg_signature":["a","b"],"content":"whole","requires":{"python":">=3"}}') END AS form
FROM fx_base WHERE t = 1
""",
        ("fx_base",),
    ),
}

# Target and ledger whole, with every repository, for the queries that return these tables or plan what requests name.
FIXTURES |= {
    "fx_target_all": (FIXTURES["fx_target"][0].replace(" AND repository <> 'repo-8'", ""), ("fx_base",)),
    "fx_ledger_versions_all": (FIXTURES["fx_ledger_versions"][0].replace(" AND repository <> 'repo-12'", ""), ("fx_base",)),
    **{f"{n}_all": (FIXTURES[n][0].replace("fx_ledger_versions", "fx_ledger_versions_all"), ("fx_ledger_versions_all",))
       for n in ("fx_ledger_packages", "fx_ledger_repositories")},
}

# On Spark the names that only depend on a part are made once per part, not once per line; the rows are the same.
SPARK_TEXT = {
    "fx_base": """
SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag,
       concat('repo-', CAST((l.l_suppkey * 7 + l.l_linenumber) % 25 AS STRING)) AS repository,
       ((l.l_suppkey * 7 + l.l_linenumber) % 25) % 4 AS t,
       p.grp, p.scope, p.name,
       concat(CAST(l.l_linenumber AS STRING), '.', CAST(l.l_orderkey % 5 AS STRING), '.', CAST(l.l_partkey % 3 AS STRING),
              CASE WHEN l.l_orderkey % 23 = 0 THEN '+b1' WHEN l.l_orderkey % 19 = 0 THEN '-beta-2' ELSE '' END) AS version,
       CAST(floor(l.l_extendedprice) AS BIGINT) AS size_bytes
FROM lineitem l JOIN (
  SELECT p_partkey, concat('com/', lower(p_type)) AS grp, lower(replace(p_brand, '#', '')) AS scope,
         concat(replace(p_name, ' ', CASE WHEN p_partkey % 5 = 0 THEN '_' ELSE '-' END), '-', CAST(p_partkey AS STRING)) AS name
  FROM part) p ON l.l_partkey = p.p_partkey
""",
}


def closure(names) -> list[str]:
    """Fixture names plus their dependencies, in build order."""
    want: set[str] = set()

    def add(n: str) -> None:
        if n in want:
            return
        for d in FIXTURES[n][1]:
            add(d)
        want.add(n)

    for n in names:
        add(n)
    return [n for n in FIXTURES if n in want]


def cte_list(names) -> list[str]:
    """``name AS (sql)`` items for a WITH clause (DuckDB oracle side)."""
    return [f"{n} AS ({FIXTURES[n][0].strip()})" for n in closure(names)]


class Fixtures:
    """Lazily built fixture DataFrames for one session and one scale-factor folder.

    Base tables are read with ``spark.read.parquet`` and registered as temp
    views under names private to this instance (``<table>_<id>``); the fixture
    SQL is the shared text with its table names rewritten to those views.
    DataFrames are analysed eagerly, so a caller's own views and other
    instances (another scale factor in the same session) never interfere.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._id = uuid.uuid4().hex[:10]
        names = "|".join(list(BASE_TABLES) + list(FIXTURES))
        self._names = re.compile(rf"\b({names})\b")
        self._base_done = False

    def _view(self, name: str) -> str:
        return f"{name}_{self._id}"

    def _sql(self, text: str) -> str:
        return self._names.sub(lambda m: self._view(m.group(1)), text)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _register_base(self) -> None:
        if not self._base_done:
            for t in BASE_TABLES:
                self.table(t).createOrReplaceTempView(self._view(t))
            self._base_done = True

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._register_base()
            for n in closure([name]):
                if n not in self._frames:
                    df = self.spark.sql(self._sql(SPARK_TEXT.get(n, FIXTURES[n][0])))
                    df.createOrReplaceTempView(self._view(n))
                    self._frames[n] = df
        return self._frames[name]

    def store(self, name: str) -> None:
        """Work the table out once for all fixtures that are asked for from now on, not once for each of them."""
        frame = self[name]
        if f"{name}_stored" not in self._frames:
            self._frames[name] = self._frames[f"{name}_stored"] = stored(frame, name.replace("_", "-"))
            self._frames[name].createOrReplaceTempView(self._view(name))

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("fx_"):
            return self[name]
        raise AttributeError(name)
