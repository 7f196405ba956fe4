"""Hand cases for the path, name and document expressions."""

import base64
import hashlib
import json

from pyspark.sql import functions as F

from pkgsync.functions import filters as C
from pkgsync.functions import paths as P
from pkgsync.operators import documents as DOC
from pkgsync.operators import inventory as INV


def _inv(spark, rows, match="contains"):
    df = spark.createDataFrame(rows, "repository string, package_type string, uri string, size_bytes bigint")
    return {r["uri"]: r for r in INV.derive_coordinates(df, match).collect()}


def test_npm_version_keeps_repeated_name(spark):
    # 2.14 #2: package 'a', file 'a-1.0.0-beta-2.tgz' -> whole version, not '1.0.0-bet'
    got = _inv(spark, [("r", "npm", "/a/-/a-1.0.0-beta-2.tgz", 1)])
    r = got["/a/-/a-1.0.0-beta-2.tgz"]
    assert r["package"] == "a" and r["version"] == "1.0.0-beta-2" and r["copy"]


def test_npm_scoped_and_json_files(spark):
    got = _inv(spark, [
        ("r", "npm", "/@s/pkg/-/@s/pkg-2.1.0.tgz", 1),
        ("r", "npm", "/@s/pkg/-/@s/pkg-2.1.0.json", 1),   # 2.14 #3: .json makes no version
        ("r", "npm", "/.npm/@s/pkg/package.json", 1),      # C3
        ("r", "npm", "/xnpm/-/xnpm-1.0.tgz", 1),           # 2.14 #4: not under /.npm/
    ])
    assert got["/@s/pkg/-/@s/pkg-2.1.0.tgz"]["package"] == "@s/pkg"
    assert got["/@s/pkg/-/@s/pkg-2.1.0.tgz"]["version"] == "2.1.0"
    assert got["/@s/pkg/-/@s/pkg-2.1.0.json"]["version"] is None
    assert got["/.npm/@s/pkg/package.json"]["package"] is None
    assert got["/xnpm/-/xnpm-1.0.tgz"]["version"] == "1.0"


def test_maven_and_pypi_coordinates(spark):
    got = _inv(spark, [
        ("r", "maven", "/org/x/lib/1.0/lib-1.0.jar", 1),
        ("r", "maven", "/org/x/lib/1.0/lib-1.0.jar.sha1", 1),
        ("r", "maven", "/org/x/lib/maven-metadata.xml", 1),
        ("r", "pypi", "/tool/0.1/tool-0.1.tar.gz", 1),
        ("r", "pypi", "/tool/0.1/tool-0.1.tar.gz.sha256", 1),
        ("r", "pypi", "/short.whl", 1),                      # C5: < 3 segments
    ])
    assert got["/org/x/lib/1.0/lib-1.0.jar"]["package"] == "org/x/lib"
    assert got["/org/x/lib/1.0/lib-1.0.jar"]["version"] == "1.0"
    assert got["/org/x/lib/1.0/lib-1.0.jar.sha1"]["copy"]           # 'contains' follows the source tool
    assert got["/org/x/lib/maven-metadata.xml"]["package"] is None
    assert got["/tool/0.1/tool-0.1.tar.gz"]["package"] == "tool"
    assert got["/short.whl"]["package"] is None
    suffix = _inv(spark, [("r", "maven", "/org/x/lib/1.0/lib-1.0.jar.sha1", 1)], "suffix")
    assert suffix["/org/x/lib/1.0/lib-1.0.jar.sha1"]["version"] is None


def test_package_prefix_of_another(spark):
    # 2.14 #24: 'a/b' and 'a/b/c' -- each file's version comes from its own path
    got = _inv(spark, [("r", "pypi", "/a/b/1.0/b-1.0.whl", 1), ("r", "pypi", "/a/b/c/2.0/c-2.0.whl", 1)])
    assert (got["/a/b/1.0/b-1.0.whl"]["package"], got["/a/b/1.0/b-1.0.whl"]["version"]) == ("a/b", "1.0")
    assert (got["/a/b/c/2.0/c-2.0.whl"]["package"], got["/a/b/c/2.0/c-2.0.whl"]["version"]) == ("a/b/c", "2.0")


def test_namespaces_and_target_coordinates(spark):
    df = spark.createDataFrame(
        [("maven", "foo/bar/foo"), ("maven", "junit"), ("npm", "@scope/name"), ("npm", "plain"), ("pypi", "My_Pkg")],
        "package_type string, package string")
    rows = INV.with_target_coordinates(df).collect()
    got = {(r["package_type"], r["package"]): (r["namespace"], r["target_namespace"], r["target_package"]) for r in rows}
    assert got[("maven", "foo/bar/foo")] == ("foo/bar", "foo.bar", "foo")   # 2.14 #5
    assert got[("maven", "junit")] == ("", "", "junit")
    assert got[("npm", "@scope/name")] == ("", "scope", "name")
    assert got[("npm", "plain")] == ("", "", "plain")
    assert got[("pypi", "My_Pkg")] == ("", "", "my-pkg")


def test_forbidden_characters(spark):
    df = spark.createDataFrame([("ok-1.0",), ("1.0+b1",), ("a b",), ("a b",), ("x[1]",), ("fine_name",)], "v string")
    got = {r["v"]: r["f"] for r in df.select("v", C.is_forbidden_name("v").alias("f")).collect()}
    assert got == {"ok-1.0": False, "1.0+b1": True, "a b": True, "a b": True, "x[1]": True, "fine_name": False}


def test_entity_keys_match_hashlib(spark):
    df = spark.createDataFrame([("repo", "pkg", "1.0")], "repository string, package string, version string")
    r = df.select(P.entity_key("repository", "package").alias("k"),
                  P.version_entity_key("repository", "package", "version").alias("v")).first()
    assert r["k"] == hashlib.sha384(b"repo/pkg").hexdigest()
    assert r["v"] == hashlib.sha384(b"repo/pkg:1.0").hexdigest()


def test_urls_and_metadata_uri(spark):
    df = spark.createDataFrame([("/org/x/lib/1.0/lib-1.0.jar",)], "uri string")
    r = df.select(P.maven_metadata_uri("uri").alias("m"), P.basename("uri").alias("b")).first()
    assert r["m"] == "/org/x/lib/1.0/maven-metadata.xml" and r["b"] == "lib-1.0.jar"
    df = spark.createDataFrame([("npm", "e/", "@s/p", "1", "p-1.tgz"), ("maven", "e/", "g/a", "2", "a-2.jar")],
                               "t string, e string, p string, v string, f string")
    urls = [r[0] for r in df.select(P.upload_url("t", "e", "p", "v", "f")).collect()]
    assert urls == ["e/@s%2fp", "e/g/a/2/a-2.jar"]


def test_npm_attachment_is_one_line_base64(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([(bytearray(data),)], "content binary")
    r = df.select(DOC.npm_attachment(F.col("content")).alias("a")).first()["a"]
    assert r["data"] == base64.b64encode(data).decode("ascii")
    assert r["length"] == str(len(data)) and r["content_type"] == "application/octet-stream"


def test_staging_names_do_not_collide(spark):
    # 2.14 #22: equal basenames from different namespaces or repositories get different staging keys
    df = spark.createDataFrame([("r", "org/a", "lib", "1.0"), ("r", "org/b", "lib", "1.0"), ("s", "org/a", "lib", "1.0")],
                               "repository string, namespace string, package string, version string")
    names = [r[0] for r in df.select(P.staging_name("repository", "namespace", "package", "version")).collect()]
    assert len(set(names)) == 3 and all(n.endswith("lib-1.0") for n in names)
