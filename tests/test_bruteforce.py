"""Coordinates and request parsing against plain-Python brute force on random inputs."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pkgsync.operators import inventory as INV
from pkgsync.operators import requests as RQ

SEG = st.text(alphabet="ab-_.12+@", min_size=1, max_size=6)
EXT = st.sampled_from(["", ".jar", ".pom", ".tar.gz", ".whl", ".egg", ".tgz", ".jar.sha1", ".json", "maven-metadata.xml"])


@st.composite
def uris(draw):
    segs = draw(st.lists(SEG, min_size=1, max_size=5))
    if draw(st.booleans()):
        segs.insert(draw(st.integers(0, len(segs))), "-")
    if draw(st.integers(0, 9)) == 0:
        segs.insert(0, ".npm")
    return "/" + "/".join(segs) + draw(EXT)


def expected(ptype: str, uri: str, match: str = "contains"):
    """Plain-Python statement of the derivation rules (see inventory.derive_coordinates)."""
    def has(exts):
        return any((e in uri) if match == "contains" else uri.endswith(e) for e in exts)

    name = uri.split("/")[-1]
    stripped = uri[1:] if uri.startswith("/") else uri
    package = version = None
    if ptype == "npm":
        if not uri.startswith("/.npm/"):
            package = stripped.split("/-/")[0]
            base = package.split("/")[-1]
            if name.endswith(".tgz") and name.startswith(base + "-") and len(name) > len(base) + 5:
                version = name[len(base) + 1:-4]
    else:
        if "maven-metadata.xml" not in uri and len(stripped.split("/")) > 2:
            package = re.sub(r"/[^/]*/[^/]*$", "", stripped)
            if has((".pom", ".jar", ".tar.gz", ".whl", ".egg")):
                version = uri.split("/")[-2]
    if version is None:
        copy = False
    elif ptype == "npm":
        copy = True
    elif ptype == "pypi":
        copy = has((".tar.gz", ".whl", ".egg"))
    else:
        copy = "maven-metadata.xml" not in uri and has((".pom", ".jar", ".tar.gz"))
    return package, version, copy


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["npm", "maven", "pypi"]), uris()), min_size=50, max_size=120),
       st.sampled_from(["contains", "suffix"]))
def test_coordinates_match_brute_force(spark, rows, match):
    df = spark.createDataFrame([("r", t, u, 1) for t, u in rows],
                               "repository string, package_type string, uri string, size_bytes bigint")
    got = [(r["package_type"], r["uri"], r["package"], r["version"], r["copy"])
           for r in INV.derive_coordinates(df, match).collect()]
    want = [(t, u, *expected(t, u, match)) for t, u in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


TOKEN = st.text(alphabet="ab:1.", min_size=0, max_size=6)


def parse(packages: str):
    out = []
    for pos, tok in enumerate(packages.split(" ")):
        n = tok.count(":")
        parts = tok.split(":")
        if tok == "":
            kind = "empty"
        elif n == 0:
            kind = "all_versions"
        elif n > 1:
            kind = "malformed"
        elif parts[1] == "":
            kind = "blank_version"
        else:
            kind = "one_version"
        out.append((pos, tok, parts[0], parts[1] if kind == "one_version" else None, kind))
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(TOKEN, min_size=1, max_size=4).map(" ".join), min_size=20, max_size=60))
def test_request_parsing_matches_brute_force(spark, lines):
    df = spark.createDataFrame([(i, "r", p) for i, p in enumerate(lines)], "request_id bigint, repository string, packages string")
    got = sorted((r["request_id"], r["pos"], r["token"], r["package"], r["version"], r["kind"])
                 for r in RQ.parse_requests(df).collect())
    want = sorted((i, *t) for i, p in enumerate(lines) for t in parse(p))
    assert got == want
