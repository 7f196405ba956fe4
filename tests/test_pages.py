"""Page readers: whole files, with cut-off, blank, foreign, repeated and overlapping pages."""

import json

from pkgsync.sources import pages as PG


def _files(root, files):
    for name, text in files.items():
        p = root / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
    return f"file://{root}"


def _reasons(dump):
    return {r["page"].rsplit("/", 1)[1]: r["reason"] for r in dump.rejects.collect()}


def test_target_repositories_from_files(spark, tmp_path):
    page = json.dumps({"repositories": [{"name": "a"}, {"name": "b"}, {"domainName": "no name"}, None]}, indent=1)
    root = _files(tmp_path, {"p1.json": page, "p2.json": '{"repositories":[{"name":"b"},{"name":"c"}]}', "p3.json": page, "p4.json": page[:-9], "p5.json": " \n",
                             "p6.json": '{"other":[]}', "p7.json": '{"repositories":7}', "p8.json": '{"repositories":[]}', "p9.json": "[1]", "p91.json": page[:1]})
    d = PG.target_repositories(PG.read_pages(spark, root))
    assert sorted(r["name"] for r in d.rows.collect()) == ["a", "b", "c"]
    assert _reasons(d) == {"p3.json": "repeated", "p4.json": "malformed", "p5.json": "empty", "p6.json": "incomplete", "p7.json": "malformed", "p9.json": "malformed", "p91.json": "malformed"}
    text = {r["reason"]: r["_corrupt_record"] for r in d.rejects.where("page like '%p4.json' or reason = 'repeated'").collect()}
    assert text == {"malformed": page[:-9], "repeated": None}


def test_files_without_a_byte_are_passed_over(spark, tmp_path):
    d = PG.target_repositories(PG.read_pages(spark, _files(tmp_path, {"p1.json": "", "p2.json": '{"repositories":[{"name":"x"}]}'})))
    assert [r["name"] for r in d.rows.collect()] == ["x"]
    assert _reasons(d) == {}


def _versions(package, versions, **more):
    return json.dumps({"format": "npm", "package": package, "versions": [{"version": v, "status": s} for v, s in versions], **more})


def test_target_versions_of_overlapping_pages(spark, tmp_path):
    first, same = _versions("p", [("1", "Published"), ("2", "Unfinished")]), _versions("q", [("1", "Published")], namespace="n")
    root = _files(tmp_path, {"repository=r/01": first, "repository=r/02": _versions("p", [("2", "Published"), ("3", "Unfinished")]), "repository=r/03": same, "repository=s/04": same,
                             "repository=s/05": same, "repository=s/06": first[:40], "repository=s/07": '{"versions":[{"version":"9"}]}'})
    d = PG.target_versions(PG.read_pages(spark, root))
    assert sorted(tuple(r) for r in d.rows.collect()) == [
        ("r", "npm", "", "p", "1", "Published"), ("r", "npm", "", "p", "2", "Published"), ("r", "npm", "", "p", "3", "Unfinished"),
        ("r", "npm", "n", "q", "1", "Published"), ("s", "npm", "n", "q", "1", "Published")]
    assert _reasons(d) == {"05": "repeated", "06": "malformed", "07": "incomplete"}


def test_listing_in_pages(spark, tmp_path):
    f = lambda *u: json.dumps({"uri": "x", "files": [{"uri": a, "size": n, "folder": a.endswith("/")} for a, n in u]})
    root = _files(tmp_path, {"repository=r/1": f(("/a/", 0), ("/a/x.jar", 1)), "repository=r/2": f(("/a/x.jar", 5), ("/b.jar", 2)), "repository=r/3": f(("/c", 1))[:-3]})
    d = PG.listing(PG.read_pages(spark, root))
    assert sorted(tuple(r) for r in d.rows.collect()) == [("r", "/a/x.jar", 5), ("r", "/b.jar", 2)]
    assert _reasons(d) == {"3": "malformed"}


def test_npm_metadata_keeps_its_text(spark, tmp_path):
    doc = '{"name": "@s/p",\n "n": 12345678901234567890123456789012345678901, "f": 1.0}\n'
    root = _files(tmp_path, {"repository=r/1": doc, "repository=r/2": '{"versions":{}}', "repository=r/3": doc[:30], "repository=t/4": doc})
    d = PG.npm_metadata(PG.read_pages(spark, root))
    assert sorted(tuple(r) for r in d.rows.collect()) == [("r", "@s/p", doc), ("t", "@s/p", doc)]
    assert _reasons(d) == {"2": "incomplete", "3": "malformed"}


def test_no_pages(spark):
    none = spark.createDataFrame([], "page string, repository string, doc string")
    for read in (PG.target_repositories, PG.target_versions, PG.listing, PG.npm_metadata):
        d = read(none)
        assert d.rows.count() == d.rejects.count() == 0
