"""Byte copy (A8, A9) and dump readers."""

import hashlib
import os

from pyspark.sql import functions as F

from pkgsync.operators import transfer as TR
from pkgsync.session import local_dir, scratch_path
from pkgsync.sources import dumps as DU

SF = "/root/testdata/sf0.001"


def _write_docs(spark, n=200):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(n)
    root = scratch_path(spark, "docs")
    docs.write.partitionBy("doc_id").text(root)
    return docs, root


def test_copy_checksums_and_rerun(spark):
    docs, root = _write_docs(spark)
    dst = local_dir(scratch_path(spark, "dst"))
    arts = TR.read_artifacts(spark, root, glob="*.txt")
    plan = arts.select(F.regexp_replace("path", "^file:", "").alias("src_path"),
                       F.concat(F.lit(dst + "/"), F.substring_index("path", "/", -2)).alias("dst_path"))
    first = {r["dst_path"]: r for r in TR.copy_artifacts(plan).collect()}
    assert len(first) == docs.count() and all(r["status"] == "copied" for r in first.values())
    want = {r["doc_id"]: hashlib.sha256((r["text"] + "\n").encode()).hexdigest() for r in docs.collect()}
    for path, r in first.items():
        doc_id = int(path.split("doc_id=")[1].split("/")[0])
        assert r["sha256"] == want[doc_id]
        with open(path, "rb") as f:
            assert hashlib.sha256(f.read()).hexdigest() == want[doc_id]
    # second run copies nothing
    assert {r["status"] for r in TR.copy_artifacts(plan).collect()} == {"skipped"}
    # a truncated destination is seen and replaced
    victim = sorted(first)[0]
    with open(victim, "r+b") as f:
        f.truncate(1)
    third = {r["dst_path"]: r["status"] for r in TR.copy_artifacts(plan).collect()}
    assert third[victim] == "copied" and sum(s == "copied" for s in third.values()) == 1
    assert not [p for p in os.listdir(os.path.dirname(victim)) if ".part-" in p]


def test_missing_source(spark):
    dst = local_dir(scratch_path(spark, "dst"))
    plan = spark.createDataFrame([("/nonexistent/file.tgz", dst + "/x.tgz")], "src_path string, dst_path string")
    assert TR.copy_artifacts(plan).first()["status"] == "missing_source"


def test_listing_documents_drop_folders(spark):
    doc = '{"uri":"u","files":[{"uri":"/a/1/a-1.jar","size":3,"folder":false},{"uri":"/a","size":0,"folder":true}]}'
    df = spark.createDataFrame([("repo", doc)], "repository string, doc string")
    rows = DU.parse_listing(df).collect()
    assert [(r["repository"], r["uri"], r["size_bytes"]) for r in rows] == [("repo", "/a/1/a-1.jar", 3)]


def test_catalogue_and_target_documents(spark):
    cat = '{"repositoriesSummaryList":[{"repoKey":"a","repoType":"LOCAL","packageType":"Maven"},{"repoKey":"TOTAL","repoType":"NA"}]}'
    rows = DU.parse_catalogue(spark.createDataFrame([(cat,)], "doc string")).collect()
    assert [(r["repo_key"], r["package_type"]) for r in rows] == [("a", "Maven"), ("TOTAL", None)]
    tgt = '{"repositories":[{"name":"a"},{"name":"b"}]}'
    assert [r["name"] for r in DU.parse_target_repositories(spark.createDataFrame([(tgt,)], "doc string")).collect()] == ["a", "b"]


def test_streaming_checksums_equal_binary_file(spark):
    docs, root = _write_docs(spark, 50)
    arts = TR.read_artifacts(spark, root, with_content=True, glob="*.txt")
    jvm = {r["path"].replace("file:", ""): (r["length"], r["sha256"]) for r in TR.checksums(arts).collect()}
    streamed = {r["path"]: (r["length"], r["sha256"]) for r in TR.streaming_checksums(arts.select("path")).collect()}
    assert streamed == jvm and len(streamed) == 50


def test_worker_functions_need_no_package_on_the_worker(tmp_path):
    """The mapInPandas functions are pickled by value: a Python process that
    cannot import pkgsync still runs them."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    f = tmp_path / "x.bin"
    f.write_bytes(b"abc")
    blob = tmp_path / "fn.pkl"
    blob.write_bytes(cloudpickle.dumps(TR._checksum_batches))
    code = (
        "import pickle, pandas as pd, sys; "
        "assert 'pkgsync' not in sys.modules; "
        f"fn = pickle.loads(open({str(blob)!r}, 'rb').read()); "
        f"out = list(fn(iter([pd.DataFrame({{'path': [{str(f)!r}]}})]))); "
        "print(out[0]['sha256'][0])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True,
                         timeout=120)
    assert res.returncode == 0, res.stderr[-2000:]
    assert res.stdout.strip() == hashlib.sha256(b"abc").hexdigest()
