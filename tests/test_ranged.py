"""Artifact bytes by path tables: writing, reading, copies in ranges."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from pkgsync.operators import ranged as RG
from pkgsync.session import local_dir, scratch_path

sha = lambda b: hashlib.sha256(b).hexdigest()
PART = 1000


def bytes_of(n, seed):
    return b"".join(hashlib.sha256(f"{seed}-{i}".encode()).digest() for i in range(n // 32 + 1))[:n]


@pytest.fixture
def files(spark):
    """A stored path table of files of 0 to 100,000 bytes, and their contents by name."""
    contents = {f"f{n}.bin": bytes_of(n, n) for n in (0, 1, 999, 1000, 1001, 2000, 100_000)}
    root, table = local_dir(scratch_path(spark, "src")), scratch_path(spark, "paths")
    rows = spark.createDataFrame([*contents.items(), ("null.bin", None)], "name string, content binary")
    RG.write_artifacts(rows, root).write.parquet(table)
    return spark.read.parquet(table), {**contents, "null.bin": b""}


def copy(spark, plan, **more):
    rows = [r.asDict() for r in RG.copy_artifacts(plan, scratch_path(spark, "ranges"), part_bytes=PART, task_bytes=16 * RG.FILE_COST, **more).collect()]
    return {r["dst_path"].rsplit("/", 1)[1]: r for r in rows}


def plan_to(paths, root):
    return paths.select(F.col("path").alias("src_path"), F.concat(F.lit(f"{root}/"), "name").alias("dst_path"), "length", "name")


def want_digest(content):
    if len(content) <= PART:
        return sha(content)
    return sha(b"".join(hashlib.sha256(content[i:i + PART]).digest() for i in range(0, len(content), PART)))


def test_path_table_and_contents(spark, files):
    paths, contents = files
    rows = {r["name"]: r for r in paths.collect()}
    assert {k: r["length"] for k, r in rows.items()} == {k: len(v) for k, v in contents.items()}
    read = {r["path"]: (bytes(r["content"]), r["error"]) for r in RG.read_contents(paths).collect()}
    assert read == {rows[k]["path"]: (v, None) for k, v in contents.items()}
    gone = RG.read_contents(spark.createDataFrame([("/nonexistent/x",)], "path string")).first()
    assert gone["content"] is None and "FileNotFoundError" in gone["error"]
    assert RG.read_contents(paths.limit(0)).count() == 0


def test_large_files_are_copied_in_ranges_by_several_tasks(spark, files):
    paths, contents = files
    dst, work = local_dir(scratch_path(spark, "dst")), scratch_path(spark, "ranges")
    done = RG.copy_artifacts(plan_to(paths, dst), work, keep=["name"], part_bytes=PART, task_bytes=16 * RG.FILE_COST).collect()
    for r in done:
        content = contents[r["name"]]
        assert (r["status"], r["length"], r["n_parts"], r["error"]) == ("copied", len(content), max(1, -(-len(content) // PART)), None)
        assert r["sha256"] == want_digest(content)
        with open(r["dst_path"], "rb") as f:
            assert f.read() == content
    assert len(done) == len(contents)
    parts = spark.read.parquet(work).where(F.col("name") == "f100000.bin")
    assert parts.count() == 100 and parts.select(F.input_file_name()).distinct().count() > 1
    assert sorted(os.listdir(dst)) == sorted(contents)  # nothing temporary is left
    # a second run copies nothing
    assert {r["status"] for r in copy(spark, plan_to(paths, dst)).values()} == {"skipped"}


def test_damaged_destinations_are_replaced(spark, files):
    paths, contents = files
    dst = local_dir(scratch_path(spark, "dst"))
    copy(spark, plan_to(paths, dst))
    with open(f"{dst}/f100000.bin", "r+b") as f:  # one range differs, the size does not
        f.seek(50_500)
        f.write(b"damage")
    with open(f"{dst}/f2000.bin", "r+b") as f:
        f.truncate(7)
    again = copy(spark, plan_to(paths, dst))
    assert {k for k, r in again.items() if r["status"] == "copied"} == {"f100000.bin", "f2000.bin"}
    for name, content in contents.items():
        with open(f"{dst}/{name}", "rb") as f:
            assert f.read() == content
    assert sorted(os.listdir(dst)) == sorted(contents)


def test_failures_are_rows(spark, files):
    paths, _ = files
    dst = local_dir(scratch_path(spark, "dst"))
    src = paths.where("name = 'f2000.bin'").first()["path"]
    rows = [("/nonexistent/a", f"{dst}/a", 5000, "a"), ("/nonexistent/b", f"{dst}/b", None, "b"), (src, f"{dst}/grown", 5000, "grown"), (src, f"{dst}/unlisted", None, "unlisted")]
    got = copy(spark, spark.createDataFrame(rows, "src_path string, dst_path string, length bigint, name string"))
    assert {k: r["status"] for k, r in got.items()} == {"a": "missing_source", "b": "missing_source", "grown": "checksum_mismatch", "unlisted": "copied"}
    assert got["grown"]["error"] == "2000 bytes instead of the 5000 listed" and got["unlisted"]["n_parts"] == 1
    assert os.listdir(dst) == ["unlisted"]
    assert copy(spark, plan_to(paths.limit(0), dst)) == {}


def test_a_range_and_a_commit_can_run_twice(tmp_path):
    """A lost executor's tasks run again, before or after the rename."""
    content = bytes_of(2500, 1)
    src, dst = tmp_path / "s.bin", tmp_path / "to" / "d.bin"
    src.write_bytes(content)
    ranges = [(0, 1000), (1000, 1000), (2000, 500)]

    def parts():
        out = [RG._copy_range(str(src), str(dst), 2500, s, n) for s, n in ranges]
        return [{"part": i, "start": s, "size": n, "sha256": o[1], "status": o[2], "error": o[3]} for i, ((s, n), o) in enumerate(zip(ranges, out, strict=True))]

    first, second = parts(), parts()
    assert first == second and {p["status"] for p in first} == {"copied"}
    assert RG._commit(str(src), str(dst), 2500, first) == RG._commit(str(src), str(dst), 2500, first) == (2500, want_digest(content), "copied", None)
    assert dst.read_bytes() == content and os.listdir(dst.parent) == ["d.bin"]


def test_tries_are_bounded(monkeypatch):
    monkeypatch.setattr(RG, "FIRST_WAIT", 0)
    calls = []

    def fails(times, error):
        def step():
            calls.append(1)
            if len(calls) <= times:
                raise error
            return "done"
        calls.clear()
        return step

    assert RG.tried(fails(2, OSError("busy"))) == "done" and len(calls) == 3
    with pytest.raises(OSError, match="busy"):
        RG.tried(fails(9, OSError("busy")))
    assert len(calls) == RG.TRIES
    with pytest.raises(FileNotFoundError):
        RG.tried(fails(9, FileNotFoundError("x")))
    assert len(calls) == 1


def test_workers_need_no_package(tmp_path):
    """As in transfer: the task functions, the module that they use included, are pickled by value."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    src = tmp_path / "s.bin"
    src.write_bytes(b"abcdef")
    blob = tmp_path / "fn.pkl"
    blob.write_bytes(cloudpickle.dumps((RG._copy_range, RG._commit)))
    code = (
        "import pickle, sys; "
        f"copy, commit = pickle.loads(open({str(blob)!r}, 'rb').read()); "
        "assert 'pkgsync' not in sys.modules; "
        f"s, d = {str(src)!r}, {str(tmp_path / 'd.bin')!r}; "
        "o = [copy(s, d, 6, a, 3) for a in (0, 3)]; "
        "print(commit(s, d, 6, [{'start': a, 'size': 3, 'sha256': x[1], 'status': x[2], 'error': x[3]} for a, x in zip((0, 3), o)])[2])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    res = subprocess.run([sys.executable, "-c", code], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=60)
    assert res.returncode == 0, res.stderr[-2000:]
    assert res.stdout.strip() == "copied" and (tmp_path / "d.bin").read_bytes() == b"abcdef"
