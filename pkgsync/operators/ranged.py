"""Artifact bytes by path tables: written, read and copied without a listing, large files in ranges.

* ``write_artifacts``: the writing tasks return the rows (name, path, length) of what they wrote, so no later step lists a
  folder, and files share 256 folders instead of having one each.
* ``read_contents``: a path table's bytes as rows.
* ``copy_artifacts``: a file above ``part_bytes`` is copied as ranges by several tasks into one temporary file; a commit
  row per file, after all its ranges were verified, renames it.  Tasks are as many as the bytes ask for, and as no row is
  larger than a range, each gets about the same number of bytes.

Tasks survive a lost executor: a range is written at its own offset, so a second attempt writes the same bytes again, the
rows of the ranges are a stored table before anything is committed, and a commit that ran already is recognised.
"""

from __future__ import annotations

import hashlib
import os
import sys
import time
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import transfer as TR

try:  # as in transfer: workers need not have this package
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:
    pass

PART_BYTES = 256 * 1024 * 1024
#: Bytes of a copy task; opening a file counts like this many bytes.
TASK_BYTES, FILE_COST = 1024 * 1024 * 1024, 1024 * 1024
TRIES, FIRST_WAIT = 3, 0.2


def tried(step, *args):
    """``step(*args)``, again after a wait when the file system fails, at most ``TRIES`` times; a missing file is no failure
    that waiting mends."""
    for attempt in range(TRIES):
        try:
            return step(*args)
        except FileNotFoundError:
            raise
        except OSError:
            if attempt == TRIES - 1:
                raise
            time.sleep(FIRST_WAIT * 2**attempt)


def _write_file(root: str, name: str, content: bytes) -> str:
    fs, base = TR._fs(root)
    folder = f"{base.rstrip('/')}/{hashlib.sha256(name.encode()).hexdigest()[:2]}"
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary, compression=None) as out:
        out.write(content)
    fs.move(temporary, f"{folder}/{name}")
    return f"{root.rstrip('/')}/{folder.rsplit('/', 1)[1]}/{name}"


def write_artifacts(rows: DataFrame, root: str) -> DataFrame:
    """Write ``content`` (binary) of each row as the file ``name`` (unique, no slash) under ``root``.

    One row per file: ``name``, ``path``, ``length``.  A null content is an empty file.  The rows are written by whoever
    evaluates them: store them as a table before use.
    """
    def run(batches):
        import pandas as pd

        for pdf in batches:
            contents = [b"" if c is None else bytes(c) for c in pdf["content"]]
            paths = [tried(_write_file, root, n, c) for n, c in zip(pdf["name"], contents, strict=True)]
            yield pd.DataFrame({"name": pdf["name"].values, "path": paths, "length": [len(c) for c in contents]})

    return rows.select("name", "content").mapInPandas(run, "name string, path string, length bigint")


def _read_file(path: str) -> bytes:
    fs, p = TR._fs(path)
    with fs.open_input_stream(p, compression=None) as f:
        return f.read()


def read_contents(paths: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """``path``, ``content`` and ``error`` (then ``content`` is null) of each row of a path table.

    For files that fit a row; larger ones go through ``transfer.streaming_checksums`` or the copy below.
    """
    def run(batches):
        import pandas as pd

        for pdf in batches:
            for path in pdf["path"]:  # a row at a time: one file in memory
                try:
                    content, error = tried(_read_file, path), None
                except Exception as e:
                    content, error = None, f"{type(e).__name__}: {e}"
                yield pd.DataFrame({"path": [path], "content": [content], "error": [error]})

    n = num_partitions or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.select("path").repartition(n, "path").mapInPandas(run, "path string, content binary, error string")


def copy_parts(plan: DataFrame, keep: list[str] | tuple = (), part_bytes: int = PART_BYTES) -> DataFrame:
    """The plan's files as ranges: ``part``, ``n_parts``, ``start``, ``size`` beside the plan's columns.

    Only a destination that is a mounted path takes writes at an offset; others, and files of unknown length, are one part.
    """
    mounted = ~F.col("dst_path").contains("://") | F.col("dst_path").startswith("file:")
    n = F.when(mounted & (F.col("length") > part_bytes), F.ceil(F.col("length") / F.lit(part_bytes))).otherwise(F.lit(1)).cast("int")
    rows = plan.select("src_path", "dst_path", F.col("length").cast("bigint").alias("length"), *keep, n.alias("n_parts"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1))).withColumn("start", F.col("part").cast("bigint") * F.lit(part_bytes))
    return rows.withColumn("size", F.when(F.col("n_parts") == 1, F.col("length")).otherwise(F.least(F.lit(part_bytes).cast("bigint"), F.col("length") - F.col("start"))))


def _mounted(path: str) -> str:
    return TR._fs(path)[1]


def _temporary(src: str, dst: str, length: int) -> str:
    """The same name for all ranges of a copy, and for a copy of the same bytes begun again."""
    return f"{_mounted(dst)}.ranges-{hashlib.sha256(f'{src} {dst} {length}'.encode()).hexdigest()[:16]}"


def _range_digest(fs, path: str, start: int, size: int, write=None) -> str:
    """SHA-256 of a range, handed on in chunks to ``write``; a file that ends too early is an OSError."""
    h, left = hashlib.sha256(), size
    with fs.open_input_file(path) as f:
        f.seek(start)
        while left:
            chunk = f.read(min(TR.CHUNK, left))
            if not chunk:
                raise OSError(f"{path} ends {left} bytes before the end of the range")
            h.update(chunk)
            if write:
                write(chunk)
            left -= len(chunk)
    return h.hexdigest()


def _write_range(fs, path: str, target: str, start: int, size: int) -> str:
    fd = os.open(target, os.O_CREAT | os.O_WRONLY, 0o644)  # never truncated: other tasks write their own ranges
    with os.fdopen(fd, "wb") as out:
        out.seek(start)
        digest = _range_digest(fs, path, start, size, out.write)
    return digest


def _copy_range(src: str, dst: str, length: int, start: int, size: int) -> tuple[int | None, str | None, str, str | None]:
    from pyarrow import fs as pafs

    sfs, spath = TR._fs(src)
    info = sfs.get_file_info(spath)
    if info.type != pafs.FileType.File:
        return None, None, "missing_source", f"no file at {src}"
    if info.size != length:
        return None, None, "checksum_mismatch", f"{info.size} bytes instead of the {length} listed"
    local, target = pafs.LocalFileSystem(), _mounted(dst)
    if os.path.isfile(target) and os.path.getsize(target) == length:
        digest = _range_digest(sfs, spath, start, size)
        if digest == _range_digest(local, target, start, size):
            return size, digest, "skipped", None
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    temporary = _temporary(src, dst, length)
    digest = _write_range(sfs, spath, temporary, start, size)
    if _range_digest(local, temporary, start, size) != digest:
        return None, digest, "checksum_mismatch", f"the range at {start} was not written as read"
    return size, digest, "copied", None


def _copied(row) -> tuple:
    try:
        if row.n_parts == 1:
            for attempt in range(TRIES):
                out = TR._copy_one(row.src_path, row.dst_path)
                if out[2] != "error" or attempt == TRIES - 1:
                    return out
                time.sleep(FIRST_WAIT * 2**attempt)
        return tried(_copy_range, row.src_path, row.dst_path, int(row.length), int(row.start), int(row.size))
    except Exception as e:  # one bad file must not fail the whole task
        return None, None, "error", f"{type(e).__name__}: {e}"


def _commit(src: str, dst: str, length: int, parts) -> tuple[int | None, str | None, str, str | None]:
    """Rename the temporary file of a copy whose ranges are all verified."""
    from pyarrow import fs as pafs

    bad = [p for p in parts if p["status"] not in ("copied", "skipped")]
    target, temporary, local = _mounted(dst), _temporary(src, dst, length), pafs.LocalFileSystem()
    if bad:
        if os.path.exists(temporary):
            os.remove(temporary)
        return None, None, bad[0]["status"], bad[0]["error"]
    digest = hashlib.sha256(b"".join(bytes.fromhex(p["sha256"]) for p in parts)).hexdigest()
    if all(p["status"] == "skipped" for p in parts):
        return length, digest, "skipped", None
    if not os.path.exists(temporary):  # an earlier attempt of this commit may have renamed it
        if os.path.isfile(target) and os.path.getsize(target) == length and all(
                _range_digest(local, target, p["start"], p["size"]) == p["sha256"] for p in parts):
            return length, digest, "copied", None
        return None, None, "error", f"no ranges at {temporary}"
    for p in parts:  # ranges that the destination had already
        if p["status"] == "skipped":
            _write_range(local, target, temporary, p["start"], p["size"])
    if os.path.getsize(temporary) != length:
        return None, None, "checksum_mismatch", f"{os.path.getsize(temporary)} of {length} bytes written"
    os.replace(temporary, target)
    return length, digest, "copied", None


def _result(pdf, out, keep):
    import pandas as pd

    return pd.DataFrame({
        "src_path": pdf["src_path"].values, "dst_path": pdf["dst_path"].values, "length": pd.array([o[0] for o in out], dtype="Int64"),
        "sha256": [o[1] for o in out], "status": [o[2] for o in out], "error": [o[3] for o in out], **{k: pdf[k].values for k in keep}})


def copy_artifacts(plan: DataFrame, work: str, keep: list[str] | tuple = (), part_bytes: int = PART_BYTES, task_bytes: int = TASK_BYTES,
                   cost: int | None = None) -> DataFrame:
    """Copy ``src_path`` to ``dst_path`` (each destination once) for rows with ``length``, the source's listed size or null.

    One row per file, as ``transfer.copy_artifacts`` gives it, and ``n_parts``.  ``sha256`` of a file copied in ranges is
    that of its ranges' SHA-256 digests in order.  The rows of the ranges are stored at ``work`` (a shared folder) before
    any file is committed; evaluating the result again commits nothing anew.  ``keep``: string columns carried along.
    ``cost``: the bytes of all files, and FILE_COST for each, where the caller knows them; otherwise they are summed first.
    """
    spark, keep = plan.sparkSession, list(keep)
    parts = copy_parts(plan, keep, part_bytes)
    if cost is None:
        cost = parts.agg(F.sum(F.coalesce("size", F.lit(0)) + F.lit(FILE_COST)).alias("n")).first()["n"] or 0
    tasks = max(1, -(-int(cost) // task_bytes), min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(cost) // FILE_COST))

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = [_copied(r) for r in pdf.itertuples(index=False)]
            yield pd.concat([_result(pdf, out, keep), pdf[["n_parts", "part", "start", "size"]].reset_index(drop=True), pdf[["length"]].reset_index(drop=True).rename(columns={"length": "listed"})], axis=1)

    kept = "".join(f", {k} string" for k in keep)
    parts.repartition(tasks, "dst_path", "part").mapInPandas(run, TR.COPY_RESULT_SCHEMA + kept + ", n_parts int, part int, start bigint, size bigint, listed bigint") \
        .write.mode("overwrite").parquet(work)
    done = spark.read.parquet(work)

    def commit(batches):
        for pdf in batches:
            out = []
            for r in pdf.itertuples(index=False):
                try:
                    out.append(tried(_commit, r.src_path, r.dst_path, int(r.listed), r.parts))
                except Exception as e:
                    out.append((None, None, "error", f"{type(e).__name__}: {e}"))
            yield _result(pdf, out, keep).assign(n_parts=pdf["n_parts"].values)

    ranges = F.sort_array(F.collect_list(F.struct("part", "start", "size", "sha256", "status", "error"))).alias("parts")
    large = done.where(F.col("n_parts") > 1).groupBy("src_path", "dst_path", "listed", "n_parts", *keep).agg(ranges)
    columns = ["src_path", "dst_path", "length", "sha256", "status", "error", *keep, "n_parts"]
    return done.where(F.col("n_parts") == 1).select(*columns).unionByName(large.mapInPandas(commit, TR.COPY_RESULT_SCHEMA + kept + ", n_parts int").select(*columns))
