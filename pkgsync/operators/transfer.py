"""Artifact bytes: read with ``binaryFile``, copy between filesystem roots.

The copy is the one step that needs Python: ``mapInPandas`` over a plan of
(source path, destination path) rows.  Bytes stream from path to path inside a
task -- they never pass through a shuffle or the driver -- and each copy is
verified (length and SHA-256 of the written file) before an atomic rename, so
a retried or re-run task finds finished files and skips them.
"""

from __future__ import annotations

import hashlib
import sys
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The functions below run in Python workers.  Pickle them by value, so a worker
# needs only the standard library, pandas and pyarrow -- not this package on its
# path (a cluster without the package installed, or a driver started elsewhere).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except Exception:  # older cloudpickle: the package must then be on the workers' path
    pass

CHUNK = 8 * 1024 * 1024
# Streams are opened with compression=None: bytes are copied as they are, even
# for names such as .tar.gz that pyarrow would otherwise decompress.
COPY_RESULT_SCHEMA = (
    "src_path string, dst_path string, length bigint, sha256 string, status string, error string"
)


def read_artifacts(spark: SparkSession, root: str, with_content: bool = False, glob: str | None = None) -> DataFrame:
    """``path, modificationTime, length[, content]``; partition directories
    (``key=value``) become columns.  Without ``content`` no bytes are read."""
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.load(root)
    return df if with_content else df.drop("content")


def checksums(artifacts: DataFrame) -> DataFrame:
    """SHA-256 and length of each file read with content (JVM side)."""
    return artifacts.withColumn("sha256", F.sha2(F.col("content"), 256)).drop("content")


CHECKSUM_SCHEMA = "path string, length bigint, sha256 string, error string"


def _checksum_batches(batches):
    import pandas as pd

    for pdf in batches:
        out = []
        for p in pdf["path"]:
            try:
                fs_, fp = _fs(p)
                out.append(_sha_of(fs_, fp) + (None,))
            except Exception as e:  # unreadable file -> error row, task goes on
                out.append((None, None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame({
            "path": pdf["path"].values,
            "length": pd.array([o[0] for o in out], dtype="Int64"),
            "sha256": [o[1] for o in out],
            "error": [o[2] for o in out],
        })


def streaming_checksums(paths: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """SHA-256 and length of each file, read in chunks inside a task.

    For artifacts too large for one ``binaryFile`` row (which loads a whole
    file, up to 2 GB): memory per task stays at one chunk.  Paths are
    hash-partitioned so a repository with most files spreads over all tasks.
    """
    n = num_partitions or int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return paths.select(F.regexp_replace("path", "^file:", "").alias("path")).repartition(n, "path") \
        .mapInPandas(_checksum_batches, CHECKSUM_SCHEMA)


def _fs(path: str):
    from pyarrow import fs as pafs

    if "://" in path or path.startswith("file:"):
        scheme, colon, rest = path.partition(":")
        if colon + rest[:1] == ":/" and rest[:2] != "//":  # file:/x, as Spark writes it
            rest = "//" + rest
        return pafs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3"}.get(scheme, scheme) + ":" + rest)  # the cluster's names of one store
    return pafs.LocalFileSystem(), path


def _sha_of(filesystem, path: str) -> tuple[int, str]:
    h = hashlib.sha256()
    n = 0
    with filesystem.open_input_stream(path, compression=None) as f:
        while True:
            b = f.read(CHUNK)
            if not b:
                break
            h.update(b)
            n += len(b)
    return n, h.hexdigest()


def _copy_one(src: str, dst: str) -> tuple[int | None, str | None, str, str | None]:
    """Copy one file; the source is read once on the common path.

    An existing destination of the same size is compared by SHA-256 and left
    alone when equal.  Otherwise the bytes stream to a temporary name while the
    source is hashed; the written file is hashed again and must match (length
    and digest, and the length the listing reported) before the atomic rename.
    """
    from pyarrow import fs as pafs

    tmp = None
    try:
        sfs, spath = _fs(src)
        dfs, dpath = _fs(dst)
        info = sfs.get_file_info(spath)
        if info.type != pafs.FileType.File:
            return None, None, "missing_source", f"no file at {src}"
        dinfo = dfs.get_file_info(dpath)
        if dinfo.type == pafs.FileType.File and dinfo.size == info.size:
            src_sum = _sha_of(sfs, spath)
            if _sha_of(dfs, dpath) == src_sum:
                return src_sum[0], src_sum[1], "skipped", None
        parent = dpath.rsplit("/", 1)[0]
        if parent:
            dfs.create_dir(parent, recursive=True)
        tmp = f"{dpath}.part-{uuid.uuid4().hex}"
        h, n = hashlib.sha256(), 0
        with sfs.open_input_stream(spath, compression=None) as fin, dfs.open_output_stream(tmp, compression=None) as fout:
            while True:
                b = fin.read(CHUNK)
                if not b:
                    break
                h.update(b)
                n += len(b)
                fout.write(b)
        src_sum = (n, h.hexdigest())
        got = _sha_of(dfs, tmp)
        if got != src_sum or n != info.size:
            dfs.delete_file(tmp)
            return got[0], got[1], "checksum_mismatch", f"read {n} of {info.size} bytes, digest {src_sum[1]}"
        dfs.move(tmp, dpath)
        return n, src_sum[1], "copied", None
    except Exception as e:  # one bad file must not fail the whole task
        try:
            if tmp:
                dfs.delete_file(tmp)
        except Exception:  # not written yet, or the file system is gone
            pass
        return None, None, "error", f"{type(e).__name__}: {e}"


def _copy_batches_keep(keep):
    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = [_copy_one(s, d) for s, d in zip(pdf["src_path"], pdf["dst_path"])]
            cols = {
                "src_path": pdf["src_path"].values,
                "dst_path": pdf["dst_path"].values,
                "length": pd.array([o[0] for o in out], dtype="Int64"),
                "sha256": [o[1] for o in out],
                "status": [o[2] for o in out],
                "error": [o[3] for o in out],
            }
            for k in keep:
                cols[k] = pdf[k].values
            yield pd.DataFrame(cols)

    return run


def copy_artifacts(plan: DataFrame, num_partitions: int | None = None, keep: list[str] | tuple = ()) -> DataFrame:
    """Copy ``src_path`` -> ``dst_path`` for each plan row; one result row per file.

    Rows are hash-partitioned by destination so one large repository is spread
    over all tasks.  Status: ``copied`` | ``skipped`` (already there, same bytes)
    | ``checksum_mismatch`` | ``missing_source`` | ``error``.  ``keep``: string
    columns of the plan carried through to the result (e.g. the version key).

    The result has side effects: materialise it once (write it) before using
    it twice, or a second evaluation copies again (idempotent, but the status
    would then read ``skipped``).
    """
    n = num_partitions or int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keep = list(keep)
    rows = plan.select("src_path", "dst_path", *keep).repartition(n, "dst_path")
    schema = COPY_RESULT_SCHEMA + "".join(f", {k} string" for k in keep)
    return rows.mapInPandas(_copy_batches_keep(keep), schema)
