"""Shared helpers: document identity, reliable checkpoints, partition counts.

Every operator first reduces its input to columns of its own (``documents``), so that extra columns of a caller's
table, whatever their names, can't clash with working columns.
"""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_root

#: The white space of every word, line and normalisation rule here: \x20 and \x09-\x0D.
SPACE = " \t\n\x0b\x0c\r"


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A never-null long that names a document: its id, or for a null id a number from 2**62 on from its text.

    Equal texts without an id are one document.  An id may be any long, so nothing reads this number as "no id":
    where that matters, the null itself decides (``missing``, or a null ``doc_id`` beside the number).
    """
    by_text = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit(2**62 - 1)).bitwiseOR(F.lit(2**62))
    return F.coalesce(F.col(id_col).cast("long"), by_text)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sid``, ``missing`` (no id), ``body`` (the text) and ``row`` (the whole row): a caller's column names stay inside
    ``row``, so none can clash with a working column; ``select("row.*")`` gives them back."""
    return docs.select(doc_key(id_col, text_col).alias("sid"), F.col(id_col).isNull().alias("missing"), F.col(text_col).alias("body"), F.struct("*").alias("row"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package (its sources in one zip, by Spark's own file distribution), once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="pkgsync-"), "pkgsync_sources.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sid`` (never null, see ``doc_key``), ``doc_id`` as given, ``text`` with null as empty."""
    ship(docs.sparkSession)
    return docs.select(
        doc_key(id_col, text_col).alias("sid"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )


def settle(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, by a reliable checkpoint in the shared ``spark.checkpoint.dir``.

    Spark removes the shuffle files behind a checkpoint when the driver's garbage is collected, so that is asked for
    here: a chain of settled steps then holds the files of about one step, not of all.
    """
    checkpoint_root(df.sparkSession)
    tidy(df)
    return df.checkpoint(eager=True)


def tidy(df: DataFrame) -> None:
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()


def partitions_for(docs: DataFrame, mb: float, text_col: str = "text", least: int = 1) -> int:
    """Partitions of about ``mb`` MB of text each: grows with the input, so a task's share does not."""
    row = docs.agg(F.sum(F.octet_length(F.col(text_col)).cast("long")).alias("n")).first()
    return max(least, -(-int(row["n"] or 0) // int(mb * 1e6)))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``packed`` (the text's UTF-8, compressed text by text) in place of ``text``: for joins that move whole
    texts, which shuffle files otherwise hold in small, fast-compressed blocks."""
    names = [c for c in docs.columns if c != "text"]

    def run(batches):
        import pyarrow as pa
        import zstandard

        c = zstandard.ZstdCompressor()
        for b in batches:
            texts = pa.array([c.compress(t.encode()) for t in b["text"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b[n] for n in names), texts], names=[*names, "packed"])

    return docs.select(*names, "text").mapInArrow(run, ", ".join([*(f"{n} {docs.schema[n].dataType.simpleString()}" for n in names), "packed binary"]))


def unpacked(batch, column: str = "packed") -> list[str]:
    """The texts of a batch of ``packed`` rows."""
    import zstandard

    d = zstandard.ZstdDecompressor()
    return [d.decompress(x).decode() for x in batch[column].to_pylist()]


def sha_hex(col: Column) -> Column:
    return F.sha2(col, 256)
