"""Token ids as succinct binary shards: a wavelet matrix per shard, in one compressed file format.

Documents go to range partitions by id, each partition encodes its documents in order and closes a shard when it
holds ``shard_tokens`` ids (a document is never cut, so a longer one makes a larger shard).  A shard is one row of
a Parquet table: a header (first document, sequence number, counts), the documents' lengths, and the bit planes
of the wavelet matrix, each with its number of zeros.  Spark's writer commits the files, so lost executors and
repeated tasks leave no half-written shard, and any file system that Spark reaches will do.

Rank and select samples are rebuilt when a shard is opened (one pass over the bits).  ``open_shard`` gives token
access, counting and occurrence lookup; ``read_tokens`` decodes whole shards.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, partitions_for, settle
from .tokens import encoder
from .wavelet import WaveletMatrix

SHARD_TOKENS = 1_000_000
FORMAT = "first_missing boolean, first_sid long, seq int, n_tokens long, n_docs long, doc_ids binary, doc_nulls binary, doc_lengths binary, zeros array<long>, planes array<binary>"


def write_tokens(docs: DataFrame, out: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", shard_tokens: int = SHARD_TOKENS, partition_mb: float = 24) -> None:
    """Encode all texts, in ascending order of id, into wavelet-matrix shards at ``out`` (a Parquet folder).

    Null text counts as empty (the end id alone); rows without an id come last, in the order of a hash of their
    text; rows that repeat an id stand next to each other, ordered by text.  An empty table gives no shard.
    """
    n = partitions_for(docs, partition_mb, text_col)

    def build(batches):
        enc, seq = encoder(tokenizer_path), 0
        bits = max(enc.size - 1, end_id).bit_length()
        dtype = np.uint16 if bits <= 16 else np.uint32
        open_: list = []
        size = 0

        def close():
            symbols = np.concatenate([x[2] for x in open_])
            planes, zeros = WaveletMatrix.pack(symbols, bits)
            ids, lengths = [x[1] for x in open_], np.array([len(x[2]) for x in open_], "<i8")
            nulls = np.array([x is None for x in ids], np.uint8)
            return pa.RecordBatch.from_pylist([{
                "first_missing": open_[0][1] is None, "first_sid": open_[0][0], "seq": seq, "n_tokens": len(symbols), "n_docs": len(ids),
                "doc_ids": np.array([x or 0 for x in ids], "<i8").tobytes(), "doc_nulls": nulls.tobytes(),
                "doc_lengths": lengths.tobytes(), "zeros": zeros, "planes": planes}], schema=SHARD_SCHEMA)

        for b in batches:
            for sid, doc_id, ids in zip(b["sid"].to_pylist(), b["doc_id"].to_pylist(), enc.encode(b["text"].to_pylist()), strict=True):
                open_.append((sid, doc_id, np.append(ids, np.uint32(end_id)).astype(dtype)))
                size += len(ids) + 1
                if size >= shard_tokens:
                    yield close()
                    open_, size, seq = [], 0, seq + 1
        if open_:
            yield close()

    own = documents(docs, id_col, text_col).withColumn("missing", F.col("doc_id").isNull())
    (own.repartitionByRange(n, "missing", "sid").sortWithinPartitions("missing", "sid", "text")
     .mapInArrow(build, FORMAT).write.option("compression", "zstd").mode("overwrite").parquet(out))


SHARD_SCHEMA = pa.schema([("first_missing", pa.bool_()), ("first_sid", pa.int64()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int64()),
                          ("doc_ids", pa.binary()), ("doc_nulls", pa.binary()), ("doc_lengths", pa.binary()),
                          ("zeros", pa.list_(pa.int64())), ("planes", pa.list_(pa.binary()))])


def open_shard(row) -> WaveletMatrix:
    """A shard's row as a wavelet matrix: ``access``, ``rank``, ``count`` and ``select`` over its ids."""
    return WaveletMatrix.unpack([bytes(p) for p in row["planes"]], list(row["zeros"]), row["n_tokens"])


def shard_starts(shards: DataFrame, slice_rows: int = 100_000) -> DataFrame:
    """``first_missing``, ``first_sid``, ``seq`` and ``shard_start``, the ids of all shards before it, from the shards'
    headers: running sums within slices of the order of about ``slice_rows`` headers each, and over the slices' totals."""
    key = ["first_missing", "first_sid", "seq"]
    slices = max(1, -(-shards.count() // slice_rows))
    headers = settle(shards.select(*key, "n_tokens").repartitionByRange(slices, *key).withColumn("slice", F.spark_partition_id()))
    totals = headers.groupBy("slice").agg(F.sum("n_tokens").alias("total"))  # one row per slice
    before = F.coalesce(F.sum("total").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("slice").orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = totals.select("slice", before.alias("offset"))
    return headers.withColumn("inside", within).join(F.broadcast(offsets), "slice").select(*key, (F.col("offset") + F.col("inside")).alias("shard_start"))


def read_tokens(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Documents of the shards at ``path``: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32``, and with ``with_ids`` the ids as little-endian unsigned 32-bit integers (binary)."""
    shards = spark.read.schema(FORMAT).parquet(path)
    starts = shard_starts(shards)

    def decode(batches):
        for b in batches:
            for r in b.to_pylist():
                symbols = WaveletMatrix.decode(r["planes"], r["zeros"], r["n_tokens"]).astype("<u4")
                lengths = np.frombuffer(r["doc_lengths"], "<i8")
                at = np.concatenate([[0], np.cumsum(lengths)])
                raw = [symbols[s:e].tobytes() for s, e in zip(at[:-1], at[1:], strict=True)]
                columns = [
                    pa.array([r["first_missing"]] * len(raw), pa.bool_()), pa.array([r["first_sid"]] * len(raw), pa.int64()), pa.array([r["seq"]] * len(raw), pa.int32()),
                    pa.array(np.frombuffer(r["doc_ids"], "<i8"), mask=np.frombuffer(r["doc_nulls"], np.uint8).astype(bool)),
                    pa.array(at[:-1]), pa.array(lengths), pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                ]
                names = ["first_missing", "first_sid", "seq", "doc_id", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(raw, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = "first_missing boolean, first_sid long, seq int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    docs = shards.mapInArrow(decode, fields)
    out = docs.join(starts, ["first_missing", "first_sid", "seq"])
    return out.select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
