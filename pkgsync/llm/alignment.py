"""Cross-tokenizer alignment by merge-path partitioning.

The ends of A's and B's tokens, as byte offsets, are two sorted lists.  Every end in their merge closes one overlap of an
A token and a B token; ends in both lists close a group.  Binary searches on the diagonals of the merge cut it into
pieces of equal work: on diagonal k they find how many of its first k ends are A's.  A piece needs nothing of the others:
it emits its overlaps and its groups, numbered from 0, and the pieces are stitched: an end that A closed in the piece
before is not closed again, and groups go on where the piece before left them.

Tasks gather documents into chunks of about ``CHUNK`` characters.  The distinct segments of a chunk (``segments``) are
encoded once and lie one after another in its two lists, so a chunk with one long text is cut like any other.  A chunk
is a row of a table: its id pairs and how many of its documents hold each, and, compressed, what its documents count by
themselves and its streams of segments.  The corpus-wide counts are sums over chunks, so a pair that every document holds
is one row in each chunk.  The pairs of the corpus, as many as overlaps of two vocabularies, are sent to the tasks, which
finish chunks where these are stored; beyond ``MOST`` pairs, or with a chunk cut into several rows for its size, counts and
chunks meet in partitions of a few chunks each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import documents
from .prefix_bpe import byte_letters
from .segments import segments

#: Characters of text in a chunk (a longer text is a chunk of its own), ends in a piece, segments given to a library at a time.
CHUNK, PIECE, RUN = 3_000_000, 65_536, 20_000
#: Bytes of a chunk in one row, rows that are written and read at once, pairs that tasks are sent, chunks that meet in a partition.
BLOCK, ROWS, MOST, TOGETHER = 1 << 26, 2, 1_000_000, 4
CHUNKS = "chunk long, block int, bytes binary, codes array<long>, holders array<long>"
CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), ("block", pa.int32()), ("bytes", pa.binary()), ("codes", pa.list_(pa.int64())),
                          ("holders", pa.list_(pa.int64()))])
INSIDE = pa.schema([*((c, pa.binary()) for c in ("doc_ids", "doc_nulls", "own", "stream", "stream_ends", "links", "n_links")),
                    ("hashes", pa.list_(pa.string())), ("groups", pa.list_(pa.string()))])


def merge_path(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """For each diagonal k how many of the first k ends of the merge are a's (a before b on ties)."""
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) >> 1
        first = np.zeros(len(mid), bool)
        first[open_] = a[mid[open_]] <= b[diagonals[open_] - 1 - mid[open_]]
        low, high = np.where(open_ & first, mid + 1, low), np.where(open_ & ~first, mid, high)
    return low


def piece_overlaps(a: np.ndarray, b: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps closed in the piece, as indices of A and B tokens, and for each of its A ends whether B ends there too."""
    x, y = a[i0:i1], b[j0:j1]
    at_b = j0 + np.searchsorted(y, x, "left")
    both = b[at_b] == x
    at = np.searchsorted(x, y, "left")
    alone = np.ones(len(y), bool)
    alone[at < len(x)] = x[at[at < len(x)]] != y[at < len(x)]
    if i0 and len(y):
        alone &= y != a[i0 - 1]  # closed in the piece before
    return np.concatenate([np.arange(i0, i1), i0 + at[alone]]), np.concatenate([at_b, j0 + np.flatnonzero(alone)]), both


def align_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps (indices of A and B tokens) and the group of each A and each B token; both lists end at the same byte."""
    cuts = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    i = merge_path(a, b, cuts)
    j = cuts - i
    of_a, of_b, group_a, closed = [], [], [], [np.empty(0, a.dtype)]
    groups = 0
    for p in range(len(cuts) - 1):
        la, lb, both = piece_overlaps(a, b, i[p], i[p + 1], j[p], j[p + 1])
        of_a.append(la)
        of_b.append(lb)
        before = np.cumsum(both) - both  # groups that the piece closed before each of its A ends
        group_a.append(groups + before)
        groups += int(both.sum())
        closed.append(a[i[p]:i[p + 1]][both])
    none = np.empty(0, np.int64)
    return (np.concatenate([none, *of_a]), np.concatenate([none, *of_b]), np.concatenate([none, *group_a]),
            np.searchsorted(np.concatenate(closed), b, "left"))


class Pair:
    """The two tokenizers, with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # strings of special tokens are plain text
        self.a.no_padding()
        self.a.no_truncation()
        letters = str.maketrans({x: chr(b) for x, b in byte_letters().items()})
        known = byte_letters().keys()
        names = [self.a.id_to_token(k) or "" for k in range(self.a.get_vocab_size())]
        self.bytes_a = [x.translate(letters).encode("latin-1") if set(x) <= known else x.encode() for x in names]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        if any("▁" in x.lstrip("▁") for x in pieces):
            raise ValueError(f"{path_b}: a piece goes on after a space")
        self.bytes_b = [bytes([int(x[3:5], 16)]) if self.b.is_byte(k) else x.replace("▁", " ").encode() for k, x in enumerate(pieces)]
        self.size_a, self.size_b = np.array([len(x) for x in self.bytes_a]), np.array([len(x) for x in self.bytes_b])
        self.word_a, self.word_b = [str(k) for k in range(len(self.bytes_a))], [str(k) for k in range(len(self.bytes_b))]

    def encode(self, some: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by A and B of segments, each after a space, how many each has, and which don't spell their bytes (these get no ids)."""
        flat_a, flat_b, n_a, n_b, bad = [], [], np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), np.zeros(len(some), bool)
        for s in range(0, len(some), RUN):
            run = some[s:s + RUN]
            ids_a = [e.ids for e in self.a.encode_batch_fast([" " + w for w in run], add_special_tokens=False)]
            ids_b = self.b.encode(run, num_threads=1)
            for k, w in enumerate(run):
                whole = (" " + w).encode()
                if b"".join([self.bytes_a[i] for i in ids_a[k]]) != whole or b"".join([self.bytes_b[i] for i in ids_b[k]]) != whole:
                    bad[s + k], ids_a[k], ids_b[k] = True, [], []
            for ids, n, flat in ((ids_a, n_a, flat_a), (ids_b, n_b, flat_b)):
                n[s:s + RUN] = [len(x) for x in ids]
                flat.append(np.fromiter(chain.from_iterable(ids), np.int64, n[s:s + RUN].sum()))
        none = np.empty(0, np.int64)
        return np.concatenate([none, *flat_a]), np.concatenate([none, *flat_b]), n_a, n_b, bad


@lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> Pair:
    """One for each worker process and pair of files."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives each task its core
    return Pair(path_a, path_b)


class Numbers(dict):
    def __missing__(self, key):
        out = self[key] = len(self)
        return out


def ends(lengths) -> np.ndarray:
    return np.cumsum(np.asarray(lengths, np.int64))


def sums(values: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Sums of the values up to each stop from the one before it."""
    run = np.concatenate([[0], np.cumsum(values)])
    return np.diff(run[np.concatenate([[0], stops])])


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after another."""
    before = np.cumsum(lengths) - lengths
    return np.arange(lengths.sum()) + np.repeat(starts - before, lengths)


def aligned_chunk(number: int, docs: list[tuple], pair: Pair, with_groups: bool = False, piece: int = PIECE) -> dict:
    """What the table of chunks holds of documents (id, text)."""
    numbers = Numbers()
    streams = [np.concatenate([np.fromiter(map(numbers.__getitem__, some), np.uint32, len(some)) for some in segments(t)]) if t else np.empty(0, np.uint32)
               for _, t in docs]
    some = list(numbers)
    del numbers
    flat_a, flat_b, n_a, n_b, bad = pair.encode(some)
    del some
    of_a, of_b, group_a, group_b = align_ends(ends(pair.size_a[flat_a]), ends(pair.size_b[flat_b]), piece)
    segment_a = np.repeat(np.arange(len(n_a)), n_a)
    shown, n_groups = spelt(flat_a, flat_b, group_a, group_b, segment_a, len(n_a), pair)
    code, segment = flat_a[of_a] << 16 | flat_b[of_b], segment_a[of_a]
    del flat_a, flat_b, of_a, of_b, group_a, group_b, segment_a
    codes, links = np.unique(code, return_inverse=True)
    links = links[np.argsort(segment, kind="stable")].astype(np.uint32)
    n_links = np.bincount(segment, minlength=len(n_a))

    lost = np.array([bool(bad[s].any()) for s in streams], bool)
    streams = [s[:0] if x else s for s, x in zip(streams, lost, strict=True)]
    stops, stream = ends([len(s) for s in streams]), np.concatenate([np.empty(0, np.uint32), *streams])
    own = np.stack([sums(n[stream], stops) for n in (n_a, n_b, n_groups, n_links)], 1)
    hashes, groups = [], []
    for s in streams:
        digest, written = hashlib.sha256(), []
        for k in range(0, len(s), 100_000):
            text = (";" if k else "") + ";".join([shown[x] for x in s[k:k + 100_000].tolist()])
            digest.update(text.encode())
            if with_groups:
                written.append(text)
        hashes.append(digest.hexdigest() if len(s) else "")
        groups.append("".join(written) if with_groups else None)
    # each document's distinct segments, then its distinct pairs, for a run of documents at a time
    before, holders, s = np.cumsum(n_links) - n_links, np.zeros(len(codes), np.int64), 0
    starts = np.concatenate([[0], stops])
    while s < len(docs):
        e = max(s + 1, int(np.searchsorted(stops, starts[s] + RUN, "right")))
        key = np.unique(np.repeat(np.arange(e - s), np.diff(starts[s:e + 1])) * max(len(n_a), 1) + stream[starts[s]:starts[e]])
        doc, each = key // max(len(n_a), 1), key % max(len(n_a), 1)
        at = spread(before[each], n_links[each])
        held = np.unique(np.repeat(doc, n_links[each]) * max(len(codes), 1) + links[at]) % max(len(codes), 1)
        holders += np.bincount(held, minlength=len(codes))
        s = e
    used = holders > 0  # pairs of documents without tokens are held by none
    places = np.cumsum(used) - 1
    links = np.where(used[links], places[links], 0).astype(np.uint32)
    return {"chunk": number, "doc_ids": np.array([x or 0 for x, _ in docs], "<i8").tobytes(),
            "doc_nulls": np.array([x is None for x, _ in docs], np.uint8).tobytes(), "own": own.astype("<i8").tobytes(), "hashes": hashes,
            "groups": groups, "stream": stream.astype("<u4").tobytes(), "stream_ends": stops.astype("<i8").tobytes(),
            "links": links.astype("<u4").tobytes(), "n_links": n_links.astype("<u4").tobytes(), "codes": codes[used], "holders": holders[used]}


def spelt(flat_a, flat_b, group_a, group_b, segment_a, n: int, pair: Pair) -> tuple[list[str], np.ndarray]:
    """Each segment's groups as text, and their number."""
    a, b = list(map(pair.word_a.__getitem__, flat_a.tolist())), list(map(pair.word_b.__getitem__, flat_b.tolist()))
    starts_a = np.flatnonzero(np.diff(group_a, prepend=-1))
    stops_a, stops_b = np.append(starts_a[1:], len(a)).tolist(), np.append(np.flatnonzero(np.diff(group_b)) + 1, len(b)).tolist()

    def texts():
        i, j = 0, 0
        for x, y in zip(stops_a, stops_b, strict=False):
            yield (a[i] if x == i + 1 else ",".join(a[i:x])) + "|" + (b[j] if y == j + 1 else ",".join(b[j:y]))
            i, j = x, y

    n_groups, each = np.bincount(segment_a[starts_a], minlength=n) if len(starts_a) else np.zeros(n, np.int64), texts()
    return [";".join(islice(each, k)) for k in n_groups.tolist()], n_groups


def chunk_rows(row: dict, block: int = BLOCK) -> pa.RecordBatch:
    """The rows of one chunk: blocks of its bytes, the first with its pairs."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, INSIDE, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(pa.RecordBatch.from_pylist([row], INSIDE))
    whole = sink.getvalue()
    rows = [{"chunk": row["chunk"], "block": k, "bytes": whole[at:at + block].to_pybytes()} for k, at in enumerate(range(0, whole.size, block))]
    rows[0] |= {"codes": row["codes"], "holders": row["holders"]}
    return pa.RecordBatch.from_pylist(rows, CHUNK_SCHEMA)


def write_chunks(docs: DataFrame, out: str, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
                 with_groups: bool = False, chunk: int = CHUNK, block: int = BLOCK) -> None:
    """Align every document and write the table of chunks at ``out``."""

    def run(batches):
        from pyspark import TaskContext

        pair, number, held, size = tokenizers(path_a, path_b), TaskContext.get().partitionId() << 32, [], 0
        for b in batches:
            for doc_id, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                held.append((doc_id, text.as_py()))
                size += len(held[-1][1])
                if size >= chunk:
                    yield chunk_rows(aligned_chunk(number, held, pair, with_groups), block)
                    held, size, number = [], 0, number + 1
        if held:
            yield chunk_rows(aligned_chunk(number, held, pair, with_groups), block)

    (documents(docs, id_col, text_col).select("doc_id", "text").mapInArrow(run, CHUNKS)
     .write.option("compression", "zstd").option("parquet.block.row.count.limit", ROWS).parquet(out))


def held_pairs(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk", F.explode(F.arrays_zip("codes", "holders")).alias("p")).select("chunk", "p.codes", "p.holders")


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Each id pair linked anywhere: ``code`` (A's id << 16 | B's), ``n`` documents that hold it, ``best`` of its A id.

    The window over one A id holds at most one row for each id of B's vocabulary.
    """
    n = held_pairs(chunks).groupBy(F.col("codes").alias("code")).agg(F.sum("holders").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.shiftright("code", 16)))
    return n.select("code", "n", (F.col("n") == most).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", with_groups: bool = False) -> DataFrame:
    """Align A's (byte-level BPE) and B's (sentencepiece) tokens of each document and count linked id pairs over all.

    One row per input row: ``doc_id``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``,
    ``groups_sha256``, and with ``with_groups`` also ``groups`` (the text that is hashed).  A null or empty text, or one
    whose tokens don't spell a space and the text, has no tokens: zeros and ''.  Every row counts as a document, also
    one that repeats another or has no id.  Very long texts are chunks of their own; extra columns are left out; an
    empty table gives no rows.  The two files must be at their paths on every worker.
    """
    spark = docs.sparkSession
    out = scratch_path(spark, "aligned")
    write_chunks(docs, out, path_a, path_b, id_col, text_col, with_groups)
    chunks = spark.read.schema(CHUNKS).parquet(out)
    counts = pair_counts(chunks).select("code", (F.col("n") * 2 + F.col("best").cast("long")).alias("told"))
    fields = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string" + (", groups string" if with_groups else "")
    known = counts.limit(MOST + 1).toArrow()
    if known.num_rows <= MOST and chunks.where("block > 0").isEmpty():
        order = np.argsort(known["code"].to_numpy())
        shared = spark.sparkContext.broadcast(tuple(known[c].to_numpy()[order] for c in ("code", "told")))

        def finish(batches):
            code, told = shared.value
            for b in batches:
                for k in range(b.num_rows):
                    yield finished_chunk(b["bytes"][k].as_buffer(), told[np.searchsorted(code, b["codes"][k].values.to_numpy())], with_groups)

        return chunks.select("bytes", "codes").mapInArrow(finish, fields)

    told = held_pairs(chunks).select("chunk", F.col("codes").alias("code")).join(counts, "code").select("chunk", F.lit(-1).alias("block"), "code", "told")
    tasks = -(-chunks.where("block = 0").count() // TOGETHER)
    rows = (chunks.select("chunk", "block", "bytes").unionByName(told, allowMissingColumns=True)
            .repartition(max(1, tasks), "chunk").sortWithinPartitions("chunk", "block"))

    def finish_together(batches):
        for rows in each_chunk(batches):
            code, told = (rows[c].drop_null().to_numpy() for c in ("code", "told"))
            yield finished_chunk(b"".join(x for x in rows["bytes"].to_pylist() if x is not None), told[np.argsort(code)], with_groups)

    return rows.mapInArrow(finish_together, fields)


def each_chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one chunk after another; they lie together."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        chunk = b["chunk"].to_numpy()
        for s, e in pairwise([0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]):
            if held and s < e and held[0]["chunk"][0].as_py() != chunk[s]:
                yield pa.Table.from_batches(held)
                held = []
            if s < e:
                held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)


def finished_chunk(whole: bytes | pa.Buffer, told: np.ndarray, with_groups: bool) -> pa.RecordBatch:
    """The rows of a chunk's documents; ``told`` of its sorted pairs, in whose places its links are."""
    inside = pa.ipc.open_stream(whole).read_next_batch()

    def ints(name, kind="<i8"):
        return np.frombuffer(inside[name][0].as_buffer(), kind)

    links, link_ends, stream, stops = ints("links", "<u4"), np.cumsum(ints("n_links", "<u4"), dtype=np.int64), ints("stream", "<u4"), ints("stream_ends")
    if len(told) == 0:
        links, link_ends = links[:0], np.zeros_like(link_ends)
    n, best = sums(told[links] >> 1, link_ends), sums(told[links] & 1, link_ends)
    own = ints("own").reshape(-1, 4)
    columns = [pa.array(ints("doc_ids"), mask=ints("doc_nulls", np.uint8).astype(bool)), *(pa.array(own[:, k]) for k in range(4)),
               pa.array(sums(best[stream], stops)), pa.array(sums(n[stream], stops)), inside["hashes"][0].values]
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return pa.RecordBatch.from_arrays(columns + ([inside["groups"][0].values] if with_groups else []), names=names + (["groups"] if with_groups else []))
