"""Windows that may repeat, found by anchors: the shared first half of both span-level dedups.

Every window of ``width`` symbols (bytes, or words) has an anchor: the leftmost smallest hash among the ``k``-grams
in it.  Equal windows have equal anchors at equal distances, so only windows whose anchor's k-gram stands elsewhere
too can repeat.  Neighbouring windows share their anchor: such a stretch is a *run*, about one in (width - k) / 2
positions, and a run's *content* is all its windows' symbols.

``marks`` shuffles one small row per run, by the k-gram's hash: runs whose content stands earlier are copies outright
(their windows all repeat), and of contents that share a k-gram the first run of each is a candidate for the exact
search.  All other windows are proved unique.  Copies are combined in the map task first, so a passage or a text that
stands in a third of all rows sends one row per task and content.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, partitions_for, settle, unpacked

#: Positions handled at a time: bounds the memory of a very long text.
BLOCK = 1 << 20
#: Runs of one k-gram beyond this many are searched by single windows, which spread over the shards.
HOT = 20_000

A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
LOW = np.uint64(0xFFFFFFFF)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * B
    return h ^ (h >> np.uint64(32))


def grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols from each position (k a power of two), by doubling."""
    h, s = mix(symbols.astype(np.uint64) + A), 1
    while s < k:
        h = mix(h[:-s] * A + h[s:])
        s *= 2
    return h


def block_runs(symbols: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one block: first and last window start, anchor, and the anchor's hash."""
    h = grams(symbols, k)
    low = (h & ~LOW) | np.arange(len(h), dtype=np.uint64)  # ties go to the left
    w, s = width - k + 1, 1
    while 2 * s <= w:
        low = np.minimum(low[:-s], low[s:])
        s *= 2
    if s < w:
        low = np.minimum(low[:len(low) - (w - s)], low[w - s:])
    at = (low & LOW).astype(np.int64)
    ends = np.append(np.flatnonzero(at[1:] != at[:-1]), len(at) - 1)
    firsts = np.append(0, ends[:-1] + 1)
    anchor = at[firsts]
    return firsts, ends, anchor, h[anchor].view(np.int64)


def runs(symbols: np.ndarray, width: int, k: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of a whole text, block by block: each block's offset and its runs."""
    n = len(symbols) - width + 1
    return [(s, *block_runs(symbols[s:min(s + BLOCK, n) + width - 1], width, k)) for s in range(0, n, BLOCK)]


#: One run: its document, first window, number of windows, and hashes of its anchor's k-gram and of its content.  A
#: copy, known as one already, has no content.
RUN = "sid long, first long, n int, key long, content long"
RUN_SCHEMA = pa.schema([("sid", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("key", pa.int64()), ("content", pa.int64())])


def run_rows(docs: DataFrame, width: int, k: int, symbols: Callable[[str], tuple[np.ndarray, bytes, int]], within: bool) -> DataFrame:
    """Runs of every text of (sid, text).  ``symbols`` gives a text's symbols as numbers, their bytes, and the bytes
    of one; ``within``: whether a repeat inside one document counts."""
    def run(batches):
        for b in batches:
            parts: list = []
            for sid, text in zip(b["sid"].to_pylist(), b["text"].to_pylist(), strict=True):
                numbers, raw, size = symbols(text)
                for offset, first, last, anchor, key in runs(numbers, width, k) if len(numbers) >= width else []:
                    hashed = [xxhash.xxh3_64_intdigest(raw[s:e]) for s, e in zip(((offset + first) * size).tolist(), ((offset + last + width) * size).tolist(), strict=True)]
                    back = anchor - first
                    content = np.array(hashed, np.uint64).view(np.int64) ^ back  # equal symbols, anchored alike
                    parts.append((np.full(len(first), sid), offset + first, last - first + 1, key, content))
            if not parts:
                continue
            sid, first, n, key, content = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((first, sid, content, key))
            sid, first, n, key, content = (c[order] for c in (sid, first, n, key, content))
            fresh = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))
            head = np.maximum.accumulate(np.where(fresh, np.arange(len(fresh)), 0))
            copy = (sid > sid[head]) | (first > first[head]) if within else sid > sid[head]
            # neighbouring copies join to one row; they only need their place from now on
            c = np.flatnonzero(copy)
            c = c[np.lexsort((first[c], sid[c]))]
            if len(c):
                joins = np.append(False, (sid[c][1:] == sid[c][:-1]) & (first[c][1:] == first[c][:-1] + n[c][:-1]))
                starts = np.flatnonzero(~joins)
                total = np.add.reduceat(n[c], starts)
                c = c[starts]
                n = n.copy()
                n[c] = total
            keep = np.concatenate([np.flatnonzero(~copy), c])
            spread = np.where(copy, mix((sid ^ first).astype(np.uint64)).view(np.int64), key)  # copies need no company
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x[keep]) for x in (sid, first, n.astype(np.int32), spread)), pa.array(content[keep], mask=copy[keep])], schema=RUN_SCHEMA)

    return docs.mapInArrow(run, RUN)


def marks(docs: DataFrame, width: int, k: int, symbols, within: bool, partitions: int) -> DataFrame:
    """Copies and candidates: ``sid``, ``first``, ``n``, ``key``, ``copy``.

    A copy's windows all stand earlier (with ``within`` also in the same document); a candidate's k-gram stands in
    another content (without ``within``, in another document).  Rows of one key are sorted and streamed through a
    window, not collected.
    """
    rows = run_rows(docs, width, k, symbols, within)
    keyed = rows.repartition(partitions, "key").withColumn("copy", F.col("content").isNull())
    group = Window.partitionBy("key", "copy", "content").orderBy("sid", "first")
    whole = Window.partitionBy("key", "copy")
    found = (keyed.withColumn("head", F.first("sid").over(group)).withColumn("number", F.rank().over(group))
             .withColumn("many", F.min("content").over(whole) != F.max("content").over(whole))
             .withColumn("docs", F.min("sid").over(whole) != F.max("sid").over(whole)))
    again = F.col("number") > 1 if within else F.col("sid") > F.col("head")
    wanted = F.col("many") if within else F.col("many") & F.col("docs")
    return found.withColumn("copy", F.col("copy") | again).where(F.col("copy") | wanted).select("sid", "first", "n", "key", "copy")


PIECE = "key long, sid long, first long, n int, content binary"
PIECE_SCHEMA = pa.schema([("key", pa.int64()), ("sid", pa.int64()), ("first", pa.int64()), ("n", pa.int32()), ("content", pa.binary())])


def pieces(docs: DataFrame, found: DataFrame, width: int, symbols, within: bool) -> DataFrame:
    """The candidates' contents: ``key``, ``sid``, ``first``, ``n``, ``content`` (the symbols' bytes).

    Candidates go to their documents (a list per document, at most its runs).  A run of a key with more than HOT
    candidates is given window by window, each under its own hash; of a hot window a task gives its first place with
    content, and the later ones, which repeat it, as rows with an empty content.
    """
    wanted = found.where(~F.col("copy"))
    hot = wanted.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > HOT).select(F.col("key").alias("hot_key"))
    wanted = wanted.join(hot, F.col("key") == F.col("hot_key"), "left")
    lists = wanted.groupBy("sid").agg(F.collect_list(F.struct("first", "n", "key", F.col("hot_key").isNotNull().alias("hot"))).alias("spans")).withColumnRenamed("sid", "to")
    texts = packed(docs).join(lists, F.col("sid") == F.col("to")).select("sid", "packed", "spans")

    def run(batches):
        for b in batches:
            rows, windows = [], {}
            for sid, text, spans in zip(b["sid"].to_pylist(), unpacked(b), b["spans"].to_pylist(), strict=True):
                _, raw, size = symbols(text)
                for s in spans:
                    first, n = s["first"], s["n"]
                    if s["hot"]:
                        for p in range(first, first + n):
                            windows.setdefault(raw[p * size:(p + width) * size], set()).add((sid, p))
                    else:
                        rows.append((s["key"], sid, first, n, raw[first * size:(first + n - 1 + width) * size]))
            for window, at in windows.items():
                key, least = xxhash.xxh3_64_intdigest(window) - 2**63, min(at)
                for sid, p in at:
                    repeats = (sid, p) > least if within else sid > least[0]
                    rows.append((hash((sid, p)), sid, p, 1, b"") if repeats else (key, sid, p, 1, window))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, PIECE_SCHEMA, strict=True)], schema=PIECE_SCHEMA)

    return texts.mapInArrow(run, PIECE)


SPAN = "sid long, first long, n int"


def searched(given: DataFrame, partitions: int, search: Callable) -> DataFrame:
    """Windows found by ``search`` in each shard of pieces, as ``sid``, ``first``, ``n`` neighbouring windows.

    A shard holds whole keys; ``partitions`` keeps it small.  ``search`` gets arrays of sid, first and n and the list
    of contents, in order of (sid, first), and gives arrays of sid and window start.
    """
    def run(batches):
        t = pa.Table.from_batches(list(batches), schema=PIECE_SCHEMA)
        sid, first, n = (t[c].to_numpy() for c in ("sid", "first", "n"))
        order = np.lexsort((first, sid))
        content = t["content"].to_pylist()
        # a repeated row gives the same piece again
        order = [i for i, last in zip(order, [-1, *order], strict=False) if last < 0 or sid[i] != sid[last] or first[i] != first[last] or content[i] != content[last]]
        content = [content[i] for i in order]
        sid, first, n = sid[order], first[order], n[order]
        known = np.array([not c for c in content], bool)
        real = np.flatnonzero(~known)
        hit_sid, hit_at = search(sid[real], first[real], n[real], [content[i] for i in real]) if len(real) else (sid[:0], first[:0])
        hit_sid, hit_at = np.append(hit_sid, sid[known]), np.append(hit_at, first[known])
        order = np.lexsort((hit_at, hit_sid))
        hit_sid, hit_at = hit_sid[order], hit_at[order]
        if len(hit_sid):
            fresh = np.append(True, (hit_sid[1:] != hit_sid[:-1]) | (hit_at[1:] > hit_at[:-1] + 1))
            at = np.flatnonzero(fresh)
            last = hit_at[np.append(at[1:] - 1, len(hit_at) - 1)]
            yield pa.RecordBatch.from_arrays([pa.array(hit_sid[at]), pa.array(hit_at[at]), pa.array((last - hit_at[at] + 1).astype(np.int32))], names=["sid", "first", "n"])

    return given.repartition(partitions, "key").mapInArrow(run, SPAN)


def joined_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of the union of [start, end)."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, s[1:] > e[:-1])
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:] - 1, len(s) - 1)]


def repeated_windows(docs: DataFrame, width: int, k: int, symbols, within: bool, search: Callable, partition_mb: float, shard_mb: float, bytes_each: int) -> DataFrame:
    """All repeated windows of (sid, text): ``sid`` and ``spans``, a list of (first, n) of neighbouring window starts."""
    found = settle(marks(docs, width, k, symbols, within, partitions_for(docs, partition_mb)))
    size = found.where(~F.col("copy")).agg(F.sum((F.col("n") + width).cast("long") * bytes_each).alias("n")).first()["n"] or 0
    given = pieces(docs, found, width, symbols, within)
    hits = searched(given, max(1, -(-int(size) // int(shard_mb * 1e6))), search)
    spans = found.where("copy").select("sid", "first", "n").unionByName(hits)
    return spans.groupBy("sid").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
