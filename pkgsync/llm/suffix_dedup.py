"""Suffix-array dedup: a logarithmic family of suffix arrays finds every byte string of ``width`` bytes that stands
earlier in the corpus.

``anchors`` first proves most windows unique and hands the rest, as pieces of text, to shards by anchor.  In a shard
the pieces come in order of (document, position), in batches.  A batch gets the suffix array of its windows' starts;
it is merge-scanned against every existing level: a suffix whose longest common prefix with its neighbour in a level
reaches ``width`` repeats that earlier text.  The suffixes that are new form a level of their own, and levels of equal
size merge, so a shard of n suffixes has at most log2(n / batch) levels and each suffix is merged as many times.
Suffixes are compared to a depth of ``width``, all that decides a match.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import joined_spans, repeated_windows
from .common import documents, keyed, packed, unpacked

WIDTH, GRAM = 100, 32
#: Suffixes of a batch; a level holds batches in powers of two.
BATCH = 32_768


def byte_symbols(text: str) -> tuple[np.ndarray, bytes, int]:
    raw = text.encode()
    return np.frombuffer(raw, np.uint8), raw, 1


class Level:
    """A text and the starts of its suffixes in order of their first ``width`` bytes, all different."""

    def __init__(self, text: np.ndarray, suffixes: np.ndarray, width: int):
        self.text, self.suffixes, self.width = text, suffixes, width

    def keys(self) -> np.ndarray:
        return suffix_keys(self.text, self.suffixes, self.width)

    def __len__(self) -> int:
        return len(self.suffixes)


def suffix_keys(text: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` bytes of each suffix, comparable as one value (all have the same length)."""
    view = np.lib.stride_tricks.sliding_window_view(text, width)
    return np.ascontiguousarray(view[starts]).view(f"S{width}").ravel()


def suffix_array(text: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts ordered by suffix, equal ones by place, and their keys."""
    keys = suffix_keys(text, starts, width)
    # the first 8 bytes decide most comparisons
    head = keys.view(np.uint8).reshape(-1, width)[:, :8].copy().view(">u8").ravel().astype(np.uint64)
    order = np.argsort(head, kind="stable")
    same = head[order][1:] == head[order][:-1]
    if same.any():
        group = np.cumsum(np.append(True, ~same))
        tied = np.flatnonzero(np.append(False, same) | np.append(same, False))
        sub = order[tied]
        inner = np.argsort(keys[sub], kind="stable")  # within all tied suffixes
        inner = inner[np.argsort(group[tied][inner], kind="stable")]
        order[tied] = sub[inner]
    return starts[order], keys[order]


class SuffixLevels:
    """The family: levels of distinct suffixes, at most one of each size class."""

    def __init__(self, width: int, batch: int = BATCH):
        self.width, self.batch, self.levels = width, batch, []

    def add(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Take a batch (starts in order of place); true where a suffix repeats an earlier one."""
        order, keys = suffix_array(text, starts, self.width)
        repeats = np.append(False, keys[1:] == keys[:-1])  # within the batch: the first in place stays
        for level in self.levels:
            theirs = level.keys()
            at = np.searchsorted(theirs, keys)
            repeats |= theirs[np.minimum(at, len(theirs) - 1)] == keys
        new = order[~repeats]
        if len(new):
            self.levels.append(Level(text, new, self.width))
            while len(self.levels) > 1 and self.size_class(self.levels[-1]) >= self.size_class(self.levels[-2]):
                self.levels.append(self.merged(self.levels.pop(), self.levels.pop()))
        out = np.zeros(len(starts), bool)
        out[np.searchsorted(starts, order[repeats])] = True
        return out

    def size_class(self, level: Level) -> int:
        return max(1, -(-len(level) // self.batch)).bit_length()

    def merged(self, a: Level, b: Level) -> Level:
        """Two levels as one: both are in order, so each suffix of b finds its place in a."""
        at = np.searchsorted(a.keys(), b.keys())
        return Level(np.concatenate([a.text, b.text]), np.insert(a.suffixes, at, b.suffixes + len(a.text)), self.width)


def search(width: int):
    """Windows of a shard's pieces that repeat earlier ones, by a family of suffix arrays."""
    def run(sid, first, n, contents):
        family, out_sid, out_at = SuffixLevels(width), [], []
        cuts = np.searchsorted(np.cumsum(n), np.arange(BATCH, n.sum() + BATCH, BATCH)) + 1
        start = 0
        for end in np.unique(np.minimum(cuts, len(n))):
            each, part = n[start:end].astype(np.int64), contents[start:end]
            text = np.frombuffer(b"".join(part), np.uint8)
            sizes = each + width - 1
            begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            inside = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            hit = family.add(text, np.repeat(begin, each) + inside)
            out_sid.append(np.repeat(sid[start:end], each)[hit])
            out_at.append((np.repeat(first[start:end], each) + inside)[hit])
            start = end
        return np.concatenate(out_sid), np.concatenate(out_at)

    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, partition_mb: float = 8, shard_mb: float = 1.5) -> DataFrame:
    """For (sid, text): ``sid`` and ``spans``, the runs of windows that stand earlier."""
    return repeated_windows(docs, width, gram, byte_symbols, True, search(width), partition_mb, shard_mb, 1)


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM) -> DataFrame:
    """Remove every byte covered by a ``width``-byte string that also starts earlier (a smaller id, or earlier in the
    same document).

    One row per input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (the
    remaining bytes) and ``kept_sha256``.  Null text counts as empty; texts below ``width`` bytes are left alone.
    Rows without an id stand, in an order of their texts, where ids from 2**62 on would.  Rows that repeat an id are one document: equal ones
    get the same result, and a window of either that repeats an earlier place is removed at that place in both.
    An empty table gives no rows; extra columns are left out.
    """
    own = documents(docs, id_col, text_col)
    spans = repeated_spans(own.select("sid", "text"), width, gram).withColumnRenamed("sid", "to")
    both = packed(own).join(spans, F.col("sid") == F.col("to"), "left").select("doc_id", "packed", "spans")

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, found in zip(b["doc_id"].to_pylist(), unpacked(b), b["spans"].to_pylist(), strict=True):
                raw = text.encode()
                kept, removed, count = cut(raw, found, width)
                rows.append((doc_id, len(raw), removed, count, kept, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 6, KEPT, strict=True)], schema=KEPT)

    return both.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string")


KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def cut(raw: bytes, found: list | None, width: int, whole: bool = False) -> tuple[bytes, int, int]:
    """Bytes that stay, how many go, and in how many maximal runs; ``whole``: a character of which a run holds only some
    bytes stays."""
    if not found:
        return raw, 0, 0
    starts = np.array([s["first"] for s in found])
    ends = np.minimum(starts + np.array([s["n"] for s in found]) - 1 + width, len(raw))
    starts, ends = joined_spans(starts[starts < len(raw)], ends[starts < len(raw)])
    if whole:
        inner = np.frombuffer(raw + b"a", np.uint8) & 0xC0 == 0x80  # a byte within a character
        bounds = np.flatnonzero(~inner)
        starts, ends = bounds[np.searchsorted(bounds, starts)], bounds[np.searchsorted(bounds, ends, "right") - 1]
        # a run is at least ``width`` bytes long, so it holds a whole character if that is four or more
        starts, ends = starts[starts < ends], ends[starts < ends]
    stay = np.concatenate([[0], ends]), np.append(starts, len(raw))
    return b"".join(raw[a:b] for a, b in zip(*stay, strict=True)), int((ends - starts).sum()), len(starts)


def drop_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row, its text without the repeated bytes; a character that the end of a removed run splits stays whole."""
    spans = repeated_spans(documents(docs, id_col, text_col).select("sid", "text"), width)
    both = keyed(docs, id_col, text_col).select("sid", "body", "row").join(spans, "sid", "left")

    @F.pandas_udf("string")
    def rest(text, found):
        import pandas as pd

        return pd.Series([t if t is None or f is None else cut(t.encode(), list(f), width, whole=True)[0].decode() for t, f in zip(text, found, strict=True)], dtype=object)

    left = F.when(F.col("spans").isNull(), F.col("body")).otherwise(rest("body", "spans"))
    return both.select(*[(left if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
