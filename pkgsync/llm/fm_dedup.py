"""Substring dedup by an FM-index per shard: backward search over a wavelet matrix finds, for every document streamed
through it, the stretches of at least ``width`` words that also stand in an earlier document.

``anchors`` first proves most windows unique and hands the rest, as pieces of word numbers, to shards by anchor.  A
shard concatenates its pieces (a separator after each), sorts the suffixes, and keeps the Burrows-Wheeler transform
as a wavelet matrix, with a range-minimum table over the documents in suffix order.  All pieces then run through the
index together, from their right ends: a match grows to the left while its suffix interval holds a smaller document,
so its length is the matching statistic against all earlier documents.  Where it can't grow, a short search finds a
stretch there that no earlier document has, and the right end moves before that stretch's own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import joined_spans, repeated_windows
from .common import documents
from .wavelet import WaveletMatrix

WIDTH, GRAM = 50, 16
#: Word numbers that a worker remembers.
CACHE = 400_000


class WordNumbers(dict):
    """64-bit hashes of words, each computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = n = xxhash.xxh3_64_intdigest(word) | 1  # 0 is the separator
        return n


NUMBERS = WordNumbers()


def word_symbols(text: str) -> tuple[np.ndarray, bytes, int]:
    words = text.encode().split()  # bytes split at \x20 and \x09-\x0D exactly
    numbers = np.fromiter(map(NUMBERS.__getitem__, words), np.uint64, len(words))
    return numbers, numbers.tobytes(), 8


class FMIndex:
    """Of a text of numbers from 1 (0 separates pieces), sorted to a depth of ``depth`` symbols."""

    def __init__(self, text: np.ndarray, owners: np.ndarray, depth: int):
        """``owners``: the document (as a rank) at each position."""
        n = len(text)
        rank, have = text.astype(np.int64), 1
        while have <= depth:  # prefix doubling: ranks by twice as many symbols each time
            after = np.zeros(n, np.int64)
            after[:-have] = rank[have:]
            pair = rank * (int(rank.max()) + 1) + after
            order = np.argsort(pair, kind="stable")
            new = np.append(0, np.cumsum(pair[order][1:] != pair[order][:-1]))
            rank = np.empty(n, np.int64)
            rank[order] = new + 1
            have *= 2
            if new[-1] == n - 1:
                break
        self.n, self.suffixes = n, order
        bits = max(1, int(text.max()).bit_length())
        self.bwt = WaveletMatrix.of(text[order - 1].astype(np.uint32), bits)
        self.first = np.append(0, np.cumsum(np.bincount(text, minlength=1 << bits)))  # smaller symbols in the text
        # where the last plane's order of each symbol starts: what rank_pair counts from
        zero = np.zeros(1 << bits, np.int64)
        self.base = self.bwt.rank_pair(np.arange(1 << bits), zero, zero)[0]
        self.least = [owners[order].astype(np.int32)]
        while 2 << (len(self.least) - 1) <= n:
            half, last = 1 << (len(self.least) - 1), self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: intervals of the symbol followed by what was matched."""
        i, j = self.bwt.rank_pair(symbol, lo, hi)
        shift = self.first[symbol] - self.base[symbol]
        return i + shift, j + shift

    def smallest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """The smallest owner in each interval (none: a large number)."""
        out = np.full(len(lo), np.iinfo(np.int32).max, np.int32)
        level = np.zeros(len(lo), np.int64)
        some = hi > lo
        level[some] = np.frexp((hi - lo)[some])[1] - 1
        for k in np.unique(level[some]):
            at = np.flatnonzero(some & (level == k))
            t = self.least[k]
            out[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << int(k))])
        return out


def matched_windows(index: FMIndex, text: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
    """Positions in ``text`` where a window starts that stands in a document with a smaller owner.

    All pieces move in step; each is at left end i and right end e of its match.  ``probe`` is -1, or the position
    that a match failed to take in, while the shortest failing stretch from there is sought by doubling.
    """
    out = []
    e, lo = (begin + size).copy(), np.zeros(len(begin), np.int64)
    i, hi = e.copy(), np.full(len(begin), index.n, np.int64)
    probe, failed = np.full(len(begin), -1, np.int64), e.copy()
    live = np.flatnonzero(size >= width)
    while len(live):
        a, own = i[live] - 1, owner[live]
        nlo, nhi = index.extend(text[a], lo[live], hi[live])
        good = index.smallest(nlo, nhi) < own
        took = live[good]
        i[took], lo[took], hi[took] = a[good], nlo[good], nhi[good]
        # a match that reaches the width is a hit at its left end, also while probing
        long_ = took[e[took] - i[took] >= width]
        out.append(i[long_])
        # a probe that took in its position: its stretch occurs, so try one twice as long, or the known failing one
        done = took[(probe[took] >= 0) & (i[took] == probe[took])]
        if len(done):
            twice = probe[done] + 2 * (e[done] - probe[done])
            again = twice < failed[done]
            e[done] = np.where(again, twice, failed[done] - 1)
            probe[done[~again]] = -1
            i[done], lo[done], hi[done] = e[done], 0, index.n
        lost = live[~good]
        if len(lost):
            at = i[lost] - 1
            # [at, e) stands in no earlier document: only windows that end before e remain, and start at or before at
            end = e[lost]
            was = probe[lost] >= 0
            short = was | (end - at <= 2)
            # a long failing match: look for a shorter failing stretch from the same position
            failed[lost] = end
            probe[lost] = np.where(short, -1, at)
            e[lost] = np.where(short, end - 1, at + 1)
            i[lost], lo[lost], hi[lost] = e[lost], 0, index.n
        at_start = i[live] == begin[live]
        live = live[((e[live] - begin[live] >= width) | (probe[live] >= 0)) & (~at_start | (probe[live] >= 0))]
    return np.unique(np.concatenate(out)) if out else np.empty(0, np.int64)


def search(width: int):
    def run(sid, first, n, contents):
        numbers = np.frombuffer(b"".join(c + b"\0" * 8 for c in contents), "<u8")
        values, text = np.unique(numbers, return_inverse=True)  # 0, the separator, comes first
        size = n.astype(np.int64) + width - 1
        begin = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        _, owner = np.unique(sid, return_inverse=True)  # ranks keep the order of documents
        index = FMIndex(text, np.repeat(owner, size + 1), width + 1)
        hits = matched_windows(index, text, begin, size, owner, width)
        piece = np.searchsorted(begin, hits, "right") - 1
        return sid[piece], first[piece] + hits - begin[piece]

    return run


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, partition_mb: float = 12, shard_mb: float = 6) -> DataFrame:
    """For (sid, text): ``sid`` and ``spans``, the runs of word windows that start in an earlier document too."""
    return repeated_windows(docs, width, gram, word_symbols, False, search(width), partition_mb, shard_mb, 8)


def remove_repeats(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM) -> DataFrame:
    """Remove every word covered by a window of ``width`` words that also starts in a document with a smaller id.

    One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``spans`` (maximal removed stretches of words, as
    start and end), ``kept`` (the words that stay, joined by a space) and ``kept_sha256``.  Null text has no words;
    shorter documents are left alone; a repeat within one document doesn't count.  Rows without an id stand where ids from 2**62 on would, in
    an order of their texts.  Rows that repeat an id are one document: equal ones get the same result, and a window
    of either that stands in an earlier document is removed at that place in both.  An empty table gives no rows;
    extra columns are left out.
    """
    own = documents(docs, id_col, text_col)
    spans = repeated_spans(own.select("sid", "text"), width, gram).withColumnRenamed("sid", "to")
    both = own.join(spans, F.col("sid") == F.col("to"), "left").select("doc_id", "text", "spans")

    def run(batches):
        for b in batches:
            rows = []
            for doc_id, text, found in zip(b["doc_id"].to_pylist(), b["text"].to_pylist(), b["spans"].to_pylist(), strict=True):
                words = text.encode().split()
                starts = np.array([s["first"] for s in found or []], np.int64)
                ends = np.minimum(starts + np.array([s["n"] for s in found or []], np.int64) - 1 + width, len(words))
                starts, ends = joined_spans(starts[starts < len(words)], ends[starts < len(words)])
                stay = zip([0, *ends.tolist()], [*starts.tolist(), len(words)], strict=True)
                kept = b" ".join([w for a, z in stay for w in words[a:z]])
                gone = [{"start": a, "end": z} for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
                rows.append((doc_id, len(words), int((ends - starts).sum()), gone, kept.decode(), hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 6, KEPT, strict=True)], schema=KEPT)

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string, kept_sha256 string")


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.string()), ("kept_sha256", pa.string())])
