"""Best-fit packing of token sequences by bin completion, a branch and bound over the histogram of lengths.

The number of pieces of each length (at most ``capacity`` numbers, whatever the input) is all that the search needs.
It takes the largest length left, enumerates all fillings of the room beside it that no other filling dominates, by
length and copies, and commits a filling for as many sequences at once as the counts allow (later for fewer).  A branch
is cut when the waste it has made exceeds what the best known packing leaves; the first such packing (the incumbent) is
best-fit decreasing, and every branch that ends in fewer sequences replaces it.  The pieces then find their places by their rank within their
length: counts by (length, task) give each task's first rank, so no task or driver ever holds the pieces together.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import documents, settle
from .tokens import encoder

CAPACITY = 2048
#: Nodes of the branch and bound; beyond them the best packing so far is returned (it is always complete).
NODES = 6_000

#: A plan: (how many sequences, the lengths in each) in order.
Plan = list[tuple[int, tuple[int, ...]]]


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Plan:
    """Each length, largest first, goes where it leaves the least room; groups of like sequences move together."""
    groups: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # by room
    rooms: list[int] = []

    def put(room, n, items):
        if room not in groups:
            groups[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        groups[room].append((n, items))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            k = bisect_left(rooms, length)
            if k == len(rooms):
                each = capacity // length
                full, rest = divmod(left, each)
                if full:
                    put(capacity - each * length, full, (length,) * each)
                if rest:
                    put(capacity - rest * length, 1, (length,) * rest)
                break
            room = rooms[k]
            n, items = groups[room].pop()
            if not groups[room]:
                del groups[room], rooms[k]
            each = min(room // length, -(-left // n)) if n <= left else 1
            used = min(n, left // each) if each > 1 else min(n, left)
            used = max(used, 1)
            each = min(each, left // used)
            put(room - each * length, used, items + (length,) * each)
            if used < n:
                put(room, n - used, items)
            left -= used * each
    return [g for room in rooms for g in groups[room]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of total over capacity and, over thresholds t, the bound of pieces that can't share a sequence:
    those over capacity - t stand alone, those over half alone too, and the rest fill what these leave."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[x] for x in lengths], dtype=np.int64)
    best = int(-(-(lengths * n).sum() // capacity)) if len(n) else 0
    for t in [0, *(int(x) for x in lengths[lengths <= capacity // 2])]:
        alone = n[lengths > capacity - t].sum()
        half = (lengths > capacity // 2) & (lengths <= capacity - t)
        small = (lengths >= t) & (lengths <= capacity // 2)
        room = capacity * n[half].sum() - (lengths * n)[half].sum()
        best = max(best, int(alone + n[half].sum() + max(0, -(-((lengths * n)[small].sum() - room) // capacity))))
    return best


def fillings(counts: dict[int, int], lengths: list[int], room: int, allowed: int, budget: list[int]):
    """All undominated fillings of ``room`` from the pieces left that waste at most ``allowed``, least waste first, then
    longest pieces first (short ones stay for later); a filling is ((length, copies), ...).

    A filling is dominated when a piece that is left fits its waste, alone or in the place of a shorter one: another
    filling then does all it does.  Sums that the lengths up to each one can reach (as bits) keep the search from lengths
    that lead nowhere; a partial filling that ends nowhere all the same takes one from ``budget``.
    """
    reach, within = [1], (2 << room) - 1
    for x in lengths:
        sums, copies, step = reach[-1], min(counts[x], room // x), 1
        while copies:
            step = min(step, copies)
            sums |= sums << step * x
            copies, step = copies - step, 2 * step
        sums &= within
        reach.append(reach[-1] if sums == reach[-1] else sums)

    def search(k: int, left: int, above: int, chosen: tuple, low: int, must: int, waste: int):
        """Fill ``left`` exactly from lengths[low:k] and ``must``; ``above``: the shortest longer length with pieces left."""
        ended = True
        if left == must and (not low or (lengths[low] if k > low else above) - lengths[low - 1] > waste):
            ended = False
            yield chosen
        while k > low and left > must and reach[k] >> left & 1:
            k -= 1
            x = lengths[k]
            if x <= left - must and above - x > waste:
                for m in range(min(counts[x], (left - must) // x), 0, -1):
                    if reach[k] >> left - m * x & 1 and budget[0] > 0:
                        ended = False
                        yield from search(k, left - m * x, x if m < counts[x] else above, (*chosen, (x, m)), low, must, waste)
            above = x
        if ended:
            budget[0] -= 1

    low = must = 0
    for waste in range(min(allowed, room) + 1):
        # pieces that fit the waste must all be in
        while low < len(lengths) and lengths[low] <= waste:
            must += lengths[low] * counts[lengths[low]]
            low += 1
        if must > room - waste:
            return
        if reach[-1] >> room - waste & 1:
            short = tuple((x, counts[x]) for x in reversed(lengths[:low]))
            for chosen in search(len(lengths), room - waste, 2 * room + 2, (), low, must, waste):
                yield waste, chosen + short


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> Plan:
    """Pack the counted lengths (1 to capacity) into as few sequences as the search finds.

    Depth first; a node is a filling that is committed or passed over, or a partial one that ends nowhere.  Every undominated filling
    is a branch, for as many sequences as the counts allow and later for fewer; only ``nodes`` ends the search early.
    """
    counts = {x: n for x, n in counts.items() if n}
    full = [(counts.pop(capacity), (capacity,))] if capacity in counts else []
    if not counts:
        return full
    incumbent = best_fit_decreasing(counts, capacity)
    best = sum(n for n, _ in incumbent)
    least = lower_bound(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    left, lengths, budget = dict(counts), sorted(counts), [nodes]
    path: list[list] = []  # fillings to come, that of this node, how many of it, its waste
    used = waste = 0

    def move(filling, n):
        """Take ``n`` times the filling from what is left (give it back if below 0)."""
        for x, k in filling:
            if x not in left:
                left[x] = 0
                lengths.insert(bisect_left(lengths, x), x)
            left[x] -= n * k
            if not left[x]:
                del left[x], lengths[bisect_left(lengths, x)]

    def allowed():
        return (best - 1) * capacity - total - waste

    def branches():
        """Every filling for as many sequences as may be, then every filling for fewer: (waste, filling, sequences)."""
        large, before = lengths[-1], path[-1][1] if path else None
        own = dict(left)
        own[large] -= 1
        room = capacity - large
        fit = [x for x in lengths[:bisect_right(lengths, room)] if own[x]]
        for fewer in (False, True):
            for spare, filling in fillings(own, fit, room, allowed(), budget):
                whole = ((large, 1), *filling)
                if filling and filling[0][0] == large:
                    whole = ((large, filling[0][1] + 1), *filling[1:])
                if spare > allowed():
                    break
                n = min(left[x] // k for x, k in whole)
                n = min(n, allowed() // spare) if spare else n
                tries = range(n - 1, 0, -1) if fewer else (n,)
                if whole == before or not tries:  # it is tried there for more sequences, or was tried for one
                    budget[0] -= 1
                    if budget[0] <= 0:
                        return
                    continue
                for k in tries:
                    yield spare, whole, k

    while best > least and budget[0] > 0:
        if not left:
            best, incumbent = used, [(n, tuple(x for x, k in filling for _ in range(k))) for _, filling, n, _ in path]
        elif allowed() >= 0:
            path.append([branches(), (), 0, 0])
        # to the next branch, of this node or of one before it
        while path:
            options, filling, n, spare = path[-1]
            if n:
                move(filling, -n)
                used, waste = used - n, waste - n * spare
                path[-1][1:] = (), 0, 0
            if (branch := next(options, None)) and branch[0] * branch[2] <= allowed():
                spare, filling, n = branch
                move(filling, n)
                used, waste = used + n, waste + n * spare
                path[-1][1:] = filling, n, spare
                budget[0] -= 1
                break
            if not branch:
                path.pop()
        if not path:
            break
    return full + incumbent


def places(plan: Plan) -> tuple[np.ndarray, ...]:
    """The plan as a table by length and rank: length, first rank, pieces per sequence, first sequence, first offset."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for n, items in plan:
        offset = 0
        for x in sorted(set(items), reverse=True):
            k = items.count(x)
            rows.append((x, taken.get(x, 0), k, sequence, offset))
            taken[x] = taken.get(x, 0) + n * k
            offset += k * x
        sequence += n
    rows.sort()
    return tuple(np.array(c, dtype=np.int64) for c in zip(*rows, strict=True)) if rows else (np.empty(0, np.int64),) * 5


def cut_pieces(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str, text_col: str, keep_ids: bool) -> DataFrame:
    """Pieces of at most ``capacity`` ids, with the task and the rank among the task's pieces of the same length."""
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("task", pa.int32()), ("task_rank", pa.int64()), *([("ids", pa.binary())] if keep_ids else [])]

    def run(batches):
        enc, task, seen = encoder(tokenizer_path), TaskContext.get().partitionId(), {}
        for b in batches:
            rows = []
            for doc_id, ids in zip(b["doc_id"].to_pylist(), enc.encode(b["text"].to_pylist()), strict=True):
                raw = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                total = len(raw) >> 2
                start, piece, length = 0, 0, total % capacity or capacity
                while start < total:
                    part = raw[4 * start:4 * (start + length)]
                    rows.append((doc_id, piece, start, length, zlib.crc32(part), task, seen.get(length, 0), part))
                    seen[length] = seen.get(length, 0) + 1
                    start, piece, length = start + length, piece + 1, capacity
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=False)], names=[f for f, _ in fields])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, task_rank long" + (", ids binary" if keep_ids else "")
    return documents(docs, id_col, text_col).select("doc_id", "text").mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY, nodes: int = NODES,
         id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Pack all documents into as few sequences of at most ``capacity`` ids as the search finds.

    A document is its ids and the end id; only one longer than ``capacity`` is cut, into pieces of ``capacity`` ids
    of which the first may be shorter.  One row per piece: ``doc_id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset`` and with ``keep_ids`` the ids (little-endian unsigned 32-bit).  Null
    and empty texts make a piece of the end id alone.  Every row of the input is packed for itself, also one that
    repeats another or has no id; an empty table gives no rows.
    """
    pieces = settle(cut_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col, keep_ids))
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    # at most `capacity` rows reach the driver, whatever the input
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(bin_completion(counts, capacity, nodes))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_rank"))
    ranked = pieces.join(firsts, ["length", "task"]).withColumn("rank", F.col("first_rank") + F.col("task_rank"))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        size, first, each, sequence, offset = table
        span = int(first.max(initial=0)) + int(rank.max()) + 1
        x, r = length.to_numpy(), rank.to_numpy()
        k = np.searchsorted(size * span + first, x * span + r, "right") - 1
        along, inside = np.divmod(r - first[k], each[k])
        return pd.DataFrame({"sequence_id": sequence[k] + along, "offset": offset[k] + inside * x})

    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "place.sequence_id", "place.offset", *(["ids"] if keep_ids else []))
