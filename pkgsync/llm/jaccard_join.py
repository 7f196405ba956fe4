"""N-gram Jaccard join by token-combination prefixes: exact links between documents whose shingle sets agree.

1. Equal sets are one *class* (a hash); everything below is about classes.  A class has the hashes of its shingles in
   one global order (by value), its size, and a small histogram sketch.
2. Two classes with a Jaccard similarity of at least ``threshold`` share at least E + 1 tokens among the first
   ``n - ceil(threshold * n) + 1 + E`` of each: the prefix, extended by E.
3. Tokens found in over ``FREQUENT`` prefixes are the frequent class, the others are rare.  Rare tokens are indexed
   alone.  The frequent ones are dealt into E groups by value, and all pairs within a group are indexed: E + 1
   shared frequent tokens leave two in one group.  A class with at most E frequent tokens in its prefix needs no
   pairs at all: one of its shared tokens is rare.  E depends only on the size (to a power of two) of the smaller
   class, and classes near a power are indexed for both.
4. Candidates from the index are pruned by size and by sketch (the sum of the histograms' differences never exceeds
   the sets' difference) and then verified on the whole sets.

Large groups of near copies: index entries with many classes are joined to groups and give no pair list at first, but
a spanning forest of each group's plausible pairs, nearest sketches first.  Verified links make components; then only
plausible pairs that still join two components are verified, inside the task that finds them, which gives back the links
that join.  So the components are exact and no group is ever written out as all its pairs, linked or not.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed, settle
from .components import components

#: Tokens in more prefixes than this are frequent; index entries of more classes than SMALL are large.
FREQUENT, SMALL = 32, 2
#: Bytes of a sketch; classes of an index entry handled in one task against another such part.
SKETCH, BLOCK = 64, 512
#: Tokens of such a part; most buckets of the histograms that pairs meet by before their sets; pairs compared in one step.
TOKENS, FINE, STEP = 4_000_000, 4096, 4096
#: Classes that meet all others of a part in one step.
ROWS = 16
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93))


class WordHashes(dict):
    """64-bit hashes of words, each computed once; bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


HASHES = WordHashes()


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted hashes of the distinct ``size``-word shingles; of fewer words the whole sequence is one."""
    words = text.encode().lower().split()  # bytes: lower() knows A-Z only, split() just \x20 and \x09-\x0D
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))
    out = h[:len(h) - size + 1].copy()
    for i in range(1, size):
        out = (out ^ (out >> np.uint64(31))) * MIX[i % 3] + h[i:len(h) - size + 1 + i]
    out = (out ^ (out >> np.uint64(29))) * MIX[0]
    return np.unique(out ^ (out >> np.uint64(32)))


def extension(size_class: int, percent: int) -> int:
    """E for classes whose smaller size is at least 2 ** size_class."""
    least = 1 << size_class
    return max(0, min(max(4, least // 20), -(-least * percent // 100) - 1))


def size_classes(n: int, percent: int) -> list[int]:
    """Powers of two that the smaller of a linked pair may have if this one has n tokens."""
    low = -(-n * percent // 100)
    return list(range(max(1, low).bit_length() - 1, n.bit_length()))


def prefix_length(n: int, size_class: int, percent: int) -> int:
    return min(n, n - -(-n * percent // 100) + 1 + extension(size_class, percent))


def sketch(tokens: np.ndarray) -> bytes:
    """Histogram of the tokens' low bits; counts stop at 255, which only lowers differences."""
    return histogram(tokens, SKETCH).tobytes()


def class_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """For (sid, missing, text): ``sid``, ``missing``, ``n``, ``cls`` (hash of the set), ``sketch``, ``tokens`` (the longest prefix; a task
    gives it once for a class, so copies send nothing more)."""
    fields = pa.schema([("sid", pa.int64()), ("missing", pa.bool_()), ("n", pa.int32()), ("cls", pa.int64()), ("sketch", pa.binary()), ("tokens", pa.list_(pa.int64()))])
    least = links_from(percent)

    def run(batches):
        given = set()
        for b in batches:
            ns, classes, sketches, prefixes = [], [], [], []
            for text in b["text"].to_pylist():
                s = shingles(text, size)
                n = len(s)
                ns.append(n)
                classes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63)
                sketches.append(sketch(s))
                new = n >= least and classes[-1] not in given
                given.add(classes[-1])
                prefixes.append(s[:max(prefix_length(n, c, percent) for c in size_classes(n, percent))].view(np.int64) if new else np.empty(0, np.int64))
            tokens = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(p) for p in prefixes])), pa.int32()), pa.array(np.concatenate([*prefixes, np.empty(0, np.int64)])))
            yield pa.RecordBatch.from_arrays([b["sid"], b["missing"], pa.array(ns, pa.int32()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary()), tokens], schema=fields)

    return docs.mapInArrow(run, "sid long, missing boolean, n int, cls long, sketch binary, tokens array<long>")


def links_from(percent: int) -> int:
    """The smallest set that can link with a different one: n / (n + 1) reaches the threshold."""
    return max(2, math.ceil(percent / (100 - percent))) if percent < 100 else 2**31


def signatures(nodes: DataFrame, percent: int) -> DataFrame:
    """Index entries: ``sig``, ``cls``, ``small`` (a rare token of at most SMALL classes)."""
    rows = nodes.select("cls", "n", F.posexplode("tokens").alias("pos", "token"))
    rows = rows.select("token", "cls", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")).alias("place"))
    # a class that several tasks gave counts as often; that only adds entries
    counts = rows.groupBy("token").agg(F.count(F.lit(1)).alias("found")).where("found > 1")
    # at most one prefix to a class; several tasks may have given it
    lists = rows.join(counts, "token").groupBy("cls").agg(F.collect_set(F.struct("place", "token", "found")).alias("t"))

    def run(batches):
        for b in batches:
            out_sig, out_cls, out_small = [], [], []
            for cls, t in zip(b["cls"].to_pylist(), b["t"], strict=True):
                place, token, found = (t.values.field(i).to_numpy() for i in range(3))
                n, pos = int(place[0] >> 32), place & 0xFFFFFFFF
                rare = found <= FREQUENT
                sig, small = [token[rare]], [found[rare] <= SMALL]
                for c in size_classes(n, percent):
                    e = extension(c, percent)
                    often = np.sort(token[~rare & (pos < prefix_length(n, c, percent))].view(np.uint64))
                    if len(often) <= e:
                        continue
                    group = often % np.uint64(e)
                    for g in np.unique(group):
                        own = often[group == g]
                        i, j = np.triu_indices(len(own), 1)
                        pair = (own[i] * MIX[0] + own[j]) * MIX[1] + np.uint64(c)
                        sig.append((pair ^ (pair >> np.uint64(31))).view(np.int64))
                        small.append(np.zeros(len(i), bool))
                sig = np.concatenate(sig)
                out_sig.append(sig)
                out_cls.append(np.full(len(sig), cls))
                out_small.append(np.concatenate(small))
            if out_sig:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (out_sig, out_cls, out_small)], names=["sig", "cls", "small"])

    return lists.mapInArrow(run, "sig long, cls long, small boolean")


def most_different(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """How many tokens two linked sets of these sizes may differ by; -1 if the sizes alone rule a link out."""
    shared = -(-percent * (a + b) // (100 + percent))
    return np.where((100 * np.minimum(a, b) >= percent * np.maximum(a, b)), a + b - 2 * shared, -1)


PAIR = "x long, y long"


def plausible(n: np.ndarray, h: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs i < j that sizes and sketches allow, and their sketch differences; ``n`` ascends.

    A few classes at a time meet all the others: sums of eight buckets first, then the pairs they leave by all buckets.
    """
    out = []
    ends = np.searchsorted(n, 100 * n // percent, "right")
    coarse = np.ascontiguousarray(h.reshape(len(h), 8, -1).sum(axis=2, dtype=np.int16).T)
    for r in range(0, len(n), ROWS):
        rows, others = slice(r, r + ROWS), slice(r, ends[r:r + ROWS].max())
        near = np.abs(coarse[:, rows, None] - coarse[:, None, others]).sum(axis=0, dtype=np.int16)
        both = n[rows, None] + n[others]
        i, j = np.nonzero(near <= both - 2 * -(-percent * both // (100 + percent)))
        i, j = i + r, j + r
        ok = (j > i) & (j < ends[i])
        i, j = i[ok], j[ok]
        gap = np.abs(h[j] - h[i]).sum(axis=1, dtype=np.int16)
        ok = gap <= most_different(n[i], n[j], percent)
        out.append((i[ok], j[ok], gap[ok]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.empty(0, np.int64),) * 3


def forest(i: np.ndarray, j: np.ndarray, gap: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Indices of the pairs of a spanning forest, smallest gaps first; equal labels are joined already.

    Each tree takes its smallest pair to another one, all at once, until none is left, so rounds grow with the
    logarithm of the classes.
    """
    k = np.argsort(gap, kind="stable")
    _, tree = np.unique(np.concatenate([label[i[k]], label[j[k]]]), return_inverse=True)
    a, b, taken = tree[:len(k)], tree[len(k):], [np.empty(0, np.int64)]
    trees = int(tree.max(initial=-1)) + 1
    while True:
        apart = a != b
        a, b, k = a[apart], b[apart], k[apart]
        if not len(k):
            return np.concatenate(taken)
        first = np.full((2, trees), len(k))
        for side, x in enumerate((a, b)):
            first[side, x[::-1]] = np.arange(len(k))[::-1]  # the last one written, the smallest, stays
        first = first.min(axis=0)
        own = np.flatnonzero(first < len(k))
        pick = first[own]
        taken.append(k[np.unique(pick)])
        parent = np.arange(trees)
        parent[own] = a[pick] + b[pick] - own
        mutual = own[(parent[parent[own]] == own) & (own < parent[own])]
        parent[mutual] = mutual
        while (parent != (up := parent[parent])).any():
            parent = up
        a, b = parent[a], parent[b]


def parts_of(batches, names: list[str]):
    """Rows of one (lead, part) at a time, as arrays, from batches sorted by these; ``sketch`` as a matrix."""
    held, key = [], None

    def part():
        t = pa.Table.from_batches(held)
        out = {c: t[c].to_numpy() for c in names if c not in ("sketch", "tokens", "fine")}
        out["n"] = out["n"].astype(np.int64)
        out["h"] = np.frombuffer(b"".join(t["sketch"].to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int16)
        for name, kind in (("tokens", np.uint64), ("fine", np.uint8)):
            if name in names:
                out[name] = [np.frombuffer(x.as_buffer(), kind) for c in t[name].chunks for x in c]
        return out

    for b in batches:
        if not b.num_rows:
            continue
        lead, number = b["lead"].to_numpy(), b["part"].to_numpy()
        cuts = (np.flatnonzero((lead[1:] != lead[:-1]) | (number[1:] != number[:-1])) + 1).tolist()
        for s, e in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if held and (lead[s], number[s]) != key:
                yield part()
                held = []
            key = lead[s], number[s]
            held.append(b.slice(s, e - s))
    if held:
        yield part()


def in_parts(groups: DataFrame, partitions: int) -> DataFrame:
    return groups.repartition(partitions, "lead", "part").sortWithinPartitions("lead", "part", "n", "cls")


def group_forests(groups: DataFrame, percent: int, partitions: int) -> DataFrame:
    """A spanning forest of each group's plausible pairs, nearest sketches first.

    ``groups``: lead, part (a pair of a group's blocks), cls, n, sketch.  A task sees one part of a group at a time, at
    most about 2 * BLOCK classes, and gives fewer pairs than these.
    """
    def run(batches):
        for t in parts_of(batches, ["cls", "n", "sketch"]):
            i, j, gap = plausible(t["n"], t["h"], percent)
            k = forest(i, j, gap, t["cls"])
            x, y = t["cls"][i[k]], t["cls"][j[k]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["x", "y"])

    return in_parts(groups, partitions).mapInArrow(run, PAIR).distinct()


def finely_near(fine: list[np.ndarray], n: np.ndarray, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs the histograms of ``class_sets`` allow; the finer one folds to the other's buckets."""
    size = np.array([min(len(f), FINE) for f in fine])
    least, ok, allowed = np.minimum(size[i], size[j]), np.zeros(len(i), bool), most_different(n[i], n[j], percent)
    for b in np.unique(least):
        at = np.flatnonzero(least == b)
        rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        h = np.stack([np.minimum(fine[r].reshape(-1, b).sum(axis=0, dtype=np.int32), 255) for r in rows]).astype(np.int16)
        x, y = place[:len(at)], place[len(at):]
        for s in range(0, len(at), STEP):
            some = slice(s, s + STEP)
            ok[at[some]] = np.abs(h[x[some]] - h[y[some]]).sum(axis=1, dtype=np.int32) <= allowed[at[some]]
    return ok


def open_classes(groups: DataFrame, percent: int, partitions: int) -> DataFrame:
    """Rows of the parts (with ``label``) that have a plausible pair to a class of another label in their part; where
    the groups have ``fine``, one that these histograms allow too."""
    names, finer = ["lead", "part", "cls", "n", "label"], ["fine"] if "fine" in groups.columns else []

    def run(batches):
        for t in parts_of(batches, [*names, "sketch", *finer]):
            if (t["label"] == t["label"][0]).all():
                continue
            i, j, _ = plausible(t["n"], t["h"], percent)
            apart = t["label"][i] != t["label"][j]
            i, j = i[apart], j[apart]
            if finer:
                near = finely_near(t["fine"], t["n"], i, j, percent)
                i, j = i[near], j[near]
            k = np.unique(np.concatenate([i, j]))
            yield pa.RecordBatch.from_arrays([pa.array(t[c][k]) for c in names] + [pa.array([x.astype(np.uint8).tobytes() for x in t["h"][k]], pa.binary())],
                                             names=[*names, "sketch"])

    return in_parts(groups, partitions).mapInArrow(run, "lead long, part int, cls long, n long, label long, sketch binary")


def joining_links(tokens: list[np.ndarray], n: np.ndarray, h: np.ndarray, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links, verified on whole sets, that join all labels that any links of these classes join: a spanning forest."""
    i, j, gap = plausible(n, h, percent)
    apart = label[i] != label[j]
    i, j, gap = i[apart], j[apart], gap[apart]
    order = np.argsort(gap, kind="stable")
    fine = [histogram(t, min(FINE, 1 << max(0, len(t) - 1).bit_length())) for t in tokens]
    tree, links = dict.fromkeys(label.tolist()), []

    def root(x):
        while tree[x] is not None:
            x = tree[x]
        return x

    i, j = i[order], j[order]
    near = finely_near(fine, n, i, j, percent)
    for x, y in zip(i[near].tolist(), j[near].tolist(), strict=True):
        p, q = root(int(label[x])), root(int(label[y]))
        if p == q:
            continue
        u, v = tokens[x], tokens[y]
        at = np.searchsorted(u, v)
        shared = int((u[np.minimum(at, len(u) - 1)] == v).sum())
        if 100 * shared >= percent * (len(u) + len(v) - shared):
            tree[max(p, q)] = min(p, q)
            links.append((x, y))
    return links


def group_links(groups: DataFrame, percent: int, partitions: int) -> DataFrame:
    """Links of each part's classes, verified where their sets (``tokens``) meet, that join labels."""
    def run(batches):
        for t in parts_of(batches, ["cls", "n", "sketch", "label", "tokens"]):
            found = joining_links(t["tokens"], t["n"], t["h"], t["label"], percent)
            x, y = (t["cls"][[f[k] for f in found]] if found else np.empty(0, np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["x", "y"])

    return in_parts(groups, partitions).mapInArrow(run, PAIR).distinct()


def large_groups(entries: DataFrame, info: DataFrame) -> DataFrame:
    """Large index entries with the same smallest class (its *lead*) as one group, in parts.

    Near copies share many entries and mostly the lead, so their pairs are looked at once instead of once per entry.
    Classes of a group go to blocks by hash (by their number and their tokens), each pair of blocks is a part: every
    pair meets in a part, and no part is large.
    """
    leads = entries.groupBy("sig").agg(F.min("cls").alias("lead"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
    groups = entries.join(leads, "sig").select("lead", "cls").distinct().join(info.select("cls", F.col("n").cast("long").alias("n")), "cls")
    sizes = groups.groupBy("lead").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / TOKENS)).cast("int").alias("nb"))
    both = groups.join(sizes, "lead").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    return (both.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
            .select("lead", (F.least("own", "other") * F.col("nb") + F.greatest("own", "other")).cast("int").alias("part"), "cls", "n")
            .join(info.select("cls", "sketch"), "cls"))


def small_pairs(entries: DataFrame, info: DataFrame, percent: int) -> DataFrame:
    """Plausible pairs of the entries of at most SMALL classes."""
    lists = entries.groupBy("sig").agg(F.array_sort(F.collect_set("cls")).alias("c")).where("size(c) > 1")  # at most SMALL
    left = lists.select(F.posexplode("c").alias("i", "x"), "c")
    pairs = left.select("x", F.explode(F.slice("c", F.col("i") + 2, SMALL)).alias("y")).distinct()
    x, y = (info.select(F.col("cls").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"s{k}")) for k in "xy")

    @F.pandas_udf("boolean")
    def allowed(nx, ny, sx, sy):
        import pandas as pd

        a, b = (np.frombuffer(b"".join(s), np.uint8).reshape(-1, SKETCH).astype(np.int16) for s in (sx, sy))
        return pd.Series(np.abs(a - b).sum(axis=1) <= most_different(nx.to_numpy().astype(np.int64), ny.to_numpy().astype(np.int64), percent))

    near = (F.lit(100) * F.least("nx", "ny") >= F.lit(percent) * F.greatest("nx", "ny"))
    return pairs.join(x, "x").join(y, "y").where(near).where(allowed("nx", "ny", "sx", "sy")).select("x", "y")


def class_sets(docs: DataFrame, members: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
    """The whole sets of the classes in pairs, each from its first document: ``cls``, ``fine`` (a histogram of about as
    many buckets as tokens), ``tokens`` (binary)."""
    need = pairs.select(F.col("x").alias("cls")).unionByName(pairs.select(F.col("y").alias("cls"))).distinct()
    first = members.join(need, "cls", "left_semi").groupBy("cls").agg(F.min("sid").alias("to"))
    texts = docs.join(first, F.col("sid") == F.col("to")).select("cls", "text").dropDuplicates(["cls"])

    def run(batches):
        for b in batches:
            sets = [shingles(t, size) for t in b["text"].to_pylist()]
            fine = [histogram(x, 1 << max(0, len(x) - 1).bit_length()).tobytes() for x in sets]
            yield pa.RecordBatch.from_arrays([b["cls"], pa.array(fine, pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["cls", "fine", "tokens"])

    return texts.mapInArrow(run, "cls long, fine binary, tokens binary")


def histogram(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Counts of the tokens' low bits, up to 255."""
    return np.minimum(np.bincount((tokens & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets), 255).astype(np.uint8)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets link.

    Histograms of about as many buckets as tokens come first: their differences rule out nearly all other pairs at an
    eighth of the bytes, so whole sets travel for the likely links alone.
    """
    def both(pairs: DataFrame, column: str) -> DataFrame:
        x, y = (sets.select(F.col("cls").alias(k), F.octet_length("tokens").alias(f"n{k}"), F.col(column).alias(f"c{k}")) for k in "xy")
        return pairs.join(x, "x").join(y, "y")

    @F.pandas_udf("boolean")
    def near(nx, ny, cx, cy):
        import pandas as pd

        out = []
        for a, b, p, q in zip(nx, ny, cx, cy, strict=True):
            p, q = np.frombuffer(p, np.uint8).astype(np.int32), np.frombuffer(q, np.uint8).astype(np.int32)
            least = min(len(p), len(q))  # the finer one folds to the other's buckets
            p, q = (np.minimum(h.reshape(-1, least).sum(axis=0), 255) for h in (p, q))
            out.append(np.abs(p - q).sum() <= most_different(np.int64(a // 8), np.int64(b // 8), percent))
        return pd.Series(out, dtype=bool)

    @F.pandas_udf("boolean")
    def link(cx, cy):
        import pandas as pd

        out = []
        for p, q in zip(cx, cy, strict=True):
            a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            shared = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * shared >= percent * (len(a) + len(b) - shared))
        return pd.Series(out, dtype=bool)

    likely = settle(both(pairs, "fine").where(near("nx", "ny", "cx", "cy")).select("x", "y"))
    return both(likely, "tokens").where(link("cx", "cy")).select("x", "y")


def linked_classes(docs: DataFrame, members: DataFrame, index: DataFrame, info: DataFrame, size: int, percent: int) -> DataFrame:
    """Components of the linked classes: ``node``, ``label``; classes without a link have no row."""
    spark = docs.sparkSession
    partitions = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    large = settle(large_groups(index.where("not small").select("sig", "cls"), info))
    pairs = settle(small_pairs(index.where("small"), info, percent).unionByName(group_forests(large, percent, partitions)).distinct())
    sets = settle(class_sets(docs, members, pairs, size))
    links = settle(verified(pairs, sets, percent))
    labels = components(links)
    # what may still join two components: histograms go to the parts of such pairs, whole sets to what these leave,
    # and only links come back; every class of such a pair is in the forest of its group, and so in `sets`
    labelled = large.join(labels, F.col("cls") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cls")).drop("node")
    rest = settle(open_classes(labelled, percent, partitions))
    rest = settle(open_classes(rest.join(sets.select("cls", "fine"), "cls"), percent, partitions))
    if rest.isEmpty():
        return labels
    more = settle(group_links(rest.join(sets.select("cls", "tokens"), "cls"), percent, partitions))
    return labels if more.isEmpty() else components(links.unionByName(more))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents linked by a Jaccard similarity of at least ``percent`` / 100 of their shingle sets.

    One row per input row: ``sid`` (see ``doc_key``), ``missing`` (no id), ``doc_id``, ``n_shingles``, ``component`` (the
    sid of the first document that links reach, its own included), ``component_missing`` and ``component_id`` (null
    where that document has no id).  Words are split at \\x20 and \\x09-\\x0D, A-Z in lower case; fewer than ``size``
    words make one shingle; texts without words (also null) have none and link with nothing.  Rows without an id
    stand for themselves (or with equal texts) and come last in the order of ids; repeated rows have equal sets and
    so one component.  An empty table gives no rows; extra columns are left out.  Shingles and sets are told apart
    by 64-bit hashes.
    """
    own = documents(docs, id_col, text_col)
    heavy = settle(class_rows(own.select("sid", F.col("doc_id").isNull().alias("missing"), "text"), size, percent))
    base = settle(heavy.drop("tokens"))
    index = settle(signatures(heavy.where(F.size("tokens") > 0), percent))
    del heavy  # the prefixes go with the next checkpoint
    members = base.where("n > 0").select("sid", "missing", "cls")
    info = base.where(F.col("n") >= links_from(percent)).groupBy("cls").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    labels = linked_classes(own.select("sid", "text"), members, index, info, size, percent)
    first = members.groupBy("cls").agg(F.min(F.struct("missing", "sid")).alias("least"))
    named = first.join(labels, F.col("cls") == F.col("node"), "left").withColumn("label", F.coalesce("label", "cls"))
    # the smallest document of each component, given back to its classes; then to the documents, copies salted
    least = named.groupBy("label").agg(F.min("least").alias("component"))
    of_class = named.join(least, "label").select("cls", "component", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("salt"))
    rows = base.select("sid", "missing", "n", "cls", F.pmod(F.hash("sid"), F.lit(8)).alias("salt"))
    out = rows.join(of_class, ["cls", "salt"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.struct("missing", "sid"))
    named = out.select("sid", "missing", F.col("n").cast("long").alias("n_shingles"), component.alias("of"))
    return named.select("sid", "missing", F.when(~F.col("missing"), F.col("sid")).alias("doc_id"), "n_shingles", F.col("of.sid").alias("component"),
                        F.col("of.missing").alias("component_missing"), F.when(~F.col("of.missing"), F.col("of.sid")).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each component, with all its columns."""
    lost = near_duplicates(docs, size, percent, id_col, text_col).where("sid <> component OR missing <> component_missing").select("sid", "missing").distinct()
    return keyed(docs, id_col, text_col).select("sid", "missing", "row").join(lost, ["sid", "missing"], "left_anti").select("row.*")
