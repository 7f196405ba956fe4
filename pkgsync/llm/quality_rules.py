"""Quality filtering by weak supervision: rules vote good or bad or abstain, EM estimates how far each rule can be
trusted, and the posterior probability of good quality decides.

One pass over the texts counts what the rules need (a small row per document); the rules themselves are column
expressions over those counts.  The counts of vote patterns (at most 3 ** rules) go to the driver, the posterior of
each pattern goes back by a broadcast join of the same bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed, settle
from .label_model import LabelModel

SYMBOLS = "#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_alpha", "n_top"]
MIN_WORDS, MAX_REPEAT = 50, 0.5
KEEP_FROM = 0.5


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    raw = text.encode()
    words = raw.split()  # bytes split at \x20 and \x09-\x0D exactly
    chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    seen, dup, lines = set(), 0, 0
    for line in raw.split(b"\n"):
        if line.split(None, 1):
            lines += 1
            dup += line in seen
            seen.add(line)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    times = np.bincount(ids, minlength=1)
    repeat = 0
    if len(ids) >= 3:
        n = len(number)
        if n < 2_000_000:
            codes = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
        else:  # too many distinct words for one 64-bit code: number the pairs first
            codes = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)[1] * n + ids[2:]
        _, which, found = np.unique(codes, return_inverse=True, return_counts=True)
        twice = found[which] > 1
        cover = np.zeros(len(ids), bool)
        for k in range(3):
            cover[k:len(ids) - 2 + k] |= twice
        repeat = int(cover.sum())
    alpha = sum(int(times[i]) for w, i in number.items() if w.decode().strip(".,;:!?\"'()-").isalpha())
    return len(words), chars, symbols, dup, repeat, lines, len(number), alpha, int(times.max()) if words else 0


def count_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sid``, ``doc_id`` and the COUNTS of every whole text; null counts as empty."""
    def run(batches):
        for b in batches:
            rows = [text_counts(t) for t in b["text"].to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * len(COUNTS))]
            yield pa.RecordBatch.from_arrays([b["sid"], b["doc_id"], *columns], names=["sid", "doc_id", *COUNTS])

    return documents(docs, id_col, text_col).mapInArrow(run, "sid long, doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 100 * MAX_REPEAT * F.col("n_words"))


def votes() -> dict[str, Column]:
    """Each rule: 1 for good, -1 for bad, 0 to abstain.  A share of no words abstains."""
    words, lines = F.nullif(F.col("n_words"), F.lit(0)), F.nullif(F.col("n_lines"), F.lit(0))

    def rule(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    mean = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    dup = F.col("n_dup_lines") / lines
    repeat = F.col("n_repeat_words") / words
    variety = F.col("n_distinct") / words
    alpha = F.col("n_alpha") / words
    top = F.col("n_top") / words
    return {
        "length": rule(F.col("n_words") < MIN_WORDS, F.col("n_words") >= 2 * MIN_WORDS),
        "word_length": rule((mean < 2.5) | (mean > 15), (mean >= 3) & (mean <= 12)),
        "symbols": rule(symbols > 0.1, symbols < 0.02),
        "dup_lines": rule(dup > 0.4, (dup < 0.05) & (lines >= 3)),
        "repeats": rule(repeat > 0.3, repeat < 0.1),
        "variety": rule(variety < 0.1, variety > 0.4),
        "alphabetic": rule(alpha < 0.6, alpha > 0.85),
        "top_word": rule(top > 0.3, top < 0.15),
    }


def posterior_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``sid``, ``doc_id``, the COUNTS, ``base_failed``, ``quality`` (posterior probability)
    and ``kept``.

    A row is kept if no base rule fails it and its posterior is at least ``KEEP_FROM``.  Null and empty texts fail.
    Patterns are counted over all rows, repeated ones too; rows without an id are judged like any other; an empty
    table gives no rows.
    """
    rules = votes()
    counted = count_texts(docs, id_col, text_col)
    voted = settle(counted.withColumn("base_failed", base_failed()).withColumn("votes", F.concat_ws(",", *[v.cast("string") for v in rules.values()])))
    patterns = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 ** rules rows
    m = np.array([[int(v) for v in r["votes"].split(",")] for r in patterns], dtype=np.int64).reshape(-1, len(rules))
    # first guess: a bad vote tells more than a good one, as most rules look for one fault each
    start = np.where((m == -1).sum(axis=1) > 0, 0.1 / np.maximum(1, (m == -1).sum(axis=1)), 0.95)
    model = LabelModel(m, np.array([r["n"] for r in patterns]), start)
    table = docs.sparkSession.createDataFrame([(r["votes"], float(p)) for r, p in zip(patterns, model.posterior(m), strict=True)], "votes string, quality double")
    out = voted.join(F.broadcast(table), "votes", "left")  # bounded by 3 ** rules rows
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)).drop("votes")


def drop_low_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all their columns."""
    lost = posterior_quality(docs, id_col, text_col).groupBy("sid").agg(F.max("kept").alias("any")).where(~F.col("any")).select("sid")
    return keyed(docs, id_col, text_col).select("sid", "row").join(lost, "sid", "left_anti").select("row.*")
