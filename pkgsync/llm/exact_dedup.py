"""Exact dedup by a tree-merge of sorted digest runs, in DataFrame operations only.

Every scan partition is a run: its rows, reduced to one entry per digest (rows counted, the best row kept).  Runs
have numbers below ``FAN ** rounds``.  In round r a run keeps the digests whose r-th digit (base ``FAN``) equals its
own r-th digit and sends the others to the runs that differ from it in that digit alone: a binomial exchange, with
``FAN`` partners instead of two.  Each receiver sorts and merges what comes in (the min of a struct makes Spark sort
by the digest and aggregate over the sorted rows), so entries meet again and again and a group of copies shrinks to
one entry per run in each round: no task ever gets a hot group whole.  After the last round run i holds exactly the
digests with number i, each once, with the smallest verified identifier.

An entry's key is verified: the SHA-256 of the normalised text together with its length and an independent 64-bit
hash, so entries merge at any level only when all three agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed, settle

#: Runs that exchange with each other in a round; the salts over which a group's rows are spread in the last join.
FAN, SALTS = 8, 16
KEY = ["digest", "n_norm", "check"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sid``, ``doc_id``, ``n_chars`` of the text and the verified key of its normal form; no text."""
    d = documents(docs, id_col, text_col).withColumn("norm", normalised(F.col("text")))
    return d.select("sid", "doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("norm", 256).alias("digest"),
                    F.octet_length("norm").cast("long").alias("n_norm"), F.xxhash64("norm").alias("check"))


def digit(number: Column, r: int) -> Column:
    return F.pmod(F.shiftright(number, 3 * r), F.lit(FAN))


def merge_runs(entries: DataFrame, rounds: int) -> DataFrame:
    """Binomial rounds of exchange and merge over (run, key, best, n)."""
    for r in range(rounds):
        own, theirs = digit(F.col("run"), r), digit(F.col("check"), r)
        moved = entries.withColumn("run", F.col("run") + (theirs - own) * FAN**r)
        entries = moved.groupBy("run", *KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    return entries


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    """For each row its group of equal normalised texts.

    One row per input row: ``doc_id``, ``keep_id`` (of the row with the most code points, then the smallest id;
    rows without an id stand last), ``group_size``, ``kept``, ``text_sha256``.  Null text counts as empty; empty
    texts are equal.  Rows that repeat the kept id with the same text are all ``kept``: they are one document.
    An empty table gives no rows; extra columns are left out.
    """
    return (group_rows(docs, id_col, text_col, rounds)
            .select("doc_id", F.when(~F.col("keep_missing"), F.col("keep_sid")).alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256")))


def group_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    rows = settle(digests(docs, id_col, text_col))
    n_runs = max(1, rows.rdd.getNumPartitions())
    if rounds is None:
        rounds = 1
        while FAN**rounds < n_runs:
            rounds += 1
    missing = F.col("doc_id").isNull()
    best = F.struct((-F.col("n_chars")).alias("most"), missing.alias("missing"), F.col("sid"))
    leaves = (rows.withColumn("run", F.pmod(F.spark_partition_id(), F.lit(FAN**rounds)).cast("long"))
              .groupBy("run", *KEY).agg(F.min(best).alias("best"), F.count(F.lit(1)).alias("n")))
    groups = merge_runs(leaves, rounds).where("n > 1").select(*KEY, F.col("best.sid").alias("keep_sid"), F.col("best.missing").alias("keep_missing"), F.col("n").alias("group_size"))
    # a group's rows are spread over salts, and the one row of the group is repeated for each
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.withColumn("salt", F.pmod(F.hash("sid"), F.lit(SALTS))).join(salted, [*KEY, "salt"], "left")
    keep_sid, keep_missing = F.coalesce("keep_sid", "sid"), F.coalesce("keep_missing", missing)
    return joined.select("sid", "doc_id", "digest", "check", keep_sid.alias("keep_sid"), keep_missing.alias("keep_missing"),
                         F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
                         ((keep_sid == F.col("sid")) & (keep_missing == missing)).alias("kept"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept row of each group, with all its columns; of repeated rows one stays.

    A row is told by its id and the digest of its text, as one id may stand for several texts.
    """
    rows = group_rows(docs, id_col, text_col).withColumn("missing", F.col("doc_id").isNull())
    key = ["sid", "missing", "digest"]
    # only rows of groups with copies can go
    lost = rows.where(~F.col("kept")).select(*key).distinct()
    twice = rows.where("kept and group_size > 1").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key)
    whole = keyed(docs, id_col, text_col)
    own = whole.select("sid", "missing", F.sha2(normalised(F.coalesce("body", F.lit(""))), 256).alias("digest"), "row")
    stay = own.join(lost, key, "left_anti")
    repeated = stay.join(twice, key, "left_semi").dropDuplicates(key)
    return stay.join(twice, key, "left_anti").unionByName(repeated).select("row.*")
