"""Line dedup: explode normalised lines, hash, count the documents of each hash, drop lines at the threshold, and
reassemble the text by line position.

Texts don't travel with their lines: the exploded rows hold two hashes, the document and the position.  The keys
found often enough are few (at most the line rows over the threshold); each is repeated over ``SALTS`` salts, so
the rows of a line that stands in a third of all documents spread over that many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, doc_key, documents

SALTS = 16


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.btrim(line, F.lit(SPACE)), upper, upper.lower())


def dropped_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sid`` and the positions (from 0) of its lines whose key stands in at least ``min_docs`` documents."""
    lines = documents(docs, id_col, text_col).select("sid", F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    keys = lines.select("sid", "at", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    # 128 bits name a key
    rows = keys.select("sid", "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"))
    often = (rows.groupBy("h1", "h2", "sid").agg(F.lit(1).alias("one")).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") >= min_docs).select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    hit = rows.withColumn("salt", F.pmod(F.hash("sid"), F.lit(SALTS))).join(often, ["h1", "h2", "salt"], "left_semi")
    return hit.groupBy("sid").agg(F.collect_set("at").alias("__llm_gone"))


def drop_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its text less the dropped lines: all columns, ``text_col`` replaced, and ``llm_n_lines`` and
    ``llm_n_dropped``.

    A null or empty text has one empty line, and empty keys (below ``min_chars`` code points) are never dropped.
    Documents are counted by id (rows without one by their text), so repeated rows count once, and each row of an id
    loses the lines found for it.  The largest collected group is the lines of one document.
    """
    gone = dropped_lines(docs, min_docs, min_chars, id_col, text_col).withColumnRenamed("sid", "__llm_sid")
    keyed = docs.withColumn("__llm_key", doc_key(id_col, text_col)).withColumn(text_col, F.coalesce(F.col(text_col), F.lit("")))
    both = keyed.join(gone, F.col("__llm_key") == F.col("__llm_sid"), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    # array_except hashes, so a document of n lines takes n steps however many go
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "__llm_gone")
    kept = F.concat_ws("\n", F.transform(stay, lambda i: F.element_at(lines, i + 1)))
    touched = F.col("__llm_gone").isNotNull()
    return (both.withColumn("llm_n_lines", F.size(lines).cast("long"))
            .withColumn("llm_n_dropped", F.when(touched, F.size(lines) - F.size(stay)).otherwise(0).cast("long"))
            .withColumn(text_col, F.when(touched, kept).otherwise(F.col(text_col))).drop("__llm_key", "__llm_sid", "__llm_gone"))
