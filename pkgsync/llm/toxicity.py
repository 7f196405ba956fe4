"""Toxicity by weak supervision: lexicon and pattern voters, a generative model of their accuracies and correlations,
and a linear classifier trained on its posterior labels.

1. Labelled rows outside the held-out fold (at most ``SAMPLE`` of them, those with the smallest hash of the id)
   give graded lexicons: words by their log odds between toxic and clean documents.
2. One pass over all texts counts hits of the voters' lexicons and patterns (a small row per document).
3. The label model fits accuracies and within-class correlations on the counted vote patterns of all rows (at most
   3 ** voters), with the known labels of the training fold held fixed.
4. A logistic regression over the hit counts learns the posterior labels of the training fold, on Spark.

Labels, language, source and id are never inputs of a score.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import documents, settle
from .label_model import LabelModel

# Plain words of insult and contempt by strength, in four languages.
INSULTS = ["asshole", "bastard", "bitch", "cretin", "dumbass", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "scum", "stupid", "idiota", "idioten",
           "imbécile", "imbécil", "estúpido", "crétin", "trottel", "arschloch", "dummkopf"]
CONTEMPT = ["clown", "disgusting", "filth", "garbage", "pathetic", "repulsive", "ridiculous", "trash", "useless", "vermin", "worthless", "ekelhaft", "wertlos",
            "dégoûtant", "asqueroso", "inútil", "basura", "müll"]
THREATS = ["burn", "hate", "hurt", "kill", "murder", "shut"]
#: At most this many labelled rows choose the lexicons' words.
SAMPLE = 20_000
#: Words of the learnt lexicons: at most so many, each in at least this share of the sampled documents, and in 5.
WORDS, SUPPORT = 300, 0.001
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")
SHOUT = re.compile(r"!{2,}|\b[A-Z]{4,}\b")

HITS = ["insults", "contempt", "threats", "strong", "medium", "weak", "clean", "shouts"]


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, mod 4; 2 is held out.  A missing id counts as empty text (fold 0)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(4))


def learn_lexicons(docs: DataFrame, labels: DataFrame) -> dict[str, list[str]]:
    """Graded lexicons from the training fold: at most WORDS words by the absolute log odds reach the driver."""
    train = labels.where((fold() != 2) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = sample.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("__toxic"))
    texts = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("__id"))  # at most SAMPLE rows
    words = texts.select("__toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("w")).where("length(w) > 1")
    n = sample.agg(F.coalesce(F.sum("__toxic"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, clean = n["t"], n["n"] - n["t"]
    counted = words.groupBy("w").agg(F.sum("__toxic").alias("t"), F.sum(1 - F.col("__toxic")).alias("c")).where(F.col("t") + F.col("c") >= max(5, SUPPORT * n["n"]))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    top = counted.withColumn("odds", odds).orderBy(F.desc(F.abs("odds") * F.sqrt(F.col("t") + F.col("c"))), "w").limit(WORDS).collect()
    return {"strong": [r["w"] for r in top if r["odds"] > 4], "medium": [r["w"] for r in top if 2 < r["odds"] <= 4],
            "weak": [r["w"] for r in top if 1 < r["odds"] <= 2], "clean": [r["w"] for r in top if r["odds"] < -1]}


def count_hits(docs: DataFrame, lexicons: dict[str, list[str]]) -> DataFrame:
    """``sid``, ``doc_id``, the number of words and of distinct-word hits and total hits of every voter."""
    sets = {k: frozenset(v) for k, v in lexicons.items()}

    def run(batches):
        for b in batches:
            rows = []
            for t in b["text"].to_pylist():
                words = WORD.findall(t.lower())
                distinct = set(words)
                row = [len(words)]
                for k in HITS[:-1]:
                    found = distinct & sets[k]
                    row += [len(found), sum(words.count(w) for w in found)]
                shouts = SHOUT.findall(t)
                rows.append(row + [len(set(shouts)), len(shouts)])
            columns = [pa.array(c, pa.int32()) for c in (zip(*rows, strict=True) if rows else [[]] * (1 + 2 * len(HITS)))]
            yield pa.RecordBatch.from_arrays([b["sid"], b["doc_id"], *columns], names=["sid", "doc_id", "n_words", *[f"{k}_{x}" for k in HITS for x in ("kinds", "hits")]])

    schema = "sid long, doc_id long, n_words int, " + ", ".join(f"{k}_{x} int" for k in HITS for x in ("kinds", "hits"))
    return documents(docs).mapInArrow(run, schema)


def votes() -> dict[str, Column]:
    """Each voter: 1 for toxic, -1 for clean, 0 to abstain."""
    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    density = (F.col("strong_hits") + F.col("insults_hits") + F.col("contempt_hits")) / F.greatest("n_words", F.lit(1))
    return {
        "insults": vote(F.col("insults_kinds") > 0, F.lit(False)),
        "contempt": vote(F.col("contempt_kinds") > 0, F.lit(False)),
        "threats": vote(F.col("threats_kinds") > 1, F.lit(False)),
        "strong": vote(F.col("strong_kinds") > 1, F.col("strong_kinds") == 0),
        "medium": vote(F.col("medium_kinds") > 2, F.col("medium_kinds") == 0),
        "weak": vote(F.col("weak_kinds") > 4, F.col("weak_kinds") == 0),
        "clean": vote(F.lit(False), F.col("clean_kinds") > 3),
        "dense": vote(density > 0.005, density == 0),
        "shouting": vote(F.col("shouts_kinds") > 3, F.lit(False)),
    }


def inputs() -> list[Column]:
    """What the classifier sees: log counts and densities of hits."""
    per = F.greatest(F.col("n_words"), F.lit(1))
    return [c for k in HITS for c in (F.log1p(F.col(f"{k}_kinds").cast("double")), F.least(F.lit(1.0), 20.0 * F.col(f"{k}_hits") / per))]


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from ``THRESHOLD``).

    ``labels`` has ``doc_id`` and ``toxic``; rows of the held-out fold and null labels are never looked at, several
    labels of one id count as toxic if one is.  Null and empty texts have no hits and get the score of no evidence;
    rows without an id are scored like any other.  Without any usable label the voters alone teach the classifier.
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    plain = documents(docs)
    lexicons = {"insults": INSULTS, "contempt": CONTEMPT, "threats": THREATS} | learn_lexicons(plain, labels)
    rules = votes()
    counted = settle(count_hits(docs, lexicons).select("sid", "doc_id", F.concat_ws(",", *[v.cast("string") for v in rules.values()]).alias("votes"), F.array(*inputs()).alias("x"), (fold() == 2).alias("held_out")))
    known = (labels.where((fold() != 2) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("double").alias("toxic"))
             .select(F.col("doc_id").alias("__id"), "toxic"))
    train = settle(counted.where(~F.col("held_out")).join(known, F.col("doc_id") == F.col("__id"), "left").select("votes", "toxic", "x"))
    # at most 3 ** voters patterns, each with or without one of two labels
    patterns = train.groupBy("votes", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    m = np.array([[int(v) for v in r["votes"].split(",")] for r in patterns], dtype=np.int64).reshape(-1, len(rules))
    fixed = np.array([np.nan if r["toxic"] is None else r["toxic"] for r in patterns], dtype=float)
    start = np.where((m == 1).sum(axis=1) > 1, 0.8, np.where((m == 1).sum(axis=1) > 0, 0.3, 0.02))
    model = LabelModel(m, np.array([r["n"] for r in patterns]), start, fixed, correlated=True)
    spark = docs.sparkSession
    soft = spark.createDataFrame([(r["votes"], r["toxic"], float(p)) for r, p in zip(patterns, model.p, strict=True)], "votes string, toxic double, p double")
    taught = train.join(F.broadcast(soft.withColumnsRenamed({"votes": "v2", "toxic": "t2"})), (F.col("votes") == F.col("v2")) & F.col("toxic").eqNullSafe(F.col("t2")))
    if not patterns:
        weights, bias = [0.0] * (2 * len(HITS)), 0.0
    else:
        # rows with the same inputs and label weigh together; each is both classes, by its posterior
        merged = taught.groupBy("x").agg(F.sum("p").alias("one"), F.sum(1 - F.col("p")).alias("zero"))
        both = merged.select(array_to_vector("x").alias("features"), F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("one").alias("weight")), F.struct(F.lit(0.0).alias("label"), F.col("zero").alias("weight")))).alias("y"))
        fit = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=40).fit(settle(both.select("features", "y.label", "y.weight").where("weight > 0")))
        weights, bias = [float(w) for w in fit.coefficients] if fit.numClasses == 2 else [0.0] * (2 * len(HITS)), float(fit.intercept)
    z = F.lit(bias)
    for i, w in enumerate(weights):
        z = z + F.lit(w) * F.col("x")[i]
    scored = counted.select("doc_id", "held_out", (1 / (1 + F.exp(-z))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
