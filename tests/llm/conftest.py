import random

import pytest
from pyspark.sql import types as T

#: As documents, with columns whose names the operators use inside.
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("sid", T.StringType()), T.StructField("key", T.IntegerType()), T.StructField("n", T.StringType()), T.StructField("spans", T.StringType())])


def corpus(seed=7, docs=60):
    """Small documents with copies, near copies, shared passages and lines, junk, empty and null texts, a long one,
    a missing id and a repeated row."""
    r = random.Random(seed)
    words = [a + b for a in ("ba", "ko", "li", "mu", "né", "ro", "ti", "zu") for b in ("n", "ra", "sil", "to", "vé", "x")]
    passage = [r.choice(words) for _ in range(70)]
    rows = []
    for i in range(docs):
        t = [r.choice(words) + r.choice(["", "", ".", ",\n"]) for _ in range(r.randint(1, 160))]
        if i % 4 == 0:
            at = r.randint(0, len(t))
            t[at:at] = passage
        if i % 5 == 1 and rows:
            t = (rows[r.randrange(len(rows))][1] or "").split(" ")
            if i % 2:
                t[r.randrange(len(t))] = "changed"
        text = " ".join(t)
        if i % 3 == 0:
            text += "\nAll rights reserved \n"
        rows.append((i, text))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "ONE "), (905, "ab " * 300), (906, "x" * 5000), (907, "𝄞 é\x00  z  y\r\n"),
             (908, " ".join(r.choice(words) for _ in range(9000))), (None, rows[3][1]), (909, rows[3][1] + " "), (5, rows[5][1]),
             (910, "a <|endoftext|> b"), (911, "x<|endoftext|><|endoftext|>\nconfused <|endof text|>")]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 1, "n", None) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
