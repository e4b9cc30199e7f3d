"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, extra columns with clashing names."""

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("n", T.StringType()), T.StructField("sid", T.StringType()), T.StructField("spans", T.StringType())])
LABELS = "doc_id bigint, quality int, toxic int"


def words(r, n, letters="abcdefghij"):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(1, 8))) for _ in range(n))


def texts(seed=1, n=40):
    """Texts with exact copies, near copies, shared passages, short, empty and null ones, and a long one."""
    r = random.Random(seed)
    out = [words(r, r.randint(1, 200)) for _ in range(n)]
    passage = words(r, 60)
    out += [out[0], out[0], out[1] + " tail", out[2].replace(" ", "\n", 3), passage + " " + words(r, 30), words(r, 20) + "\n" + passage, passage]
    base = words(r, 150).split()
    for i in range(12):
        own = list(base)
        for _ in range(i // 2):
            own[r.randrange(len(own))] = words(r, 1)
        out.append(" ".join(own))
    out += [None, "", " \n\t", "a", "a b", "A B", "é ü 漢字 🙂", "x" * 500, "ab" * 400, words(r, 4000), "<|endoftext|> </s>[INST] \\"]
    return out


def documents(spark, found=None):
    found = texts() if found is None else found
    rows = [(i, t, ("en", "de", None)[i % 3], "src0", len(t or ""), "x", None, "y") for i, t in enumerate(found)]
    rows += [(3, found[3], "en", None, None, None, None, None), (None, found[4], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)] if len(found) > 5 else []
    return spark.createDataFrame(rows, DOCS).repartition(3)


def pairs(df):
    """(doc_id, text) of every row."""
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
