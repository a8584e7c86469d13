"""Small tables with the awkward cases, and plain versions of the operators."""

import random
import re

from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                    T.StructField("n_tokens", T.StringType()), T.StructField("class", T.IntegerType()),
                    T.StructField("version", T.StringType()), T.StructField("start", T.StringType())])


def docs_df(spark, rows):
    """Documents with further columns whose names clash with ones that the operators use."""
    return spark.createDataFrame([(i, t, "x", 1, "v", "s") for i, t in rows], DOC)


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def mixed_docs(seed=3):
    """Exact copies, near copies, shared passages, white space of all kinds, nulls, empty and long texts."""
    rng = random.Random(seed)
    base = [sentence(rng, rng.randint(60, 160)) for _ in range(12)]
    passage = sentence(rng, 70)
    out = []
    for t in base:
        out.append(t)
        out.append(t.upper())
        words = t.split()
        for _ in range(3):
            w = list(words)
            for _ in range(rng.randint(1, 4)):
                w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
            out.append("\n".join(w[:20]) + "\t " + " ".join(w[20:]))
    out += [sentence(rng, 30) + " " + passage + "  " + sentence(rng, 20) for _ in range(6)]
    out += [base[0], base[0], None, None, "", " \n\t", "one", "one", "Two words", "a b c d", "a b c d e", "É é ß 漢字  x",
            sentence(rng, 5000), "x" * 20000, "it's <|endoftext|> we'll  \n\n go　on 1234 !!"]
    rng.shuffle(out)
    return list(enumerate(out, 100))


def find_components(ids, links):
    parent = {i: i for i in ids}
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def white_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
