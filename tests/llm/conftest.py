import random

import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])
# columns whose names the operators use inside
CLASH = ["n", "row", "bucket", "tid", "words", "term", "pos", "score", "key", "gid", "node", "bin", "offset",
         "length", "kept", "is_copy", "spans", "rep", "a", "b", "component", "size", "first", "host"]


def prose(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def vocabulary(rng, n=400):
    return ["".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(2, 8))) for _ in range(n)]


def hostile_rows(seed=1):
    """doc_id, text with nulls, empty, long, equal, nearly equal and odd texts."""
    rng = random.Random(seed)
    voc = vocabulary(rng)
    base = [prose(rng, rng.randint(1, 120), voc) for _ in range(40)]
    texts = [None, "", " ", "\n\t ", "x", "Ñ.", "a b c d", "A B  c\nD", "a" * 400, "ab" * 300, "\x00\x1c\x85 \xa0", "ß é 日本語 " * 30,
             "😀" * 40, "<|endoftext|> b <|startoftext|>", "don't WE'LL 's 12 ² ½", "e\u0301 \u00e9 \u03a3\u0391\u03a3"]
    texts += base
    texts += base[:6] + base[:2] + base[:2]  # equal texts
    for t in base[5:25]:  # near copies
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    passage = prose(rng, 30, voc)
    texts += [prose(rng, 20, voc) + " " + passage + " " + prose(rng, k, voc) for k in range(12)]
    texts.append(prose(rng, 9000, voc) + passage)  # long
    texts += [passage, passage.upper(), passage[:49], passage[:50], passage[3:53]]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = [(i, t) for i, t in zip(ids, texts)]
    rows += [rows[20], rows[20], (rows[21][0], "another text under a used id " * 4)]  # repeated rows, a repeated id
    rows += [(None, base[0]), (None, None)]
    return rows


@pytest.fixture(scope="session")
def hostile(spark):
    rows = hostile_rows()
    langs = ["en", "de", None]
    return spark.createDataFrame([(d, t, langs[i % 3], None if i % 5 else "s", None) for i, (d, t) in enumerate(rows)], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing(hostile):
    from pyspark.sql import functions as F

    return hostile.repartition(5).withColumns({c: F.lit(i) for i, c in enumerate(CLASH)})
