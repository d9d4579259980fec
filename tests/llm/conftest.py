import random

import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside, or might.
    T.StructField("fp", T.StringType()), T.StructField("n", T.StringType()), T.StructField("component", T.StringType()),
])


def rows_of(texts, sources=("a",)):
    return [Row(i, t, "en", sources[i % len(sources)], None if t is None else len(t), "x", None, "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        return spark.createDataFrame([tuple(r) for r in rows], DOCS).repartition(3)

    return make


@pytest.fixture(scope="session")
def texts():
    """Null, empty, blank, short, repeated, near-copied, very long and odd texts."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["Straße", "éa", "日本", "A.", "b,"]
    body = [" ".join(rnd.choice(words) for _ in range(rnd.randint(20, 120))) for _ in range(12)]
    long = " ".join(rnd.choice(words) for _ in range(30_000))
    near = body[3].replace(body[3].split()[7], "zzz", 1)
    passage = " ".join(f"p{i}" for i in range(20))
    return [None, "", " \t\n ", "one", "Two words", *body, body[3], body[3], near, long, passage, f"{body[5]} {passage} {body[6]}",
            f"x {passage} y", "same same same same same same same same same same same same same same same same", " wide space x", "a\x0bb\x0cc"]
