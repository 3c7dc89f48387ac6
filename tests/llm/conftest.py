import random

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # columns whose names the operators use inside
        T.StructField("key", T.StringType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("row", T.StringType()),
        T.StructField("component", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def odd_texts():
    """Null, empty, blank, one word, repeats, white-space variants, odd characters, near and far copies."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["é", "naïve", "ß", "日本語", "THE", "the", "of,"]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = prose(120)
    near = base.split(" ")
    near[40] = "changed"
    texts = [None, "", "   \n\t", "one", "one", "two words", "a\tb", "a \n b", "a b", base, base, base.upper(),
             " ".join(near), prose(300), prose(3000) + "\n" + base, "x" * 5000, prose(40) + "\n" + prose(40),
             "\x1c \x85 \xa0", "don't stop! 12.5 <|endoftext|>", base + " tail"]
    return texts + [prose(rng.randint(1, 60)) for _ in range(40)]


@pytest.fixture(scope="session")
def texts():
    return dict(enumerate(odd_texts()))


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else None, "s", None, None, 1, "r", "c", None) for i, t in texts.items()]
    return spark.createDataFrame(rows, DOCUMENTS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


def lowered(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})
