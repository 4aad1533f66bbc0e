import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use inside
        T.StructField("fp", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("block", T.StringType()),
        T.StructField("span", T.StringType()),
        T.StructField("grade", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("__row", T.StringType()),
    ]
)
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
PASSAGE = " ".join(f"shared{i}" for i in range(40))
TEXTS = [
    (1, "The quick brown fox, the lazy dog.\nThe quick brown fox again!"),
    (2, None),
    (3, ""),
    (4, " \t\n\r "),
    (5, "one"),
    (6, LONG),
    (7, "Ünïcödé ñandú 漢字 かな 🙂🙂 <|endoftext|> it's 1,234 #tag\u0085x y"),
    (8, "start a " + PASSAGE + " end a"),
    (9, "other begin " + PASSAGE + " other end"),
    (10, "start a " + PASSAGE + " end a"),
    (11, "ab" * 400),
    (12, "same same same same same same"),
    (None, "no id here at all"),
    (5, "one"),
    (14, "nul \x00 byte \x00 text"),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, t, "en", None, None, "f", 1, "b", "s", "g", "i", "x", "r") for i, t in rows], DOCS
    )


@pytest.fixture(scope="session")
def docs(spark):
    return frame(spark, TEXTS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return frame(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, None, None), (3, 0, 0), (8, 1, None), (None, 0, 1), (1, 0, 0), (9, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
