import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("node", T.StringType()),  # names that the operators use inside
        T.StructField("slot", T.StringType()),
    ]
)


def words_of(seed: int, n: int) -> str:
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i) % 99991}" for i in range(n))


#: Nulls, empty, blank, short and very long texts, ties, repeated ids and rows.
TEXTS = [
    (1, words_of(1, 120)),
    (2, words_of(1, 120)),
    (3, words_of(1, 119) + " changed"),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "Two words"),
    (8, "two WORDS"),
    (9, words_of(2, 30_000)),
    (10, words_of(3, 60) + " " + words_of(1, 70)),
    (None, words_of(4, 80)),
    (11, words_of(5, 80)),
    (11, words_of(5, 80)),
    (12, "émile  ça va　bien\x85 \x1c x" * 3),
]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [
        (i, text, "en" if k % 2 else None, f"s{k % 3}" if k % 4 else None, None, "n", None)
        for k, (i, text) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, DOCUMENT).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)
