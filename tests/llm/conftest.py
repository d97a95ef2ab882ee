import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    # names that the operators use for columns of their own
    *[T.StructField(c, T.LongType()) for c in ("n", "key", "fp", "row", "part", "used", "slot", "n_lines", "keys")]])

LONG = "the quick brown fox jumps over the lazy dog near the quiet river bank " * 300
PASSAGE = "a passage of more than fifty bytes that two documents have in common, word for word"
TEXTS = [
    (1, "Hello wide world, this is a plain text.\nsecond line", "en", "a"),
    (2, "Hello wide  world,\tthis is a plain text.\nsecond line", "en", "a"),
    (3, None, "en", None), (4, "", None, "b"), (5, " \t\r\n", "de", "b"),
    (6, LONG, "en", "a"), (7, LONG + "end", "en", None), (8, LONG + "end", "en", "c"),
    (9, "intro " + PASSAGE + " outro", "en", "c"), (10, PASSAGE, "en", "c"),
    (11, "12345 67 !!! ---", "de", "a"), (12, "Straße, Äpfel und Übermut über alles", "de", "b"),
    (12, "another text under the same id", "en", "b"), (13, "same row twice", "en", "a"),
    (13, "same row twice", "en", "a"), (None, "no id at all", "en", "a"), (None, None, None, None),
    (14, "日本語のテキスト😀 <|endoftext|> it's I'll 1234abc", None, "a"), (15, "x" * 40_000, None, "a"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows and ids, clashing names."""
    rows = [(i, t, lang, src, None if t is None else len(t), *range(9)) for i, t, lang, src in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
