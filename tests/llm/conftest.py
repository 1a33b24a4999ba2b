import pytest

EDGES = [
    (1, None, "en", "a", 0),
    (2, "", None, None, 0),
    (3, " \n\t ", "en", None, 4),
    (4, "The same text of a document that two rows hold here twice", "en", "a", 57),
    (4, "The same text of a document that two rows hold here twice", "en", "a", 57),
    (5, "The same text of a document that two rows hold here twice", "en", "b", 57),
    (6, "12 345 ###", "en", "b", 10),
    (None, "a row without an id but with a fine text of some words", "en", "b", 54),
    (7, "word " * 30_000, "en", "é", 150_000),
    (8, "ein kurzer deutscher Satz mit einigen Wörtern darin", "de", "z", 51),
    (-9, "don't  stop\n\n <|endoftext|>　x y \U0001f642 é", "en", "z", 40),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def edges(spark):
    """Nulls, blanks, repeated rows, a long text, and columns named like ones the operators use inside."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(EDGES, SCHEMA)
    for name in (
        "size", "shard", "_line", "_one", "_n", "fp", "votes", "counts", "length", "component_id", "place", "doc", "_doc", "_text",
        "_row", "_size", "_quality", "_votes", "_fp", "_language", "_words", "_cuts", "_lap", "key", "found",
    ):
        rows = rows.withColumn(name, F.lit("clash"))
    return rows


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
