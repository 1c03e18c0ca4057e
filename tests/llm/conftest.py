import pytest
from pyspark.sql import functions as F

from llm_prose import prose


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty and blank texts, ties, repeated rows, a very long text."""
    long = prose(1, 30_000) + "\n" + prose(2, 400)
    twin = prose(3, 60)
    return [(None, None), (None, twin), (1, ""), (2, None), (3, "  \t\n "), (4, twin), (4, twin),
            (5, twin), (6, long), (7, prose(2, 400)), (8, "one"), (9, "two words"), (10, "one"),
            (11, "x" * 5000), (12, "mail a.b@c.de now +1 (407) 555-7710 4111 1111 1111 1111"),
            (13, twin + " more"), (13, "another text of the same id"), (14, "日本 ▁ \x00 🎉")]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with other columns whose names the operators use themselves."""
    frame = spark.createDataFrame(odd_rows, "doc_id long, text string")
    for name in ("lang", "key", "bucket", "node", "tag", "found", "place", "kept", "score", "row",
                 "n", "label", "text_key", "span_list", "gone_id", "component", "ids"):
        frame = frame.withColumn(name, F.lit(None).cast("string"))
    return frame


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
