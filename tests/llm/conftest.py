import pytest

LONG = "lorem ipsum dolor sit amet " * 40_000  # about a million characters


@pytest.fixture(scope="session")
def sf_mid():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, an empty and a very long text, ties and repeated rows, extra columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "a", 1, 1),
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "a", 1, 1),
        (2, "The quick brown fox jumps over the lazy dog again and again today", "en", None, 2, 2),
        (3, None, None, None, None, None),
        (4, "", "en", "b", 0, 4),
        (5, " \n\t ", "de", "b", 4, 5),
        (6, "word", None, "a", 4, 6),
        (7, LONG, "la", "c", None, 7),
        (None, "no id but a text", "en", "c", 5, 8),
        (None, None, None, None, None, 9),
        (8, "123 456 !!! %%%", "en", "a", 3, 10),
        (9, "Größe été ñandú İstanbul 漢字 😀 <|endoftext|> [INST]</s>", "de", "b", 3, 11),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int")
    from pyspark.sql import functions as F

    return df.withColumn("h", F.lit("x")).withColumn("fp", F.lit(1)).withColumn("key", F.lit(2)).withColumn("taken", F.lit(3)).withColumn("item", F.lit("y"))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
