"""Awkward documents for the tests of this folder."""
import pytest
#: rows that every operator must take: nulls, empty and long texts, ties and repeated rows
LONG = "alpha beta gamma delta " * 4000
ROWS = [(1, "the cat sat on the mat and the dog ran off to the park with a big red ball", "en", "s"),
        (1, "the cat sat on the mat and the dog ran off to the park with a big red ball", "en", "s"),
        (2, None, None, None), (3, "", "en", None), (None, "le chat noir est sur la table avec le chien et la souris", "fr", "s"),
        (4, LONG, "en", "s"), (5, " \n\t", "de", "s"), (6, "12345 !!! ###", "en", "s"), (7, "naïve ĲOƏ Σίσυφος 漢字 <|endoftext|> x\x1cy", None, "s"),
        (8, "the cat sat on the mat and the dog ran off to the park with a big red ball", "en", "t"),
        (2**62, "le chat noir est sur la table", "fr", "s")]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd(spark):
    """Awkward documents, with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ROWS, SCHEMA)
    for name in ("node", "band", "words", "n", "row", "id", "score", "_key_of_ids", "n_chars"):
        df = df.withColumn(name, F.lit(7).cast("long"))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
