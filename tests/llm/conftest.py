import pytest

ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 7),
    (2, "The quick brown fox jumps over the lazy dog near the river bank  today", "en", "a", 7),
    (2, "The quick brown fox jumps over the lazy dog near the river bank  today", "en", "a", 7),
    (3, None, None, None, None),
    (4, "", "de", "b", 0),
    (5, " \t\n", "de", "b", 3),
    (None, "Ein ganz anderer Satz mit Umlauten: äöü ß", "de", "b", 9),
    (None, None, "fr", "c", 0),
    (6, "12345 67890 !!!", "fr", "c", 1),
    (7, "Petit texte français: où est la bibliothèque?", "fr", None, 1),
    (8, "word " * 20000, "en", "a", 100000),
    (9, "x" * 50000, "en", "a", 50000),
    (10, "nul \x00 and ▁ mark and \U0001f600 and Ünïcödé  double  spaces\r\nline", "en", "c", 1),
    (11, "nul \x00 and ▁ mark and \U0001f600 and Ünïcödé  double  spaces\r\nline", "en", "c", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns whose names operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("digest", "fp", "kept", "keep_id", "size", "draw", "n", "t", "u", "v", "score", "run", "_id", "component_id"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
