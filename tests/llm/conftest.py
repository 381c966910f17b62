"""Documents with every odd case: null, empty, very long, ties, repeats, odd bytes."""

import pytest

ROWS = [
    (1, "The quick brown fox. Mail me at a.b@example.com or +1 (212) 555-0100.", "en", "s0", 10),
    (2, None, "en", "s0", None),
    (3, "", None, None, 0),
    (4, "   \n\t\n ", "fr", "s1", 7),
    (5, "Licensed under the MIT License. Licensed under the MIT License.\nApache License, Version 2.0 and CC BY-NC", "en", "s1", 5),
    (5, "Licensed under the MIT License. Licensed under the MIT License.\nApache License, Version 2.0 and CC BY-NC", "en", "s1", 5),
    (None, "no id here but a text with words " * 5, None, "s2", 5),
    (6, "le chat est dans la maison et il dort sur le lit avec une balle " * 3, "fr", "s2", 5),
    (7, "straße größe über und \u3000\x1c\x85 zwei\u00a0Wörter \U0001f600 日本語 текст", "de", "s2", 5),
    (8, "word " * 30_000, "en", "s3", 150_000),
    (9, "a|b# * $%&<> ! ! UPPER CASE TEXT " * 20, "en", "s3", 5),
    (10, "one two three four five six seven eight nine ten eleven twelve", "en", "s3", 5),
    (11, "one two three four five six seven eight nine ten eleven twelve", "en", "s3", 5),
    (12, "x" * 100_000, "en", "s3", 100_000),
    (13, "line one here\nline one here\n\nother\nline one here", "en", "s3", 5),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(odd):
    """Extra columns whose names the operators make themselves."""
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("kept?") for c in ("n_words", "kept", "score", "spans", "labels", "row", "hash", "piece", "class_id", "lang_pred", "n", "key", "held_out", "component_id", "_bytes", "extra")})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").toPandas()
