import pytest

LONG = "the quick brown fox jumps over the lazy dog and runs away from here. " * 3000


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows and ids."""
    line = "this line is long enough to be a key of its own"
    return [
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, " \t\n\x0b ", "en", "s", 5),
        (4, LONG, "en", "s", len(LONG)),
        (5, f"{line}\nother text of five or more words", "en", "s", 1),
        (6, f"  {line.upper()}\t\nsomething else entirely here now", "en", None, 1),
        (7, f"{line}\nles mots de la langue qui est autre", "fr", "s", 1),
        (8, "a b c", "en", "s", 5),
        (9, "a b c", "en", "s", 5),
        (10, "12345 67890", None, "s", 11),
        (None, "a row without an id but with some words", "en", "s", 1),
        (None, "a row without an id but with some words", "en", "s", 1),
        (11, "repeated row with the same id and text", "en", "s", 1),
        (11, "repeated row with the same id and text", "en", "s", 1),
        (12, "naïve café — “quotes” \U0001f600 <|endoftext|> 日本語 \x1c x", "de", "s", 1),
    ]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


#: Names that operators use inside or return, as extra columns of the input.
CLASHES = ["bucket", "id", "doc", "key", "kept", "score", "n_lines", "n_tokens", "component", "seed", "posterior", "copies", "offset", "t", "d", "held_out", "lang_pred"]


@pytest.fixture(scope="session")
def clashing(edges):
    from pyspark.sql import functions as F

    return edges.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def texts(small_docs):
    return {r.doc_id: r.text or "" for r in small_docs.select("doc_id", "text").collect()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
