import pytest

LONG = "lorem ipsum dolor sit amet " * 20_000
#: Nulls, empty and blank texts, one very long text, ties, repeated rows, and columns of clashing names.
ODD = [
    (1, "one two three four five six", "en", "a", 3),
    (1, "one two three four five six", "en", "a", 3),
    (2, "One  TWO three\tfour five six", None, "a", None),
    (3, None, "en", "b", 0),
    (4, "", None, None, 0),
    (5, " \n\t ", "en", None, 3),
    (None, "one two three four five six", "en", "b", 1),
    (None, None, None, None, None),
    (6, LONG, "en", "b", 1),
    (7, "tiny text", "en", "a", 9),
    (8, "tiny text", "en", "a", 9),
    (9, 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" a@b.example.com 漢字 +1 (262) 555-3752', "de", "c", 9),
]
ODD_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("key", "copies", "size", "score", "row", "kind", "node", "component", "bands", "taken", "target")


def thue_morse(size):
    """The Thue-Morse word of a and b, and its complement: hashes that add up powers take them for one."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(size))
    return word, word.translate({97: 98, 98: 97})


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, ODD_COLUMNS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with more columns, called as the operators call their own."""
    from pyspark.sql import functions as F

    return odd.withColumns({name: F.lit("x") for name in CLASHING})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def texts(data):
    """(doc_id, text) of the smallest documents table, read without Spark."""
    import duckdb

    return duckdb.sql(f"SELECT doc_id, text FROM '{data}/documents.parquet'").fetchall()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
