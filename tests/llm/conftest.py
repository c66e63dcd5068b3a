import pytest

DATA = "/root/testdata/sf0.001"

# Cases that every operator on documents has to stand: NULLs anywhere, empty and long texts,
# repeated rows, ties, and columns named like the operators' own.
ODD_ROWS = [
    (1, "The cat sat on the mat and looked at the dog.", "en", "a", 0, "x"),
    (2, "the CAT sat on the mat and looked at the dog.", "en", "a", 0, "y"),
    (2, "the CAT sat on the mat and looked at the dog.", "en", "a", 0, "y"),
    (3, None, "en", None, None, None),
    (4, "", None, "b", 0, "z"),
    (5, "12 34 !?", "en", "b", 0, "z"),
    (None, "Der Hund und die Katze gehen in das Haus.", "de", None, 0, "z"),
    (6, "Der Hund und die Katze gehen in das Haus.", "de", "c", 0, "z"),
    (7, "Ελληνικά ΣΣ İ é <|endoftext|> \x1c\x85\xa0 ### don't", None, "c", 0, "z"),
    (8, "word " * 60_000, "en", "c", 0, "z"),
    (9, "The cat sat on the mat and looked at the dog.", "fr", "d", 0, "z"),
]
ODD_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, row_key bigint, `a.b c` string"
)


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows as a frame, with clashing and awkward column names."""
    return spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)


@pytest.fixture(scope="session")
def odd_file(spark, odd, tmp_path_factory):
    """The same rows read from Parquet, as pipeline stages get them."""
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    odd.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
