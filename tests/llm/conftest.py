import pytest

from sparkrisk.llm.common import setup

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

# Nulls, empty and very long texts, repeated rows, unusual characters, and columns whose names
# the operators use themselves.
ROWS = [
    (1, "", "en", "a", 0), (2, None, None, None, None), (3, "one", "en", "a", 3), (4, LONG, "en", "b", len(LONG)),
    (5, LONG, "en", "b", 1), (6, " \t\n\r ", "fr", None, 5), (7, "Straße İstanbul Σίσυφος́ \U0001f44d\x1c|", "de", "c", 9),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "a", 0),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z", "en", "a", 0),
    (9, "x\n\nx\n \n<|endoftext|> tail", "en", "a", 1), (10, "the " * 500, "en", "a", 2000),
    (None, "a row without an id", "en", "a", 0), (11, "q" * 5000, "en", "a", 5000),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("score", "kept", "piece", "start", "length", "rank", "component_id", "n_words", "spans", "label", "part", "key", "id", "grp", "doc", "t")


@pytest.fixture(scope="session")
def llm(spark):
    return setup(spark)


@pytest.fixture(scope="session")
def odd(llm):
    """The edge-case documents, with clashing extra columns."""
    from pyspark.sql import functions as F

    return llm.createDataFrame(ROWS, COLUMNS).withColumns({c: F.lit("extra") for c in CLASH}).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def small_docs(llm):
    rows = [tuple(r) for r in llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return sorted(rows)


@pytest.fixture(scope="session")
def small_pages(llm):
    return [r.html for r in llm.read.parquet(f"{SF}/pages.parquet").select("html").collect()]
