import pytest

BASE = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, start=0):
    """A documents table of (id or text) with clashing extra columns."""
    rows = [(*(t if isinstance(t, tuple) else (start + i, t)), "en", f"src{i % 3}", len(t[1] or "") if isinstance(t, tuple) else len(t or "")) for i, t in enumerate(texts)]
    extra = ", count long, size long, weight double, fp string, start string"
    return spark.createDataFrame([(*r, 1, 2, 0.5, "x", "y") for r in rows], BASE + extra)


@pytest.fixture
def docs_of(spark):
    return lambda texts: documents(spark, texts)


@pytest.fixture(scope="session")
def small(spark):
    """The smallest documents table: (DataFrame, sorted list of (doc_id, text))."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df, sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


EDGES = [None, "", " \n\t ", "one", "one two", "a b c d e f g h i j k l m n o p", "a b c d e f g h i j k l m n o p", "x " * 40_000, "é ü 漢字 🙂 " * 6, "x\x1fy z\x85w"]
