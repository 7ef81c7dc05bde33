import pytest

ROWS = [
    (1, None, "en"), (2, "", None), (3, "One two three.", "en"), (4, "one TWO three.", "en"), (5, "  \n\t ", "en"), (6, "solo", "de"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty and blank texts, ties, a long text and clashing column names."""
    long_text = " ".join(f"w{i % 977} x{i}" for i in range(6000))
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [*ROWS, (7, long_text, "en"), (8, long_text, "en"), (9, f"intro a b c {passage} tail d e", "en"), (10, f"other {passage} end", "en"),
            (11, "x " * 700, "en"), (11, "repeated id " * 30, "en"), (None, "no id at all", "en")]
    return spark.createDataFrame([(i, t, lang, "clash", 7) for i, t, lang in rows], "doc_id long, text string, lang string, n_words string, items int")


@pytest.fixture(scope="session")
def real_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
