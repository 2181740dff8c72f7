import pytest
from llm_cases import SF, TEXTS

@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, repeated rows and ids, and columns whose names clash with inner ones."""
    rows = [(i, text, ["en", "fr", None][i % 3], ["src1", None, "other"][i % 3], len(text or ""), "kept", i) for i, text in enumerate(TEXTS)]
    rows += [rows[7], rows[0], (None, "no id here at all", "en", "src1", 3, None, None), (None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, tokens int")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
