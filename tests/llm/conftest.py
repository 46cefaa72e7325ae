import pytest

from fablens.llm.shipping import ship_package

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def documents(spark):
    """Rows of (id, text) as documents; other columns hold nulls now and then, and clash with names used inside."""

    def build(rows):
        full = [(i, t, None if k % 3 == 0 else "en", f"s{k % 2}", None, f"x{k}", k, "y") for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS + ", doc string, line int, kept string")

    return build
