import pytest

from daymark.llm.common import prepared
from daymark.session import ship


@pytest.fixture(scope="session")
def corpus(spark):
    """The session with the settings of the corpus operators."""
    ship(spark)
    return prepared(spark)


@pytest.fixture
def rows_of():
    """Rows of a frame as sorted tuples."""

    def sort(df, *columns):
        chosen = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return sort
