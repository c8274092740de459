import pytest

from custlens.llm.queries import importable


@pytest.fixture(autouse=True, scope="session")
def _workers(spark):
    importable(spark)
