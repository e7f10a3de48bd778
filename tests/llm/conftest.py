import pytest
from llm_helpers import awkward_rows, make_docs


@pytest.fixture(scope="session")
def awkward(spark):
    return make_docs(spark, awkward_rows()).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return make_docs(spark, [])
