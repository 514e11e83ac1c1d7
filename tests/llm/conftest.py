import pytest


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    """The workers find the package wherever pytest was started."""
    from factkeeper.llm.common import prepare
    prepare(spark)
