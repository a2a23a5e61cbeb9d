import pytest


@pytest.fixture(scope="session")
def sp(spark):
    """The shared session, with the package sent to its Python workers."""
    from pricetide.llm.common import ship_package
    ship_package(spark)
    return spark
