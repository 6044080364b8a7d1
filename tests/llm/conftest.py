import pytest


@pytest.fixture(scope="module", autouse=True)
def nothing_stays_cached(spark):
    """Frames that a module caches go with it; later modules count what is held."""
    yield
    spark.catalog.clearCache()
