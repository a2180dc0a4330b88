import pytest


@pytest.fixture(scope="session")
def spark():
    from vecspark.session import build_session
    return build_session("local[4]", partitions=4, app="vecspark-llm-tests")
