from __future__ import annotations

import pytest

from newslake.session import use_utc
from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = use_utc(local_session("4"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    from newslake.session import scratch_path

    return lambda name: scratch_path(spark, f"test-{name}")
