import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.config import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        os.environ.get("TEST_MASTER", "local[*]"), 8, "strata-tests",
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-ckpt-")},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="strata-test-")


@pytest.fixture()
def clean_catalog(spark):
    from strata.plans.catalog import drop_registrations

    drop_registrations(spark)
    yield
    drop_registrations(spark)
