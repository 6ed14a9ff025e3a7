import sys
import uuid
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillhouse.session import local_session, new_folder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def shuffled(spark):
    """No join is broadcast, not even when adaptive execution finds a side small."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def folder(spark):
    """A factory of fresh paths."""
    return lambda label="t": new_folder(spark, f"{label}-{uuid.uuid4().hex[:6]}")
