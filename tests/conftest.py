import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from carelake.session import local_session  # noqa: E402
from helpers import PEOPLE, SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        8, app="tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def people(spark):
    """Four patients, the first of them twice."""
    from carelake import schemas

    return spark.createDataFrame([*PEOPLE, PEOPLE[0]], schemas.ENCOUNTER)
