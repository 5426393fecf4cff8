import os
import sys

import pytest

_HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(_HERE), _HERE]

from stratalake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", cpus=8, **{"spark.driver.memory": "6g", "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1"})
    session.sparkContext.environment["PYTHONPATH"] = os.path.dirname(_HERE)
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")
