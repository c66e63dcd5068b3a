import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

from larder.session import local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", **{"spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def workspace(spark):
    from larder.plans.catalog import Workspace

    return Workspace(spark, DATA)


@pytest.fixture(scope="session")
def feature_table(workspace):
    """Feature rows of the smallest data set, written once."""
    return workspace.stored(*workspace.features.columns)
