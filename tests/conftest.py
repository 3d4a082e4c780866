import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from statloom.session import local_session  # noqa: E402

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    # compiling a plan costs more than running it on tables this small
    session = local_session(8, 4, {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER
