from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.sessions import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    # A few rows per test: compiling whole stages would take most of the time.
    session = local_session(4, **{"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture
def workspace(spark, tmp_path):
    from cargolens.workspace import Workspace

    return Workspace(spark, str(tmp_path / "workspace"))
