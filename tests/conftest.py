from __future__ import annotations

import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = local_session(
        4,
        memory="4g",
        app="tidemill-tests",
        spark__sql__warehouse__dir=str(warehouse),
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    yield session
    session.stop()


@pytest.fixture
def root(tmp_path) -> str:
    """A folder for tables and checkpoints."""
    return str(tmp_path / "lake")


@pytest.fixture
def database(spark) -> str:
    """A fresh catalog database."""
    name = f"db_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name}")
    return name
