from __future__ import annotations

import pytest

import oracle
from tillflow.session import local_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = local_session(4, 4, {"spark.sql.warehouse.dir": warehouse})
    session.sql("CREATE DATABASE IF NOT EXISTS till_tests")
    yield session
    session.sql("DROP DATABASE IF EXISTS till_tests CASCADE")
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck(sf_dir):
    return oracle.connect(sf_dir)


@pytest.fixture
def table(request, tmp_path):
    """A fresh table name."""
    safe = "".join(c if c.isalnum() else "_" for c in request.node.name)
    return f"till_tests.{safe}_{abs(hash(str(tmp_path))) % 10**8}"
