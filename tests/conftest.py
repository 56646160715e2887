import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import local_session

    session = local_session("tests")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session


@pytest.fixture
def store(spark, tmp_path):
    from tidemark.plans.store import Store

    return Store(spark, str(tmp_path / "store"))
