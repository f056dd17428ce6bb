from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tradeloom.session import get_session

    session = get_session(
        "tests",
        master="local[8]",
        extra={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stage")),
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def no_views_left(request):
    """Views of one module show in every database, so they go with it."""
    yield
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    for table in session.catalog.listTables() if session else ():
        if table.isTemporary:
            session.catalog.dropTempView(table.name)
