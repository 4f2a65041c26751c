import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))

from braidline import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    s = session.local_session(
        "tests", 4, **{"spark.checkpoint.dir": shared, "spark.sql.shuffle.partitions": "4"}
    )
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from braidline.queries.base import Tables

    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def duck():
    from check import connect

    return connect(SMALL)
