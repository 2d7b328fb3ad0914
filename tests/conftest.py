import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkpipe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="sparkpipe-tests-")
    session = build_session(
        "tests",
        "local[4]",
        {
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": work,
            "spark.driver.extraJavaOptions": f"-Dderby.stream.error.file={work}/derby.log",
        },
        "ERROR",
    )
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
