import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from strata.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    session = build_session(
        "strata-tests",
        master=f"local[{os.environ.get("TEST_CPUS", "*")}, 4]",   # all cores; a failed task is retried up to 4 times
        shuffle_partitions=8,
        conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
    yield session
    session.stop()


@pytest.fixture()
def tmp_uri(tmp_path):
    return "file:" + str(tmp_path)
