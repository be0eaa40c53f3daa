import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from tableload.session import local_session

    s = local_session(cores=4, shuffle_partitions=8)
    # tests keep their scratch output in a folder of their own
    if not s.conf.get("spark.checkpoint.dir", None):
        root = tempfile.mkdtemp(prefix="tableload-tests-")
        s.sparkContext.setCheckpointDir(root)
        s.conf.set("spark.checkpoint.dir", root)
    yield s


@pytest.fixture()
def tmp_root(spark):
    from tableload.session import scratch_dir

    return scratch_dir(spark, "test")
