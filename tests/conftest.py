import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from spindle.session import checkpoint_root, local_session

    # Tests only: a scratch warehouse so managed tables never land in the repo.
    warehouse = tempfile.mkdtemp(prefix="spindle-wh-")
    s = local_session(app="spindle-tests", cores="4", partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    # Tests only: a scratch checkpoint folder when the session names none.
    checkpoint_root(s, fallback=tempfile.mkdtemp(prefix="spindle-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch(tmp_path):
    return str(tmp_path)
