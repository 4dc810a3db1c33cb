import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from stackroom.runtime import CHECKPOINT_SETTING, local_session

    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, **{CHECKPOINT_SETTING: shared, "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
