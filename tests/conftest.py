import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from abode.session import build_session, ensure_checkpoint_dir

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    session = build_session("local[4]", app_name="abode-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(session)
    yield session


@pytest.fixture()
def scratch(spark):
    from abode.session import scratch_path

    return lambda name: scratch_path(spark, name)
