import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from courtload.session import build_session
    s = build_session("local[4]", app="courtload-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield s
    s.stop()
