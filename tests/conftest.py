import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from ledgerflow.session import build_session

    s = build_session(
        "local[4]",
        app_name="ledgerflow-tests",
        shuffle_partitions=4,
        # tests only: no shared folder is configured here, so take a fresh one
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="lf-test-ckpt-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
