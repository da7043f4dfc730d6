import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import build_session

    s = build_session("local[4]", 4, app="ledgerloom-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="ll-test-ckpt-")})
    yield s
    s.stop()
