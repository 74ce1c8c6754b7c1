import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import build_session

    s = build_session("local[*]", app="quarry-tests", shuffle_partitions=8)
    # tests run in local mode: a private checkpoint folder is set only because
    # none is configured
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tsv(tmp_path):
    """Write lines as a tab-separated file; returns its path."""
    counter = iter(range(10_000))

    def write(lines, name=None):
        path = tmp_path / (name or f"in{next(counter)}")
        path.mkdir(parents=True, exist_ok=True)
        (path / "part-0").write_text("".join(line + "\n" for line in lines))
        return str(path)

    return write
