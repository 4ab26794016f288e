import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

# One fresh scratch folder per test session (never cleared by the tests).
SCRATCH = tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark():
    from screenroi.session import local_session

    s = local_session(
        "4",
        shuffle_partitions=8,
        app="screenroi-tests",
        # spark.checkpoint.dir is left to the environment; scratch_root() installs a folder
        # below this warehouse dir only when the environment names none.
        extra={"spark.sql.warehouse.dir": f"{SCRATCH}/warehouse"},
    )
    from screenroi.session import scratch_root

    scratch_root(s)
    yield s
    s.stop()


@pytest.fixture
def scratch(request):
    """A new folder for one test."""
    return tempfile.mkdtemp(prefix=f"{request.node.name[:40]}-", dir=SCRATCH)


def rows(df, *cols):
    """Collected rows as sorted tuples (None sorts first)."""
    data = [tuple(r[c] for c in (cols or df.columns)) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))
