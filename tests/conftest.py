import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    scratch = tempfile.mkdtemp(prefix="eventide-tests-")
    s = get_session("local[4]", 4, app_name="eventide-tests",
                    extra_conf={"spark.ui.showConsoleProgress": "false",
                                "spark.checkpoint.dir": scratch})
    yield s


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the checkpoint root, as a local path."""
    from eventide.session import scratch_path
    p = scratch_path(spark, "t")
    return p[len("file:"):] if p.startswith("file:") else p


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
