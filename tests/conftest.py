import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reglink.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[*]", shuffle_partitions=8, app_name="reglink-tests")
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as plain tuples (in the frame's order)."""
    sel = df.select(*cols) if cols else df
    return [tuple(r) for r in sel.collect()]


def plan_text(df, mode: str = "simple") -> str:
    """The plan ``df.explain(mode)`` prints, as text."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
