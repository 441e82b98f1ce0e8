import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from weftline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        2,
        spark__ui__enabled=False,
        spark__ui__showConsoleProgress=False,
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """The rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
