import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__checkpoint__dir=shared)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


def rows(df, *order):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))
