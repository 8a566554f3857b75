import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from dqforge.session import local_session

    return local_session(4, shuffle_partitions=4, app="dqforge-tests")


@pytest.fixture
def write_text(tmp_path):
    """Write literal text to a fresh file; returns its path."""

    def _w(name: str, text: str) -> str:
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(text)
        return str(p)

    return _w
