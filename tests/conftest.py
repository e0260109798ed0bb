import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loanloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "loanloom-tests", partitions=4)
    yield session
    session.stop()


@pytest.fixture
def no_small_path(monkeypatch):
    """Force the bucketed way of the ranking kernel."""
    from loanloom.operators import ranking

    monkeypatch.setattr(ranking, "SMALL_DISTINCT", -1)
