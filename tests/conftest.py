import sys
from datetime import datetime, timezone
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from riverglass import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4",
                            spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                            spark__driver__memory="6g", spark__default__parallelism="8")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def at():
    """UTC times on 1 January 2024 from "HH:MM[:SS]"."""
    def parse(clock: str, day: int = 1) -> datetime:
        parts = [int(p) for p in clock.split(":")]
        return datetime(2024, 1, day, *parts, tzinfo=timezone.utc)
    return parse


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect
