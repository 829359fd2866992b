import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.session import make_session


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame, NULLs first."""

    def collect(df, *cols):
        got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
        return sorted(got, key=lambda r: [(v is not None, str(type(v)), v) for v in r])

    return collect
