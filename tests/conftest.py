from __future__ import annotations

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session(4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rng():
    return np.random.default_rng(42)
