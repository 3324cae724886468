import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tessera.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import os

    os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
    return local_session(4, 4, "4g")


@pytest.fixture(scope="session")
def small() -> str:
    return "/root/testdata/sf0.001"
