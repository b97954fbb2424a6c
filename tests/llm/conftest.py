import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from emberfield.llm.queries import python_path  # noqa: E402


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    python_path(spark)
