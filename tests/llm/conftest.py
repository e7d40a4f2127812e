from pathlib import Path

import pytest

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip("test tables not present")
    return str(DATA)
