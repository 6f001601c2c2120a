import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
os.environ.setdefault("LECTERN_DRIVER_MEMORY", "4g")


@pytest.fixture(scope="session")
def spark():
    from lectern.session import local_session

    return local_session("tests", cores=4, partitions=2)


@pytest.fixture(scope="session")
def sf_dir():
    path = Path("/root/testdata/sf0.001")
    if not path.exists():
        pytest.skip("driver tables are not here")
    return str(path)
