import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from readloom.session import local_session

    work = tmp_path_factory.mktemp("spark")
    return local_session(4, "4g", 4, **{"spark.sql.warehouse.dir": str(work / "warehouse"), "spark.checkpoint.dir": str(work / "shared")})


@pytest.fixture(scope="session")
def sf_dir():
    return SF
