from __future__ import annotations

import sys
import warnings
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))
warnings.filterwarnings("ignore", category=FutureWarning)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from flowsieve.session import build_session, ship_package
    session = build_session("tests", "8", **{
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.driver.memory": "6g"})
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def run(spark, sf):
    from flowsieve.plans.model_catalog import training_run
    return training_run(spark, sf)
