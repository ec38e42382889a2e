import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from meterlake.plans.session import build_session  # noqa: E402
from meterlake.schemas import INTERACTION  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("meterlake-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"


@pytest.fixture
def make_calls(spark):
    """Interaction rows from partial dicts; everything not given has a default."""

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            at = row.get("timestamp", datetime(2024, 1, 1) + timedelta(minutes=i))
            base = dict(
                interaction_id=f"i{i}", user_id="u1", session_id=None, model="gpt-4", provider="openai",
                prompt="p", response="r", input_tokens=10, output_tokens=20, latency_ms=100.0, cost_usd=0.01,
                metadata="{}")
            base.update(row)
            base["timestamp"], base["date"] = at, at.date()
            base["total_tokens"] = base["input_tokens"] + base["output_tokens"]
            full.append(tuple(base[f.name] for f in INTERACTION))
        return spark.createDataFrame(full, INTERACTION)

    return make
