import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parent), str(Path(__file__).resolve().parents[1])]

from llm_data import edge_rows, frame  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def checkpoint_folder(spark, tmp_path_factory):
    if spark.conf.get("spark.checkpoint.dir", None) is None:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


@pytest.fixture
def edges(spark):
    return frame(spark, edge_rows())


@pytest.fixture
def empty(spark):
    return frame(spark, [])
