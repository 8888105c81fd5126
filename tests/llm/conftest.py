import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_docs import SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def llm_spark(spark):
    from ledgerflow.llm.common import ship

    ship(spark)
    return spark


@pytest.fixture
def empty(llm_spark):
    return llm_spark.createDataFrame([], SCHEMA)
