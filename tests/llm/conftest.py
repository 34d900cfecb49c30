import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cases import CLASHING, ODD, rows  # noqa: E402

@pytest.fixture(scope="session")
def documents(spark):
    return rows(spark, "documents", "doc_id", "text")


@pytest.fixture
def table(spark):
    """A documents table with further columns of clashing names."""

    def build(*pairs):
        kinds = "doc_id bigint, text string, " + ", ".join(f"{c} string" for c in CLASHING)
        return spark.createDataFrame([(i, t, *CLASHING) for i, t in pairs], kinds)

    return build


@pytest.fixture
def odd(table):
    return table(*ODD)


@pytest.fixture
def nothing(table):
    return table()
