"""Queries that SQL can express against their SQL in another engine."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from assaymill.llm.checks import SQL  # noqa: E402
from cases import SF  # noqa: E402
from compare import compare, connect  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, name):
    assert compare(spark, connect(SF), name, SF) == ""


def test_all_are_registered():
    names = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert set(names) == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry.queries()
