import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assaymill.functions.columns import fingerprint  # noqa: E402
from assaymill.session import local_session  # noqa: E402
from sample_events import EVENTS, text  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "assaymill-tests",
        cores=4,
        partitions=4,
        **{
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw rows from documents or from payload text."""

    def build(*payloads):
        from pyspark.sql import functions as F

        rows = [
            (p if isinstance(p, str) else text(p), f"memory://{i}") for i, p in enumerate(payloads)
        ]
        return spark.createDataFrame(rows, "raw_payload string, source_file string").select(
            "*",
            F.lit("2026-06-28 12:00:00").cast("timestamp").alias("ingested_at"),
            fingerprint(F.col("raw_payload")).alias("payload_sha256"),
        )

    return build


@pytest.fixture
def event_file(tmp_path):
    path = tmp_path / "events" / "first.jsonl"
    path.parent.mkdir()
    path.write_text("".join(text(e) + "\n" for e in EVENTS), encoding="utf-8")
    return path
