import os
import uuid
from pathlib import Path

import pytest

from assaymill.plans.candidates import material_candidates
from assaymill.plans.experiments import quarantined_events, valid_events, validated_events
from assaymill.schemas import CANDIDATE_COLUMNS, RAW_COLUMNS, VALIDATED_COLUMNS
from assaymill.sources.files import read_raw
from assaymill.streaming.layers import (
    CANDIDATES,
    COMMENTS,
    QUARANTINED,
    RAW,
    VALID,
    VALIDATED,
    Layers,
    run_available,
    validate,
)
from sample_events import EVENTS, changed, text

COMPARED = [c for c in VALIDATED_COLUMNS if c not in ("ingested_at", "processed_at")]


@pytest.fixture
def layers(tmp_path):
    return Layers(f"db_{uuid.uuid4().hex}", str(tmp_path / "layers"))


def counts(spark, layers):
    names = (RAW, VALIDATED, VALID, QUARANTINED, CANDIDATES)
    return [spark.read.table(layers.table(n)).count() for n in names]


def rows(df, columns):
    return sorted((str(tuple(r)) for r in df.select(*columns).collect()))


@pytest.fixture
def folder(event_file):
    (event_file.parent / "bad.jsonl").write_text('{"schema_version":\n\t\n   \n')
    return event_file.parent


@pytest.mark.parametrize("split", ["views", "tables"])
def test_layers_agree_with_the_batch_plans(spark, folder, layers, split):
    run_available(spark, str(folder), layers, split=split)
    batch = validated_events(read_raw(spark, folder))
    for name, expected, columns in (
        (RAW, read_raw(spark, folder), [c for c in RAW_COLUMNS if c != "ingested_at"]),
        (VALIDATED, batch, COMPARED),
        (VALID, valid_events(batch), COMPARED),
        (QUARANTINED, quarantined_events(batch), COMPARED),
        (CANDIDATES, material_candidates(valid_events(batch)), CANDIDATE_COLUMNS),
    ):
        table = spark.read.table(layers.table(name))
        assert rows(table, columns) == rows(expected, columns), name
    assert tuple(spark.read.table(layers.table(VALID)).columns) == VALIDATED_COLUMNS
    assert counts(spark, layers) == [5, 5, 3, 2, 3]


@pytest.mark.parametrize("split", ["views", "tables"])
def test_later_files_are_added_once(spark, folder, layers, split):
    run_available(spark, str(folder), layers, split=split)
    run_available(spark, str(folder), layers, split=split)
    assert counts(spark, layers) == [5, 5, 3, 2, 3]
    event = changed("event_id", "00000000-0000-4000-8000-000000000097")
    event["experiment"]["material"]["material_id"] = "MAT-AL-003"
    (folder / "later.jsonl").write_text(text(event) + "\n" + text(EVENTS[0]) + "\n")
    run_available(spark, str(folder), layers, split=split, maxFilesPerTrigger=1)
    assert counts(spark, layers) == [7, 7, 5, 2, 4]


def test_a_file_that_grows_is_not_read_again(spark, folder, layers, event_file):
    run_available(spark, str(folder), layers)
    with event_file.open("a") as f:
        f.write(text(EVENTS[0]) + "\n")
    run_available(spark, str(folder), layers)
    assert counts(spark, layers)[0] == 5


def test_a_late_file_with_an_old_date_is_read(spark, folder, layers):
    run_available(spark, str(folder), layers)
    late = folder / "late.jsonl"
    late.write_text(text(EVENTS[0]) + "\n")
    os.utime(late, (1_000_000_000, 1_000_000_000))
    run_available(spark, str(folder), layers)
    assert counts(spark, layers) == [6, 6, 4, 2, 3]


def test_a_lost_step_is_made_up_for(spark, folder, layers):
    """The raw layer ran, the rest did not, as after a failure in between."""
    from assaymill.sources.files import stream_raw
    from assaymill.streaming.layers import append, create_database

    create_database(spark, layers)
    append(stream_raw(spark, str(folder)), layers, RAW)
    validate(spark, layers)
    run_available(spark, str(folder), layers)
    assert counts(spark, layers) == [5, 5, 3, 2, 3]


def test_a_backlog_is_taken_in_batches(spark, folder, layers):
    for i in range(3):
        (folder / f"more{i}.jsonl").write_text(text(EVENTS[i]) + "\n")
    run_available(spark, str(folder), layers, split="tables", maxFilesPerTrigger=1)
    assert counts(spark, layers) == [8, 8, 6, 2, 3]
    for name in (RAW, VALIDATED, VALID, QUARANTINED):
        commits = [p.name for p in Path(layers.checkpoint(name), "commits").glob("[0-9]*")]
        assert len(commits) >= 5, name


def test_a_new_catalog_takes_up_the_tables(spark, folder, layers):
    """As after a restart with a catalog that lives in the session."""
    run_available(spark, str(folder), layers)
    spark.sql(f"DROP DATABASE {layers.database} CASCADE")
    (folder / "later.jsonl").write_text(text(EVENTS[0]) + "\n")
    run_available(spark, str(folder), layers)
    assert counts(spark, layers) == [6, 6, 4, 2, 3]
    assert dict(spark.read.table(layers.table(VALID)).dtypes)["is_valid"] == "boolean"


def test_comments(spark, folder, layers):
    run_available(spark, str(folder), layers)
    for name, comment in COMMENTS.items():
        assert spark.catalog.getTable(layers.table(name)).description == comment


def test_verdict_prunes_the_other_partition(spark, folder, layers):
    run_available(spark, str(folder), layers, split="views")
    valid = spark.read.table(layers.table(VALID)).select("event_id")
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in plan
    assert "ReadSchema: struct<event_id:string>" in plan


def test_verdict_tables_can_be_streamed(spark, folder, layers):
    run_available(spark, str(folder), layers, split="tables")
    query = (
        spark.readStream.table(layers.table(VALID))
        .writeStream.format("memory")
        .queryName("valid_again")
        .start()
    )
    query.processAllAvailable()
    query.stop()
    assert spark.table("valid_again").count() == 3


def test_candidates_are_replaced_as_a_whole(spark, folder, layers):
    from assaymill.streaming.layers import refresh_candidates

    run_available(spark, str(folder), layers)
    before = spark.catalog.getTable(layers.table(CANDIDATES))
    weights = {"strength_weight": 1.0, "conductivity_weight": 0.0, "density_weight": 0.0}
    refresh_candidates(spark, layers, **weights)
    table = spark.read.table(layers.table(CANDIDATES))
    first = table.filter("program_id = 'LIGHTWEIGHT-ALLOYS' AND candidate_rank = 1").first()
    assert (table.count(), first.material_id) == (3, "MAT-AL-002")
    assert spark.catalog.getTable(layers.table(CANDIDATES)) == before


def test_old_versions_of_the_candidates_are_removed(spark, folder, layers):
    from assaymill.streaming.layers import refresh_candidates

    run_available(spark, str(folder), layers)
    for _ in range(3):
        refresh_candidates(spark, layers)
        assert spark.read.table(layers.table(CANDIDATES)).count() == 3
    assert len(list(Path(layers.location(CANDIDATES)).glob("version-*"))) == 2


def test_a_quote_in_a_folder_name(spark, folder, tmp_path):
    layers = Layers(f"db_{uuid.uuid4().hex}", str(tmp_path / "it's here"))
    run_available(spark, str(folder), layers)
    run_available(spark, str(folder), layers)
    assert counts(spark, layers) == [5, 5, 3, 2, 3]
    spark.sql(f"DROP DATABASE {layers.database} CASCADE")
