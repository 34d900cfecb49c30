import pytest
from pyspark.sql import functions as F

from assaymill.plans.experiments import quarantined_events, valid_events, validated_events
from assaymill.schemas import VALIDATED_COLUMNS
from assaymill.session import setting
from sample_events import EVENTS, Dropped, changed, text

EXPERIMENT = "experiment."
MATERIAL = "experiment.material."
CONDITIONS = "experiment.process_conditions."
MEASURED = "experiment.measurements."


def codes(raw, *payloads):
    rows = validated_events(raw(*payloads)).orderBy("source_file").collect()
    for row in rows:
        assert row.is_valid == (row.validation_errors == [])
    return [row.validation_errors for row in rows]


BROKEN = [
    ("schema_version", Dropped, ["MISSING_SCHEMA_VERSION"]),
    ("schema_version", None, ["MISSING_SCHEMA_VERSION"]),
    ("schema_version", "", ["MISSING_SCHEMA_VERSION", "UNSUPPORTED_SCHEMA_VERSION"]),
    ("schema_version", "2.0.0", ["UNSUPPORTED_SCHEMA_VERSION"]),
    ("event_id", "  ", ["MISSING_EVENT_ID"]),
    ("event_type", Dropped, ["MISSING_EVENT_TYPE"]),
    ("event_type", "", ["MISSING_EVENT_TYPE", "UNSUPPORTED_EVENT_TYPE"]),
    ("event_type", "experiment.started", ["UNSUPPORTED_EVENT_TYPE"]),
    ("occurred_at", Dropped, ["INVALID_OCCURRED_AT"]),
    ("occurred_at", "", ["INVALID_OCCURRED_AT"]),
    ("occurred_at", " ", ["INVALID_OCCURRED_AT"]),
    ("occurred_at", "not-a-date", ["INVALID_OCCURRED_AT"]),
    ("occurred_at", "2026-13-01T00:00:00Z", ["INVALID_OCCURRED_AT"]),
    ("occurred_at", "2026-06-20T14:15:60Z", ["INVALID_OCCURRED_AT"]),
    (EXPERIMENT + "experiment_id", Dropped, ["MISSING_EXPERIMENT_ID"]),
    (EXPERIMENT + "program_id", " ", ["MISSING_PROGRAM_ID"]),
    (EXPERIMENT + "lab_id", "", ["MISSING_LAB_ID"]),
    (MATERIAL + "material_id", None, ["MISSING_MATERIAL_ID"]),
    (MATERIAL + "family", "", ["MISSING_MATERIAL_FAMILY"]),
    (MATERIAL + "composition", Dropped, ["MISSING_COMPOSITION"]),
    (MATERIAL + "composition", [], ["MISSING_COMPOSITION", "COMPOSITION_TOTAL_NOT_100"]),
    (MATERIAL + "composition.0.mass_percent", 80.0, ["COMPOSITION_TOTAL_NOT_100"]),
    (MATERIAL + "composition.0.mass_percent", 95.52, ["COMPOSITION_TOTAL_NOT_100"]),
    (CONDITIONS + "temperature_c", -273.16, ["INVALID_TEMPERATURE"]),
    (CONDITIONS + "temperature_c", Dropped, ["INVALID_TEMPERATURE"]),
    (CONDITIONS + "pressure_mpa", -0.1, ["INVALID_PRESSURE"]),
    (CONDITIONS + "duration_minutes", 0, ["INVALID_DURATION"]),
    (MEASURED + "tensile_strength_mpa", -1, ["INVALID_TENSILE_STRENGTH"]),
    (MEASURED + "conductivity_s_per_m", None, ["INVALID_CONDUCTIVITY"]),
    (MEASURED + "density_g_per_cm3", 0.0, ["INVALID_DENSITY"]),
]

# Values at the edge of what the rules accept, and what they do not look at.
ACCEPTED = [
    ("source_system", ""),
    ("source_system", Dropped),
    ("unknown", {"a": [1]}),
    ("occurred_at", "2026-06-20"),
    ("occurred_at", " 2026-06-20T14:15:00+02:00 "),
    (EXPERIMENT + "lab_id", 17),
    (EXPERIMENT + "lab_id", {"a": 1}),
    (MATERIAL + "composition.0.mass_percent", 95.505),
    (MATERIAL + "composition.0.mass_percent", Dropped),
    (MATERIAL + "composition.0", None),
    (MATERIAL + "composition", [{"mass_percent": -20}, {"mass_percent": 120}]),
    (CONDITIONS + "temperature_c", -273.15),
    (CONDITIONS + "pressure_mpa", 0),
    (MEASURED + "tensile_strength_mpa", 0),
    (MEASURED + "conductivity_s_per_m", float("nan")),
    (MEASURED + "density_g_per_cm3", float("inf")),
]

MALFORMED = [
    '{"schema_version":',
    "[" + text(EVENTS[0]) + "]",
    "42",
    "null",
    "\t",
    text(changed(MEASURED + "density_g_per_cm3", "1.5")),
    text(changed(MEASURED + "density_g_per_cm3", True)),
    text(changed(MATERIAL + "composition", "iron")),
    text(changed("experiment", "none")),
]


def test_each_rule_reports_its_code(raw):
    found = codes(raw, *(changed(path, value) for path, value, _ in BROKEN))
    order = sorted(range(len(BROKEN)), key=lambda i: f"memory://{i}")
    assert found == [BROKEN[i][2] for i in order]


def test_verdicts_without_ansi(spark, raw):
    payloads = [*(changed(p, v) for p, v, _ in BROKEN), *(changed(p, v) for p, v in ACCEPTED)]
    with setting(spark, "spark.sql.ansi.enabled", "false"):
        lenient = codes(raw, *payloads, *MALFORMED)
    assert lenient == codes(raw, *payloads, *MALFORMED)


def test_what_the_rules_accept(raw):
    assert codes(raw, *(changed(p, v) for p, v in ACCEPTED)) == [[]] * len(ACCEPTED)


def test_malformed_rows_have_one_code(raw):
    assert codes(raw, *MALFORMED) == [["MALFORMED_JSON"]] * len(MALFORMED)


def test_mistyped_value_keeps_its_neighbours(raw):
    row = validated_events(raw(changed(MEASURED + "density_g_per_cm3", "n/a"))).first()
    assert (row.density_g_per_cm3, row.tensile_strength_mpa) == (None, 310.0)
    assert row.event_id == EVENTS[0]["event_id"]


def test_text_after_the_document_is_dropped(raw):
    line = text(EVENTS[0]) + text(EVENTS[1])
    row = validated_events(raw(line)).first()
    assert (row.is_valid, row.event_id) == (True, EVENTS[0]["event_id"])


def test_duplicate_keys_and_letter_case(raw):
    doubled = text(EVENTS[0]).replace('"event_id":', '"event_id":"first","event_id":')
    other_case = text(EVENTS[0]).replace('"event_id"', '"EVENT_ID"')
    assert codes(raw, doubled, other_case) == [[], ["MISSING_EVENT_ID"]]


def test_nan_mass_breaks_the_total(raw):
    assert codes(raw, changed(MATERIAL + "composition.0.mass_percent", float("nan"))) == [
        ["COMPOSITION_TOTAL_NOT_100"]
    ]


def test_empty_document_reports_everything_missing(raw):
    (found,) = codes(raw, "{}")
    assert len(found) == 16
    assert "COMPOSITION_TOTAL_NOT_100" not in found and "MALFORMED_JSON" not in found


def test_codes_accumulate_in_rule_order(raw):
    event = changed("schema_version", "9")
    event["experiment"]["measurements"]["density_g_per_cm3"] = -1
    event["experiment"]["lab_id"] = ""
    assert codes(raw, event) == [
        ["UNSUPPORTED_SCHEMA_VERSION", "MISSING_LAB_ID", "INVALID_DENSITY"]
    ]


def test_validated_layout_and_values(raw):
    validated = validated_events(raw(*EVENTS))
    assert tuple(validated.columns) == VALIDATED_COLUMNS
    row = validated.withColumn("epoch", F.unix_timestamp("occurred_at")).orderBy("event_id").first()
    assert row.epoch == 1781964900
    assert row.composition_mass_percent_total == 100.0
    assert [c.component for c in row.composition] == ["base", "second", "third"]
    assert row.raw_payload == text(EVENTS[0])
    assert row.processed_at is not None


def test_offsets_are_converted(raw):
    rows = validated_events(
        raw(changed("occurred_at", "2026-06-20T16:15:00+02:00"), EVENTS[0])
    ).select(F.unix_timestamp("occurred_at").alias("epoch"))
    assert {r.epoch for r in rows.collect()} == {1781964900}


def test_split_is_complete(raw):
    validated = validated_events(
        raw(*EVENTS, *MALFORMED, *(changed(p, v) for p, v, _ in BROKEN))
    )
    assert valid_events(validated).count() == 3
    assert quarantined_events(validated).count() == len(MALFORMED) + len(BROKEN)


@pytest.mark.parametrize("keep", [valid_events, quarantined_events])
def test_the_payload_is_parsed_once(raw, keep):
    plan = keep(validated_events(raw(*EVENTS)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1
