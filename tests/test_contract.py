import calendar
import copy
import random
import re

import pytest

from assaymill.operators.contract import (
    EXPERIMENT_CONTRACT,
    ROOT,
    Items,
    Object,
    Text,
    contract_violations,
    report,
)
from assaymill.session import setting
from sample_events import EVENTS, Dropped, changed, text

MATERIAL = "experiment.material"
ITEMS = MATERIAL + ".composition"
CONDITIONS = "experiment.process_conditions"
MEASURED = "experiment.measurements"

# Ids below that are not all zeros are fixed values, spoiled.
# One change to a good event, and the violations that follow, in path order.
CHANGES = [
    ("schema_version", Dropped, [(ROOT, "required")]),
    ("schema_version", None, [("schema_version", "type"), ("schema_version", "const")]),
    ("schema_version", 1, [("schema_version", "type"), ("schema_version", "const")]),
    ("schema_version", "1.0", [("schema_version", "const")]),
    ("extra", 1, [(ROOT, "additionalProperties")]),
    ("event_id", "3d9af7b0b1364a7fb384d3ab66c64a01", [("event_id", "format")]),
    ("event_id", "3d9af7b0-b136-4a7f-b384-d3ab66c64a0g", [("event_id", "format")]),
    ("event_type", "", [("event_type", "const")]),
    ("occurred_at", "2026-06-20", [("occurred_at", "format")]),
    ("occurred_at", "2026-06-20 14:15:00Z", [("occurred_at", "format")]),
    ("occurred_at", "2026-02-30T14:15:00Z", [("occurred_at", "format")]),
    ("occurred_at", "2026-06-20T14:15:00", [("occurred_at", "format")]),
    ("occurred_at", 20260620, [("occurred_at", "type")]),
    ("source_system", "", [("source_system", "minLength")]),
    ("experiment", [], [("experiment", "type")]),
    ("experiment", None, [("experiment", "type")]),
    ("experiment", {}, [("experiment", "required")] * 6),
    ("experiment.extra", 1, [("experiment", "additionalProperties")]),
    ("experiment.lab_id", Dropped, [("experiment", "required")]),
    ("experiment.lab_id", 17, [("experiment.lab_id", "type")]),
    ("experiment.program_id", "", [("experiment.program_id", "minLength")]),
    (MATERIAL + ".family", {"a": 1}, [(MATERIAL + ".family", "type")]),
    (MATERIAL + ".extra", None, [(MATERIAL, "additionalProperties")]),
    (ITEMS, Dropped, [(MATERIAL, "required")]),
    (ITEMS, {}, [(ITEMS, "type")]),
    (ITEMS, [], [(ITEMS, "minItems")]),
    (ITEMS + ".1", None, [(ITEMS + ".1", "type")]),
    (ITEMS + ".1", 5, [(ITEMS + ".1", "type")]),
    (ITEMS + ".1", {}, [(ITEMS + ".1", "required")] * 2),
    (ITEMS + ".2.extra", 1, [(ITEMS + ".2", "additionalProperties")]),
    (ITEMS + ".0.component", "", [(ITEMS + ".0.component", "minLength")]),
    (ITEMS + ".0.mass_percent", "95.5", [(ITEMS + ".0.mass_percent", "type")]),
    (ITEMS + ".0.mass_percent", -0.1, [(ITEMS + ".0.mass_percent", "minimum")]),
    (ITEMS + ".0.mass_percent", 100.1, [(ITEMS + ".0.mass_percent", "maximum")]),
    (CONDITIONS, "x", [(CONDITIONS, "type")]),
    (CONDITIONS + ".extra", 1, [(CONDITIONS, "additionalProperties")]),
    (CONDITIONS + ".temperature_c", -273.16, [(CONDITIONS + ".temperature_c", "minimum")]),
    (CONDITIONS + ".pressure_mpa", -1, [(CONDITIONS + ".pressure_mpa", "minimum")]),
    (CONDITIONS + ".duration_minutes", 0, [(CONDITIONS + ".duration_minutes", "exclusiveMinimum")]),
    (MEASURED + ".tensile_strength_mpa", True, [(MEASURED + ".tensile_strength_mpa", "type")]),
    (MEASURED + ".tensile_strength_mpa", -1e-9, [(MEASURED + ".tensile_strength_mpa", "minimum")]),
    (MEASURED + ".conductivity_s_per_m", Dropped, [(MEASURED, "required")]),
    (MEASURED + ".density_g_per_cm3", 0.0, [(MEASURED + ".density_g_per_cm3", "exclusiveMinimum")]),
    (MEASURED + ".density_g_per_cm3", float("nan"), [(ROOT, "json")]),
]

ALLOWED = [
    ("event_id", "3D9AF7B0-B136-4A7F-B384-D3AB66C64A01"),
    ("occurred_at", "2026-06-20t14:15:00.123z"),
    ("occurred_at", "2026-06-20T14:15:00+02:00"),
    ("source_system", " "),
    (ITEMS + ".0.mass_percent", 0),
    (ITEMS + ".0.mass_percent", 100),
    (CONDITIONS + ".temperature_c", -273.15),
    (CONDITIONS + ".duration_minutes", 1e-9),
    (MEASURED + ".conductivity_s_per_m", 10**40),
]

GOOD = text(EVENTS[0])

# Lines that are not one JSON document, also where only their end tells.
NOT_ONE_DOCUMENT = [
    GOOD[:-1],
    GOOD + " junk",
    GOOD + GOOD,
    GOOD + "," + GOOD,
    GOOD + "] x",
    GOOD + "," + GOOD + "] x",
    GOOD + ',"x"] {}',
    GOOD + ",",
    GOOD.replace('"event_id":', '"event_id":"a","event_id":'),
    "\t",
]


def found(raw, *payloads):
    rows = contract_violations(raw(*payloads)).collect()
    result = {f"memory://{i}": [] for i in range(len(payloads))}
    for row in rows:
        result[row.source_file].append((row.field_path, row.rule))
    return list(result.values())


def test_good_events_have_no_violations(raw):
    assert found(raw, *EVENTS) == [[], [], []]


def test_every_constraint(raw):
    payloads = [changed(path, value) for path, value, _ in CHANGES]
    for (path, value, expected), ours in zip(CHANGES, found(raw, *payloads), strict=True):
        assert ours == expected, (path, value)


def test_every_constraint_without_ansi(spark, raw):
    payloads = [changed(path, value) for path, value, _ in CHANGES]
    with setting(spark, "spark.sql.ansi.enabled", "false"):
        assert found(raw, *payloads) == [expected for _, _, expected in CHANGES]


def test_what_the_contract_allows(raw):
    payloads = [changed(path, value) for path, value in ALLOWED]
    for change, ours in zip(ALLOWED, found(raw, *payloads), strict=True):
        assert ours == [], change


def test_one_document_per_line(raw):
    assert found(raw, *NOT_ONE_DOCUMENT) == [[(ROOT, "json")]] * len(NOT_ONE_DOCUMENT)


@pytest.mark.parametrize("payload", ["42", "null", "[]", '"x"', f"[{GOOD}]"])
def test_a_document_that_is_no_object(raw, payload):
    assert found(raw, payload) == [[(ROOT, "type")]]


def test_spaces_around_the_document(raw):
    assert found(raw, f"  {GOOD} ") == [[]]


def test_violations_come_in_path_order(raw):
    event = changed("schema_version", "x")
    event["event_id"] = "x"
    event["more"] = event["extra"] = 1
    del event["source_system"]
    event["experiment"]["material"]["composition"][1]["mass_percent"] = -1
    event["experiment"]["measurements"]["density_g_per_cm3"] = 0
    assert found(raw, event) == [
        [
            (ROOT, "additionalProperties"),
            (ROOT, "required"),
            ("event_id", "format"),
            (ITEMS + ".1.mass_percent", "minimum"),
            (MEASURED + ".density_g_per_cm3", "exclusiveMinimum"),
            ("schema_version", "const"),
        ]
    ]


def test_messages_and_report(raw):
    event = changed("event_id", "x")
    event["more"] = event["extra"] = 1
    bronze = raw(event)
    sha = bronze.first().payload_sha256
    rows = report(contract_violations(bronze.unionAll(bronze))).collect()
    assert [r.copies for r in rows] == [2, 2]
    assert [r.line for r in rows] == [
        f"Payload {sha}, field <root>: Additional properties are not allowed: 'extra', 'more'",
        f"Payload {sha}, field event_id: \"x\" is not a 'uuid'",
    ]


def test_the_payload_is_parsed_once(raw):
    plan = contract_violations(raw(*EVENTS))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and plan.count("from_json(") == 1


UUID = "[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"


def is_date_time(value):
    """By the grammar of RFC 3339; year 0000 is a leap year."""
    form = r"(\d{4})-(\d\d)-(\d\d)[Tt](\d\d):([0-5]\d):([0-5]\d)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)"
    found = re.fullmatch(form, value, re.ASCII)
    if not found or int(found[4]) > 23 or not 1 <= int(found[2]) <= 12:
        return False
    return 1 <= int(found[3]) <= calendar.monthrange(int(found[1]) or 2000, int(found[2]))[1]


FORMS = [
    ("event_id", "00000000-0000-4000-8000-000000000001\n", False),
    ("event_id", "\n00000000-0000-4000-8000-000000000001", False),
    ("event_id", "ABCDEFab-0000-0000-0000-000000000000", True),
    ("occurred_at", "2026-06-20T14:15:00Z\n", False),
    ("occurred_at", "2026-06-20T14:15:00Z\r", False),
    ("occurred_at", "2026-06-20T14:15:00Z\u2028", False),
    ("occurred_at", "0000-01-01T00:00:00Z", True),
    ("occurred_at", "0000-02-29T00:00:00Z", True),
    ("occurred_at", "2024-02-29T00:00:00+23:59", True),
    ("occurred_at", "2000-02-29T00:00:00Z", True),
    ("occurred_at", "2023-02-29T00:00:00Z", False),
    ("occurred_at", "1900-02-29T00:00:00Z", False),
    ("occurred_at", "2023-04-31t23:59:59.123456789z", False),
]


@pytest.mark.parametrize(("path", "value", "fits"), FORMS)
def test_forms(raw, path, value, fits):
    event = changed(path, value)
    assert found(raw, event) == [[] if fits else [(path, "format")]]
    assert by_hand(EXPERIMENT_CONTRACT, event) == found(raw, event)[0]


def by_hand(spec, value, path=()):
    """The same checks in plain Python, one document at a time."""
    place = ".".join(path) or ROOT
    if isinstance(spec, Object):
        if not isinstance(value, dict):
            return [(place, "type")]
        result = [(place, "additionalProperties")] * bool(set(value) - set(spec.fields))
        result += [(place, "required")] * len(set(spec.fields) - set(value))
        for key in sorted(set(spec.fields) & set(value)):
            result += by_hand(spec.fields[key], value[key], (*path, key))
        return result
    if isinstance(spec, Items):
        if not isinstance(value, list):
            return [(place, "type")]
        result = [(place, "minItems")] * (len(value) < spec.min_items)
        for i, item in enumerate(value):
            result += by_hand(spec.item, item, (*path, str(i)))
        return result
    result = []
    if isinstance(spec, Text):
        if not isinstance(value, str):
            return [(place, "type")] + [(place, "const")] * (spec.const is not None)
        if spec.const is not None and value != spec.const:
            result.append((place, "const"))
        if spec.min_length is not None and len(value) < spec.min_length:
            result.append((place, "minLength"))
        if spec.form == "uuid" and not re.fullmatch(UUID, value):
            result.append((place, "format"))
        if spec.form == "date-time" and not is_date_time(value):
            result.append((place, "format"))
        return result
    if isinstance(value, bool) or not isinstance(value, int | float):
        return [(place, "type")]
    if spec.minimum is not None and value < spec.minimum:
        result.append((place, "minimum"))
    if spec.above is not None and value <= spec.above:
        result.append((place, "exclusiveMinimum"))
    if spec.maximum is not None and value > spec.maximum:
        result.append((place, "maximum"))
    return result


def test_random_documents_against_checks_by_hand(raw):
    dice = random.Random(11)
    values = ["\n", "2026-06-20T14:15:00Z\n", None, True, 0, -1, 0.5, 100, 1e20, -273.15, "", " ", "x", "1.0.0", "5", {}, []]
    values += [{"component": "x", "mass_percent": 1}, [{"component": "x"}], [None], ["a", 1]]

    def spoil(node):
        """Change something at a random depth."""
        keys = list(node) if isinstance(node, dict) else range(len(node))
        key = dice.choice(list(keys)) if keys else None
        if key is not None and isinstance(node[key], dict | list) and dice.random() < 0.7:
            spoil(node[key])
        elif isinstance(node, list):
            node.append(copy.deepcopy(dice.choice(values)))
        elif key is None or dice.random() < 0.2:
            node[f"extra{dice.randrange(3)}"] = copy.deepcopy(dice.choice(values))
        elif dice.random() < 0.3:
            del node[key]
        else:
            node[key] = copy.deepcopy(dice.choice(values))

    documents = []
    for _ in range(400):
        document = copy.deepcopy(dice.choice(EVENTS))
        for _ in range(dice.randrange(4)):
            spoil(document)
        documents.append(document)
    for document, ours in zip(documents, found(raw, *documents), strict=True):
        assert ours == by_hand(EXPERIMENT_CONTRACT, document), document
