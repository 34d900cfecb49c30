"""The sample experiments that the tests start from."""

import copy
import json


def experiment(
    number,
    program,
    material,
    family,
    masses,
    conditions,
    measured,
    occurred_at,
):
    names = ("base", "second", "third")
    return {
        "schema_version": "1.0.0",
        "event_id": f"00000000-0000-4000-8000-{number:012d}",
        "event_type": "experiment.completed",
        "occurred_at": occurred_at,
        "source_system": "lab",
        "experiment": {
            "experiment_id": f"EXP-2026-{number:03d}",
            "program_id": program,
            "lab_id": "LAB-1",
            "material": {
                "material_id": material,
                "family": family,
                "composition": [
                    {"component": n, "mass_percent": m} for n, m in zip(names, masses)
                ],
            },
            "process_conditions": dict(
                zip(("temperature_c", "pressure_mpa", "duration_minutes"), conditions)
            ),
            "measurements": dict(
                zip(
                    ("tensile_strength_mpa", "conductivity_s_per_m", "density_g_per_cm3"), measured
                )
            ),
        },
    }


# --- fixed values: the three sample experiments, and EXPECTED_RANKING in test_reconcile.py ---
# Two materials that compete and one that is alone in its program.
EVENTS = [
    experiment(
        1,
        "LIGHTWEIGHT-ALLOYS",
        "MAT-AL-001",
        "aluminum-alloy",
        (95.5, 3.0, 1.5),
        (520.0, 35.0, 90.0),
        (310.0, 23500000.0, 2.7),
        "2026-06-20T14:15:00Z",
    ),
    experiment(
        2,
        "LIGHTWEIGHT-ALLOYS",
        "MAT-AL-002",
        "aluminum-alloy",
        (94.0, 4.0, 2.0),
        (535.0, 40.0, 105.0),
        (342.0, 22100000.0, 2.72),
        "2026-06-21T16:40:00Z",
    ),
    experiment(
        3,
        "CONDUCTIVE-COMPOSITES",
        "MAT-COMP-001",
        "polymer-composite",
        (70.0, 30.0),
        (180.0, 8.0, 120.0),
        (610.0, 12500.0, 1.58),
        "2026-06-22T11:25:00Z",
    ),
]
# --- end of fixed values ---


class Dropped:
    """As a value for ``changed``: leave the key out."""


def changed(path="", value=None, event=EVENTS[0]):
    """A copy of an event with one value replaced, added or dropped."""
    document = copy.deepcopy(event)
    if path:
        *parents, last = [int(p) if p.isdigit() else p for p in path.split(".")]
        place = document
        for part in parents:
            place = place[part]
        if value is Dropped:
            del place[last]
        else:
            place[last] = value
    return document


def text(document):
    return json.dumps(document, separators=(",", ":"))
