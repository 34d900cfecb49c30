"""Experiment events on Spark: raw lines to validated rows to ranked candidates."""

from assaymill.plans.candidates import material_candidates, top_candidates
from assaymill.plans.experiments import (
    quarantined_events,
    valid_events,
    validated_events,
)
from assaymill.sources.files import read_events, read_raw, stream_raw

__all__ = [
    "material_candidates",
    "quarantined_events",
    "read_events",
    "read_raw",
    "stream_raw",
    "top_candidates",
    "valid_events",
    "validated_events",
]
