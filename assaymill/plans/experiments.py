"""From raw lines to validated experiment events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.functions.columns import array_total
from assaymill.operators import rules
from assaymill.operators.parse import flatten, parse_json, parse_succeeded
from assaymill.operators.rules import Rule
from assaymill.schemas import EVENT, EVENT_PATHS, VALIDATED_COLUMNS


def _blank(column: str) -> str:
    return f"{column} IS NULL OR trim({column}) = ''"


def _not_exactly(column: str, text: str) -> str:
    return f"{column} <> '{text}'"


def _outside(column: str, limit: str) -> str:
    return f"{column} IS NULL OR {column} {limit}"


# --- fixed values: rule codes, their order, and the limits they test ---
EXPERIMENT_RULES = (
    Rule("MISSING_SCHEMA_VERSION", _blank("schema_version")),
    Rule("UNSUPPORTED_SCHEMA_VERSION", _not_exactly("schema_version", "1.0.0")),
    Rule("MISSING_EVENT_ID", _blank("event_id")),
    Rule("MISSING_EVENT_TYPE", _blank("event_type")),
    Rule("UNSUPPORTED_EVENT_TYPE", _not_exactly("event_type", "experiment.completed")),
    Rule("INVALID_OCCURRED_AT", f"occurred_at IS NULL OR {_blank('occurred_text')}"),
    Rule("MISSING_EXPERIMENT_ID", _blank("experiment_id")),
    Rule("MISSING_PROGRAM_ID", _blank("program_id")),
    Rule("MISSING_LAB_ID", _blank("lab_id")),
    Rule("MISSING_MATERIAL_ID", _blank("material_id")),
    Rule("MISSING_MATERIAL_FAMILY", _blank("material_family")),
    Rule("MISSING_COMPOSITION", "composition IS NULL OR size(composition) = 0"),
    Rule("COMPOSITION_TOTAL_NOT_100", "abs(composition_mass_percent_total - 100D) > 0.01D"),
    Rule("INVALID_TEMPERATURE", _outside("temperature_c", "< -273.15D")),
    Rule("INVALID_PRESSURE", _outside("pressure_mpa", "< 0D")),
    Rule("INVALID_DURATION", _outside("duration_minutes", "<= 0D")),
    Rule("INVALID_TENSILE_STRENGTH", _outside("tensile_strength_mpa", "< 0D")),
    Rule("INVALID_CONDUCTIVITY", _outside("conductivity_s_per_m", "< 0D")),
    Rule("INVALID_DENSITY", _outside("density_g_per_cm3", "<= 0D")),
)
# --- end of fixed values ---


def validated_events(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every raw row with its flat event columns, its error codes and its verdict.

    Narrow from end to end and usable on a stream. The rules accept some
    documents the data contract refuses (text after the document, NaN measures,
    an item without mass); ``operators.contract`` reports those.

    An unreadable time becomes NULL and is reported by its rule. The failing
    conversion would end the whole job under ANSI mode instead.

    ``keep`` names further columns of ``raw`` to carry along in front.
    """
    parsed = parse_json(raw, "raw_payload", EVENT)
    flat = parsed.select(
        *flatten("parsed", EVENT_PATHS),
        F.col("parsed.occurred_at").alias("occurred_text"),
        F.try_to_timestamp("parsed.occurred_at").alias("occurred_at"),
        array_total(F.col("parsed.experiment.material.composition"), "mass_percent").alias(
            "composition_mass_percent_total"
        ),
        parse_succeeded("parsed").alias("readable"),
        *raw.columns,
    )
    return (
        rules.validate(flat, EXPERIMENT_RULES, F.col("readable"))
        .withColumn("processed_at", F.current_timestamp())
        .select(*keep, *VALIDATED_COLUMNS)
    )


def valid_events(validated: DataFrame) -> DataFrame:
    return rules.valid(validated)


def quarantined_events(validated: DataFrame) -> DataFrame:
    return rules.quarantined(validated)
