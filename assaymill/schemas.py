"""Column layouts. Every field is nullable: presence is a rule, not a type."""

# --- fixed values: field names, types and column order of the four tables ---

EVENT = """
    schema_version string,
    event_id string,
    event_type string,
    occurred_at string,
    source_system string,
    experiment struct<
        experiment_id: string,
        program_id: string,
        lab_id: string,
        material: struct<
            material_id: string,
            family: string,
            composition: array<struct<component: string, mass_percent: double>>
        >,
        process_conditions: struct<
            temperature_c: double,
            pressure_mpa: double,
            duration_minutes: double
        >,
        measurements: struct<
            tensile_strength_mpa: double,
            conductivity_s_per_m: double,
            density_g_per_cm3: double
        >
    >
"""

RAW_COLUMNS = ("raw_payload", "source_file", "ingested_at", "payload_sha256")

VALIDATED_COLUMNS = (
    "event_id",
    "schema_version",
    "event_type",
    "occurred_at",
    "source_system",
    "experiment_id",
    "program_id",
    "lab_id",
    "material_id",
    "material_family",
    "composition",
    "composition_mass_percent_total",
    "temperature_c",
    "pressure_mpa",
    "duration_minutes",
    "tensile_strength_mpa",
    "conductivity_s_per_m",
    "density_g_per_cm3",
    "validation_errors",
    "is_valid",
    "raw_payload",
    "payload_sha256",
    "source_file",
    "ingested_at",
    "processed_at",
)

CANDIDATE_COLUMNS = (
    "program_id",
    "material_id",
    "material_family",
    "experiment_count",
    "average_tensile_strength_mpa",
    "average_conductivity_s_per_m",
    "average_density_g_per_cm3",
    "strength_score",
    "conductivity_score",
    "density_score",
    "candidate_score",
    "candidate_rank",
    "latest_experiment_at",
)

# Where each flat column of a validated event sits in the parsed document.
EVENT_PATHS = {
    "schema_version": "schema_version",
    "event_id": "event_id",
    "event_type": "event_type",
    "source_system": "source_system",
    "experiment_id": "experiment.experiment_id",
    "program_id": "experiment.program_id",
    "lab_id": "experiment.lab_id",
    "material_id": "experiment.material.material_id",
    "material_family": "experiment.material.family",
    "composition": "experiment.material.composition",
    "temperature_c": "experiment.process_conditions.temperature_c",
    "pressure_mpa": "experiment.process_conditions.pressure_mpa",
    "duration_minutes": "experiment.process_conditions.duration_minutes",
    "tensile_strength_mpa": "experiment.measurements.tensile_strength_mpa",
    "conductivity_s_per_m": "experiment.measurements.conductivity_s_per_m",
    "density_g_per_cm3": "experiment.measurements.density_g_per_cm3",
}

# --- end of fixed values ---
