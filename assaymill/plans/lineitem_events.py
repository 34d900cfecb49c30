"""Experiment events derived from the ``lineitem`` and ``part`` tables.

Every line item becomes one event. Its brand is the program, its part the
material, its price, retail value and quantity the measurements. Line items of
some orders become faulty events, one kind of fault per ``l_orderkey % 100``, so
that SQL over the same tables can say what each operator has to find. All line
items take part; the remainder only picks the kind of event.

The SQL here is the common subset of Spark and the checking engine, so both sides
derive the same values from the same text.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.functions.columns import fingerprint, has_text
from assaymill.operators.parse import compute_once

FAULT = "l_orderkey % 100"

# Where the derived columns come from. Plain SQL, the same for both engines.
BASE = {
    "schema_version": "'1.0.0'",
    "event_key": "md5(concat(l_orderkey, '-', l_linenumber))",
    "event_id": (
        "concat_ws('-', substr(event_key, 1, 8), substr(event_key, 9, 4),"
        " substr(event_key, 13, 4), substr(event_key, 17, 4), substr(event_key, 21, 12))"
    ),
    "event_type": "'experiment.completed'",
    "occurred_at": "concat(replace(cast(l_shipdate AS string), ' ', 'T'), 'Z')",
    "source_system": "l_linestatus",
    "experiment_id": "concat('EXP-', l_orderkey)",
    "program_id": "p_brand",
    "lab_id": "concat('LAB-', l_suppkey)",
    "material_id": "concat('MAT-', l_partkey)",
    "material_family": "p_type",
    "first_mass": "cast(p_size AS double)",
    "second_mass": "cast(100 - p_size AS double)",
    "temperature_c": "l_discount * 1000",
    "pressure_mpa": "l_tax * 100",
    "duration_minutes": "cast(p_size AS double)",
    "tensile_strength_mpa": "l_extendedprice",
    "conductivity_s_per_m": (
        "cast(cast(p_retailprice AS decimal(10, 2)) * cast(l_quantity AS decimal(10, 0))"
        " AS double)"
    ),
    "density_g_per_cm3": "l_quantity",
}


@dataclass(frozen=True)
class Fault:
    """How an event is spoiled, and what the rules and the contract have to say.

    ``changes`` replace base columns (SQL, NULL drops the key), ``payload``
    rewrites the finished JSON text, called ``json`` in it. ``lost`` says that
    no field survives the parse. ``violations`` are path, rule and message, with
    event columns in braces.
    """

    codes: tuple[str, ...] = ()
    violations: tuple[tuple[str, str, str], ...] = ()
    changes: Mapping[str, str] = field(default_factory=dict)
    payload: str | None = None
    lost: bool = False


MATERIAL = "experiment.material"
CONDITIONS = "experiment.process_conditions"
MEASURED = "experiment.measurements"


def _absent(path: str, *keys: str) -> tuple[tuple[str, str, str], ...]:
    return tuple((path, "required", f"'{key}' is a required property") for key in keys)


NOT_JSON = ("<root>", "json", "not exactly one JSON document")
COLD = (
    f"{CONDITIONS}.temperature_c",
    "minimum",
    "-300 is less than the minimum of -273.15",
)

# Lines without any JSON.
BLANK = ("'   '", "'\t'")

FAULTS = {
    0: Fault(
        ("MALFORMED_JSON",),
        (NOT_JSON,),
        payload="substr(json, 1, length(json) - 40)",
        lost=True,
    ),
    1: Fault(
        ("MISSING_SCHEMA_VERSION",), _absent("<root>", "schema_version"), {"schema_version": "NULL"}
    ),
    2: Fault(
        ("MISSING_SCHEMA_VERSION", "UNSUPPORTED_SCHEMA_VERSION"),
        (("schema_version", "const", "\"\" is not '1.0.0'"),),
        {"schema_version": "''"},
    ),
    3: Fault(
        ("UNSUPPORTED_SCHEMA_VERSION",),
        (("schema_version", "const", "\"2.0.0\" is not '1.0.0'"),),
        {"schema_version": "'2.0.0'"},
    ),
    4: Fault(("MISSING_EVENT_ID",), _absent("<root>", "event_id"), {"event_id": "NULL"}),
    5: Fault(
        ("MISSING_EVENT_ID",),
        (("event_id", "format", "\"  \" is not a 'uuid'"),),
        {"event_id": "'  '"},
    ),
    6: Fault(("MISSING_EVENT_TYPE",), _absent("<root>", "event_type"), {"event_type": "NULL"}),
    7: Fault(
        ("UNSUPPORTED_EVENT_TYPE",),
        (("event_type", "const", "\"experiment.started\" is not 'experiment.completed'"),),
        {"event_type": "'experiment.started'"},
    ),
    8: Fault(("INVALID_OCCURRED_AT",), _absent("<root>", "occurred_at"), {"occurred_at": "NULL"}),
    9: Fault(
        ("INVALID_OCCURRED_AT",),
        (("occurred_at", "format", "\"not-a-date\" is not a 'date-time'"),),
        {"occurred_at": "'not-a-date'"},
    ),
    10: Fault(("MISSING_EXPERIMENT_ID",), (), {"experiment_id": "' '"}),
    11: Fault(("MISSING_PROGRAM_ID",), _absent("experiment", "program_id"), {"program_id": "NULL"}),
    12: Fault(
        ("MISSING_LAB_ID",),
        (("experiment.lab_id", "minLength", '"" is too short'),),
        {"lab_id": "''"},
    ),
    13: Fault(("MISSING_MATERIAL_ID",), _absent(MATERIAL, "material_id"), {"material_id": "NULL"}),
    14: Fault(("MISSING_MATERIAL_FAMILY",), (), {"material_family": "' '"}),
    15: Fault(
        ("MISSING_COMPOSITION",),
        _absent(MATERIAL, "composition"),
        payload="regexp_replace(json, ',\"composition\":[^]]*]', '')",
    ),
    16: Fault(
        ("MISSING_COMPOSITION", "COMPOSITION_TOTAL_NOT_100"),
        ((f"{MATERIAL}.composition", "minItems", "[] has too few items"),),
        payload="regexp_replace(json, '\"composition\":[^]]*]', '\"composition\":[]')",
    ),
    17: Fault(
        ("COMPOSITION_TOTAL_NOT_100",),
        (),
        {"first_mass": "cast(60 AS double)", "second_mass": "cast(20 AS double)"},
    ),
    18: Fault(
        ("INVALID_TEMPERATURE",),
        (COLD,),
        {"temperature_c": "cast(-300 AS double)"},
    ),
    19: Fault(("INVALID_PRESSURE",), _absent(CONDITIONS, "pressure_mpa"), {"pressure_mpa": "NULL"}),
    20: Fault(
        ("INVALID_PRESSURE",),
        ((f"{CONDITIONS}.pressure_mpa", "minimum", "-1 is less than the minimum of 0"),),
        {"pressure_mpa": "cast(-1 AS double)"},
    ),
    21: Fault(
        ("INVALID_DURATION",),
        (
            (
                f"{CONDITIONS}.duration_minutes",
                "exclusiveMinimum",
                "0 is less than or equal to the exclusive minimum of 0",
            ),
        ),
        {"duration_minutes": "cast(0 AS double)"},
    ),
    22: Fault(
        ("INVALID_TENSILE_STRENGTH",),
        (
            (
                f"{MEASURED}.tensile_strength_mpa",
                "minimum",
                "-5 is less than the minimum of 0",
            ),
        ),
        {"tensile_strength_mpa": "cast(-5 AS double)"},
    ),
    23: Fault(
        ("INVALID_CONDUCTIVITY",),
        _absent(MEASURED, "conductivity_s_per_m"),
        {"conductivity_s_per_m": "NULL"},
    ),
    24: Fault(
        ("INVALID_DENSITY",),
        (
            (
                f"{MEASURED}.density_g_per_cm3",
                "exclusiveMinimum",
                "0 is less than or equal to the exclusive minimum of 0",
            ),
        ),
        {"density_g_per_cm3": "cast(0 AS double)"},
    ),
    25: Fault(
        ("MISSING_LAB_ID", "INVALID_TEMPERATURE", "INVALID_DENSITY"),
        (
            *_absent("experiment", "lab_id"),
            COLD,
            (
                f"{MEASURED}.density_g_per_cm3",
                "exclusiveMinimum",
                "-1 is less than or equal to the exclusive minimum of 0",
            ),
        ),
        {
            "lab_id": "NULL",
            "temperature_c": "cast(-300 AS double)",
            "density_g_per_cm3": "cast(-1 AS double)",
        },
    ),
    # A number written as text: refused by the parse, its neighbours are kept.
    26: Fault(
        ("MALFORMED_JSON",),
        ((f"{MEASURED}.tensile_strength_mpa", "type", "\"n/a\" is not of type 'number'"),),
        {"tensile_strength_mpa": "NULL"},
        payload=(
            "replace(json, '\"measurements\":{',"
            " '\"measurements\":{\"tensile_strength_mpa\":\"n/a\",')"
        ),
    ),
    27: Fault(
        ("MALFORMED_JSON",),
        (("<root>", "type", "42 is not of type 'object'"),),
        payload="'42'",
        lost=True,
    ),
    28: Fault(
        (
            "MISSING_SCHEMA_VERSION",
            "MISSING_EVENT_ID",
            "MISSING_EVENT_TYPE",
            "INVALID_OCCURRED_AT",
            "MISSING_EXPERIMENT_ID",
            "MISSING_PROGRAM_ID",
            "MISSING_LAB_ID",
            "MISSING_MATERIAL_ID",
            "MISSING_MATERIAL_FAMILY",
            "MISSING_COMPOSITION",
            "INVALID_TEMPERATURE",
            "INVALID_PRESSURE",
            "INVALID_DURATION",
            "INVALID_TENSILE_STRENGTH",
            "INVALID_CONDUCTIVITY",
            "INVALID_DENSITY",
        ),
        _absent(
            "<root>",
            "schema_version",
            "event_id",
            "event_type",
            "occurred_at",
            "source_system",
            "experiment",
        ),
        payload="'{}'",
        lost=True,
    ),
    # Accepted by the rules, refused by the contract.
    29: Fault((), (NOT_JSON,), payload="concat(json, ' trailing')"),
    30: Fault(
        (),
        (("<root>", "additionalProperties", "Additional properties are not allowed: 'note'"),),
        payload="concat('{\"note\":1,', substr(json, 2))",
    ),
    31: Fault((), (("source_system", "minLength", "\"\" is too short"),), {"source_system": "''"}),
    32: Fault(
        (),
        (
            (
                f"{MATERIAL}.composition.0.mass_percent",
                "minimum",
                "-20 is less than the minimum of 0",
            ),
            (
                f"{MATERIAL}.composition.1.mass_percent",
                "maximum",
                "120 is greater than the maximum of 100",
            ),
        ),
        {"first_mass": "cast(-20 AS double)", "second_mass": "cast(120 AS double)"},
    ),
    33: Fault(
        (),
        (("event_id", "format", "\"{event_id}\" is not a 'uuid'"),),
        {"event_id": "event_key"},
    ),
    34: Fault(
        (),
        (("occurred_at", "format", "\"{occurred_at}\" is not a 'date-time'"),),
        {"occurred_at": "concat(cast(l_shipdate AS string), 'Z')"},
    ),
    35: Fault(
        (), _absent(f"{MATERIAL}.composition.0", "mass_percent"), {"first_mass": "NULL"}
    ),
    36: Fault(
        (),
        (("experiment.lab_id", "type", "17 is not of type 'string'"),),
        {"lab_id": "'17'"},
        payload="replace(json, '\"lab_id\":\"17\"', '\"lab_id\":17')",
    ),
    # A pattern's end must be the text's end: a line break after it breaks the contract only.
    39: Fault(
        (),
        (("event_id", "format", "\"{event_id}\" is not a 'uuid'"),),
        {"event_id": f"concat({BASE['event_id']}, chr(10))"},
    ),
    40: Fault(
        (),
        (("occurred_at", "format", "\"{occurred_at}\" is not a 'date-time'"),),
        {"occurred_at": f"concat({BASE['occurred_at']}, chr(10))"},
    ),
    # An extra key in every other object.
    **{
        number: Fault(
            (),
            ((path, "additionalProperties", "Additional properties are not allowed: 'note'"),),
            payload=f"replace(json, '{opening}', '{opening}\"note\":[1],')",
        )
        for number, path, opening in (
            (41, "experiment", '"experiment":{'),
            (42, MATERIAL, '"material":{'),
            (43, CONDITIONS, '"process_conditions":{'),
            (44, MEASURED, '"measurements":{'),
            (45, f"{MATERIAL}.composition.0", '"composition":[{'),
        )
    },
    46: Fault(
        ("MISSING_LAB_ID",),
        (("experiment.lab_id", "type", "null is not of type 'string'"),),
        {"lab_id": "NULL"},
        payload="replace(json, '\"experiment\":{', '\"experiment\":{\"lab_id\":null,')",
    ),
    47: Fault(
        (),
        ((f"{MATERIAL}.composition.1.component", "minLength", '"" is too short'),),
        payload="replace(json, '\"component\":\"rest\"', '\"component\":\"\"')",
    ),
    48: Fault((), (NOT_JSON,), payload="concat(json, json)"),
    49: Fault(
        ("MISSING_EVENT_TYPE", "UNSUPPORTED_EVENT_TYPE"),
        (("event_type", "const", "\"\" is not 'experiment.completed'"),),
        {"event_type": "''"},
    ),
    # Spaces only: never becomes a raw row. A tab does, and is malformed.
    37: Fault((), (), payload=BLANK[0]),
    38: Fault(("MALFORMED_JSON",), (NOT_JSON,), payload=BLANK[1], lost=True),
}

# The line item an event came from; kept beside the payload for comparisons.
SOURCE_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def column_sql(name: str) -> str:
    """The value of an event column under every fault, as one SQL expression."""
    cases = [
        f"WHEN {number} THEN {fault.changes[name]}"
        for number, fault in FAULTS.items()
        if name in fault.changes
    ]
    if not cases:
        return BASE[name]
    return f"CASE fault {' '.join(cases)} ELSE {BASE[name]} END"


def payload_sql() -> str:
    cases = [
        f"WHEN {number} THEN {fault.payload}" for number, fault in FAULTS.items() if fault.payload
    ]
    return f"CASE fault {' '.join(cases)} ELSE json END"


def event_columns(spark: SparkSession, sf_dir: str, file: str | None = None) -> DataFrame:
    """Line items with all event columns. Only what the events use is read.

    With ``file``, SQL for the file that a line item's event goes to, that column is there too and the rows of a
    file are together. They are dealt out as line items, which take a fraction of their events' room.
    """
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").drop("l_returnflag")
    # Parts grow with the line items, so they are not broadcast; the shuffle by part also deals
    # out a small table that came as one row group.
    part = spark.read.parquet(f"{sf_dir}/part.parquet").drop("p_name").hint("shuffle_hash")
    joined = lineitem.join(part, lineitem.l_partkey == part.p_partkey, "left")
    keys = SOURCE_KEYS
    if file is not None:
        # By number: the rows' size here says nothing of their events', so partitions must not be put together.
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        joined = joined.selectExpr("*", f"{file} AS file").repartition(partitions, "file")
        keys = (*keys, "file")
    keyed = joined.selectExpr("*", f"{FAULT} AS fault", f"{BASE['event_key']} AS event_key")
    return keyed.selectExpr(
        *keys,
        "fault",
        *(f"{column_sql(name)} AS {name}" for name in BASE if name != "event_key"),
    )


def derived_payloads(spark: SparkSession, sf_dir: str, file: str | None = None) -> DataFrame:
    """Every line item's keys with its event as JSON text in ``value``; ``file`` as in ``event_columns``."""
    part = F.struct(
        F.lit("base").alias("component"), F.col("first_mass").alias("mass_percent")
    ), F.struct(F.lit("rest").alias("component"), F.col("second_mass").alias("mass_percent"))
    material = F.struct(
        "material_id", F.col("material_family").alias("family"), F.array(*part).alias("composition")
    )
    event = F.struct(
        "schema_version",
        "event_id",
        "event_type",
        "occurred_at",
        "source_system",
        F.struct(
            "experiment_id",
            "program_id",
            "lab_id",
            material.alias("material"),
            F.struct("temperature_c", "pressure_mpa", "duration_minutes").alias(
                "process_conditions"
            ),
            F.struct("tensile_strength_mpa", "conductivity_s_per_m", "density_g_per_cm3").alias(
                "measurements"
            ),
        ).alias("experiment"),
    )
    columns = event_columns(spark, sf_dir, file)
    keys = SOURCE_KEYS if file is None else (*SOURCE_KEYS, "file")
    written = columns.select(*keys, "fault", F.to_json(event).alias("json"))
    return compute_once(written, "value", F.expr(payload_sql())).select(*keys, "value")


def derived_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows as the file source gives them, without a detour through files."""
    return (
        derived_payloads(spark, sf_dir)
        .filter(has_text(F.col("value")))
        .select(
            *SOURCE_KEYS,
            F.col("value").alias("raw_payload"),
            F.lit("lineitem").alias("source_file"),
            F.current_timestamp().alias("ingested_at"),
            fingerprint(F.col("value")).alias("payload_sha256"),
        )
    )


# Which copy of an event is kept, in columns both engines have; True where the larger value comes first.
DERIVED_ORDER = (
    ("occurred_at", True),
    ("material_id", False),
    ("lab_id", False),
    ("tensile_strength_mpa", False),
    ("density_g_per_cm3", False),
    ("temperature_c", False),
    ("pressure_mpa", False),
)


def derived_order():
    return [F.desc(c) if descending else F.asc(c) for c, descending in DERIVED_ORDER]
