"""Every operator as a query over the given tables, and the SQL that checks it.

The experiment events of these queries come from ``plans.lineitem_events``. Each
query takes a session and the folder of the tables. ``QUERIES`` and ``SQL`` list
them by name.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill.functions.columns import fingerprint, has_text
from assaymill.operators import reconcile
from assaymill.operators.contract import (
    EXPERIMENT_CONTRACT,
    contract_violations,
    numbered_report,
    report,
)
from assaymill.operators.dedup import latest_per_key
from assaymill.operators.json_schema import as_schema, compiled, schema_violations, tree_violations
from assaymill.operators.exact_sum import exact_sums
from assaymill.operators.intervals import overlapping
from assaymill.operators.parse import flatten, parse_json, parse_succeeded
from assaymill.operators.ranking import rank_within
from assaymill.operators.scoring import bounds
from assaymill.operators.timeline import asof_join, sessions, stream_sessions
from assaymill.plans import candidates as gold
from assaymill.plans.experiments import quarantined_events, valid_events, validated_events
from assaymill.plans.lineitem_events import (
    BASE,
    BLANK,
    DERIVED_ORDER,
    FAULT,
    FAULTS,
    SOURCE_KEYS,
    column_sql,
    derived_order,
    derived_payloads,
    derived_raw,
)
from assaymill.schemas import CANDIDATE_COLUMNS
from assaymill.session import emptied, materialise, setting, shared_folder, shuffles_released
from assaymill.sources.files import read_events, read_raw
from assaymill.sources.ranges import read_raw_numbered
from assaymill.sources.tables import read_table, stream_table
from assaymill.streaming import incremental, ledger
from assaymill.streaming import layers as stream
from assaymill.streaming.latest import standing

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
WEIGHTS = (0.45, 0.35, 0.20)
OTHER_WEIGHTS = (0.5, -0.25, 0.75)
TOP = 3


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL that checks it."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        SQL[function.__name__] = sql
        return function

    return register


# ---------------------------------------------------------------- derived input


def epoch(column: str, name: str):
    return F.unix_timestamp(column).alias(name)


def validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated derived events, with the keys of the line item they came from."""
    raw = derived_raw(spark, sf_dir)
    return validated_events(raw, keep=SOURCE_KEYS)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(validated(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.material_summary(valid(spark, sf_dir), derived_order(), scale=2)


def ranked(spark: SparkSession, sf_dir: str, weights=WEIGHTS, **options) -> DataFrame:
    return gold.material_candidates(
        valid(spark, sf_dir), *weights, order=derived_order(), scale=2, **options
    )


# Lines to a compressed text file, which one task reads whole.
LINES_PER_FILE = 250_000


def written_lines(lines: DataFrame) -> str:
    """Compressed text files in the shared folder, one line per row, for the file sources."""
    folder = shared_folder(lines.sparkSession, "lines")
    lines.write.options(compression="gzip", maxRecordsPerFile=LINES_PER_FILE).text(folder)
    return folder


_streamed: dict[tuple[str, str], tuple[tuple, stream.Layers]] = {}


def _content(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells tables of one folder apart from what it held before."""
    return tuple(
        tuple(
            spark.read.parquet(f"{sf_dir}/{name}.parquet")
            .select(F.xxhash64("*").cast("decimal(38,0)").alias("row"))
            .agg(F.count("*"), F.sum("row"))
            .first()
        )
        for name in ("lineitem", "part")
    )


def streamed(spark: SparkSession, sf_dir: str) -> stream.Layers:
    """All layers filled by the streams, once per session and content of the folder."""
    key, content = (spark.sparkContext.applicationId, sf_dir), _content(spark, sf_dir)
    if key in _streamed and _streamed[key][0] != content:
        spark.sql(f"DROP DATABASE {_streamed.pop(key)[1].database} CASCADE")
    if key not in _streamed:
        root = shared_folder(spark, "layers")
        made = stream.Layers(f"layers_{root[-32:]}", root)
        with shuffles_released(spark):
            arrived = written_lines(derived_payloads(spark, sf_dir).select("value"))
            stream.create_database(spark, made)
            stream.append(stream.stream_raw(spark, arrived), made, stream.RAW)
            # The raw layer has the lines now; their files would only lie beside all layers until the end.
            emptied(spark, arrived)
            scoring = {"order": derived_order(), "scale": 2}
            stream.run_available(spark, arrived, made, scoring=scoring)
        _streamed[key] = content, made
    return _streamed[key][1]


# ------------------------------------------------------ the same in checking SQL


def _by_fault(value: Callable[[int], str | None], otherwise: str) -> str:
    cases = " ".join(f"WHEN {n} THEN {value(n)}" for n in FAULTS if value(n) is not None)
    return f"CASE fault {cases} ELSE {otherwise} END"


def _numbers(wanted: Callable[[int], bool]) -> str:
    return ", ".join(str(n) for n in FAULTS if wanted(n))


LOST = _numbers(lambda n: FAULTS[n].lost)

# The text of a line as far as telling blank lines takes it: all of a line without
# any JSON, else its first character.
LINE = _by_fault(lambda n: FAULTS[n].payload if FAULTS[n].payload in BLANK else None, "'{'")

# Line items as the raw layer holds them: without the lines that are blank.
RAW_SQL = f"""
    keyed AS (
        SELECT *, {FAULT} AS fault, {BASE["event_key"]} AS event_key
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    ),
    raw AS (
        SELECT {", ".join(SOURCE_KEYS)}, fault,
            {", ".join(f"{column_sql(c)} AS {c}" for c in BASE if c != "event_key")},
            {LINE} AS line
        FROM keyed
        WHERE length(trim({LINE})) > 0
    )
"""

_PARSED = [c for c in BASE if c not in ("event_key", "first_mass", "second_mass", "occurred_at")]

# What the parse and the rules make of them.
VALIDATED_SQL = f"""
    {RAW_SQL},
    validated AS (
        SELECT {", ".join(SOURCE_KEYS)}, fault, line,
            {", ".join(f"CASE WHEN fault NOT IN ({LOST}) THEN {c} END AS {c}" for c in _PARSED)},
            CASE WHEN fault NOT IN ({LOST}, 8, 9)
                THEN CAST(epoch(l_shipdate) AS BIGINT) END AS occurred_epoch,
            CASE WHEN fault IN ({LOST}, 15) THEN NULL WHEN fault = 16 THEN 0
                ELSE first_mass + second_mass END AS mass_total,
            CASE WHEN fault IN ({LOST}, 15) THEN NULL WHEN fault = 16 THEN ''
                ELSE concat('base:', coalesce(CAST(CAST(first_mass AS BIGINT) AS VARCHAR), ''),
                    CASE fault WHEN 47 THEN ';:' ELSE ';rest:' END,
                    CAST(CAST(second_mass AS BIGINT) AS VARCHAR)) END AS composition,
            {_by_fault(lambda n: f"'{','.join(FAULTS[n].codes)}'", "''")} AS codes
        FROM raw
    ),
    valid AS (SELECT * FROM validated WHERE codes = '')
"""

# Which copy of an event comes first: by values, as ``derived_order`` says, or by when it was read.
BY_VALUES = (
    "occurred_epoch DESC, material_id, lab_id, tensile_strength_mpa, density_g_per_cm3,"
    " temperature_c, pressure_mpa"
)
BY_READING = "occurred_epoch DESC, l_partkey DESC, l_suppkey DESC"


def _latest_sql(order: str) -> str:
    return f"""
        {VALIDATED_SQL},
        latest AS (
            SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY {order}) AS copy
                FROM valid
            ) WHERE copy = 1
        )
    """


LATEST_SQL = _latest_sql(BY_VALUES)


def _mean_sql(column: str) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18, 2))) AS DOUBLE) / count({column})"


def _summary_sql(order: str) -> str:
    return f"""
        {_latest_sql(order)},
        summary AS (
            SELECT program_id, material_id, material_family,
                CAST(count(DISTINCT experiment_id) AS BIGINT) AS experiment_count,
                {_mean_sql("tensile_strength_mpa")} AS average_tensile_strength_mpa,
                {_mean_sql("conductivity_s_per_m")} AS average_conductivity_s_per_m,
                {_mean_sql("density_g_per_cm3")} AS average_density_g_per_cm3,
                max(occurred_epoch) AS latest_epoch
            FROM latest
            GROUP BY program_id, material_id, material_family
        )
    """


SUMMARY_SQL = _summary_sql(BY_VALUES)


def _scaled_sql(column: str, higher: bool) -> str:
    low, high = f"min({column}) OVER program", f"max({column}) OVER program"
    distance = f"{column} - {low}" if higher else f"{high} - {column}"
    return f"CASE WHEN {low} = {high} THEN 1.0::DOUBLE ELSE ({distance}) / ({high} - {low}) END"


def _ranked_sql(weights: tuple[float, float, float], order: str = BY_VALUES) -> str:
    strength, conductivity, density = (f"{w}::DOUBLE" for w in weights)
    return f"""
        {_summary_sql(order)},
        scaled AS (
            SELECT *,
                {_scaled_sql("average_tensile_strength_mpa", True)} AS strength_score,
                {_scaled_sql("average_conductivity_s_per_m", True)} AS conductivity_score,
                {_scaled_sql("average_density_g_per_cm3", False)} AS density_score
            FROM summary
            WINDOW program AS (PARTITION BY program_id)
        ),
        scored AS (
            SELECT *, round(
                strength_score * {strength} + conductivity_score * {conductivity}
                + density_score * {density}, 4) + 0::DOUBLE AS candidate_score
            FROM scaled
        ),
        ranked AS (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY program_id
                ORDER BY candidate_score DESC, average_tensile_strength_mpa DESC,
                    average_conductivity_s_per_m DESC, average_density_g_per_cm3,
                    material_id, material_family
            ) AS INTEGER) AS candidate_rank
            FROM scored
        )
    """


RANKED_SQL = _ranked_sql(WEIGHTS)

_RANKED_COLUMNS = (
    "program_id, material_id, material_family, experiment_count, average_tensile_strength_mpa,"
    " average_conductivity_s_per_m, average_density_g_per_cm3, strength_score,"
    " conductivity_score, density_score, candidate_score, candidate_rank, latest_epoch"
)


def with_epoch(ranked_rows: DataFrame) -> DataFrame:
    return ranked_rows.select(
        *(c for c in ranked_rows.columns if c != "latest_experiment_at"),
        epoch("latest_experiment_at", "latest_epoch"),
    )


# -------------------------------------------------------------- sources, raw layer


@query("""
    SELECT props AS raw_payload, sha256(props) AS payload_sha256
    FROM events WHERE length(trim(props)) > 0
""")
def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw line read, blank-line filter and fingerprint, from text files."""
    props = spark.read.parquet(f"{sf_dir}/events.parquet").select("props")
    return read_raw(spark, written_lines(props)).select("raw_payload", "payload_sha256")


@query("""
    SELECT doc_id, sha256(text) AS payload_sha256
    FROM documents WHERE length(trim(text)) > 0
""")
def text_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank filter and fingerprint over whole texts of several lines."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return documents.filter(has_text(F.col("text"))).select(
        "doc_id", fingerprint(F.col("text")).alias("payload_sha256")
    )


_TYPED_TEXT = ("schema_version", "event_id", "event_type", "source_system")
_TYPED = (
    "experiment_id",
    "program_id",
    "lab_id",
    "material_id",
    "material_family",
    "temperature_c",
    "pressure_mpa",
    "duration_minutes",
    "tensile_strength_mpa",
    "conductivity_s_per_m",
    "density_g_per_cm3",
)


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(_TYPED_TEXT + _TYPED)}
    FROM validated WHERE regexp_matches(line, '[^ \t]')
""")
def typed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed read of JSON lines: bad lines as rows of NULLs, bad values as NULL."""
    lines = written_lines(derived_payloads(spark, sf_dir).select("value"))
    return read_events(spark, lines).select(
        *_TYPED_TEXT,
        "experiment.experiment_id",
        "experiment.program_id",
        "experiment.lab_id",
        "experiment.material.material_id",
        F.col("experiment.material.family").alias("material_family"),
        "experiment.process_conditions.*",
        "experiment.measurements.*",
    )


# ------------------------------------------------------------- parse and validate


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, TRUE AS readable
    FROM events
""")
def parse_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse with another schema."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "props")
    return parse_json(events, "props", "k bigint").select(
        "event_id", *flatten("parsed", {"k": "k"}), parse_succeeded().alias("readable")
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS + _TYPED_TEXT + _TYPED)} FROM validated
""")
def parse_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All flat columns of all raw rows, whatever their verdict."""
    return validated(spark, sf_dir).select(*KEYS, *_TYPED_TEXT, *_TYPED)


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS)}, mass_total FROM validated
""")
def composition_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).select(
        *KEYS, F.col("composition_mass_percent_total").alias("mass_total")
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS)}, occurred_epoch FROM validated
""")
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validated(spark, sf_dir).select(*KEYS, epoch("occurred_at", "occurred_epoch"))


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS)}, codes, codes = '' AS is_valid FROM validated
""")
def rule_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codes of every raw row, in rule order."""
    return validated(spark, sf_dir).select(
        *KEYS, F.array_join("validation_errors", ",").alias("codes"), "is_valid"
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT code, CAST(count(*) AS BIGINT) AS row_count
    FROM (SELECT unnest(string_split(codes, ',')) AS code FROM validated WHERE codes <> '')
    GROUP BY code
""")
def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = quarantined_events(validated(spark, sf_dir))
    return (
        broken.select(F.explode("validation_errors").alias("code"))
        .groupBy("code")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


_EVENT_COLUMNS = (
    "event_id",
    "experiment_id",
    "program_id",
    "lab_id",
    "material_id",
    "material_family",
    "tensile_strength_mpa",
    "conductivity_s_per_m",
    "density_g_per_cm3",
)


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS + _EVENT_COLUMNS)}, occurred_epoch, mass_total FROM valid
""")
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid(spark, sf_dir).select(
        *KEYS,
        *_EVENT_COLUMNS,
        epoch("occurred_at", "occurred_epoch"),
        F.col("composition_mass_percent_total").alias("mass_total"),
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS)}, event_id, codes FROM validated WHERE codes <> ''
""")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined_events(validated(spark, sf_dir)).select(
        *KEYS, "event_id", F.array_join("validation_errors", ",").alias("codes")
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(KEYS + _TYPED_TEXT + _TYPED)}, occurred_epoch, mass_total, composition, codes,
        codes = '' AS is_valid, TRUE AS has_payload, TRUE AS has_fingerprint
    FROM validated
""")
def validated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole validated row, the composition as text. Its line and hash are only looked at
    for being there: another engine does not write JSON byte for byte."""
    return validated(spark, sf_dir).select(
        *KEYS,
        *_TYPED_TEXT,
        *_TYPED,
        epoch("occurred_at", "occurred_epoch"),
        F.col("composition_mass_percent_total").alias("mass_total"),
        F.expr(
            "array_join(transform(composition, i -> concat(coalesce(i.component, ''), ':',"
            " coalesce(CAST(CAST(i.mass_percent AS bigint) AS string), ''))), ';')"
        ).alias("composition"),
        F.array_join("validation_errors", ",").alias("codes"),
        "is_valid",
        (F.length("raw_payload") > 0).alias("has_payload"),
        (fingerprint(F.col("raw_payload")) == F.col("payload_sha256")).alias("has_fingerprint"),
    )


# ---------------------------------------------------------------- data contract

def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_VIOLATIONS_SQL = f"""
    violation(fault, field_path, rule, template) AS (
        VALUES {", ".join(
            f"({n}, {', '.join(map(_literal, v))})" for n, f in FAULTS.items() for v in f.violations
        )}
    )
"""


def _found_sql(keys: tuple[str, ...]) -> str:
    return f"""
        {RAW_SQL}, {_VIOLATIONS_SQL},
        found AS (
            SELECT {", ".join(keys)}, field_path, rule,
                replace(replace(template, '{{event_id}}', replace(coalesce(event_id, ''), chr(10), '\\n')),
                    '{{occurred_at}}', replace(coalesce(occurred_at, ''), chr(10), '\\n')) AS message
            FROM raw JOIN violation USING (fault)
        )
    """


_FOUND_SQL = _found_sql(KEYS)


@query(f"WITH {_FOUND_SQL} SELECT * FROM found")
def contract_violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every violation of every raw row."""
    return contract_violations(derived_raw(spark, sf_dir), keep=KEYS)


@query(f"""
    WITH {_FOUND_SQL}
    SELECT field_path, rule, CAST(count(*) AS BIGINT) AS row_count
    FROM found GROUP BY field_path, rule
""")
def contract_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contract_violations(derived_raw(spark, sf_dir))
    return found.groupBy("field_path", "rule").agg(F.count(F.lit(1)).alias("row_count"))


@query(f"""
    WITH {_FOUND_SQL}
    SELECT concat('field ', field_path, ': ', message) AS line, CAST(count(*) AS BIGINT) AS copies
    FROM found GROUP BY field_path, message
""")
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the report, without the payload's name: that is a hash of JSON text
    which another engine does not write byte for byte."""
    lines = report(contract_violations(derived_raw(spark, sf_dir)))
    unnamed = F.regexp_replace("line", "^Payload [0-9a-f]{64}, ", "").alias("line")
    return lines.groupBy(unnamed).agg(F.sum("copies").alias("copies"))


@query(f"WITH {_FOUND_SQL} SELECT * FROM found")
def schema_contract_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract as a JSON Schema document, by the tree of checks that takes any schema."""
    schema = compiled(json.dumps(as_schema(EXPERIMENT_CONTRACT)))
    return tree_violations(derived_raw(spark, sf_dir), schema, "raw_payload", KEYS)


# A second contract, for documents made of the table ``events``: references, alternatives, constants,
# a pattern and nested lists.
ACTION_SCHEMA = """{
    "$schema": "https://json-schema.org/draft/2020-12/schema",
    "title": "What a user did",
    "$defs": {
        "step": {"type": "integer", "minimum": 0, "maximum": 8},
        "steps": {"type": "array", "minItems": 2, "items": {"$ref": "#/$defs/step"}}
    },
    "type": "object",
    "required": ["id", "kind"],
    "additionalProperties": false,
    "properties": {
        "id": {"type": "integer", "multipleOf": 2},
        "kind": {"enum": ["click", "view", "purchase", "signup"]},
        "by": {"anyOf": [{"type": "null"}, {"type": "string", "pattern": "^u[1-9]"}]},
        "paths": {"type": "array", "maxItems": 2, "items": {"$ref": "#/$defs/steps"}},
        "props": {"properties": {"k": {"anyOf": [{"type": "integer", "maximum": 49}, {"const": 77}]}}}
    }
}"""

# The same text in both engines. Every third event has no kind, one in seven no user.
_ACTION = """concat(
    '{"id":', event_id,
    CASE WHEN event_id % 3 <> 0 THEN concat(',"kind":"', event_type, '"') ELSE '' END,
    ',"by":', CASE WHEN user_id % 7 = 0 THEN 'null' ELSE concat('"u', user_id % 4, '"') END,
    ',"paths":[[', user_id % 10, ',', event_id % 11, '],[', event_id % 5, ']],"props":', props, '}')"""


@query("""
    WITH checked AS (
        SELECT event_id, event_type, user_id, user_id % 10 AS a, event_id % 11 AS b, event_id % 5 AS c,
            CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events
    )
    SELECT event_id, 'id' AS field_path, 'multipleOf' AS rule, concat(event_id, ' is not a multiple of 2') AS message
    FROM checked WHERE event_id % 2 = 1
    UNION ALL
    SELECT event_id, '<root>', 'required', concat(chr(39), 'kind', chr(39), ' is a required property')
    FROM checked WHERE event_id % 3 = 0
    UNION ALL
    SELECT event_id, 'kind', 'enum', concat('"', event_type,
        replace('" is not one of [|click|, |view|, |purchase|, |signup|]', '|', chr(39)))
    FROM checked WHERE event_id % 3 <> 0 AND event_type = 'error'
    UNION ALL
    SELECT event_id, 'by', 'anyOf', '"u0" is not valid under any of the given schemas'
    FROM checked WHERE user_id % 7 <> 0 AND user_id % 4 = 0
    UNION ALL
    SELECT event_id, 'paths.0.0', 'maximum', concat(a, ' is greater than the maximum of 8') FROM checked WHERE a > 8
    UNION ALL
    SELECT event_id, 'paths.0.1', 'maximum', concat(b, ' is greater than the maximum of 8') FROM checked WHERE b > 8
    UNION ALL
    SELECT event_id, 'paths.1', 'minItems', concat('[', c, '] has too few items') FROM checked
    UNION ALL
    SELECT event_id, 'props.k', 'anyOf', concat(k, ' is not valid under any of the given schemas')
    FROM checked WHERE k > 49 AND k <> 77
""")
def schema_violation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of another kind against their own schema."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    actions = events.select("event_id", F.expr(_ACTION).alias("action"))
    return schema_violations(actions, ACTION_SCHEMA, payload="action", keep=("event_id",))


# ------------------------------------------------------------------- candidates


@query(f"""
    WITH {LATEST_SQL}
    SELECT {", ".join(_EVENT_COLUMNS)}, occurred_epoch FROM latest
""")
def latest_per_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = latest_per_key(valid(spark, sf_dir), ["event_id"], derived_order())
    return latest.select(*_EVENT_COLUMNS, epoch("occurred_at", "occurred_epoch"))


@query(f"WITH {SUMMARY_SQL} SELECT * FROM summary")
def material_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(summary(spark, sf_dir))


@query(f"""
    WITH {SUMMARY_SQL}
    SELECT program_id,
        min(average_tensile_strength_mpa) AS minimum_average_tensile_strength_mpa,
        max(average_tensile_strength_mpa) AS maximum_average_tensile_strength_mpa,
        min(average_conductivity_s_per_m) AS minimum_average_conductivity_s_per_m,
        max(average_conductivity_s_per_m) AS maximum_average_conductivity_s_per_m,
        min(average_density_g_per_cm3) AS minimum_average_density_g_per_cm3,
        max(average_density_g_per_cm3) AS maximum_average_density_g_per_cm3,
        CAST(count(*) AS BIGINT) AS group_rows
    FROM summary GROUP BY program_id
""")
def program_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounds(summary(spark, sf_dir), gold.PROGRAM, gold.criteria())


@query(f"""
    WITH {RANKED_SQL}
    SELECT program_id, material_id, material_family, strength_score, conductivity_score,
        density_score, candidate_score
    FROM ranked
""")
def normalised_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = gold.scored_candidates(materialise(summary(spark, sf_dir)), gold.criteria())
    return scored.select(
        *gold.GROUPS, "strength_score", "conductivity_score", "density_score", "candidate_score"
    )


@query(f"WITH {RANKED_SQL} SELECT {_RANKED_COLUMNS} FROM ranked")
def ranked_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole way from line items to ranked candidates."""
    return with_epoch(ranked(spark, sf_dir))


@query(f"WITH {RANKED_SQL} SELECT {_RANKED_COLUMNS} FROM ranked")
def ranked_candidates_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with small slices, so that most programs are cut into several."""
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):
        return with_epoch(ranked(spark, sf_dir))


@query(f"WITH {RANKED_SQL} SELECT {_RANKED_COLUMNS} FROM ranked")
def ranked_candidates_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with each program in one window, for programs known to be small."""
    scored = gold.scored_candidates(materialise(summary(spark, sf_dir)), gold.criteria())
    rows = rank_within(scored, gold.PROGRAM, gold.candidate_order(), "candidate_rank")
    return with_epoch(rows.select(*CANDIDATE_COLUMNS))


@query(f"WITH {_ranked_sql(WEIGHTS, BY_READING)} SELECT {_RANKED_COLUMNS} FROM ranked")
def ranked_candidates_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing chosen: the default event order and averages without a given scale.

    Each copy of an event has a reading time of its own, in the order of its part and supplier: the
    default order's next column, the hash of JSON text, is one that another engine cannot know.
    """
    raw = derived_raw(spark, sf_dir)
    read_at = F.timestamp_micros(F.col("l_partkey") * 10_000_000 + F.col("l_suppkey"))
    rows = validated_events(raw.withColumn("ingested_at", read_at))
    return with_epoch(gold.material_candidates(valid_events(rows)))


@query(f"WITH {_ranked_sql(OTHER_WEIGHTS)} SELECT {_RANKED_COLUMNS} FROM ranked")
def ranked_candidates_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Other weights, one of them negative."""
    return with_epoch(ranked(spark, sf_dir, OTHER_WEIGHTS))


@query(f"WITH {RANKED_SQL} SELECT {_RANKED_COLUMNS} FROM ranked WHERE candidate_rank <= {TOP}")
def top_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_epoch(gold.top_candidates(ranked(spark, sf_dir), TOP))


# ----------------------------------------------------------------------- streams


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT {", ".join(_EVENT_COLUMNS)}, occurred_epoch, mass_total FROM valid
""")
def stream_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid layer after files went through the raw and the validated stream."""
    made = streamed(spark, sf_dir)
    return read_table(spark, made.table(stream.VALID)).select(
        *_EVENT_COLUMNS,
        epoch("occurred_at", "occurred_epoch"),
        F.col("composition_mass_percent_total").alias("mass_total"),
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT event_id, experiment_id, codes FROM validated WHERE codes <> ''
""")
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = streamed(spark, sf_dir)
    return read_table(spark, made.table(stream.QUARANTINED)).select(
        "event_id", "experiment_id", F.array_join("validation_errors", ",").alias("codes")
    )


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT program_id, CAST(count(*) AS BIGINT) AS row_count FROM valid GROUP BY program_id
""")
def stream_from_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid layer streamed on into a table of its own."""
    made = streamed(spark, sf_dir)
    folder = shared_folder(spark, "from-valid")
    rows = stream_table(spark, made.table(stream.VALID)).select("program_id")
    sink = rows.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
    sink.trigger(availableNow=True).start(f"{folder}/rows").awaitTermination()
    copied = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    return copied.groupBy("program_id").agg(F.count(F.lit(1)).alias("row_count"))


@query(f"WITH {RANKED_SQL} SELECT {_RANKED_COLUMNS} FROM ranked")
def stream_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidate table as refreshed from the streamed valid layer."""
    made = streamed(spark, sf_dir)
    return with_epoch(read_table(spark, made.table(stream.CANDIDATES)))


# Derived events lie up to some seven years apart and arrive in any order.
_YEARS = 20
# Files that arrive one after the other; the streams stop and take up again after each.
ARRIVALS = 3

_increments: dict[tuple[str, str], tuple[tuple, stream.Layers]] = {}


def increments(spark: SparkSession, sf_dir: str) -> stream.Layers:
    """The layers after several arrivals with the streams run after each, once per session and content."""
    key, content = (spark.sparkContext.applicationId, sf_dir), _content(spark, sf_dir)
    if key in _increments and _increments[key][0] != content:
        spark.sql(f"DROP DATABASE {_increments.pop(key)[1].database} CASCADE")
    if key not in _increments:
        root = shared_folder(spark, "increments")
        made = stream.Layers(f"increments_{root[-32:]}", root)
        stream.create_database(spark, made)
        lines = materialise(derived_payloads(spark, sf_dir).select("value"))
        columns = dict.fromkeys(("event_id", *gold.SUMMARISED, *(c for c, _ in DERIVED_ORDER)))
        for arrival in range(ARRIVALS):
            part = lines.where(F.pmod(F.xxhash64("value"), F.lit(ARRIVALS)) == arrival)
            part.write.mode("append").text(f"{root}/arrived")
            stream.append(stream.stream_raw(spark, f"{root}/arrived"), made, stream.RAW)
            stream.validate(spark, made)
            stream.publish_tables(spark, made)
            incremental.settle(
                spark, made, list(columns), DERIVED_ORDER, f"{_YEARS * 366} days", _YEARS * 366 * 24
            )
            incremental.merge_changes(spark, made, scoring={"scale": 2})
        _increments[key] = content, made
    return _increments[key][1]


@query(f"""
    WITH {LATEST_SQL}
    SELECT {", ".join(_EVENT_COLUMNS)}, occurred_epoch FROM latest
""")
def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest copy of every event as its stream of changes adds up, over several arrivals and restarts."""
    made = increments(spark, sf_dir)
    rows = standing(read_table(spark, made.table(incremental.CHANGES)))
    return rows.select(*_EVENT_COLUMNS, epoch("occurred_at", "occurred_epoch"))


@query(f"WITH {RANKED_SQL} SELECT {_RANKED_COLUMNS} FROM ranked")
def incremental_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates after several arrivals, each added to what was stored of the ones before."""
    made = increments(spark, sf_dir)
    return with_epoch(read_table(spark, made.table(incremental.LIVE)))


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT event_id, experiment_id, occurred_epoch, codes FROM validated
""")
def stream_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table both verdicts are read from."""
    made = streamed(spark, sf_dir)
    return read_table(spark, made.table(stream.VALIDATED)).select(
        "event_id",
        "experiment_id",
        epoch("occurred_at", "occurred_epoch"),
        F.array_join("validation_errors", ",").alias("codes"),
    )


# ------------------------------------------------------------- files that grow


def append_lines(lines: DataFrame, folder: str) -> None:
    """Append the ``value``s of each ``file`` below a folder, in the order of ``at``, by tasks."""
    import pyarrow.fs as pafs

    def write(rows):
        system, path = pafs.LocalFileSystem(), folder.removeprefix("file:").replace("///", "/")
        system.create_dir(path)
        with system.open_append_stream(f"{path}/{rows['file'].iloc[0]}") as file:
            file.write("".join(f"{value}\n" for value in rows.sort_values("at")["value"]).encode())
        return rows[["file"]].head(1)

    lines.groupBy("file").applyInPandas(write, "file string").write.format("noop").mode("overwrite").save()


def file_name(path: str):
    return F.element_at(F.split(path, "/"), -1).alias("file")


# Files of some 12,500 lines; the third that comes last is appended to what was read before.
_EVENT_FILE = "concat('part-', CAST(floor(event_id / 50000) AS bigint), '-', event_id % 4)"
_EVENT_LINE = "CASE WHEN event_id % 7 = 0 THEN '  ' ELSE concat(event_id, ' ', props) END"


@query(f"""
    WITH lines AS (
        SELECT {_EVENT_FILE} AS file, {_EVENT_LINE} AS raw_payload,
            row_number() OVER (PARTITION BY {_EVENT_FILE} ORDER BY event_id % 3, event_id) AS line_number
        FROM events
    )
    SELECT file, line_number, raw_payload, sha256(raw_payload) AS payload_sha256
    FROM lines WHERE length(trim(raw_payload)) > 0
""")
def ingested_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of files that grow between three runs, each read once and with its number in the file."""
    folder = shared_folder(spark, "growing")
    book = ledger.Ledger(shared_folder(spark, "ledger"))
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    lines = events.selectExpr(
        f"{_EVENT_FILE} AS file", f"{_EVENT_LINE} AS value", "event_id AS at", "event_id % 3 AS arrival"
    )
    for arrival in range(3):
        append_lines(lines.where(F.col("arrival") == arrival), folder)
        ledger.ingest(spark, book, folder, range_bytes=1 << 18)
    rows = ledger.ingested(spark, book)
    return rows.select(file_name("source_file"), "line_number", "raw_payload", "payload_sha256")


_LINE_FILE = "concat('lines-', CAST(floor(l_orderkey / 10000) AS bigint), '-', l_orderkey % 2)"


@query(f"""
    WITH {_found_sql(SOURCE_KEYS)},
    places AS (
        SELECT {", ".join(SOURCE_KEYS)}, {_LINE_FILE} AS file,
            row_number() OVER (PARTITION BY {_LINE_FILE} ORDER BY {", ".join(SOURCE_KEYS)}) AS line_number
        FROM keyed
    )
    SELECT file, line_number, concat('Line ', line_number, ', field ', field_path, ': ', message) AS line
    FROM found JOIN places USING ({", ".join(SOURCE_KEYS)})
""")
def contract_line_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract report with line numbers, for files cut into many ranges; blank lines count."""
    folder = shared_folder(spark, "numbered")
    lines = derived_payloads(spark, sf_dir, _LINE_FILE).selectExpr(
        "file", "value",
        f"concat_ws('/', {', '.join(f"lpad(CAST({k} AS string), 30, '0')" for k in SOURCE_KEYS)}) AS at",
    )
    append_lines(lines, folder)
    raw = read_raw_numbered(spark, folder, 1 << 20)
    found = contract_violations(raw, keep=("source_file", "line_number"))
    return numbered_report(found).select(file_name("source_file"), "line_number", "line")


# ------------------------------------------------------------------ time lines

# A user that a third of all events belong to, beside the others.
_USER = "CASE WHEN event_id % 3 = 0 THEN -1 ELSE user_id END"
_GAP_SECONDS = 1200


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.selectExpr("event_id", f"{_USER} AS user", "CAST(ts AS timestamp) AS ts", "event_type", "value")


@query(f"""
    WITH events_of AS (SELECT event_id, {_USER} AS user, ts, event_type, value FROM events)
    SELECT p.event_id, p.user, c.event_id AS click_id, c.value AS click_value
    FROM (SELECT * FROM events_of WHERE event_type = 'purchase') p
    ASOF LEFT JOIN (SELECT * FROM events_of WHERE event_type = 'click') c ON p.user = c.user AND p.ts >= c.ts
""")
def asof_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase with its user's last click before it."""
    events = user_events(spark, sf_dir)
    clicks = events.where("event_type = 'click'").selectExpr(
        "user", "ts AS clicked_at", "event_id AS click_id", "value AS click_value"
    )
    joined = asof_join(
        events.where("event_type = 'purchase'"), clicks, ["user"], "ts", "clicked_at",
        ["click_id", "click_value"], tie=["click_id"],
    )
    return joined.select("event_id", "user", "click_id", "click_value")


_SESSIONS_SQL = f"""
    WITH marked AS (
        SELECT {_USER} AS user, ts,
            CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY {_USER} ORDER BY ts)) <= {_GAP_SECONDS * 10**6}
                THEN 0 ELSE 1 END AS new
        FROM events
    ),
    numbered AS (SELECT *, sum(new) OVER (PARTITION BY user ORDER BY ts) AS session FROM marked)
    SELECT user, epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, CAST(count(*) AS BIGINT) AS n_events
    FROM numbered GROUP BY user, session
"""


def _session_rows(found: DataFrame) -> DataFrame:
    return found.select(
        "user", F.unix_micros("session_start").alias("started"), F.unix_micros("session_end").alias("ended"), "n_events"
    )


@query(_SESSIONS_SQL)
def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of every user, whose events may lie in any number of slices."""
    return _session_rows(sessions(user_events(spark, sf_dir), ["user"], "ts", _GAP_SECONDS))


@query(_SESSIONS_SQL)
def user_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a stream over files of events, those still open at the end included."""
    folder = shared_folder(spark, "sessions")
    user_events(spark, sf_dir).repartition(4, "event_id").write.parquet(f"{folder}/in")
    events = spark.readStream.schema("event_id long, user long, ts timestamp").option("maxFilesPerTrigger", 2)
    made = stream_sessions(events.parquet(f"{folder}/in"), ["user"], "ts", _GAP_SECONDS, "3650 days")
    # Complete mode gives all sessions after each batch; each takes the place of the one before.
    out = made.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/checkpoint")
    out = out.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{folder}/out"))
    out.trigger(availableNow=True).start().awaitTermination()
    return _session_rows(spark.read.schema(made.schema).parquet(f"{folder}/out"))


@query("""
    WITH shipped AS (SELECT l_orderkey, max(l_shipdate) AS last FROM lineitem GROUP BY l_orderkey),
    spans AS (
        SELECT o_custkey, o_orderkey, o_totalprice,
            least(CAST(o_orderdate AS DATE), CAST(last AS DATE)) AS a,
            greatest(CAST(o_orderdate AS DATE), CAST(last AS DATE)) AS b
        FROM orders JOIN shipped ON o_orderkey = l_orderkey
    )
    SELECT x.o_orderkey, CAST(count(*) AS BIGINT) AS overlapping_orders,
        CAST(sum(CAST(y.o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS overlapping_price
    FROM spans x JOIN spans y ON x.o_custkey = y.o_custkey AND x.a <= y.b AND y.a <= x.b AND x.o_orderkey <> y.o_orderkey
    GROUP BY x.o_orderkey
""")
def overlapping_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every order, the customer's other orders that are open at the same time."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    shipped = lines.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last"))
    day = lambda c: F.unix_date(F.to_date(c))
    spans = materialise(
        orders.join(shipped, orders["o_orderkey"] == shipped["l_orderkey"]).select(
            "o_custkey", "o_orderkey", "o_totalprice",
            F.least(day("o_orderdate"), day("last")).alias("a"), F.greatest(day("o_orderdate"), day("last")).alias("b"),
        )
    )
    others = spans.select("o_custkey", F.col("o_orderkey").alias("other"), F.col("o_totalprice").alias("price"),
                          F.col("a").alias("c"), F.col("b").alias("d"))
    pairs = overlapping(spans, others, ["o_custkey"], ("a", "b"), ("c", "d")).where("o_orderkey <> other")
    price = F.sum(F.col("price").cast("decimal(18,2)")).cast("double")
    return pairs.groupBy("o_orderkey").agg(F.count("*").alias("overlapping_orders"), price.alias("overlapping_price"))


# ------------------------------------------------------------------ exact sums


@query("""
    SELECT l_suppkey, CAST(2 * count(*) + count(*) AS BIGINT) AS v_n,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 1024 AS v_sum,
        CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 1024 / (3 * count(*)) AS v_mean
    FROM lineitem GROUP BY l_suppkey
""")
def exact_sums_that_cancel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums in which values of all sizes cancel but for small ones, which plain addition would lose."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    big = F.col("l_quantity") * F.pow(F.lit(2.0), 40 * (F.col("l_linenumber") % 20) + 30)
    small = F.round(F.col("l_extendedprice") * 100) / 1024
    rows = lines.select("l_suppkey", F.explode(F.array(big, -big, small)).alias("v"))
    return exact_sums(rows, ["l_suppkey"], ["v"])


# ---------------------------------------------------------------- reconciliation


def layer_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    made = streamed(spark, sf_dir)
    names = {
        "bronze": stream.RAW,
        "silver": stream.VALID,
        "quarantine": stream.QUARANTINED,
        "gold": stream.CANDIDATES,
    }
    return {layer: read_table(spark, made.table(name)) for layer, name in names.items()}


COUNTS_SQL = f"""
    {SUMMARY_SQL},
    counts AS (
        SELECT 'bronze' AS layer, CAST(count(*) AS BIGINT) AS row_count FROM raw
        UNION ALL SELECT 'silver', CAST(count(*) AS BIGINT) FROM valid
        UNION ALL SELECT 'quarantine', CAST(count(*) AS BIGINT) FROM validated WHERE codes <> ''
        UNION ALL SELECT 'gold', CAST(count(*) AS BIGINT) FROM summary
    )
"""


@query(f"WITH {COUNTS_SQL} SELECT * FROM counts")
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.layer_counts(layer_tables(spark, sf_dir))


@query(f"""
    WITH {COUNTS_SQL}
    SELECT whole_rows, part_rows, whole_rows = part_rows AS conserved FROM (
        SELECT CAST(sum(row_count) FILTER (layer = 'bronze') AS BIGINT) AS whole_rows,
            CAST(sum(row_count) FILTER (layer IN ('silver', 'quarantine')) AS BIGINT) AS part_rows
        FROM counts
    )
""")
def layers_conserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of both verdicts are as many as the raw rows."""
    counts = reconcile.layer_counts(layer_tables(spark, sf_dir))
    return reconcile.conserved(counts, "bronze", ["silver", "quarantine"])


@query(f"""
    WITH {VALIDATED_SQL}
    SELECT CAST(count(*) AS BIGINT) AS raw_rows, 0::BIGINT AS lost, 0::BIGINT AS doubled FROM raw
""")
def layers_same_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No raw row is lost or doubled on its way to a verdict, payload by payload."""
    made = layer_tables(spark, sf_dir)
    # As bytes: the shuffle by fingerprint moves half of what hex digits take.
    of = lambda name: made[name].select(F.unhex("payload_sha256").alias("fingerprint"))
    judged = of("silver").unionByName(of("quarantine"))
    wrong = reconcile.diff(of("bronze"), judged).groupBy().agg(
        *(
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("copies"))), F.lit(0)).alias(name)
            for side, name in (("missing", "lost"), ("unexpected", "doubled"))
        )
    )
    raw = of("bronze").groupBy().agg(F.count(F.lit(1)).alias("raw_rows"))
    return raw.select("raw_rows", *(wrong.select(c).scalar().alias(c) for c in wrong.columns))


@query(f"""
    WITH {COUNTS_SQL}
    SELECT layer, expected_rows, actual_rows
    FROM (SELECT layer, row_count + CASE layer WHEN 'gold' THEN 1 ELSE 0 END AS expected_rows
          FROM counts WHERE layer <> 'silver')
    FULL JOIN (SELECT layer, row_count AS actual_rows FROM counts) USING (layer)
    WHERE expected_rows IS DISTINCT FROM actual_rows
""")
def count_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts against an expectation that has one wrong and one missing layer."""
    actual = reconcile.layer_counts(layer_tables(spark, sf_dir))
    wrong = F.col("row_count") + F.when(F.col("layer") == "gold", 1).otherwise(0)
    expected = actual.filter("layer <> 'silver'").withColumn("row_count", wrong)
    return reconcile.count_diff(expected, actual)


_ALTERED = "CASE WHEN candidate_rank = 1 THEN candidate_score + 1 ELSE candidate_score END"


@query(f"""
    WITH {RANKED_SQL},
    expected AS (
        SELECT program_id, material_id, candidate_rank, {_ALTERED} AS candidate_score FROM ranked
    ),
    actual AS (SELECT program_id, material_id, candidate_rank, candidate_score FROM ranked)
    SELECT *, CAST(count(*) AS BIGINT) AS copies FROM (
        SELECT *, 'missing' AS side
        FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual)
        UNION ALL
        SELECT *, 'unexpected' AS side
        FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM expected)
    ) GROUP BY ALL
""")
def ranking_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranking against a copy in which every winner's score is off."""
    actual = reconcile.ranking_extract(ranked(spark, sf_dir))
    expected = actual.withColumn("candidate_score", F.expr(_ALTERED))
    return reconcile.diff(expected, actual)


@query(f"""
    WITH {VALIDATED_SQL},
    expected AS (
        SELECT program_id, material_id, lab_id FROM valid
        UNION ALL SELECT program_id, material_id, lab_id FROM valid WHERE l_linenumber = 1
    ),
    actual AS (SELECT program_id, material_id, lab_id FROM valid)
    SELECT *, 'missing' AS side, CAST(count(*) AS BIGINT) AS copies
    FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual) GROUP BY ALL
""")
def event_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with copies against an expectation that has some of them once more."""
    # Each event is expected once, and once more if first of its order; and it is there once.
    expected = 1 + F.when(F.col("l_linenumber") == 1, 1).otherwise(0)
    balance = (expected - 1).alias("balance")
    rows = valid(spark, sf_dir).select("program_id", "material_id", "lab_id", balance)
    return reconcile.unbalanced(rows, "balance")


@query(f"""
    WITH {RANKED_SQL}
    SELECT program_id, material_id, candidate_rank, candidate_score FROM ranked
    ORDER BY program_id, candidate_rank
""")
def ranking_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.ranking_extract(ranked(spark, sf_dir))


@query(f"""
    WITH {VALIDATED_SQL},
    expected AS (
        SELECT program_id, material_id, lab_id FROM valid
        UNION ALL SELECT program_id, material_id, lab_id FROM valid WHERE l_linenumber = 1
    ),
    actual AS (SELECT program_id, material_id, lab_id FROM valid)
    SELECT *, 'missing' AS side, CAST(count(*) AS BIGINT) AS copies
    FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual) GROUP BY ALL
""")
def event_diff_by_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from two whole tables, of which only buckets that differ are compared row by row."""
    rows = materialise(valid(spark, sf_dir).select("l_linenumber", "program_id", "material_id", "lab_id"))
    actual = rows.drop("l_linenumber")
    expected = actual.unionByName(rows.where("l_linenumber = 1").drop("l_linenumber"))
    return reconcile.digest_diff(expected, actual)
