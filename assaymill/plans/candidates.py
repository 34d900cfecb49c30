"""From valid experiment events to ranked material candidates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.operators.dedup import latest_per_key
from assaymill.operators.ranking import rank_within_slices
from assaymill.operators.scoring import Criterion, bounds, check_weights, score
from assaymill.operators.summary import Measure, summarise
from assaymill.schemas import CANDIDATE_COLUMNS
from assaymill.session import materialise

PROGRAM = "program_id"
GROUPS = (PROGRAM, "material_id", "material_family")

STRENGTH = "average_tensile_strength_mpa"
CONDUCTIVITY = "average_conductivity_s_per_m"
DENSITY = "average_density_g_per_cm3"

SUMMARISED = (
    *GROUPS,
    "experiment_id",
    "tensile_strength_mpa",
    "conductivity_s_per_m",
    "density_g_per_cm3",
)

# What the criteria count for unless told otherwise.
STRENGTH_WEIGHT, CONDUCTIVITY_WEIGHT, DENSITY_WEIGHT = 0.45, 0.35, 0.20


def event_order(columns: Sequence[str]) -> list[Column]:
    """Which copy of an event is kept: the latest, then the last one read.

    The payload's fingerprint decides between copies read together; without it, the
    values that the summary uses do.
    """
    newest = [F.desc(c) for c in ("occurred_at", "ingested_at") if c in columns]
    rest = ["payload_sha256"] if "payload_sha256" in columns else SUMMARISED
    return [*newest, *(F.asc(c) for c in rest)]


def candidate_order() -> list[Column]:
    """Best candidate first. Total: material and family are unique in a program."""
    return [
        F.desc("candidate_score"),
        F.desc(STRENGTH),
        F.desc(CONDUCTIVITY),
        F.asc(DENSITY),
        F.asc("material_id"),
        F.asc("material_family"),
    ]


def criteria(
    strength: float = STRENGTH_WEIGHT,
    conductivity: float = CONDUCTIVITY_WEIGHT,
    density: float = DENSITY_WEIGHT,
) -> tuple[Criterion, ...]:
    chosen = (
        Criterion(STRENGTH, "strength_score", strength),
        Criterion(CONDUCTIVITY, "conductivity_score", conductivity),
        Criterion(DENSITY, "density_score", density, higher_is_better=False),
    )
    check_weights(chosen)
    return chosen


def measures(scale: int | None = None) -> list[Measure]:
    return [
        Measure("tensile_strength_mpa", STRENGTH, scale),
        Measure("conductivity_s_per_m", CONDUCTIVITY, scale),
        Measure("density_g_per_cm3", DENSITY, scale),
    ]


def material_summary(
    events: DataFrame, order: Sequence[Column] | None = None, scale: int | None = None
) -> DataFrame:
    """Distinct events per material, averaged. One row per program, material and family."""
    return summarise(
        latest_per_key(events, ["event_id"], order or event_order(events.columns)),
        GROUPS,
        measures(scale),
        distinct="experiment_id",
        count_name="experiment_count",
        latest="occurred_at",
        latest_name="latest_experiment_at",
    )


def rank_candidates(summary: DataFrame, weighed: Sequence[Criterion]) -> DataFrame:
    """Score and rank a summary that has been written or checkpointed.

    Reads it for the bounds and for the rows. Programs are ranked in slices, whatever their size.
    """
    scored = scored_candidates(summary, weighed)
    ranked = rank_within_slices(scored, PROGRAM, candidate_order(), "candidate_rank")
    return ranked.select(*CANDIDATE_COLUMNS)


def scored_candidates(summary: DataFrame, weighed: Sequence[Criterion]) -> DataFrame:
    """The summary with its scores, not yet ranked."""
    limits = bounds(summary, PROGRAM, weighed)
    return score(summary, limits, PROGRAM, weighed, "candidate_score")


def material_candidates(
    events: DataFrame,
    strength_weight: float = STRENGTH_WEIGHT,
    conductivity_weight: float = CONDUCTIVITY_WEIGHT,
    density_weight: float = DENSITY_WEIGHT,
    order: Sequence[Column] | None = None,
    scale: int | None = None,
) -> DataFrame:
    """Ranked candidates per program from valid events.

    The summary, one row per material, is checkpointed: the pass over the
    events then runs once, and what follows works on its small result. So most of the
    work is done when this returns, before the caller reads a row.
    """
    weighed = criteria(strength_weight, conductivity_weight, density_weight)
    return rank_candidates(materialise(material_summary(events, order, scale)), weighed)


def top_candidates(candidates: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of every program."""
    return candidates.filter(F.col("candidate_rank") <= k)
