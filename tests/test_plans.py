"""What the physical plans have to look like to hold at a thousand times the data."""

import pytest

from assaymill import queries
from assaymill.operators.scoring import bounds
from pyspark.sql import functions as F

from assaymill.operators.ranking import rank_sliced, sliced
from assaymill.plans.candidates import (
    PROGRAM,
    candidate_order,
    criteria,
    event_order,
    material_summary,
    scored_candidates,
)
from assaymill.session import setting
from assaymill.plans.experiments import valid_events, validated_events
from assaymill.operators.dedup import latest_per_key
from sample_events import EVENTS

SF = "/root/testdata/sf0.001"


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, raw, tmp_path):
    path = str(tmp_path / "validated")
    validated_events(raw(*EVENTS)).write.parquet(path)
    return valid_events(spark.read.parquet(path))


def test_copies_are_dropped_before_the_shuffle(stored):
    plan = physical(latest_per_key(stored, ["event_id"], event_order(stored.columns)))
    final, exchange, partial = (
        plan.index(part) for part in ("Final", "Exchange hashpartitioning(event_id", "Partial")
    )
    assert final < exchange < partial


def test_summary_reads_its_columns_only_and_hashes(stored):
    plan = physical(material_summary(stored, scale=2))
    (read,) = [line for line in plan.splitlines() if "ReadSchema" in line]
    for unused in ("raw_payload", "composition", "validation_errors", "temperature_c", "lab_id"):
        assert unused not in read.split("ReadSchema")[1]
    assert "SortAggregate" not in plan and "Expand" not in plan
    # By event, by group and experiment, by group.
    assert plan.count("Exchange") == 3


def test_bounds_combine_before_the_shuffle(stored):
    plan = physical(bounds(material_summary(stored), PROGRAM, criteria()))
    top = plan[: plan.index("hashpartitioning(program_id#")]
    assert "Window" not in plan[: plan.index("partial_min")]
    assert "HashAggregate" in top


def test_validation_does_not_shuffle(raw):
    assert "Exchange" not in physical(validated_events(raw(*EVENTS)))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_no_query_crosses_or_runs_python(spark, name):
    plan = physical(queries.QUERIES[name](spark, SF))
    for part in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert part not in plan


def test_slices_are_not_shuffled_twice(spark, stored):
    """One exchange of the candidates cut in slices, for the window and the join alike."""
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        summary = material_summary(stored)
        rows = scored_candidates(summary, criteria()).withColumn("payload", F.lit("x").cast("string"))
        cut = sliced(rows, PROGRAM, candidate_order()).checkpoint()
        plan = physical(rank_sliced(cut, PROGRAM, candidate_order(), "n"))
    by_slice = [line for line in plan.splitlines() if "Exchange hashpartitioning(_key" in line]
    # The candidates by program and slice; the counts by program and slice, then by program.
    assert len(by_slice) <= 4
    joined = plan[plan.index("SortMergeJoin") :]
    assert joined.index("Window") < joined.index("Exchange")
    assert "eqNullSafe" not in plan and "coalesce(program_id" not in plan
