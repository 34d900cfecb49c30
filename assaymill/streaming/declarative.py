"""The same layers for Spark's declarative pipelines.

A pipeline file needs two lines::

    from assaymill.streaming.declarative import declare
    declare(spark)

The pipeline runner orders the tables by what they read and keeps their
checkpoints. It speaks to Spark through a Connect server; ``layers`` does the same work in
a plain session.
"""

from __future__ import annotations

from pyspark import pipelines as dp
from pyspark.sql import SparkSession

from assaymill.operators.ranking import rank_sliced, sliced
from assaymill.plans.candidates import (
    PROGRAM,
    candidate_order,
    criteria,
    material_summary,
    scored_candidates,
)
from assaymill.plans.experiments import validated_events
from assaymill.schemas import CANDIDATE_COLUMNS
from assaymill.sources.files import batch_size, stream_raw
from assaymill.sources.tables import read_table, stream_table
from assaymill.streaming.layers import (
    CANDIDATES,
    COMMENTS,
    QUARANTINED,
    RAW,
    VALID,
    VALIDATED,
    VERDICT,
    of_verdict,
    with_verdict,
)

# Fixed value: the setting that names the folder where event files arrive.
SOURCE_PATH = "materials.source_path"

# Settings of a pipeline that may be left out: the file source's batch size, the weights of
# strength, conductivity and density with commas between, and the decimals of the measures.
BATCH_BYTES = "materials.max_bytes_per_trigger"
WEIGHTS = "materials.weights"
SCALE = "materials.scale"

SUMMARY = "material_summary"
SLICES = "candidate_slices"


def declare(spark: SparkSession, source: str | None = None) -> None:
    """Declare all layers; folder, batch size and scoring come from the pipeline's settings."""
    folder = source or spark.conf.get(SOURCE_PATH)
    batch_bytes, weights, scale = (spark.conf.get(k, None) for k in (BATCH_BYTES, WEIGHTS, SCALE))
    batches = {"maxBytesPerTrigger": batch_bytes} if batch_bytes else {}
    weighed = criteria(*map(float, weights.split(","))) if weights else criteria()
    decimals = int(scale) if scale else None

    def layer(name: str, **options):
        return {"name": name, "comment": COMMENTS.get(name), **options}

    @dp.table(**layer(RAW))
    def raw():
        return stream_raw(spark, folder, **batches)

    @dp.table(**layer(VALIDATED, partition_cols=[VERDICT]))
    def validated():
        return with_verdict(validated_events(stream_table(spark, RAW, **batch_size(batches))))

    @dp.table(**layer(VALID))
    def valid():
        return of_verdict(stream_table(spark, VALIDATED, **batch_size(batches)), VALID)

    @dp.table(**layer(QUARANTINED))
    def quarantined():
        return of_verdict(stream_table(spark, VALIDATED, **batch_size(batches)), QUARANTINED)

    # Query functions may not run jobs, so what the batch plan checkpoints is a
    # table of its own here: the summary, which scoring reads twice, and the
    # slices, whose cut points all readers have to share.
    @dp.materialized_view(name=SUMMARY, comment="Distinct events per material, averaged.")
    def summary():
        return material_summary(read_table(spark, VALID), scale=decimals)

    @dp.materialized_view(name=SLICES, comment="Scored materials, range-partitioned by rank.")
    def slices():
        scored = scored_candidates(read_table(spark, SUMMARY), weighed)
        return sliced(scored, PROGRAM, candidate_order())

    @dp.materialized_view(**layer(CANDIDATES))
    def candidates():
        ranked = rank_sliced(
            read_table(spark, SLICES), PROGRAM, candidate_order(), "candidate_rank"
        )
        return ranked.select(*CANDIDATE_COLUMNS)
