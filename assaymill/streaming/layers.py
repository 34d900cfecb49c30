"""The layers as tables, filled by streams that process what is there and stop.

    files -> raw -> validated -> valid and quarantined -> candidates

``validated`` is written once, partitioned by ``verdict``, by an ordinary
exactly-once stream. The valid and the quarantined layer are tables of their own, which can be
streamed on. Where nobody streams from them, ``split="views"`` makes them views that read
one partition each, so that an event is stored once.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import is_remote

from assaymill.plans.candidates import material_candidates
from assaymill.plans.experiments import validated_events
from assaymill.schemas import VALIDATED_COLUMNS
from assaymill.session import setting
from assaymill.sources.files import batch_size, stream_raw
from assaymill.sources.tables import read_table, stream_table

# --- fixed values: table names ---
RAW = "bronze_experiment_events"
VALIDATED = "validated_experiment_events"
VALID = "silver_experiment_events"
QUARANTINED = "quarantined_experiment_events"
CANDIDATES = "gold_material_candidates"
# --- end of fixed values ---

VERDICT = "verdict"

COMMENTS = {
    RAW: "Experiment event lines as received, with origin and fingerprint.",
    VALIDATED: "Parsed experiment events with the verdict on each.",
    VALID: "Experiment events that pass all rules.",
    QUARANTINED: "Experiment events that break a rule, with their original line.",
    CANDIDATES: "Scored and ranked materials of every program.",
}


# A task writes at most two partitions, one per verdict. With that many writers open
# Spark does not sort whole rows by verdict first.
CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
OPEN_WRITERS = 2

# Each layer holds the lines once more, so they are stored as small as parquet's codecs make them.
PARQUET_CODEC = "spark.sql.parquet.compression.codec"
CODEC = "zstd"


@dataclass(frozen=True)
class Layers:
    """Where the tables live: a database, and a folder every executor can reach.

    ``table_format`` is any format that streams can append to.
    """

    database: str
    root: str
    table_format: str = "parquet"

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"

    def location(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


def run_available(
    spark: SparkSession,
    source: str,
    layers: Layers,
    split: str = "tables",
    scoring: Mapping | None = None,
    **options,
) -> None:
    """Bring every layer up to date with the files in ``source``, then stop.

    A second run takes up where the last one ended, also after a failure.
    ``options`` go to the file source, see ``stream_raw``; the size of a batch among them
    holds for the later streams too. ``scoring`` goes to ``material_candidates``.
    """
    batches = batch_size(options)
    create_database(spark, layers)
    append(stream_raw(spark, source, **options), layers, RAW)
    validate(spark, layers, **batches)
    if split == "views":
        publish_views(spark, layers)
        refresh_candidates(spark, layers, **(scoring or {}))
    else:
        publish_table(spark, layers, VALID, **batches)
        # Before the quarantined layer is stored: the candidates' shuffles are the most that lies beside the layers.
        refresh_candidates(spark, layers, **(scoring or {}))
        publish_table(spark, layers, QUARANTINED, **batches)


def quoted(text: str) -> str:
    """A SQL string of any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, layers: Layers) -> None:
    spark.sql(
        f"CREATE DATABASE IF NOT EXISTS {layers.database}"
        f" LOCATION {quoted(f'{layers.root}/database')}"
    )


def append(
    rows: DataFrame,
    layers: Layers,
    name: str,
    partition_by: tuple[str, ...] = (),
    comment: str | None = None,
) -> StreamingQuery:
    """Append a stream's available rows to a table, exactly once."""
    spark = rows.sparkSession
    partitioned = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {layers.table(name)} ({rows.schema.toDDL()})"
        f" USING {layers.table_format} {partitioned}"
        f" LOCATION {quoted(layers.location(name))} COMMENT {quoted(comment or COMMENTS[name])}"
    )
    with setting(spark, CONCURRENT_WRITERS, str(OPEN_WRITERS)), setting(spark, PARQUET_CODEC, CODEC):
        query = (
            rows.writeStream.format(layers.table_format)
            .outputMode("append")
            .partitionBy(*partition_by)
            .option("checkpointLocation", layers.checkpoint(name))
            .trigger(availableNow=True)
            .toTable(layers.table(name))
        )
        query.awaitTermination()
    spark.catalog.refreshTable(layers.table(name))
    return query


def validate(spark: SparkSession, layers: Layers, **options) -> StreamingQuery:
    """Parse and check the raw rows that are new."""
    raw = stream_table(spark, layers.table(RAW), **options)
    return append(with_verdict(validated_events(raw)), layers, VALIDATED, (VERDICT,))


def with_verdict(validated: DataFrame) -> DataFrame:
    """Add the partition column: which of the two layers a row belongs to.

    Not ``is_valid`` itself: read back from folder names by a new catalog, a
    boolean partition column would be a string.
    """
    layer = F.when(F.col("is_valid"), VALID).otherwise(QUARANTINED)
    return validated.withColumn(VERDICT, layer)


def of_verdict(validated: DataFrame, name: str) -> DataFrame:
    """The rows of one layer; reads its partition only."""
    return validated.filter(F.col(VERDICT) == name).select(*VALIDATED_COLUMNS)


def publish_views(spark: SparkSession, layers: Layers) -> None:
    """The valid and the quarantined layer, each a view on its partition."""
    columns = ", ".join(VALIDATED_COLUMNS)
    for name in (VALID, QUARANTINED):
        spark.sql(
            f"CREATE OR REPLACE VIEW {layers.table(name)} COMMENT '{COMMENTS[name]}' AS"
            f" SELECT {columns} FROM {layers.table(VALIDATED)} WHERE {VERDICT} = '{name}'"
        )


def publish_tables(spark: SparkSession, layers: Layers, **options) -> None:
    """The valid and the quarantined layer as tables that can be streamed on."""
    for name in (VALID, QUARANTINED):
        publish_table(spark, layers, name, **options)


def publish_table(spark: SparkSession, layers: Layers, name: str, **options) -> StreamingQuery:
    """Bring the layer of one verdict up to date."""
    return append(of_verdict(stream_validated(spark, layers, **options), name), layers, name)


def stream_validated(spark: SparkSession, layers: Layers, **options) -> DataFrame:
    """The validated rows as a stream, verdict included.

    A new catalog that takes up a partitioned folder keeps no columns for it and finds them anew on
    each batch read, which a stream cannot do; then the folder is streamed with the columns named.
    """
    table = layers.table(VALIDATED)
    columns, rows = read_table(spark, table).schema, stream_table(spark, table, **options)
    if set(columns.names) <= set(rows.columns):
        return rows
    files = spark.readStream.format(layers.table_format).schema(columns).options(**options)
    return files.load(layers.location(VALIDATED))


def refresh_candidates(spark: SparkSession, layers: Layers, **scoring) -> None:
    """Recompute the candidates from all valid events.

    The new version is written in full beside the old one and takes its place by one
    catalog change, so a reader or a failed run never leaves half a table. The
    version before stays for those who are reading it; older ones are removed.
    """
    candidates = material_candidates(read_table(spark, layers.table(VALID)), **scoring)
    version = f"{layers.location(CANDIDATES)}/version-{uuid.uuid4().hex}"
    candidates.write.parquet(version)
    table = layers.table(CANDIDATES)
    if spark.catalog.tableExists(table):
        before = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()[1]
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(version)}")
        remove_versions(spark, layers, keep=(version, before))
    else:
        spark.sql(
            f"CREATE TABLE {table} ({candidates.schema.toDDL()}) USING parquet"
            f" LOCATION {quoted(version)} COMMENT '{COMMENTS[CANDIDATES]}'"
        )
    spark.catalog.refreshTable(table)


def remove_versions(spark: SparkSession, layers: Layers, keep: tuple[str, ...]) -> None:
    """Remove the candidates' versions but those to keep.

    Through the file system of the folder, which a plain session can reach; over Connect they stay.
    """
    if is_remote():
        return
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = hadoop(layers.location(CANDIDATES))
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    kept = {hadoop(path).getName() for path in keep}
    for found in store.listStatus(folder):
        if found.getPath().getName().startswith("version-") and found.getPath().getName() not in kept:
            store.delete(found.getPath(), True)
