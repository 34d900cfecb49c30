"""Files that grow: a ledger of what has been read of each, and their new lines by byte ranges.

The file stream sees a file once. Here a table says up to which byte each file was read; it is joined with the
listing, and of a file that has grown only the tail is read. A file that became shorter or changed before
that byte was rewritten, which is reported. The listing, the ledger and the ranges are tables:
the driver holds counts only, however many files there are.

A batch of lines is written aside, then the ledger's entry is put in place, then the lines. A run that ended in
between is finished or begun anew by the next one, so that each line is there once for all readers.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from assaymill.session import materialise
from assaymill.sources.ranges import RANGE_BYTES, _opened, counted_ranges, cut_ranges, list_files, raw_rows, read_lines

#: Bytes before the place reached whose digest tells whether a file was rewritten.
MARK_BYTES = 4096
#: Seconds without a change after which a last line without an end counts as whole.
CLOSED_AFTER = 3600

_ENTRY = "path string, length bigint, modified timestamp, offset bigint, lines bigint, mark string, status string"
_RAW = "raw_payload string, source_file string, ingested_at timestamp, payload_sha256 string, line_number bigint"


@dataclass(frozen=True)
class Ledger:
    """The folder of a ledger and of the raw lines that were read by it."""

    root: str

    @property
    def entries(self) -> str:
        return f"{self.root}/ledger"

    @property
    def rows(self) -> str:
        return f"{self.root}/rows"

    def staged(self, what: str, batch: int) -> str:
        return f"{self.root}/staged/{what}-{batch}"


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _there(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place)


def _move(spark: SparkSession, source: str, target: str) -> None:
    store, place = _store(spark, target)
    store.mkdirs(place.getParent())
    if not store.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place):
        raise OSError(f"Cannot move {source} to {target}.")


def entries(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """All entries, with their ``batch``: what happened to which file."""
    if not _there(spark, ledger.entries):
        return spark.createDataFrame([], f"{_ENTRY}, batch bigint")
    return spark.read.schema(f"{_ENTRY}, batch bigint").parquet(ledger.entries)


def known_files(spark: SparkSession, ledger: Ledger) -> DataFrame:
    """The last entry of every file."""
    last = Window.partitionBy("path").orderBy(F.desc("batch"))
    found = entries(spark, ledger).withColumn("_last", F.row_number().over(last))
    return found.where("_last = 1").drop("_last", "batch")


def ingested(spark: SparkSession, ledger: Ledger, stream: bool = False) -> DataFrame:
    """The raw rows that were read so far, in batch or as a stream of them."""
    _store(spark, ledger.rows)[0].mkdirs(_store(spark, ledger.rows)[1])
    reader = spark.readStream if stream else spark.read
    return reader.schema(f"{_RAW}, batch bigint").parquet(ledger.rows)


def _marking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the bytes before ``offset`` in each file."""
    for batch in batches:
        marks = []
        for path, offset in zip(batch.column("path").to_pylist(), batch.column("offset").to_pylist()):
            system, name = _opened(path)
            with system.open_input_file(name) as file:
                file.seek(max(0, offset - MARK_BYTES))
                marks.append(hashlib.sha256(file.read(min(offset, MARK_BYTES))).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(marks, pa.string())], names=["path", "mark"])


def _marks(files: DataFrame) -> DataFrame:
    places = files.select("path", "offset")
    return places.repartition("path").mapInArrow(_marking, "path string, mark string")


def changed_files(spark: SparkSession, ledger: Ledger, folder: str, reread: bool) -> DataFrame:
    """Files with something to read or report: listing, ``first`` byte, ``lines`` before it, ``status``.

    ``new``, ``grown``, or ``rewritten`` when the bytes before the place reached are not those that were read.
    """
    known = known_files(spark, ledger).select(
        "path", "offset", "lines", F.col("mark").alias("old_mark"),
        F.struct("length", "modified").alias("old"), F.col("status").alias("old_status"),
    )
    listed = list_files(spark, folder)
    same = F.struct("length", "modified") == F.col("old")
    done = same & ((F.col("offset") == F.col("length")) | (F.col("old_status") == "rewritten"))
    open_files = materialise(listed.join(known, "path", "left").where(~F.coalesce(done, F.lit(False))))
    long_enough = open_files.where("offset > 0 AND length >= offset")
    marked = open_files.join(_marks(long_enough), "path", "left")
    rewritten = F.coalesce((F.col("length") < F.col("offset")) | (F.col("mark") != F.col("old_mark")), F.lit(False))
    status = F.when(F.col("offset").isNull(), "new").when(rewritten, "rewritten").otherwise("grown")
    begin = lambda column: F.when(
        (F.col("status") == "rewritten") & F.lit(reread), 0
    ).otherwise(F.coalesce(column, F.lit(0)))
    return materialise(
        marked.withColumn("status", status).select(
            "path", "length", "modified", "status", "old_mark",
            begin("offset").cast("bigint").alias("first"), begin("lines").cast("bigint").alias("lines"),
        )
    )


def ingest(
    spark: SparkSession,
    ledger: Ledger,
    folder: str,
    closed_after: float = CLOSED_AFTER,
    reread: bool = False,
    range_bytes: int = RANGE_BYTES,
) -> dict[str, int]:
    """Read what is new below a folder as one batch; the number of files by status.

    A last line without an end is left for later, as its rest may still come, unless its file has not
    changed for ``closed_after`` seconds. A rewritten file is reported once, as an entry of the ledger; its lines
    stay as they were read, or with ``reread`` it is read again from its start.
    """
    finish(spark, ledger)
    last = entries(spark, ledger).agg(F.max("batch")).first()[0]
    batch = 0 if last is None else last + 1
    changed = changed_files(spark, ledger, folder, reread)
    reported = (F.col("status") == "rewritten") & F.lit(not reread)
    ranges = counted_ranges(cut_ranges(changed.where(~reported), range_bytes))
    of_file = ranges.groupBy("path").agg(
        F.sum("n").alias("n"),
        F.max_by(F.struct("last_line", "ended"), F.when(F.col("n") > 0, F.col("start"))).alias("tail"),
    )
    age = F.unix_micros(F.current_timestamp()) - F.unix_micros("modified")
    whole = F.col("tail.ended") | (age >= int(closed_after * 1_000_000))
    files = materialise(
        changed.join(of_file, "path", "left").select(
            "path", "length", "modified", "status", "old_mark", "first", "lines", reported.alias("reported"),
            F.when(reported | F.col("n").isNull(), F.col("first")).when(whole, F.col("length"))
            .otherwise(F.col("tail.last_line")).alias("offset"),
            F.when(reported | F.col("n").isNull(), 0).when(whole, F.col("n")).otherwise(F.col("n") - 1).alias("new_lines"),
        )
    )
    # Ranges end where their file's whole lines do.
    cut = ranges.join(files.select("path", "offset"), "path").where("start < offset")
    cut = cut.withColumn("stop", F.least("stop", "offset")).withColumn("length", F.col("offset"))
    rows = raw_rows(read_lines(cut))
    now = files.join(_marks(files.where("NOT reported")), "path", "left").select(
        "path", "length", "modified", "offset", (F.col("lines") + F.col("new_lines")).alias("lines"),
        F.coalesce("mark", "old_mark").alias("mark"), "status",
    )
    # Files that only wait for the end of their line change nothing.
    now = now.join(files.select("path", (F.col("offset") > F.col("first")).alias("read")), "path")
    now = materialise(now.where("read OR status <> 'grown'").drop("read"))
    counts = {r["status"]: r["count"] for r in now.groupBy("status").count().collect()}
    if counts:
        commit(spark, ledger, batch, rows, now)
    return counts


def commit(spark: SparkSession, ledger: Ledger, batch: int, rows: DataFrame, now: DataFrame) -> None:
    """Rows aside, entries aside, entries in place, rows in place: the third step decides."""
    rows.write.mode("overwrite").parquet(ledger.staged("rows", batch))
    now.write.mode("overwrite").parquet(ledger.staged("ledger", batch))
    _move(spark, ledger.staged("ledger", batch), f"{ledger.entries}/batch={batch}")
    finish(spark, ledger)


def finish(spark: SparkSession, ledger: Ledger) -> None:
    """Put the rows of the last batch in place that the ledger has and a run left aside."""
    last = entries(spark, ledger).agg(F.max("batch")).first()[0]
    if last is not None and _there(spark, ledger.staged("rows", last)):
        _move(spark, ledger.staged("rows", last), f"{ledger.rows}/batch={last}")


def status_report(spark: SparkSession, ledger: Ledger) -> str:
    """The files of the last batch by status, as a JSON line for a log."""
    found = entries(spark, ledger)
    last = found.agg(F.max("batch")).first()[0]
    counts = found.where(F.col("batch") == last).groupBy("status").count().collect() if last is not None else []
    return json.dumps({"batch": last, **{r["status"]: r["count"] for r in counts}})
