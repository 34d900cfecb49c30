"""Substring dedup by lines and their sentences: of equal units in the corpus, the earliest stays.

Texts are cut into units: paragraphs, lines, or the sentences of lines, so that a passage is found inside a longer
line too. Units are normalised and hashed, whatever their length, and digests are grouped over the whole
corpus. All but a digest's earliest occurrence, by document id and then place, are repeats. Single short
repeats ("Yes.") stand in clean texts as well, so what is removed are runs of neighbouring repeats that together
have at least as many words as a passage; offsets in the original text are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored

#: Words of neighbouring repeated units from which they are removed.
LEAST_RUN = 25
#: Characters that count as a word where spaces are few, as in Chinese or Thai.
WORD_CHARS = 6

# Marks that end a sentence: before white space, and wherever they stand in scripts without spaces.
_END, _WIDE_END = ".!?", "。！？"
#: Units as patterns; a text is its matches one after the other, the last one perhaps empty.
UNITS = {
    "sentence": (
        rf"(?:[^\n{_END}{_WIDE_END}]+|[{_END}]+[^\n{_END}{_WIDE_END}\x20\t])*"
        rf"(?:[{_WIDE_END}]+|[{_END}]*[\x20\t]*)\n?"
    ),
    "line": r"[^\n]*\n?",
    "paragraph": r"(?:[^\n]+\n?)*\n*",
}

_SPACES = re.compile(r"[\x20\x09-\x0D]+")


def unit_key(unit: str) -> tuple[str, int]:
    """A unit without regard to case and white space, and how many words it counts for; none if it has none."""
    words = [w for w in _SPACES.split(unit.lower()) if w]
    key = " ".join(words)
    return key, max(len(words), len(key) // WORD_CHARS)


def _digest(key: str) -> bytes:
    return hashlib.blake2b(key.encode(), digest_size=16).digest()


def _unit_rows(unit: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = re.compile(UNITS[unit])
        for batch in batches:
            owner, places, digests, again = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                seen: set[bytes] = set()
                keys = (unit_key(piece)[0] for piece in pieces.findall(text.as_py() or ""))
                for place, key in enumerate(k for k in keys if k):
                    digest = _digest(key)
                    owner.append(row)
                    places.append(place)
                    digests.append(digest)
                    again.append(digest in seen)
                    seen.add(digest)
            rows = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(rows),
                    batch.column("text_hash").take(rows),
                    pa.array(places, pa.int32()),
                    pa.array(digests, pa.binary()),
                    pa.array(again, pa.bool_()),
                ],
                names=["id", "text_hash", "place", "digest", "again"],
            )

    return of


def removed_runs(sizes: list[int], repeated: set[int], least_run: int) -> list[tuple[int, int]]:
    """Runs of repeated units with enough words, as (first, last); ``sizes`` are the units' words."""
    runs, start = [], None
    for place in range(len(sizes) + 1):
        if place in repeated:
            start = place if start is None else start
        elif start is not None:
            if sum(sizes[start:place]) >= least_run:
                runs.append((start, place - 1))
            start = None
    return runs


def _without(unit: str, least_run: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = re.compile(UNITS[unit])
        kinds = [pa.int64()] * 3 + [pa.string(), pa.string()]
        for batch in batches:
            out = []
            for text, gone in zip(batch.column("text"), batch.column("gone")):
                whole = text.as_py()
                starts, ends, sizes = [], [], []
                for found in pieces.finditer(whole or ""):
                    key, size = unit_key(found[0])
                    if key:
                        starts.append(found.start())
                        ends.append(found.end())
                        sizes.append(size)
                runs = removed_runs(sizes, set(gone.as_py() or ()), least_run)
                spans = [(starts[first], ends[last]) for first, last in runs]
                borders = [0, *(x for span in spans for x in span), len(whole or "")]
                left = "".join(whole[a:b] for a, b in zip(borders[::2], borders[1::2])) if whole else whole
                listed = ",".join(f"{a}:{b}" for a, b in spans)
                n_removed = sum(last - first + 1 for first, last in runs)
                out.append((len(sizes), n_removed, sum(b - a for a, b in spans), listed, left))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array([o[i] for o in out], k) for i, k in enumerate(kinds))],
                names=["doc_id", "n_units", "n_removed", "n_removed_chars", "removed_spans", "text"],
            )

    return of


def remove_repeated_units(docs: DataFrame, unit: str = "sentence", least_run: int = LEAST_RUN) -> DataFrame:
    """One row per document: its units, those removed with their spans, and the text that is left.

    Every unit with a word takes part. Units are equal when their words are, whatever their case and white
    space. Repeated units go where neighbouring ones, with only blank units between them, have ``least_run`` words or more
    together; a unit has as many words as white space parts, or one for every ``WORD_CHARS`` characters
    if that is more. ``least_run=0`` removes every repeat. Spans are code points ``start:end`` in the
    original text, ends exclusive, one for each run. Rows without an id rank first; rows that share an id count
    as one document, so the first occurrence stays in each. A null text stays null with no units. An
    empty table gives no rows. Other columns are not looked at.
    """
    texts = columns(docs, id="doc_id", text="text").withColumn(
        "text_hash", F.xxhash64(F.coalesce("text", F.lit("")))
    )
    kind = texts.schema["id"].dataType.simpleString()
    schema = f"id {kind}, text_hash bigint, place int, digest binary, again boolean"
    rows = texts.mapInArrow(_unit_rows(unit), schema)
    # One row per task and digest reaches the shuffle, whatever repeats.
    first = rows.groupBy("digest").agg(
        F.min("id").alias("first_id"),
        F.count("*").alias("n"),
        F.count_if(F.col("id").isNull()).alias("nameless"),
    )
    named = F.when(F.col("nameless") == 0, F.col("first_id")).alias("first_id")
    first = stored(first.where("n > 1").select("digest", named), "first-units")
    gone = (
        rows.join(first, "digest")
        .where(F.col("again") | ~F.col("id").eqNullSafe(F.col("first_id")))
        .groupBy(F.col("id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
        .agg(F.collect_set("place").alias("gone"))
    )
    same = texts["id"].eqNullSafe(gone["gone_id"]) & (texts["text_hash"] == gone["gone_hash"])
    out = f"doc_id {kind}, n_units bigint, n_removed bigint, n_removed_chars bigint, removed_spans string, text string"
    return texts.join(gone, same, "left").select("id", "text", "gone").mapInArrow(_without(unit, least_run), out)
