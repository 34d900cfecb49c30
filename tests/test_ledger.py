"""Lines by byte ranges, their numbers, and files that grow."""

import os
import random
import re
import time

import pytest

from assaymill.operators.contract import contract_violations, numbered_report
from assaymill.sources.files import read_raw
from assaymill.sources.ranges import list_files, read_raw_numbered
from assaymill.streaming import ledger as books
from assaymill.streaming.ledger import Ledger, entries, ingest, ingested
from sample_events import EVENTS, changed, text


def shown(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def by_hand(folder):
    """(file, number, line) of all lines that are not blank."""
    out = []
    for path in sorted(folder.rglob("*")):
        if path.is_file() and not path.name.startswith((".", "_")):
            lines = re.split(rb"\r\n|\n|\r", path.read_bytes())
            out += [(path.name, n, x.decode()) for n, x in enumerate(lines, 1) if x.strip(b" ")]
    return sorted(out)


def read(df):
    return sorted((r[0].rsplit("/", 1)[1], r[1], r[2]) for r in df.select("source_file", "line_number", "raw_payload").collect())


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_lines_have_the_numbers_of_their_file(spark, tmp_path, size):
    rng = random.Random(size)
    folder = tmp_path / "in"
    for n in range(6):
        path = folder / ("deep/er" if n % 2 else "") / f"f{n}"
        path.parent.mkdir(parents=True, exist_ok=True)
        parts = [b"a", "é".encode(), b"\n", b"\r", b"\r\n", b" ", b"\t"]
        path.write_bytes(b"".join(rng.choice(parts) for _ in range(60 * n)))
    (folder / "_hidden").write_bytes(b"not read\n")
    found = read_raw_numbered(spark, str(folder), size)
    assert read(found) == by_hand(folder)
    plain = read_raw(spark, str(folder) + "/*").unionByName(read_raw(spark, str(folder) + "/deep/er"))
    assert shown(found, "raw_payload", "payload_sha256") == shown(plain, "raw_payload", "payload_sha256")


def test_listing(spark, tmp_path):
    assert list_files(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x").write_text("12345")
    row = list_files(spark, f"file://{tmp_path}").first()
    assert row["path"] == f"file://{tmp_path}/a/x" and row["length"] == 5


def test_the_report_names_lines(spark, tmp_path):
    lines = [text(EVENTS[0]), "", text(changed("source_system", "", EVENTS[1])), "   ", "{", text(EVENTS[2])]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "events.jsonl").write_text("\n".join(lines))
    raw = read_raw_numbered(spark, str(tmp_path / "in"), 100)
    found = contract_violations(raw, keep=("source_file", "line_number"))
    assert [r["line"] for r in numbered_report(found).collect()] == [
        'Line 3, field source_system: "" is too short',
        "Line 5, field <root>: not exactly one JSON document",
    ]


class Folder:
    def __init__(self, path):
        self.path = path
        path.mkdir()

    def append(self, name, data):
        with open(self.path / name, "ab") as file:
            file.write(data.encode())
        # Times that differ, however fast the test is.
        Folder.clock = getattr(Folder, "clock", time.time()) + 1
        os.utime(self.path / name, (Folder.clock - 10**6, Folder.clock - 10**6))


@pytest.fixture
def book(tmp_path):
    return Ledger(str(tmp_path / "book"))


@pytest.fixture
def folder(tmp_path):
    return Folder(tmp_path / "in")


def test_appended_lines_are_read_once(spark, book, folder):
    folder.append("a", "one\ntwo\n")
    folder.append("b", "first\n\n")
    assert ingest(spark, book, str(folder.path)) == {"new": 2}
    assert ingest(spark, book, str(folder.path)) == {}
    folder.append("a", "three\r\nfour\n")
    folder.append("c", "new file\n")
    assert ingest(spark, book, str(folder.path), range_bytes=4) == {"new": 1, "grown": 1}
    folder.append("b", "third\n")
    ingest(spark, book, str(folder.path))
    assert read(ingested(spark, book)) == by_hand(folder.path)
    # Only the tail was read: the number of lines goes on, and the entries say from where.
    assert [(r["offset"], r["lines"]) for r in entries(spark, book).where("path LIKE '%/a'").orderBy("batch").collect()] == [(8, 2), (20, 4)]


def test_a_line_without_an_end_waits(spark, book, folder):
    folder.append("a", "one\ntw")
    ingest(spark, book, str(folder.path), closed_after=10**9)
    assert [r[2] for r in read(ingested(spark, book))] == ["one"]
    assert ingest(spark, book, str(folder.path), closed_after=10**9) == {}
    folder.append("a", "o\nthree\r")
    ingest(spark, book, str(folder.path), closed_after=10**9)
    assert [r[2] for r in read(ingested(spark, book))] == ["one", "two"]
    # Unchanged for long enough, the file's last line is whole.
    assert ingest(spark, book, str(folder.path), closed_after=0) == {"grown": 1}
    assert read(ingested(spark, book)) == by_hand(folder.path)


def test_a_rewritten_file_is_reported_once(spark, book, folder):
    folder.append("a", "one\ntwo\n")
    folder.append("b", "keep\n")
    ingest(spark, book, str(folder.path))
    (folder.path / "a").write_text("")
    folder.append("a", "other\ntext\nand more\n")
    assert ingest(spark, book, str(folder.path)) == {"rewritten": 1}
    assert ingest(spark, book, str(folder.path)) == {}
    assert [r[2] for r in read(ingested(spark, book))] == ["one", "two", "keep"]
    (folder.path / "b").write_text("")
    folder.append("b", "k\n")
    assert ingest(spark, book, str(folder.path), reread=True) == {"rewritten": 1}
    assert [r[2] for r in read(ingested(spark, book)) if r[0] == "b"] == ["k", "keep"]


@pytest.mark.parametrize("step", ["before the ledger", "after the ledger"])
def test_a_run_that_ended_half_way(spark, book, folder, monkeypatch, step):
    folder.append("a", "one\n")
    ingest(spark, book, str(folder.path))
    folder.append("a", "two\n")
    plain = books._move

    def dying(spark, source, target):
        if step == "after the ledger":
            plain(spark, source, target)
        raise RuntimeError("killed")

    monkeypatch.setattr(books, "_move", dying)
    with pytest.raises(RuntimeError):
        ingest(spark, book, str(folder.path))
    assert [r[2] for r in read(ingested(spark, book))] == ["one"]
    monkeypatch.setattr(books, "_move", plain)
    folder.append("b", "three\n")
    ingest(spark, book, str(folder.path))
    assert read(ingested(spark, book)) == by_hand(folder.path)


def test_the_rows_can_be_streamed(spark, book, folder, tmp_path):
    for part in ("one\n", "two\nthree\n"):
        folder.append("a", part)
        ingest(spark, book, str(folder.path))
        rows = ingested(spark, book, stream=True).select("raw_payload")
        sink = rows.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
        sink.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    copied = spark.read.schema("raw_payload string").parquet(str(tmp_path / "out"))
    assert shown(copied, "raw_payload") == [("one",), ("three",), ("two",)]


def test_an_empty_folder(spark, book, folder):
    assert ingest(spark, book, str(folder.path)) == {}
    folder.append("empty", "")
    ingest(spark, book, str(folder.path))
    assert ingested(spark, book).count() == 0
