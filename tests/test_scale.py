"""What the queries write and how their steps are planned, as far as it decides how large tables may be."""

import time
from pathlib import Path

import pandas as pd
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from assaymill import queries
from assaymill.functions.columns import has_text
from assaymill.operators.contract import Items, Number, Object, Text, contract_violations, numbered_report
from assaymill.operators.json_schema import tree_violations
from assaymill.plans.lineitem_events import derived_payloads
from assaymill.session import SHUFFLE_CLEANUP, shared_folder
from assaymill.sources.files import read_raw
from assaymill.streaming import layers as stream
from assaymill.streaming.latest import _settling


def _files(folder, suffix):
    return [p for p in Path(folder.removeprefix("file:")).rglob(f"*{suffix}") if p.stat().st_size]


def test_written_lines_are_compressed_in_files_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(queries, "LINES_PER_FILE", 2)
    lines = ["a", " ", "b\tc", "d" * 5000, "ä"]
    folder = queries.written_lines(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1))
    files = _files(folder, ".txt.gz")
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 1000
    assert sorted(r[0] for r in read_raw(spark, folder).select("raw_payload").collect()) == sorted(
        x for x in lines if x != " "
    )


def test_layers_are_stored_as_zstd(spark, tmp_path):
    root = shared_folder(spark, "codec")
    made = stream.Layers(f"codec_{root[-32:]}", root)
    stream.create_database(spark, made)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("x\ny\n")
    stream.append(stream.stream_raw(spark, str(tmp_path / "in")), made, stream.RAW)
    files = _files(made.location(stream.RAW), ".parquet")
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}
    assert codecs == {"ZSTD"}
    assert spark.read.table(made.table(stream.RAW)).count() == 2


class _State:
    """What the change stream asks of the state of a key."""

    hasTimedOut = False

    def __init__(self, kept=None):
        self.get, self.exists = kept, kept is not None

    def update(self, kept):
        self.get, self.exists = kept, True

    def getCurrentWatermarkMs(self):
        return 0

    def setTimeoutTimestamp(self, at):
        self.until = at


def test_a_key_is_settled_by_its_columns_without_a_frame_for_each_batch():
    settle = _settling(["k", "t", "s"], [(1, True, True), (2, False, False)], 1, 1000)
    # Columns by name only: a selection of columns, which makes a new frame, is not there.
    batches = [{"k": pd.Series(["a", "a"]), "t": pd.Series(["5000", "7000"]), "s": pd.Series(["x", None], dtype=object)}]
    state = _State()
    (first,) = settle(("a",), iter(batches), state)
    assert [tuple(r) for r in first.to_numpy()] == [("a", "7000", None, 1)]
    assert state.get == ("a", "7000", None) and state.until == 1007
    (second,) = settle(("a",), iter([{c: pd.Series([v]) for c, v in zip("kts", ("a", "8000", "y"))}]), state)
    assert [tuple(r) for r in second.to_numpy()] == [("a", "7000", None, -1), ("a", "8000", "y", 1)]
    assert list(settle(("a",), iter(batches), state)) == []


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_contract_checks_neither_copy_objects_for_their_keys_nor_run_inside_a_lambda(raw):
    tree = {"type": "object", "required": ["a"], "properties": {"a": {"type": "string", "minLength": 1}}}
    checked = tree_violations(raw('{"a":""}', "{}", "1"), tree, "raw_payload", ("source_file",))
    assert "lambdafunction" not in _plan(checked)
    assert sorted((r["source_file"], r["rule"]) for r in checked.collect()) == [
        ("memory://0", "minLength"), ("memory://1", "required"), ("memory://2", "type")
    ]
    closed = Object({"a": Text(min_length=1), "b": Object({"n": Number(minimum=0)})})
    found = contract_violations(raw('{"a":"","b":{"n":-1}}', '{"a":"x","b":{"n":-1,"m":{}}}'), closed)
    assert "Map(StringType,VariantType" not in _plan(found) and "map<string,variant>" not in _plan(found)
    assert sorted(tuple(r) for r in found.select("field_path", "rule", "message").collect()) == [
        ("a", "minLength", '"" is too short'),
        ("b", "additionalProperties", "Additional properties are not allowed: 'm'"),
        ("b.n", "minimum", "-1 is less than the minimum of 0"),
        ("b.n", "minimum", "-1 is less than the minimum of 0"),
    ]


def test_contract_checks_copy_no_rows_for_their_parses(raw):
    found = contract_violations(raw('{"n":-1}', '{"n":1}', '{"n":1} x', "[", "null"), Object({"n": Number(minimum=0)}))
    plan = _plan(found)
    # The violations are the only generator; each parse is there once, below the filter.
    assert plan.count("Generate ") == 1 and plan.count("parseJson(") == 1 and plan.count("from_json(") == 1
    assert sorted((r["source_file"], r["rule"]) for r in found.collect()) == [
        ("memory://0", "minimum"), ("memory://2", "json"), ("memory://3", "json"), ("memory://4", "type")
    ]


def test_a_document_of_the_right_shape_is_told_by_its_typed_parse_with_the_value_as_written(raw):
    closed = Object({"l": Items(Object({"n": Number(0, 9)}), min_items=1), "t": Text(form="uuid")})
    payloads = ['{"l":[{"n":1},{"n":10}],"t":"u"}', '{"l":[],"t":"u"}', '{"l":[{"n":1.50},{"n":"2"}],"t":null}']
    found = contract_violations(raw(*payloads), closed, keep=("source_file",))
    assert sorted(tuple(r)[:3] + (r["message"],) for r in found.collect()) == [
        ("memory://0", "l.1.n", "maximum", "10 is greater than the maximum of 9"),
        ("memory://0", "t", "format", "\"u\" is not a 'uuid'"),
        ("memory://1", "l", "minItems", "[] has too few items"),
        ("memory://1", "t", "format", "\"u\" is not a 'uuid'"),
        ("memory://2", "l.1.n", "type", "\"2\" is not of type 'number'"),
        ("memory://2", "t", "type", "null is not of type 'string'"),
    ]


def _tables(spark, tmp_path):
    line = "id l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 1D l_quantity, 1D l_extendedprice, 0D l_discount"
    line = f"{line}, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus, timestamp'2026-01-01' l_shipdate"
    part = "SELECT 1L p_partkey, 'n' p_name, 'b' p_brand, 't' p_type, 1 p_size, 1D p_retailprice"
    spark.sql(f"SELECT {line} FROM VALUES (1L), (50L) AS t(id)").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql(part).write.parquet(f"{tmp_path}/part.parquet")


def test_lines_of_a_file_are_dealt_out_before_they_are_written_as_json(spark, tmp_path):
    line = "1L l_orderkey, 1L l_partkey, 1L l_suppkey, 1 l_linenumber, 1D l_quantity, 1D l_extendedprice, 0D l_discount"
    line = f"{line}, 0D l_tax, 'N' l_returnflag, 'O' l_linestatus, timestamp'2026-01-01' l_shipdate"
    part = "1L p_partkey, 'n' p_name, 'b' p_brand, 't' p_type, 1 p_size, 1D p_retailprice"
    for name, row in (("lineitem", line), ("part", part)):
        spark.sql(f"SELECT {row}").write.parquet(f"{tmp_path}/{name}.parquet")
    placed = derived_payloads(spark, str(tmp_path), "concat('f', l_orderkey % 2)")
    # Plans are printed from the last step to the first.
    before, after = _plan(placed).split("RepartitionByExpression [file")
    assert "AS json#" in before and "AS json#" not in after
    plain = derived_payloads(spark, str(tmp_path))
    assert [(*r[:-2], r["value"]) for r in placed.select(*plain.columns[:-1], "file", "value").collect()] == [
        tuple(r) for r in plain.collect()
    ]
    assert placed.first()["file"] == "f1"


def test_a_numbered_report_checks_its_files_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def check(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch.assign(field_path="a.b", rule="r", message="m")

    schema = "source_file string, line_number bigint, field_path string, rule string, message string"
    places = spark.range(200, numPartitions=4).selectExpr("concat('f', id % 2) AS source_file", "id AS line_number")
    rows = numbered_report(places.mapInPandas(check, schema)).collect()
    assert seen.value == 200
    assert [(r["source_file"], r["line_number"]) for r in rows] == sorted((f"f{n % 2}", n) for n in range(200))


def test_the_streamed_layers_keep_no_files_of_lines_beside_them(spark, tmp_path, monkeypatch):
    _tables(spark, tmp_path)
    folders = []
    write = queries.written_lines
    monkeypatch.setattr(queries, "written_lines", lambda lines: folders.append(write(lines)) or folders[-1])
    layers = queries.layer_tables(spark, str(tmp_path))
    # Faults 1 and 50: one is quarantined, one valid.
    assert {name: rows.count() for name, rows in layers.items()} == {
        "bronze": 2, "silver": 1, "quarantine": 1, "gold": 1
    }
    assert len(folders) == 1 and Path(folders[0]).is_dir() and not list(Path(folders[0]).iterdir())


def test_the_blank_test_does_not_count_the_characters_of_a_line(spark):
    lines = spark.createDataFrame([("",), ("  ",), ("\t",), (" a ",), ("ä",), (None,)], "value string")
    assert "length" not in _plan(lines.where(has_text(F.col("value"))))
    assert [r[0] for r in lines.select(has_text(F.col("value"))).collect()] == [False, False, True, True, True, None]


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {p for folder in folders for p in Path(folder.getPath()).rglob("shuffle_*")}


def test_the_fill_of_the_layers_keeps_no_shuffles_and_stores_the_quarantine_after_the_candidates(
    spark, tmp_path, monkeypatch
):
    _tables(spark, tmp_path)
    steps = []
    for step in ("append", "refresh_candidates"):
        run = getattr(stream, step)
        monkeypatch.setattr(stream, step, lambda *a, run=run, step=step, **k: steps.append((step, *a[2:3])) or run(*a, **k))
    monkeypatch.setattr(queries, "_content", lambda *_: ())
    before = _shuffle_files(spark)
    layers = queries.layer_tables(spark, str(tmp_path))
    until = time.monotonic() + 10
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert steps[-2:] == [("refresh_candidates",), ("append", stream.QUARANTINED)]
    assert {name: rows.count() for name, rows in layers.items()} == {
        "bronze": 2, "silver": 1, "quarantine": 1, "gold": 1
    }


def test_payloads_of_the_layers_are_compared_by_the_bytes_of_their_fingerprints(spark, tmp_path):
    _tables(spark, tmp_path)
    found = queries.layers_same_payloads(spark, str(tmp_path))
    plan = _plan(found)
    assert "unhex(payload_sha256" in plan and "Aggregate [payload_sha256" not in plan
    assert tuple(found.first()) == (2, 0, 0)
