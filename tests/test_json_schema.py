"""Contracts from JSON Schema documents."""

import json

import pytest

from assaymill.operators.contract import EXPERIMENT_CONTRACT, contract_violations
from assaymill.operators.json_schema import as_schema, closed, compiled, schema_violations, tree_violations
from sample_events import EVENTS, changed, text
from test_contract import CHANGES

SCHEMA = json.dumps({"$schema": "https://json-schema.org/draft/2020-12/schema", "title": "Events", **as_schema(EXPERIMENT_CONTRACT)})
KEEP = ("source_file", "payload_sha256")


def listed(df):
    return sorted(tuple(r) for r in df.select("source_file", "field_path", "rule", "message").collect())


def test_a_closed_schema_is_the_contract_in_constants():
    assert closed(compiled(SCHEMA)) == EXPERIMENT_CONTRACT


@pytest.fixture(scope="module")
def spoiled():
    changes = [changed(path, value) for path, value, _ in CHANGES]
    return [*EVENTS, *changes, "", "nothing", "{}", "[]", "42", text(EVENTS[0]) + " {}", '{"a": NaN}', '{"a":1,"a":2}']


def test_the_document_finds_what_the_constants_find(raw, spoiled):
    rows = raw(*spoiled)
    expected = listed(contract_violations(rows))
    assert listed(schema_violations(rows, SCHEMA)) == expected
    # The tree of checks, too, which takes any schema.
    assert listed(tree_violations(rows, compiled(SCHEMA), "raw_payload", KEEP)) == expected


def found(raw, schema, *documents):
    rows = schema_violations(raw(*(d if isinstance(d, str) else json.dumps(d) for d in documents)), schema)
    out = [[] for _ in documents]
    for r in rows.collect():
        out[int(r["source_file"].rsplit("/", 1)[1])].append((r["field_path"], r["rule"]))
    return [sorted(x) for x in out]


def test_references_and_nested_lists(raw):
    schema = {
        "$defs": {"cell": {"type": "integer", "minimum": 0}, "row": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"$ref": "#/$defs/cell"}}},
        "type": "object",
        "properties": {"grid": {"type": "array", "items": {"$ref": "#/$defs/row"}}, "one": {"$ref": "#/$defs/cell", "maximum": 3}},
    }
    assert found(
        raw, schema, {"grid": [[1], [2, 3]], "one": 2}, {"grid": [[], [1, -2], [1, 2, 3], 5, ["x"], [1.0, 1.5]]}, {"one": 4}, {"other": 1}, {"grid": {}},
    ) == [
        [],
        [("grid.0", "minItems"), ("grid.1.1", "minimum"), ("grid.2", "maxItems"), ("grid.3", "type"), ("grid.4.0", "type"), ("grid.5.1", "type")],
        [("one", "maximum")],
        [],
        [("grid", "type")],
    ]


def test_alternatives(raw):
    schema = {
        "properties": {
            "any": {"anyOf": [{"type": "null"}, {"type": "string", "pattern": "^u[0-9]+$"}, {"type": "object", "required": ["k"]}]},
            "one": {"oneOf": [{"type": "number", "minimum": 5}, {"type": "number", "maximum": 7}]},
            "never": {"not": {"type": "string"}},
            "all": {"allOf": [{"type": "integer"}, {"multipleOf": 3}]},
            "no": False,
        }
    }
    documents = [{"any": None}, {"any": "u12"}, {"any": {"k": 1}}, {"any": "12"}, {"any": {}}, {"one": 9}, {"one": 6}, {"one": "x"},
                 {"never": "s"}, {"never": 1}, {"all": 9}, {"all": 10}, {"all": "x"}, {"no": 1}, {}]
    assert found(raw, schema, *documents) == [
        [], [], [], [("any", "anyOf")], [("any", "anyOf")], [], [("one", "oneOf")], [("one", "oneOf")],
        [("never", "not")], [], [], [("all", "multipleOf")], [("all", "type")], [("no", "false")], [],
    ]


def test_constants_texts_and_numbers(raw):
    schema = {
        "type": "object",
        "properties": {
            "e": {"enum": ["a", 1, None, True]}, "c": {"const": 2}, "t": {"minLength": 2, "maxLength": 3, "pattern": "b"},
            "n": {"type": ["number", "null"], "exclusiveMinimum": 0, "exclusiveMaximum": 10}, "f": {"format": "date-time"},
        },
        "additionalProperties": {"type": "boolean"},
    }
    documents = [{"e": "a"}, {"e": 1.0}, {"e": None}, {"e": True}, {"e": False}, {"e": "1"}, {"c": 2.0}, {"c": "2"}, {"t": "é\U0001f600b"}, {"t": "b"},
                 {"t": "bbbb"}, {"t": "aa"}, {"t": 5}, {"n": None}, {"n": 0}, {"n": 10}, {"n": 9.9}, {"n": "5"}, {"f": "x"}, {"f": 1},
                 {"x": True, "y": 1}]
    assert found(raw, schema, *documents) == [
        [], [], [], [], [("e", "enum")], [("e", "enum")], [], [("c", "const")], [], [("t", "minLength")],
        [("t", "maxLength")], [("t", "pattern")], [], [], [("n", "exclusiveMinimum")], [("n", "exclusiveMaximum")], [], [("n", "type")],
        [("f", "format")], [], [("y", "type")],
    ]


@pytest.mark.parametrize(
    "schema, said",
    [
        ({"typ": "object"}, "not supported: typ"),
        ({"type": "text"}, "No such type"),
        ({"properties": {"a": {"format": "colour"}}}, "Format"),
        ({"$ref": "#/$defs/none"}, "No such definition"),
        ({"$ref": "https://elsewhere/x"}, "within the document"),
        ({"$defs": {"a": {"items": {"$ref": "#/$defs/a"}}}, "$ref": "#/$defs/a"}, "back to itself"),
        ({"const": {"a": 1}}, "constants"),
        ([], "object or a boolean"),
    ],
)
def test_what_is_not_understood_is_an_error(schema, said):
    with pytest.raises(ValueError, match=said):
        compiled(schema)


def test_one_parse_and_no_shuffle(raw):
    plan = schema_violations(raw(*EVENTS), {"type": "object", "properties": {"a": {"anyOf": [{"type": "null"}]}}})
    text_ = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text_.count("try_parse_json") + text_.count("parse_json(") <= 2 and "Exchange" not in text_


def test_objects_are_known_by_their_keys(raw):
    """No copy of an object is made for its checks, and what stands in its place is still told."""
    plan = tree_violations(raw(*EVENTS), compiled(SCHEMA), "raw_payload", KEEP)
    columns = plan._jdf.queryExecution().analyzed().toString()
    objects = [0, *(n for n in range(1, 40) if f"AS _keys_{n}#" in columns)]
    assert len(objects) == 5 and all(f"AS _value_{n}#" not in columns for n in objects)
    schema = {"properties": {"p": {"required": ["k"], "properties": {"k": {"type": "integer"}}}, "q": {"type": ["object", "null"]}}}
    documents = [{"p": 5}, {"p": []}, {"p": None}, {"p": {}}, {"p": {"k": 2.0}}, {"p": {"k": "1"}}, {"p": {"k": 1.5}}, {"q": {}}, {"q": None}, {"q": []}]
    assert found(raw, schema, *documents) == [
        [], [], [], [("p", "required")], [], [("p.k", "type")], [("p.k", "type")], [], [], [("q", "type")],
    ]


def test_lists_of_flat_objects(raw):
    """Items are opened one by one unless all hold together: a field that only some have, mixed kinds, limits."""
    item = {
        "type": "object", "additionalProperties": False, "required": ["n", "s"],
        "properties": {"n": {"type": "number", "maximum": 2.5}, "s": {"type": "string", "minLength": 1}},
    }
    good = {"n": 2.5, "s": "x"}
    lists = [
        [], [good], [good, {"n": 1, "s": "y"}], [good, {"n": 1}], [{"n": "1", "s": "x"}, good], [{"n": 1e300, "s": ""}],
        [good, {**good, "z": 1}], [good, None], [5], {},
    ]
    assert found(raw, {"properties": {"l": {"items": item}}}, *({"l": x} for x in lists)) == [
        [], [], [], [("l.1", "required")], [("l.0.n", "type")], [("l.0.n", "maximum"), ("l.0.s", "minLength")],
        [("l.1", "additionalProperties")], [("l.1", "type")], [("l.0", "type")], [],
    ]
