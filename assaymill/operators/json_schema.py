"""Violations of a contract that is given as a JSON Schema document.

The document is compiled, on the driver, into column expressions over one parsed variant per payload.
A closed schema (each object with exactly its required keys, lists of flat objects) becomes the
specification that ``contract_violations`` checks fastest; any other one becomes a tree of checks.
Keywords that are not understood are an error when the schema is compiled and never a check left out.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaymill.operators.contract import (
    FORMS,
    KEYS_ONLY,
    ROOT,
    VIOLATION,
    WRAPPED,
    Items,
    Number,
    Object,
    Text,
    _item_holds,
    _keys,
    _said,
    _violation,
    _where,
    contract_violations,
    one_document,
)

# --- fixed values: keywords of the schema language ---
NOTES = {"$schema", "$id", "$comment", "$defs", "definitions", "title", "description", "default", "examples", "deprecated"}
TEXT_LIMITS = {"minLength", "maxLength", "pattern", "format"}
NUMBER_LIMITS = {"minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "multipleOf"}
LIST_LIMITS = {"items", "minItems", "maxItems"}
OBJECT_LIMITS = {"properties", "required", "additionalProperties"}
COMBINED = {"anyOf", "oneOf", "allOf", "not"}
KNOWN = NOTES | TEXT_LIMITS | NUMBER_LIMITS | LIST_LIMITS | OBJECT_LIMITS | COMBINED | {"type", "const", "enum", "$ref"}
TYPES = ("null", "boolean", "integer", "number", "string", "array", "object")
# --- end of fixed values ---


def compiled(schema: str | dict | bool) -> dict | bool:
    """The schema with its local references put in place; raises ValueError for what is not supported."""
    whole = json.loads(schema) if isinstance(schema, str) else schema

    def resolve(part, open_refs: tuple[str, ...]):
        if isinstance(part, bool):
            return part
        if not isinstance(part, dict):
            raise ValueError(f"A schema is an object or a boolean, not {part!r}.")
        unknown = sorted(set(part) - KNOWN)
        if unknown:
            raise ValueError(f"Keywords that are not supported: {', '.join(unknown)}")
        out = {k: v for k, v in part.items() if k not in NOTES and k != "$ref"}
        kinds = [out["type"]] if isinstance(out.get("type"), str) else out.get("type", [])
        if any(k not in TYPES for k in kinds):
            raise ValueError(f"No such type: {out['type']!r}")
        if "format" in out and out["format"] not in FORMS:
            raise ValueError(f"Format that is not supported: {out['format']!r}")
        if "pattern" in out:
            re.compile(out["pattern"])
        for value in out.get("enum", []) + ([out["const"]] if "const" in out else []):
            if isinstance(value, (dict, list)):
                raise ValueError("Objects and lists as constants are not supported.")
        if "properties" in out:
            out["properties"] = {k: resolve(v, open_refs) for k, v in out["properties"].items()}
        for key in ("items", "additionalProperties", "not"):
            if key in out:
                out[key] = resolve(out[key], open_refs)
        for key in ("anyOf", "oneOf", "allOf"):
            if key in out:
                out[key] = [resolve(v, open_refs) for v in out[key]]
        if "$ref" in part:
            ref = part["$ref"]
            if ref in open_refs:
                raise ValueError(f"A reference leads back to itself: {ref}")
            target = resolve(_at(whole, ref), (*open_refs, ref))
            out = target if not out else {"allOf": [target, out]}
        return out

    return resolve(whole, ())


def _at(whole, ref: str):
    if not ref.startswith("#"):
        raise ValueError(f"Only references within the document are supported: {ref}")
    found = whole
    for part in ref[1:].split("/")[1:]:
        key = part.replace("~1", "/").replace("~0", "~")
        found = found[int(key)] if isinstance(found, list) else found.get(key)
        if found is None:
            raise ValueError(f"No such definition: {ref}")
    return found


def closed(schema: dict | bool) -> Object | None:
    """A compiled schema as the specification of a closed contract, None if it is not one."""
    found = _closed(schema)
    return found if isinstance(found, Object) else None


def _closed(schema):
    if isinstance(schema, bool) or not isinstance(schema.get("type"), str):
        return None
    kind, rest = schema["type"], {k: v for k, v in schema.items() if k != "type"}
    if kind == "string" and set(rest) <= {"const", "minLength", "format"}:
        if isinstance(rest.get("const", ""), str):
            return Text(rest.get("const"), rest.get("minLength"), rest.get("format"))
    if kind == "number" and set(rest) <= {"minimum", "maximum", "exclusiveMinimum"}:
        return Number(rest.get("minimum"), rest.get("maximum"), rest.get("exclusiveMinimum"))
    if kind == "array" and set(rest) <= {"items", "minItems"} and "items" in rest:
        item = _closed(rest["items"])
        if isinstance(item, Object) and all(isinstance(x, (Text, Number)) for x in item.fields.values()):
            return Items(item, rest.get("minItems", 0))
    if kind == "object" and rest.get("additionalProperties") is False and set(rest) <= OBJECT_LIMITS:
        fields = {k: _closed(v) for k, v in rest.get("properties", {}).items()}
        if fields and all(fields.values()) and set(rest.get("required", ())) == set(fields):
            return Object({k: fields[k] for k in rest["required"]})
    return None


def as_schema(spec: Object | Items | Text | Number) -> dict:
    """A closed contract as a JSON Schema document."""
    if isinstance(spec, Object):
        fields = {k: as_schema(v) for k, v in spec.fields.items()}
        return {"type": "object", "additionalProperties": False, "required": list(fields), "properties": fields}
    if isinstance(spec, Items):
        return {"type": "array", "items": as_schema(spec.item), "minItems": spec.min_items}
    if isinstance(spec, Text):
        found = {"const": spec.const, "minLength": spec.min_length, "format": spec.form}
    else:
        found = {"minimum": spec.minimum, "maximum": spec.maximum, "exclusiveMinimum": spec.above}
    return {"type": spec.json_name, **{k: v for k, v in found.items() if v is not None}}


def schema_violations(
    raw: DataFrame,
    schema: str | dict,
    payload: str = "raw_payload",
    keep: Sequence[str] = ("source_file", "payload_sha256"),
) -> DataFrame:
    """Every violation of a JSON Schema document in ``payload``, with the ``keep`` columns of its row.

    Narrow: no shuffle, one parse. The columns are those of ``contract_violations``, as is what counts as one
    document. Patterns may match anywhere in a text, as the schema language has it. Alternatives that all
    fail are one violation at their place. Null payloads are not JSON.
    """
    whole = compiled(schema)
    spec = closed(whole)
    return contract_violations(raw, spec, payload, keep) if spec else tree_violations(raw, whole, payload, keep)


def tree_violations(raw: DataFrame, schema: dict | bool, payload: str, keep: Sequence[str]) -> DataFrame:
    """The same for any compiled schema."""
    parsed = one_document(raw, payload, keep)
    places = _Places()
    arrays = _checks(schema, places.root(schema))
    unreadable = F.array(_violation(F.lit(ROOT), "json", F.lit("not exactly one JSON document")))
    every = F.concat(F.array().cast(f"array<{VIOLATION}>"), *arrays)
    found = F.when(F.col("_single"), every).otherwise(unreadable)
    looked_up = parsed.select(*keep, "_single", WRAPPED, *places.values)
    looked_up = looked_up.select("*", *places.kinds, *places.keys)
    # Checks that hold leave a NULL, dropped after the explode: a lambda that drops them would have all
    # checks interpreted. The outer form adds no size filter, which would repeat all checks.
    return (
        looked_up.select(*keep, found.alias("_found"))
        .select(*keep, F.explode_outer("_found").alias("_violation"))
        .filter("_violation IS NOT NULL")
        .select(*keep, "_violation.*")
    )


class _Place:
    """A value in the document: its variant, the kind of it (NULL if absent), an object's keys, and its path as text."""

    def __init__(
        self, value: Column, kind: Column, keys: Callable[[], Column], path: Column, top: bool,
        below: Callable[[str, dict | bool], _Place] | None,
    ):
        self.value, self.kind, self.keys, self.path, self.top, self._below = value, kind, keys, path, top, below

    def typed(self, name: str) -> Column:
        return F.try_variant_get(self.value, "$", name)

    def number(self) -> Column:
        """A number as a double, by way of its text: a variant's decimal is cast by an expression made for each value."""
        return F.to_json(self.value).try_cast("double")

    def is_kind(self, name: str) -> Column:
        if name in ("object", "array"):
            return self.kind.startswith(f"{name.upper()}<")
        if name == "integer":  # 2.0 is one
            whole = self.number()
            return self.is_kind("number") & (whole == F.floor(whole))
        if name == "number":
            return self.kind.isin("BIGINT", "DOUBLE", "FLOAT") | self.kind.startswith("DECIMAL")
        return self.kind == {"null": "VOID", "boolean": "BOOLEAN", "string": "STRING"}[name]

    def below(self, key: str, schema: dict | bool) -> _Place:
        if self._below is not None:
            return self._below(key, schema)
        return _inner(F.try_variant_get(self.value, f"$['{_quoted(key)}']", "variant"), self.path_of(F.lit(key)))

    def path_of(self, key: Column) -> Column:
        return key if self.top else F.concat(self.path, F.lit("."), key)

    def shown_path(self) -> Column:
        return F.lit(ROOT) if self.top else self.path


def _quoted(key: str) -> str:
    if "'" in key or "\\" in key:
        raise ValueError(f"A key with a quote or a backslash is not supported: {key!r}")
    return key


def _inner(value: Column, path: Column) -> _Place:
    return _Place(value, F.schema_of_variant(value), lambda: _keys(value), path, False, None)


class _Places:
    """Places that do not depend on list items: each is looked up once, as a column.

    Where an object is expected, that column has its keys. A copy of the object itself, with all below it, is
    only made to say what else stands there.
    """

    def __init__(self) -> None:
        self.values: list[Column] = []
        self.kinds: list[Column] = []
        self.keys: list[Column] = []
        self._known: dict[tuple[str, ...], _Place] = {}

    def root(self, schema: dict | bool) -> _Place:
        return self._at((), schema)

    def _at(self, keys: tuple[str, ...], schema: dict | bool) -> _Place:
        if keys not in self._known:
            n = len(self.values)
            steps = "$[0]" + "".join(f"['{_quoted(key)}']" for key in keys)
            value = F.try_variant_get(WRAPPED, steps, "variant")
            if isinstance(schema, dict) and (schema.get("type") == "object" or OBJECT_LIMITS & set(schema)):
                known = F.col(f"_keys_{n}")
                self.values.append(F.map_keys(F.try_variant_get(WRAPPED, steps, KEYS_ONLY)).alias(f"_keys_{n}"))
                keys_of = lambda: known
                kind = F.when(known.isNotNull(), "OBJECT<>").otherwise(F.schema_of_variant(value))
            else:
                self.values.append(value.alias(f"_value_{n}"))
                value = F.col(f"_value_{n}")
                keys_of = lambda: self._keys_of(n)
                kind = F.schema_of_variant(value)
            self.kinds.append(kind.alias(f"_kind_{n}"))
            self._known[keys] = _Place(
                value, F.col(f"_kind_{n}"), keys_of, F.lit(".".join(keys)), not keys,
                lambda key, below: self._at((*keys, key), below),
            )
        return self._known[keys]

    def _keys_of(self, n: int) -> Column:
        name = f"_keys_{n}_{len(self.keys)}"
        self.keys.append(_keys(F.col(f"_value_{n}")).alias(name))
        return F.col(name)


def _checks(schema: dict | bool, place: _Place) -> list[Column]:
    """Arrays of violations in path order, with a NULL for every check that holds."""
    there, path = place.kind.isNotNull(), place.shown_path()
    if isinstance(schema, bool):
        wrong = [] if schema else [_where(there, path, "false", _said(place.value, "is not allowed"))]
        return [F.array(*wrong)] if wrong else []
    own = [*_value_checks(schema, place), *_combined_checks(schema, place)]
    below = [array for part in schema.get("allOf", []) for array in _checks(part, place)]
    if OBJECT_LIMITS & set(schema):
        own += _object_checks(schema, place)
        for key, inside in sorted(schema.get("properties", {}).items()):
            below += _checks(inside, place.below(key, inside))
        if isinstance(schema.get("additionalProperties"), dict):
            below.append(_additional_checks(schema, place))
    if "items" in schema:
        below.append(_item_checks(schema["items"], place))
    return ([F.array(*own)] if own else []) + below


def _value_checks(schema: dict, place: _Place) -> list[Column]:
    there, path, value = place.kind.isNotNull(), place.shown_path(), place.value
    found = []

    def add(rule: str, broken: Column, text: str) -> None:
        found.append(_where(there & broken, path, rule, _said(value, text)))

    if "type" in schema:
        kinds = [schema["type"]] if isinstance(schema["type"], str) else schema["type"]
        right = place.is_kind(kinds[0])
        for kind in kinds[1:]:
            right = right | place.is_kind(kind)
        add("type", ~right, f"is not of type {', '.join(map(repr, kinds))}")
    if "const" in schema:
        add("const", ~_equals(place, schema["const"]), f"is not {_spelled(schema['const'])}")
    if "enum" in schema:
        hit = F.lit(False)
        for value_ in schema["enum"]:
            hit = hit | _equals(place, value_)
        add("enum", ~hit, f"is not one of [{', '.join(map(_spelled, schema['enum']))}]")
    text, number = place.typed("string"), place.number()
    if TEXT_LIMITS & set(schema):
        is_text = place.is_kind("string")
        for rule, holds, said in (
            ("minLength", lambda x: F.length(text) >= x, "is too short"),
            ("maxLength", lambda x: F.length(text) <= x, "is too long"),
            ("pattern", lambda x: text.rlike(x), None),
            ("format", lambda x: FORMS[x](text), None),
        ):
            if rule in schema:
                said = said or (f"does not match '{schema[rule]}'" if rule == "pattern" else f"is not a '{schema[rule]}'")
                add(rule, is_text & ~holds(schema[rule]), said)
    if NUMBER_LIMITS & set(schema):
        is_number = place.is_kind("number")
        for rule, holds, said in (
            ("minimum", lambda x: number >= x, "is less than the minimum of"),
            ("exclusiveMinimum", lambda x: number > x, "is less than or equal to the exclusive minimum of"),
            ("maximum", lambda x: number <= x, "is greater than the maximum of"),
            ("exclusiveMaximum", lambda x: number < x, "is greater than or equal to the exclusive maximum of"),
            ("multipleOf", lambda x: (number / x) == F.floor(number / x), "is not a multiple of"),
        ):
            if rule in schema:
                add(rule, is_number & ~holds(schema[rule]), f"{said} {schema[rule]}")
    if LIST_LIMITS & set(schema):
        size = F.array_size(place.typed("array<variant>"))
        if "minItems" in schema:
            add("minItems", place.is_kind("array") & (size < schema["minItems"]), "has too few items")
        if "maxItems" in schema:
            add("maxItems", place.is_kind("array") & (size > schema["maxItems"]), "has too many items")
    return found


def _spelled(value) -> str:
    return f"'{value}'" if isinstance(value, str) else json.dumps(value)


def _equals(place: _Place, value) -> Column:
    if value is None:
        return place.is_kind("null")
    if isinstance(value, bool):
        return place.is_kind("boolean") & (place.typed("boolean") == value)
    if isinstance(value, str):
        return place.is_kind("string") & (place.typed("string") == value)
    return place.is_kind("number") & (place.number() == float(value))


def _combined_checks(schema: dict, place: _Place) -> list[Column]:
    there, path, value = place.kind.isNotNull(), place.shown_path(), place.value

    def holds(part) -> Column:
        arrays = _checks(part, place)
        if not arrays:
            return F.lit(True)
        return ~F.exists(F.concat(*arrays), lambda x: x.isNotNull())

    found = []
    if "anyOf" in schema:
        hit = F.lit(False)
        for part in schema["anyOf"]:
            hit = hit | holds(part)
        found.append(_where(there & ~hit, path, "anyOf", _said(value, "is not valid under any of the given schemas")))
    if "oneOf" in schema:
        hits = F.lit(0)
        for part in schema["oneOf"]:
            hits = hits + holds(part).cast("int")
        found.append(_where(there & (hits != 1), path, "oneOf", _said(value, "is not valid under exactly one of the given schemas")))
    if "not" in schema:
        found.append(_where(there & holds(schema["not"]), path, "not", _said(value, "is valid under a schema that it should not match")))
    return found


def _entries(place: _Place) -> Column:
    return place.typed("map<string, variant>")


def _object_checks(schema: dict, place: _Place) -> list[Column]:
    path, keys = place.shown_path(), place.keys()
    found = []
    if schema.get("additionalProperties") is False:
        allowed = F.array(*(F.lit(k) for k in schema.get("properties", {}))).cast("array<string>")
        extra = F.array_except(keys, allowed)
        named = F.concat(F.lit("'"), F.array_join(F.sort_array(extra), "', '"), F.lit("'"))
        said = F.concat(F.lit("Additional properties are not allowed: "), named)
        found.append(_where(F.array_size(extra) > 0, path, "additionalProperties", said))
    for key in schema.get("required", []):
        said = F.lit(f"'{key}' is a required property")
        found.append(_where(~F.array_contains(keys, key), path, "required", said))
    return found


def _whole(arrays: list[Column]) -> Column:
    return F.filter(F.concat(F.array().cast(f"array<{VIOLATION}>"), *arrays), lambda x: x.isNotNull())


def _additional_checks(schema: dict, place: _Place) -> Column:
    """The checks of every key that has none of its own."""
    own = list(schema.get("properties", {}))
    others = F.filter(F.map_entries(_entries(place)), lambda e: ~e["key"].isin(own) if own else F.lit(True))
    inside = F.transform(
        others, lambda e: _whole(_checks(schema["additionalProperties"], _inner(e["value"], place.path_of(e["key"]))))
    )
    return F.coalesce(F.flatten(inside), F.array().cast(f"array<{VIOLATION}>"))


def _item_checks(schema: dict | bool, place: _Place) -> Column:
    items = F.when(place.is_kind("array"), place.typed("array<variant>"))
    spec = _closed({"type": "array", "items": schema})
    if spec is not None:
        # Items of a list that holds together are not opened.
        holds = F.forall(place.typed(spec.type_name), lambda item: _item_holds(spec.item, item))
        items = F.when(~F.coalesce(place.kind.rlike(f"^{spec.shape}$") & holds, F.lit(False)), items)
    inside = F.transform(
        items, lambda item, at: _whole(_checks(schema, _inner(item, place.path_of(at.cast("string")))))
    )
    return F.coalesce(F.flatten(inside), F.array().cast(f"array<{VIOLATION}>"))
