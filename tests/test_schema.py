import json

import pytest

from veilstream.functions.keyed import Keys
from veilstream.plans import avro, schema
from veilstream.plans.policy import parse_policy

KEYS = Keys(bytes(16))
ROW = {
    "type": "record", "name": "Value", "namespace": "raw.public.t",
    "fields": [
        {"name": "id", "type": "long", "doc": "key"}, {"name": "name", "type": ["null", "string"], "default": None}, {"name": "zip", "type": "string", "default": "x"},
        {"name": "at", "type": {"type": "string", "connect.name": avro.ZONED}}, {"name": "ssn", "type": ["null", "string"], "default": None},
    ],
}
ENVELOPE = {
    "type": "record", "name": "Envelope", "namespace": "raw.public.t",
    "fields": [
        {"name": "before", "type": ["null", ROW], "default": None}, {"name": "after", "type": ["null", "Value"], "default": None},
        {"name": "source", "type": {"type": "record", "name": "Source", "fields": [{"name": "lsn", "type": ["null", "long"], "default": None}]}}, {"name": "op", "type": "string"}, {"name": "ts_ms", "type": ["null", "long"]},
    ],
}
RULES = {"id": {"op": "hmac", "domain": "p"}, "name": {"op": "fake", "kind": "full_name"}, "zip": {"op": "generalize", "to": "zip3"}, "at": {"op": "date_shift", "anchor": "id"}, "ssn": {"op": "drop"}}


def policy(rules=RULES, uncovered="halt_topic"):
    return parse_policy({"on_uncovered_column": uncovered, "tables": {"public.t": rules}})


def test_clean_envelope():
    clean = schema.derive_clean_schema(ENVELOPE, policy(), "public.t", KEYS)
    row = clean["fields"][0]["type"][1]
    assert [(f["name"], f["type"]) for f in row["fields"]] == [
        ("id", "string"), ("name", ["null", "string"]), ("zip", ["null", "string"]), ("at", ["null", {"type": "string", "connect.name": avro.ZONED}]),
    ]
    assert row["fields"][0]["doc"] == "key" and row["fields"][2]["default"] is None and "default" not in row["fields"][0]
    assert clean["fields"][1]["type"] == ["null", "raw.public.t.Value"]
    assert json.dumps(clean["fields"][2:]) == json.dumps(ENVELOPE["fields"][2:])
    assert schema.dropped_columns(ROW["fields"], row["fields"]) == ["ssn"]


def test_namespace_moves():
    clean = schema.derive_clean_schema(ENVELOPE, policy(), "public.t", KEYS, ("raw.public.t", "clean.public.t"))
    assert clean["namespace"] == "clean.public.t" and clean["fields"][1]["type"][1] == "clean.public.t.Value"


@pytest.mark.parametrize(
    "change,error",
    [
        (lambda e: e["fields"].pop(0), schema.SchemaError),
        (lambda e: e["fields"][1].update(type=["null", "Other"]), schema.SchemaError),
        (lambda e: e["fields"][1].update(type=["null", "Source"]), schema.SchemaError),
        (lambda e: e["fields"][0]["type"][1]["fields"].append({"name": "new", "type": "int"}), schema.UncoveredColumns),
        (lambda e: e["fields"][0]["type"][1]["fields"].pop(1), schema.UnknownColumns),
    ],
)
def test_bad_envelopes(change, error):
    e = json.loads(json.dumps(ENVELOPE))
    change(e)
    with pytest.raises(error):
        schema.derive_clean_schema(e, policy(), "public.t", KEYS)
    with pytest.raises(schema.SchemaError):
        schema.derive_clean_schema(ROW, policy(), "public.t", KEYS)


def test_store(tmp_path):
    store = schema.SchemaStore(str(tmp_path))
    assert store.register("clean.t-value", ENVELOPE) == 1 and store.register("clean.t-value", json.loads(json.dumps(ENVELOPE))) == 1
    full = json.loads(json.dumps(ENVELOPE).replace('["null", "Value"]', '["null", "raw.public.t.Value"]'))
    assert schema.same_schema(full, ENVELOPE) and store.register("clean.t-value", full) == 1
    other = {**ENVELOPE, "doc": "x"}
    assert store.register("clean.t-value", other) == 2 and store.get("clean.t-value", 1) == ENVELOPE and store.get("clean.t-value") == other
    assert store.subjects() == ["clean.t-value"] and store.delete("clean.t-value") == 2
    with pytest.raises(KeyError):
        store.get("clean.t-value")
    with pytest.raises(schema.SchemaError):
        store.register("x", {"type": "record", "name": "A", "fields": [{"name": "f", "type": "B"}]})


FITS = [("x", "string"), (None, ["null", "int"]), (5, "int"), (5, "double"), (2**40, "long"), ([1, None], {"type": "array", "items": ["null", "int"]}), ({"a": 1}, {"type": "map", "values": "int"}), ("A", {"type": "enum", "name": "E", "symbols": ["A"]})]
MISFITS = [(None, "string"), (True, "int"), (2**40, "int"), (1.5, "long"), ("B", {"type": "enum", "name": "E", "symbols": ["A"]}), ({"a": 1, "b": 2}, {"type": "record", "name": "R", "fields": [{"name": "a", "type": "int"}]}), ("x", "Unknown"), (b"ab", {"type": "fixed", "name": "F", "size": 3})]


@pytest.mark.parametrize("value,t", FITS)
def test_conforms(value, t):
    assert avro.conforms(value, t)


@pytest.mark.parametrize("value,t", MISFITS)
def test_does_not_conform(value, t):
    assert not avro.conforms(value, t)


def test_questions():
    assert avro.non_null(["null", "int", "string"]) == ["int", "string"] and avro.nullable("int") == ["null", "int"] and avro.like("int", ["null", "x"]) == ["null", "int"]
    assert avro.logical({"type": "int", "logicalType": "date", "connect.name": avro.DATE}) == avro.DATE
    assert avro.describe(["null", {"type": "long", "connect.name": avro.MICRO}]) == f"null | long ({avro.MICRO})"


def test_registered_against_derived(tmp_path):
    clean = schema.derive_clean_schema(ENVELOPE, policy(), "public.t", KEYS)
    store = schema.SchemaStore(str(tmp_path))
    store.register("clean", clean)
    check = lambda s: schema.contradictions(s, ENVELOPE, policy(), "public.t", KEYS)
    assert check(store.get("clean")) == []
    assert any("ssn is dropped by the policy but registered" in x for x in check(ENVELOPE))
    bent = json.loads(json.dumps(clean))
    fields = schema.row_fields(bent)
    gone = fields.pop()["name"]
    fields.append({"name": "extra", "type": "string"})
    assert check(bent) == [f"column {gone} is kept by the policy but not registered", "column extra is registered but not in the source"]
