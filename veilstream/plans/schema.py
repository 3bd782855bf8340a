"""Clean schemas, derived from raw schemas and a policy before any record is read, and a store of their versions."""

from __future__ import annotations

import json
import os
from copy import deepcopy
from dataclasses import dataclass
from typing import Any

from pyarrow import fs as pafs
from pyspark.sql import types as T

from ..functions.keyed import Keys
from ..operators.deid import DROPPED, Built, build
from . import avro
from . import policy as P


class SchemaError(Exception):
    """A raw schema the policy cannot be applied to."""


class UncoveredColumns(SchemaError):
    """Columns nobody reviewed; all of them are named."""


class UnknownColumns(SchemaError):
    """Rules for columns the table does not have."""


@dataclass(frozen=True)
class RowPlan:
    """What happens to each column of a table, in the table's order."""

    table: str
    built: tuple[Built, ...]

    @property
    def kept(self) -> tuple[Built, ...]:
        return tuple(b for b in self.built if b.clean is not DROPPED)

    def clean_fields(self) -> list[dict]:
        return [{"name": b.rule.column, "type": b.clean} for b in self.kept]

    def spark_schema(self) -> T.StructType:
        return T.StructType([avro.spark_field(b.rule.column, b.clean) for b in self.kept])


def plan_row(fields: list[dict], policy: P.Policy, table: str, keys: Keys) -> RowPlan:
    """Bind every column to its rule.

    A column without a rule halts the table (all such columns are named) or is left out, as the policy
    says; a rule without a column is an error; the order of columns stays.
    """
    rules = policy.table(table).rules
    names = [f["name"] for f in fields]
    if ghosts := [c for c in rules if c not in names]:
        raise UnknownColumns(f"{table}: rules for columns that do not exist: {', '.join(ghosts)}")
    bare = [n for n in names if n not in rules]
    if bare and policy.on_uncovered_column == P.HALT:
        raise UncoveredColumns(f"{table}: columns without a rule: {', '.join(bare)}")
    return RowPlan(table, tuple(build(rules[f["name"]], f["type"], keys) for f in fields if f["name"] in rules))


def plan_table(schema: T.StructType, policy: P.Policy, table: str, keys: Keys) -> RowPlan:
    """plan_row for a Spark schema."""
    return plan_row([{"name": f.name, "type": avro.avro_type(f)} for f in schema.fields], policy, table, keys)


# --- Avro envelopes ------------------------------------------------------------------------------


def _full(name: str, space: str | None) -> str:
    return name if "." in name or not space else f"{space}.{name}"


def definitions(schema: Any, space: str | None = None, found: dict | None = None) -> dict[str, dict]:
    """Named types by full name; a name defined twice is an error."""
    found = {} if found is None else found
    if isinstance(schema, list):
        for b in schema:
            definitions(b, space, found)
    elif isinstance(schema, dict):
        kind = schema.get("type")
        if kind in ("record", "enum", "fixed"):
            space = schema.get("namespace", space)
            full = _full(schema["name"], space)
            if full in found:
                raise SchemaError(f"the name {full} is defined twice")
            found[full] = schema
        for f in schema.get("fields", ()):
            definitions(f["type"], space, found)
        for k in ("items", "values"):
            if k in schema:
                definitions(schema[k], space, found)
        if isinstance(kind, (dict, list)):
            definitions(kind, space, found)
    return found


def references(schema: Any, space: str | None = None) -> list[str]:
    """Full names that are referred to, in order."""
    if isinstance(schema, str):
        return [] if schema in avro.PRIMITIVES else [_full(schema, space)]
    if isinstance(schema, list):
        return [r for b in schema for r in references(b, space)]
    kind = schema.get("type")
    if kind in ("record", "enum", "fixed"):
        space = schema.get("namespace", space)
        return [r for f in schema.get("fields", ()) for r in references(f["type"], space)]
    if kind == "array":
        return references(schema["items"], space)
    if kind == "map":
        return references(schema["values"], space)
    return references(kind, space)


def check_names(schema: Any) -> None:
    """Every name is defined once and every reference has its definition."""
    known = definitions(schema)
    if lost := [r for r in references(schema) if r not in known]:
        raise SchemaError(f"names without a definition: {', '.join(sorted(set(lost)))}")


def _moved(schema: Any, old: str, new: str) -> Any:
    """The schema with one namespace (and names in it) changed."""
    if isinstance(schema, str):
        return new + schema[len(old):] if schema == old or schema.startswith(old + ".") else schema
    if isinstance(schema, list):
        return [_moved(b, old, new) for b in schema]
    if isinstance(schema, dict):
        out = {}
        for k, v in schema.items():
            if k in ("namespace", "connect.name", "name", "type", "items", "values"):
                out[k] = _moved(v, old, new)
            elif k == "fields":
                out[k] = [{**f, "type": _moved(f["type"], old, new)} for f in v]
            else:
                out[k] = v
        return out
    return schema


def _fitting_default(field: dict, clean: Any) -> dict:
    """A field with its attributes and the type ``clean``; nullable fields default to null, others keep what fits."""
    out = {k: v for k, v in field.items() if k not in ("type", "default")}
    out["type"] = clean
    if avro.is_union(clean) and avro.base(clean[0]) == "null":
        out["default"] = None
    elif "default" in field and avro.conforms(field["default"], avro.branches(clean)[0]):
        out["default"] = field["default"]
    return out


def derive_clean_schema(envelope: dict, policy: P.Policy, table: str, keys: Keys, namespace: tuple[str, str] | None = None) -> dict:
    """The clean envelope of a raw one: before and after changed by the policy, all else as it was.

    The row image is defined once and referred to from the other side.  ``namespace`` (old, new) moves names.
    """
    check_names(envelope)
    if avro.base(envelope) != "record":
        raise SchemaError("an envelope is a record")
    sides = {f["name"]: f for f in envelope["fields"]}
    for need in ("before", "after", "source", "op"):
        if need not in sides:
            raise SchemaError(f"an envelope has the field {need!r}")
    known = definitions(envelope)
    space = envelope.get("namespace")
    image, shape = {}, {}
    for side in ("before", "after"):
        inner = avro.non_null(sides[side]["type"])
        if isinstance(inner, str):
            image[side] = _full(inner, space)
        elif isinstance(inner, dict) and inner.get("type") == "record":
            image[side] = _full(inner["name"], inner.get("namespace", space))
        else:
            raise SchemaError(f"{side} is no record")
        shape[side] = avro.is_nullable(sides[side]["type"])
    if image["before"] != image["after"]:
        raise SchemaError("before and after are different records")
    record = known[image["before"]]
    plan = plan_row(record["fields"], policy, table, keys)
    clean_by = {b.rule.column: b.clean for b in plan.kept}
    row = {**record, "fields": [_fitting_default(f, clean_by[f["name"]]) for f in record["fields"] if f["name"] in clean_by]}
    fields, defined = [], False
    for f in envelope["fields"]:
        if f["name"] in ("before", "after"):
            inner = image["before"] if defined else row
            defined = True
            fields.append({**f, "type": ["null", inner] if shape[f["name"]] else inner})
        else:
            fields.append(f)
    out = deepcopy({**envelope, "fields": fields})
    if namespace:
        out = _moved(out, *namespace)
    check_names(out)
    return out


def same_schema(a: Any, b: Any) -> bool:
    """Equal but for how references are spelled: full and relative names are the same."""

    def resolved(s: Any, space: str | None = None) -> Any:
        if isinstance(s, str):
            return s if s in avro.PRIMITIVES else _full(s, space)
        if isinstance(s, list):
            return [resolved(x, space) for x in s]
        if isinstance(s, dict):
            own = s.get("namespace", space) if s.get("type") in ("record", "enum", "fixed") else space
            out = {k: v for k, v in s.items() if k not in ("namespace", "fields", "items", "values", "type", "name")}
            if s.get("type") in ("record", "enum", "fixed"):
                out["name"] = _full(s["name"], own)
                out["type"] = s["type"]
            elif "type" in s:
                out["type"] = resolved(s["type"], own)
            if "fields" in s:
                out["fields"] = [{**f, "type": resolved(f["type"], own)} for f in s["fields"]]
            for k in ("items", "values"):
                if k in s:
                    out[k] = resolved(s[k], own)
            return out
        return s

    return resolved(a) == resolved(b)


def dropped_columns(raw: list[dict], clean: list[dict]) -> list[str]:
    """Columns of the raw row that the clean row lacks."""
    left = {f["name"] for f in clean}
    return [f["name"] for f in raw if f["name"] not in left]


def row_fields(envelope: dict) -> list[dict]:
    """The fields of an envelope's row image."""
    known = definitions(envelope)
    inner = avro.non_null(next(f["type"] for f in envelope["fields"] if f["name"] == "after"))
    if isinstance(inner, dict):
        return inner["fields"]
    return known[_full(inner, envelope.get("namespace"))]["fields"]


def contradictions(registered: dict, raw: dict, policy: P.Policy, table: str, keys: Keys, namespace: tuple[str, str] | None = None) -> list[str]:
    """What a registered clean schema and the one derived from the raw schema disagree in; empty when all is well.

    Of the raw columns exactly those the policy drops must be absent, no other may be added, and the whole must
    equal what is derived.
    """
    derived = derive_clean_schema(raw, policy, table, keys, namespace)
    before, now, want = row_fields(raw), row_fields(registered), row_fields(derived)
    names = [f["name"] for f in now]
    out = [f"column {n} is dropped by the policy but registered" for n in dropped_columns(before, want) if n in names]
    out += [f"column {n} is kept by the policy but not registered" for n in (f["name"] for f in want) if n not in names]
    out += [f"column {n} is registered but not in the source" for n in names if n not in {f["name"] for f in before}]
    types = {f["name"]: f for f in want}
    out += [f"column {f['name']} is registered with another type or default" for f in now if f["name"] in types and not same_schema({"type": "record", "name": "r", "fields": [f]}, {"type": "record", "name": "r", "fields": [types[f["name"]]]})]
    if not out and not same_schema(registered, derived):
        out.append("the registered schema is another one than the derived")
    return out


class SchemaStore:
    """Versions of schemas by subject, as JSON files in a folder: a path, or a URI of any file system pyarrow knows (hdfs, s3, gs)."""

    def __init__(self, folder: str):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), os.path.abspath(folder))
        self.fs.create_dir(self.folder, recursive=True)

    def _names(self) -> list[str]:
        return [f.base_name for f in self.fs.get_file_info(pafs.FileSelector(self.folder)) if f.is_file]

    def _files(self, subject: str) -> list[str]:
        head = subject.replace("/", "_") + ".v"
        return sorted((f for f in self._names() if f.startswith(head) and f[len(head):-5].isdigit()), key=lambda f: int(f[len(head):-5]))

    def register(self, subject: str, schema: Any) -> int:
        """Version of the schema; an equal newest one is not stored again."""
        check_names(schema)
        files = self._files(subject)
        if files and same_schema(self.get(subject), schema):
            return len(files)
        with self.fs.open_output_stream(f"{self.folder}/{subject.replace('/', '_')}.v{len(files) + 1}.json") as f:
            f.write(json.dumps(schema, ensure_ascii=False, indent=1).encode())
        return len(files) + 1

    def get(self, subject: str, version: int | None = None) -> Any:
        files = self._files(subject)
        if not files or (version is not None and not 1 <= version <= len(files)):
            raise KeyError(f"no such schema: {subject}" + (f" version {version}" if version else ""))
        with self.fs.open_input_stream(f"{self.folder}/{files[(version or len(files)) - 1]}") as f:
            return json.loads(f.read())

    def subjects(self) -> list[str]:
        return sorted({f.rsplit(".v", 1)[0] for f in self._names()})

    def delete(self, subject: str) -> int:
        files = self._files(subject)
        for f in files:
            self.fs.delete_file(f"{self.folder}/{f}")
        return len(files)
