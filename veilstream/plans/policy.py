"""The policy language: one operation per column, read from strict YAML and checked before any data is seen."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping
from dataclasses import MISSING, dataclass, field, fields
from types import MappingProxyType
from typing import Any, ClassVar

import yaml

from ..functions.synthetic import KINDS

#: Parts of an envelope no rule may address.
RESERVED = frozenset({"source", "op", "ts_ms", "transaction"})
HALT, DROP = "halt_topic", "drop_column"
TARGETS = ("zip3", "icd10_category", "year", "month", "birth_year", "age_band")
CAPPED = ("birth_year", "age_band")
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*\Z")
_TABLE = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*\.[A-Za-z_][A-Za-z0-9_$]*\Z")


class PolicyError(Exception):
    """A policy that cannot be used; the text says file, table, column and problem, as far as they are known."""

    def __init__(self, problem: str, source: str | None = None, table: str | None = None, column: str | None = None):
        self.problem, self.source, self.table, self.column = problem, source, table, column
        where = ".".join(x for x in (table, column) if x)
        super().__init__(": ".join(x for x in (source, where, problem) if x))


class Malformed(PolicyError):
    """Not the shape of a policy."""


class DuplicateKey(PolicyError):
    """A key written twice, of which YAML would keep one."""


class UnknownOp(PolicyError):
    """No such operation."""


class MissingArgument(PolicyError):
    """An argument the operation needs."""


class UnknownArgument(PolicyError):
    """An argument the operation does not take."""


class InvalidArgument(PolicyError):
    """An argument that cannot be used."""


class ReservedField(PolicyError):
    """A rule for a part of the envelope."""


@dataclass(frozen=True)
class Op:
    """An operation; its dataclass fields are its arguments."""

    name: ClassVar[str]

    def problem(self) -> str | None:
        """What is wrong with the arguments' values."""

    def problem_among(self, column: str, rules: Mapping[str, Rule]) -> str | None:
        """What is wrong with the rule beside the table's other rules."""


@dataclass(frozen=True)
class Passthrough(Op):
    name = "passthrough"


@dataclass(frozen=True)
class Drop(Op):
    name = "drop"


@dataclass(frozen=True)
class Null(Op):
    name = "null"


@dataclass(frozen=True)
class Redact(Op):
    name = "redact"
    value: str = "[redacted]"

    def problem(self):
        return None if self.value else "value must not be empty"


@dataclass(frozen=True)
class Hmac(Op):
    name = "hmac"
    domain: str

    def problem(self):
        return None if self.domain.strip() else "domain must not be empty"


@dataclass(frozen=True)
class Fake(Op):
    name = "fake"
    kind: str

    def problem(self):
        return None if self.kind in KINDS else f"unknown kind {self.kind!r}; known are {', '.join(KINDS)}"


@dataclass(frozen=True)
class Generalize(Op):
    name = "generalize"
    to: str
    cap_age: int | None = None

    def problem(self):
        if self.to not in TARGETS:
            return f"unknown target {self.to!r}; known are {', '.join(TARGETS)}"
        if self.cap_age is not None and not 1 <= self.cap_age <= 120:
            return "cap_age must lie between 1 and 120"


@dataclass(frozen=True)
class Anchored(Op):
    anchor: str

    def problem(self):
        return None if self.anchor.strip() else "anchor must name a column"

    def problem_among(self, column, rules):
        if self.anchor == column:
            return "a column cannot be its own anchor"
        if self.anchor not in rules:
            return f"the anchor {self.anchor!r} has no rule in this table"
        if isinstance(rules[self.anchor].op, Anchored):
            return f"the anchor {self.anchor!r} is itself anchored"


@dataclass(frozen=True)
class DateShift(Anchored):
    name = "date_shift"


@dataclass(frozen=True)
class NumericJitter(Anchored):
    name = "numeric_jitter"
    pct: int

    def problem(self):
        return super().problem() or (None if 1 <= self.pct <= 25 else "pct must lie between 1 and 25")


OPS: Mapping[str, type[Op]] = MappingProxyType({c.name: c for c in (Passthrough, Drop, Null, Redact, Hmac, Fake, Generalize, DateShift, NumericJitter)})


@dataclass(frozen=True)
class Rule:
    table: str
    column: str
    op: Op


@dataclass(frozen=True)
class TablePolicy:
    name: str
    rules: Mapping[str, Rule]


@dataclass(frozen=True)
class Policy:
    tables: Mapping[str, TablePolicy]
    on_uncovered_column: str = HALT
    source: str | None = field(default=None, compare=False)

    def table(self, name: str) -> TablePolicy:
        if name not in self.tables:
            raise PolicyError("the policy has no such table", self.source, name)
        return self.tables[name]

    def covers(self, table: str, column: str) -> bool:
        return table in self.tables and column in self.tables[table].rules

    def rule_for(self, table: str, column: str) -> Rule | None:
        return self.tables[table].rules.get(column) if table in self.tables else None

    def all_rules(self) -> Iterator[Rule]:
        for t in self.tables.values():
            yield from t.rules.values()

    def hmac_domains(self) -> dict[str, list[str]]:
        """Which columns share a domain, and so join."""
        out: dict[str, list[str]] = {}
        for r in self.all_rules():
            if isinstance(r.op, Hmac):
                out.setdefault(r.op.domain, []).append(f"{r.table}.{r.column}")
        return out


class _Strict(yaml.SafeLoader):
    """YAML that refuses a key written twice."""


def _mapping(loader: _Strict, node: yaml.MappingNode):
    seen = set()
    for key_node, _ in node.value:
        key = loader.construct_object(key_node)
        if key in seen:
            raise DuplicateKey(f"the key {key!r} is written twice (line {key_node.start_mark.line + 1})")
        seen.add(key)
    return loader.construct_mapping(node, deep=True)


_Strict.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, _mapping)

#: Types of arguments, as their dataclass annotations spell them.
_TYPES = {"str": (str,), "int": (int,), "int | None": (int, type(None))}


def _op(spec: Any, **where) -> Op:
    if not isinstance(spec, dict):
        raise Malformed("a rule must be a mapping with an op", **where)
    if "op" not in spec:
        raise MissingArgument("the rule names no op", **where)
    name = spec["op"]
    if name is None:
        raise InvalidArgument('op is empty; to null a column, write op: "null" in quotes', **where)
    if not isinstance(name, str) or name not in OPS:
        raise UnknownOp(f"unknown op {name!r}; known are {', '.join(OPS)}", **where)
    kind = OPS[name]
    known = {f.name: f for f in fields(kind)}
    given = {k: v for k, v in spec.items() if k != "op"}
    for k in given:
        if k not in known:
            raise UnknownArgument(f"{name} takes no argument {k!r}", **where)
    for k, f in known.items():
        if k not in given:
            if f.default is MISSING:
                raise MissingArgument(f"{name} needs the argument {k!r}", **where)
            continue
        v = given[k]
        if isinstance(v, bool) or not isinstance(v, _TYPES[f.type]):
            raise InvalidArgument(f"{k} of {name} must be {f.type}, not {type(v).__name__}", **where)
    op = kind(**given)
    if isinstance(op, Generalize) and op.cap_age is not None and op.to in TARGETS and op.to not in CAPPED:
        raise UnknownArgument(f"cap_age has no meaning for {op.to}", **where)
    if problem := op.problem():
        raise InvalidArgument(problem, **where)
    return op


def _table(name: Any, spec: Any, source: str | None) -> TablePolicy:
    if not isinstance(name, str) or not _TABLE.match(name):
        raise Malformed(f"{name!r} is no schema.table", source)
    if not isinstance(spec, dict) or not spec:
        raise Malformed("a table must map its columns to rules", source, name)
    rules = {}
    for column, rule in spec.items():
        if not isinstance(column, str):
            raise Malformed(f"{column!r} is no column name", source, name)
        if column.split(".")[0] in RESERVED:
            raise ReservedField("this is a part of the envelope, which is never changed", source, name, column)
        if not _NAME.match(column):
            raise Malformed(f"{column!r} is no column name", source, name)
        rules[column] = Rule(name, column, _op(rule, source=source, table=name, column=column))
    for r in rules.values():
        if problem := r.op.problem_among(r.column, rules):
            raise InvalidArgument(problem, source, name, r.column)
    return TablePolicy(name, MappingProxyType(rules))


def parse_policy(document: Any, source: str | None = None) -> Policy:
    """A policy from the document YAML gives."""
    if document is None:
        raise Malformed("the policy is empty", source)
    if not isinstance(document, dict):
        raise Malformed("a policy must be a mapping", source)
    for k in document:
        if isinstance(k, str) and k.split(".")[0] in RESERVED:
            raise ReservedField(f"{k!r} is a part of the envelope, which is never changed", source)
        if k not in ("on_uncovered_column", "tables"):
            raise Malformed(f"unknown key {k!r}", source)
    uncovered = document.get("on_uncovered_column", HALT)
    if uncovered not in (HALT, DROP):
        raise InvalidArgument(f"on_uncovered_column must be {HALT} or {DROP}; a column nobody reviewed never passes through", source)
    if "tables" not in document:
        raise Malformed("the policy has no tables", source)
    tables = document["tables"]
    if not isinstance(tables, dict):
        raise Malformed("tables must be a mapping", source)
    if not tables:
        raise Malformed("the policy covers no table", source)
    return Policy(MappingProxyType({n: _table(n, s, source) for n, s in tables.items()}), uncovered, source)


def load_policy(path: str) -> Policy:
    try:
        with open(path, encoding="utf-8") as f:
            return read_policy(f.read(), path)
    except OSError as e:
        raise Malformed(f"cannot be read: {e.strerror}", path) from e


def read_policy(text: str, source: str | None = None) -> Policy:
    try:
        document = yaml.load(text, _Strict)  # noqa: S506  (a SafeLoader)
    except DuplicateKey as e:
        raise DuplicateKey(e.problem, source) from None
    except yaml.YAMLError as e:
        raise Malformed(f"no valid YAML: {e}", source) from e
    return parse_policy(document, source)


def main(argv: list[str] | None = None) -> int:
    """Check a policy file and print its rules and domains."""
    args = sys.argv[1:] if argv is None else argv
    if len(args) != 1:
        print("python -m veilstream.plans.policy FILE", file=sys.stderr)
        return 2
    try:
        p = load_policy(args[0])
    except PolicyError as e:
        print(e, file=sys.stderr)
        return 1
    for r in p.all_rules():
        print(f"{r.table}.{r.column}: {r.op}")
    for d, columns in p.hmac_domains().items():
        print(f"domain {d}: {', '.join(columns)}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
