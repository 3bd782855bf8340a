"""A timeline of transactions on the clinic, as a ledger.

Every transaction reads what the one before it left, so the planner is sequential and runs on the driver; its
ceilings (transactions, entries, seconds) bound what it holds, and it says which of them it met.  It starts from
the rows of the population, all columns of them.  The ledger is a table like any other.
"""

from __future__ import annotations

import json
import random
from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocabulary import FIRST_NAMES, LAST_NAMES

LEDGER = "history_id bigint, txid bigint, tx_at timestamp, stmt_at timestamp, table_name string, op string, row_id bigint, before_row string, after_row string"


@dataclass(frozen=True)
class Ceilings:
    """``low`` and ``high`` bound the fullest table against what it started with."""

    transactions: int = 2000
    entries: int = 50_000
    seconds: float = 3600.0
    low: float = 0.7
    high: float = 1.4


@dataclass
class Timeline:
    entries: list[tuple]
    rows: dict[str, dict[int, dict]]  # what exists at the end
    shapes: Counter  # transactions of each shape
    none: Counter  # how often a shape had no candidate
    cascaded: Counter  # entries by (table, op) that follow from another delete
    stopped: str  # done, or the ceiling met: transactions, entries, seconds


class Clinic:
    """The state the planner works on, and the entries of the transaction in hand."""

    TABLES = ("providers", "patients", "appointments", "claims", "notes")

    def __init__(self, rng: random.Random, start: dict[str, int]):
        self.rng, self.start = rng, start
        self.rows: dict[str, dict[int, dict]] = {t: {} for t in self.TABLES}
        self.next: dict[str, int] = dict.fromkeys(self.TABLES, 1)
        self.log: list[tuple[str, str, int, dict | None, dict | None]] = []
        self.now = datetime(2026, 1, 1)
        self.cascaded: Counter = Counter()

    def instant(self, days: int = 0) -> str:
        """The time of the transaction in hand, some days later."""
        return (self.now + timedelta(days=days)).isoformat(sep=" ")

    def load(self, table: str, key: int, row: dict) -> None:
        self.rows[table][key] = row
        self.next[table] = max(self.next[table], key + 1)
        self.log.append((table, "I", key, None, dict(row)))

    def insert(self, table: str, **row) -> int:
        key = self.next[table]
        self.next[table] += 1
        row = {**row, "created_at": self.instant(), "updated_at": self.instant()}
        self.rows[table][key] = row
        self.log.append((table, "I", key, None, dict(row)))
        return key

    def update(self, table: str, key: int, **change) -> None:
        before = dict(self.rows[table][key])
        self.rows[table][key].update(change, updated_at=self.instant())
        self.log.append((table, "U", key, before, dict(self.rows[table][key])))

    def delete(self, table: str, key: int) -> None:
        self.log.append((table, "D", key, self.rows[table].pop(key), None))

    def pick(self, table: str, where: Callable[[dict], bool] = lambda r: True) -> int | None:
        keys = [k for k, r in self.rows[table].items() if where(r)]
        return self.rng.choice(keys) if keys else None

    def fill(self) -> float:
        """How full the fullest table is, against what it started with."""
        return max(len(self.rows[t]) / max(1, self.start[t]) for t in self.TABLES)


def _visit(c: Clinic, p: int, v: int) -> int:
    return c.insert(
        "appointments", patient_id=p, provider_id=v, scheduled_at=c.instant(c.rng.randrange(1, 90)), checked_in_at=None, completed_at=None, duration_minutes=c.rng.choice([15, 30, 45]), status="scheduled",
        location_name=c.rng.choice(["Main clinic, room 4", "Lab building", None]), intake_answers=c.rng.choice([None, "{}", '{"smoker":true}']),
    )


def _note(c: Clinic, r: dict, a: int | None, amends: int | None = None) -> int:
    kind = c.rng.choice(["progress", "discharge", "telephone"])
    return c.insert("notes", patient_id=r["patient_id"], provider_id=r["provider_id"], appointment_id=a, amends_note_id=amends, note_type=kind, body=f"Seen for {c.rng.choice(['a cough', 'a rash'])}.", authored_at=c.instant(), signed_at=None, is_amended=False)


def _register(c: Clinic) -> bool:
    v = c.pick("providers")
    if v is None:
        return False
    n = c.next["patients"]
    p = c.insert(
        "patients", mrn=f"MRN-{n:06d}", first_name=c.rng.choice(FIRST_NAMES), middle_name=None, last_name=c.rng.choice(LAST_NAMES), date_of_birth=f"{c.rng.randrange(1940, 2020)}-0{c.rng.randrange(1, 10)}-15", ssn=None,
        email=f"u{n}@example.com", phone=None, address_line1=f"{c.rng.randrange(1, 999)} Linden Road", address_line2=None, city="Granby", state=c.rng.choice("PA OH NC CO".split()), postal_code=f"{c.rng.randrange(100000):05d}",
    )
    a = _visit(c, p, v)
    _note(c, {"patient_id": p, "provider_id": v}, a)
    return True


def _book(c: Clinic) -> bool:
    p, v = c.pick("patients"), c.pick("providers")
    if p is None or v is None:
        return False
    _visit(c, p, v)
    return True


def _check_in(c: Clinic) -> bool:
    a = c.pick("appointments", lambda r: r["status"] == "scheduled")
    if a is None:
        return False
    c.update("appointments", a, status="checked_in", checked_in_at=c.instant())
    return True


def _complete(c: Clinic) -> bool:
    a = c.pick("appointments", lambda r: r["status"] == "checked_in")
    if a is None:
        return False
    r = c.rows["appointments"][a]
    c.update("appointments", a, status="completed", completed_at=c.instant())
    _note(c, r, a)
    c.insert(
        "claims", patient_id=r["patient_id"], appointment_id=a, billed_amount=c.rng.randrange(500_000) / 100, allowed_amount=None, paid_amount=None, patient_responsibility=None, diagnosis_codes=["I10"],
        procedure_code="99213", claim_status="submitted", submitted_at=c.instant(), adjudicated_at=None,
    )
    return True


def _judge(c: Clinic, k: int, status: str) -> None:
    allowed = round(c.rows["claims"][k]["billed_amount"] * c.rng.randrange(60, 101) / 100, 2)
    paid = round(allowed * c.rng.randrange(50, 101) / 100, 2) if status == "paid" else 0.0
    c.update("claims", k, claim_status=status, allowed_amount=allowed, paid_amount=paid, patient_responsibility=round(allowed - paid, 2), adjudicated_at=c.instant())


def _adjudicate(c: Clinic) -> bool:
    k = c.pick("claims", lambda r: r["claim_status"] == "submitted")
    if k is None:
        return False
    _judge(c, k, c.rng.choice(["paid", "denied"]))
    return True


def _batch(c: Clinic) -> bool:
    open_ = [k for k, r in c.rows["claims"].items() if r["claim_status"] == "submitted"]
    if len(open_) < 5:
        return False
    for k in c.rng.sample(open_, min(len(open_), c.rng.randint(5, 20))):
        _judge(c, k, "paid")
    return True


def _amend(c: Clinic) -> bool:
    n = c.pick("notes", lambda r: not r["is_amended"])
    if n is None:
        return False
    r = c.rows["notes"][n]
    _note(c, r, r["appointment_id"], n)
    c.update("notes", n, is_amended=True)
    return True


def _demographics(c: Clinic) -> bool:
    p = c.pick("patients")
    if p is None:
        return False
    n = c.rng.randrange(10**6)
    c.update("patients", p, **c.rng.choice([{"email": f"new{n}@example.com"}, {"phone": f"(304) 555-01{n % 100:02d}"}, {"address_line1": f"{n % 900 + 1} Poplar Row", "postal_code": f"{n % 90_000 + 10_000}"}]))
    return True


def _reschedule(c: Clinic) -> bool:
    a = c.pick("appointments", lambda r: r["status"] == "scheduled")
    if a is None:
        return False
    c.update("appointments", a, scheduled_at=c.instant(c.rng.randrange(1, 90)))
    return True


def _provider(c: Clinic) -> bool:
    v = c.pick("providers")
    if v is None:
        return False
    c.update("providers", v, specialty=c.rng.choice(["cardiology", "oncology", "neurology"]))
    return True


def _hire(c: Clinic) -> bool:
    n = c.next["providers"]
    c.insert("providers", npi=f"{1_000_000_000 + n}", full_name=f"{c.rng.choice(FIRST_NAMES)} {c.rng.choice(LAST_NAMES)}", specialty="cardiology", email=f"p{n}@example.org")
    return True


def _detach(c: Clinic) -> bool:
    """Deletes a visit that has both a claim and a note: claims go with it, notes lose it."""
    with_claim = {r["appointment_id"] for r in c.rows["claims"].values()}
    with_note = {r["appointment_id"] for r in c.rows["notes"].values()}
    both = sorted(a for a in with_claim & with_note if a in c.rows["appointments"])
    if not both:
        return False
    _remove_visit(c, c.rng.choice(both))
    return True


def _remove_visit(c: Clinic, a: int) -> None:
    for k in [k for k, r in c.rows["claims"].items() if r["appointment_id"] == a]:
        c.delete("claims", k)
        c.cascaded["claims", "D"] += 1
    for k in [k for k, r in c.rows["notes"].items() if r["appointment_id"] == a]:
        c.update("notes", k, appointment_id=None)
        c.cascaded["notes", "U"] += 1
    c.delete("appointments", a)


def _purge(c: Clinic) -> bool:
    """Deletes a patient with one to five visits and all that is theirs."""
    n: dict[int, int] = defaultdict(int)
    for r in c.rows["appointments"].values():
        n[r["patient_id"]] += 1
    few = sorted(p for p, k in n.items() if 1 <= k <= 5 and p in c.rows["patients"])
    if not few:
        return False
    p = c.rng.choice(few)
    for a in [k for k, r in c.rows["appointments"].items() if r["patient_id"] == p]:
        _remove_visit(c, a)
        c.cascaded["appointments", "D"] += 1
    for t in ("claims", "notes"):
        for k in [k for k, r in c.rows[t].items() if r["patient_id"] == p]:
            if t == "notes":
                for x in [x for x, r in c.rows[t].items() if r["amends_note_id"] == k and x != k]:
                    c.update(t, x, amends_note_id=None)
                    c.cascaded[t, "U"] += 1
            c.delete(t, k)
            c.cascaded[t, "D"] += 1
    c.delete("patients", p)
    return True


#: name: weight, whether it grows or shrinks the tables, what it does.
SHAPES: dict[str, tuple[float, str, Callable[[Clinic], bool]]] = {
    "register_patient": (4, "insert", _register), "book_appointment": (14, "insert", _book), "check_in": (12, "update", _check_in), "complete_visit": (12, "insert", _complete),
    "adjudicate_claim": (10, "update", _adjudicate), "batch_adjudication": (2, "update", _batch), "amend_note": (5, "insert", _amend), "correct_demographics": (10, "update", _demographics),
    "reschedule": (8, "update", _reschedule), "update_provider": (2, "update", _provider), "hire_provider": (0.5, "insert", _hire), "detach_appointment": (4, "delete", _detach), "purge_patient": (1.5, "delete", _purge),
}


def _weights(fill: float, limits: Ceilings) -> list[float]:
    """Inserts stop at the upper bound and deletes at the lower, each fading towards it."""
    room = (limits.high - fill) / (limits.high - 1)
    spare = (fill - limits.low) / (1 - limits.low)
    factor = {"insert": min(1.0, max(0.0, room)), "delete": min(1.0, max(0.0, spare)), "update": 1.0}
    return [w * factor[kind] for w, kind, _ in SHAPES.values()]


def plan(
    seed: int = 42, transactions: int = 200, start: dict[str, dict[int, dict]] | None = None, limits: Ceilings = Ceilings(), begins: datetime = datetime(2026, 1, 1), rate: float = 2.0,
) -> Timeline:
    """The timeline of a seed: ``rate`` transactions a second from ``begins``.

    The first transactions load the rows of ``start`` (by table and key; a small clinic of its own without), one
    for each table.  Then every shape is tried once, and after that shapes are drawn by weight.  A shape without a
    candidate leaves no trace; each transaction has one instant of its own, and its statements follow each other
    within it.  At a ceiling the timeline ends, and ``stopped`` names it.
    """
    c = Clinic(random.Random(seed), {})
    got = Timeline([], c.rows, Counter(), Counter(), c.cascaded, "done")
    tx = 0

    def commit() -> None:
        nonlocal tx
        tx += 1
        for k, (table, op, key, before, after) in enumerate(c.log):
            got.entries.append((len(got.entries) + 1, tx, c.now, c.now + timedelta(microseconds=k), table, op, key, *(None if r is None else json.dumps(r, sort_keys=True) for r in (before, after))))
        c.log.clear()

    def clock() -> None:
        step = 1 / rate
        c.now = begins + timedelta(seconds=step * (tx + 1) + c.rng.random() * step * 0.8)

    clock()
    if start is None:
        for shape, n in ((_hire, 4), (_register, 30), (_book, 30)):
            for _ in range(n):
                shape(c)
                commit()
                clock()
    else:
        for table in Clinic.TABLES:
            for key, row in sorted(start.get(table, {}).items()):
                c.load(table, key, dict(row))
            if c.log:
                commit()
                clock()
    c.start = {t: len(c.rows[t]) for t in Clinic.TABLES}
    first, names = list(SHAPES), list(SHAPES)
    for n in range(transactions):
        if n >= limits.transactions:
            got.stopped = "transactions"
        elif len(got.entries) >= limits.entries:
            got.stopped = "entries"
        elif (c.now - begins).total_seconds() >= limits.seconds:
            got.stopped = "seconds"
        if got.stopped != "done":
            break
        name = first.pop(0) if first else c.rng.choices(names, _weights(c.fill(), limits))[0]
        if SHAPES[name][2](c):
            if not c.log:
                raise RuntimeError(f"{name} changed something without an entry")
            got.shapes[name] += 1
            commit()
        else:
            got.none[name] += 1
        clock()
    return got


def start_rows(tables: dict[str, DataFrame]) -> dict[str, dict[int, dict]]:
    """The rows of a population by table and key.  They come to the driver, where the planner works: their number is the population's."""
    out = {}
    for name, df in tables.items():
        key = df.columns[0]
        rest = [c for c in df.columns if c != key]
        out[name] = {r[key]: json.loads(r["_row"]) for r in df.select(key, F.to_json(F.struct(*rest), {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd HH:mm:ss"}).alias("_row")).collect()}
    return out


def ledger(spark: SparkSession, timeline: Timeline) -> DataFrame:
    """A timeline as a ledger."""
    return spark.createDataFrame(timeline.entries, LEDGER)


def state(spark: SparkSession, timeline: Timeline) -> DataFrame:
    """What exists at its end: table_name, row_id, after_row."""
    rows = [(t, k, json.dumps(r, sort_keys=True)) for t, rs in timeline.rows.items() for k, r in rs.items()]
    return spark.createDataFrame(rows, "table_name string, row_id bigint, after_row string")


def report(spark: SparkSession, timeline: Timeline) -> DataFrame:
    """counter, name, n: transactions by shape, shapes without a candidate, cascaded entries by table and operation."""
    rows = [("shape", k, n) for k, n in timeline.shapes.items()] + [("none", k, n) for k, n in timeline.none.items()] + [("cascaded", f"{t} {op}", n) for (t, op), n in timeline.cascaded.items()]
    return spark.createDataFrame(sorted(rows), "counter string, name string, n bigint")


def violations(spark: SparkSession, timeline: Timeline, limits: Ceilings = Ceilings()) -> DataFrame:
    """check, n_bad: what of a timeline is not as promised; all 0."""
    rows, log = timeline.rows, timeline.entries
    at: dict[int, set] = defaultdict(set)
    for e in log:
        at[e[1]].add(e[2])
    instants = [min(x) for _, x in sorted(at.items())]
    visits, notes = rows["appointments"], rows["notes"]
    amended = {r["amends_note_id"] for r in notes.values()}
    checks = {
        "shapes_missing": len(SHAPES) - len(timeline.shapes),
        "transactions_with_two_instants": sum(len(x) > 1 for x in at.values()), "instants_not_rising": sum(a >= b for a, b in zip(instants, instants[1:])),
        "claims_without_visit": sum(r["appointment_id"] is not None and r["appointment_id"] not in visits for r in rows["claims"].values()), "notes_without_visit": sum(r["appointment_id"] is not None and r["appointment_id"] not in visits for r in notes.values()),
        "rows_without_patient": sum(r["patient_id"] not in rows["patients"] for t in ("appointments", "claims", "notes") for r in rows[t].values()),
        "amended_without_flag": sum(k in amended and not r["is_amended"] for k, r in notes.items()),
        "status_and_arrival": sum((r["status"] in ("checked_in", "completed")) != (r["checked_in_at"] is not None) for r in visits.values()),
        "beyond_ceilings": int(sum(timeline.shapes.values()) > limits.transactions) + int(len(log) >= limits.entries + 1000),
    }
    return spark.createDataFrame(list(checks.items()), "check string, n_bad bigint")
