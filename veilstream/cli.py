"""Command line: ``python -m veilstream COMMAND``.

policy FILE                          check a policy, print its rules and domains
ops                                  worked examples of the operations
schema POLICY TABLE RAW.json [OLD=NEW]  the clean schema of a raw envelope schema ('-': standard input)
register STORE SUBJECT SCHEMA.json   store a schema version
check STORE SUBJECT POLICY TABLE RAW.json [OLD=NEW]
                                     whether the registered schema is the one the policy derives
seed OUT [--seed N] [--dry-run] [--quiet]  write the synthetic clinic; prints each table's fingerprint
churn OUT [--seed N] [--max-txns N] [--max-entries N] [--rate R] [--duration S] [--quiet] [--dry-run]
                                     write a generated ledger, and verify it; names the ceiling it stopped at
clean POLICY TABLE IN OUT            de-identify a Parquet table; the salt is read from VEILSTREAM_SALT (hex)
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from .functions.keyed import Keys


def _keys() -> Keys:
    text = os.environ.get("VEILSTREAM_SALT", "")
    if not text:
        raise SystemExit("set VEILSTREAM_SALT to at least 32 hex digits")
    return Keys(bytes.fromhex(text))


def _read(path: str):
    return json.load(sys.stdin if path == "-" else open(path, encoding="utf-8"))  # noqa: SIM115


def examples(spark) -> list[tuple[str, str, str]]:
    """(rule, input, output) of the operations."""
    from pyspark.sql import functions as F

    from .plans.policy import parse_policy
    from .plans.transform import clean_table

    keys = Keys(bytes(range(32)))
    cases = [
        ({"op": "passthrough"}, "PA"), ({"op": "null"}, "PA"), ({"op": "redact"}, "free text"), ({"op": "hmac", "domain": "mrn"}, "  MRN-000482 "), ({"op": "hmac", "domain": "mrn"}, "mrn-000482"),
        ({"op": "fake", "kind": "full_name"}, "Ann Lee"), ({"op": "fake", "kind": "email"}, "ann@x.org"), ({"op": "fake", "kind": "phone"}, "6145550123"), ({"op": "fake", "kind": "street_address"}, "1 Main St"),
        ({"op": "fake", "kind": "company"}, "Acme"), ({"op": "generalize", "to": "zip3"}, "02139-1234"), ({"op": "generalize", "to": "zip3"}, "03601"), ({"op": "generalize", "to": "icd10_category"}, "m54.5"),
        ({"op": "numeric_jitter", "anchor": "who", "pct": 5}, "1420.00"), ({"op": "numeric_jitter", "anchor": "who", "pct": 5}, "not money"),
    ]
    out = []
    for rule, value in cases:
        policy = parse_policy({"tables": {"public.t": {"who": {"op": "drop"}, "v": rule}}})
        df = spark.range(1).select(F.lit(7).alias("who"), F.lit(value).alias("v"))
        out.append((str(rule), value, str(clean_table(df, policy, "public.t", keys).first()["v"])))
    return out


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="veilstream", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("policy").add_argument("file")
    sub.add_parser("ops")
    s = sub.add_parser("schema")
    for a in ("policy", "table", "raw"):
        s.add_argument(a)
    s.add_argument("namespace", nargs="?")
    s = sub.add_parser("register")
    for a in ("store", "subject", "schema"):
        s.add_argument(a)
    s = sub.add_parser("check")
    for a in ("store", "subject", "policy", "table", "raw"):
        s.add_argument(a)
    s.add_argument("namespace", nargs="?")
    for name in ("seed", "churn"):
        s = sub.add_parser(name)
        s.add_argument("out")
        s.add_argument("--seed", type=int, default=42)
        s.add_argument("--dry-run", action="store_true")
        s.add_argument("--quiet", action="store_true")
        if name == "churn":
            s.add_argument("--max-txns", type=int, default=200)
            s.add_argument("--max-entries", type=int, default=50_000)
            s.add_argument("--rate", type=float, default=2.0)
            s.add_argument("--duration", type=float, default=3600.0)
    s = sub.add_parser("clean")
    for a in ("policy", "table", "source", "out"):
        s.add_argument(a)
    args = p.parse_args(argv)
    if args.command == "policy":
        from .plans.policy import main as check

        return check([args.file])
    if args.command in ("schema", "register", "check"):
        from .plans import schema as C
        from .plans.policy import load_policy

        if args.command == "register":
            print(C.SchemaStore(args.store).register(args.subject, _read(args.schema)))
            return 0
        space = tuple(args.namespace.split("=")) if args.namespace else None
        if args.command == "check":
            bad = C.contradictions(C.SchemaStore(args.store).get(args.subject), _read(args.raw), load_policy(args.policy), args.table, Keys(bytes(16)), space)
            print("\n".join(bad) or "as derived")
            return int(bool(bad))
        print(json.dumps(C.derive_clean_schema(_read(args.raw), load_policy(args.policy), args.table, Keys(bytes(16)), space), indent=1, ensure_ascii=False))
        return 0
    from .session import local_session

    spark = local_session()
    if args.command == "ops":
        for rule, value, result in examples(spark):
            print(f"{rule}: {value!r} -> {result!r}")
    elif args.command == "seed":
        from .generate.population import population
        from .operators.fingerprint import fingerprint

        for name, df in population(spark, args.seed).items():
            row = fingerprint(df).first()
            if not args.quiet:
                print(f"{name}: {row.n_rows} rows, {row.digest}")
            if not args.dry_run:
                df.write.mode("overwrite").parquet(f"{args.out}/{name}.parquet")
    elif args.command == "churn":
        from .generate import churn
        from .generate.population import population
        from .operators import ledger

        limits = churn.Ceilings(entries=args.max_entries, seconds=args.duration)
        planned = churn.plan(args.seed, args.max_txns, churn.start_rows(population(spark, args.seed)), limits, rate=args.rate)
        log = churn.ledger(spark, planned)
        bad = ledger.difference(ledger.replay(log, ["table_name", "row_id"], ["after_row"]), churn.state(spark, planned)).count()
        bad += ledger.inversions(log).count() + ledger.split_transactions(log).count() + sum(r.n_bad for r in churn.violations(spark, planned, limits).collect() if r.check != "shapes_missing")
        if not args.dry_run:
            log.write.mode("overwrite").parquet(args.out)
        if not args.quiet:
            for r in churn.report(spark, planned).collect():
                print(f"{r.counter} {r.name}: {r.n}")
        print(f"{sum(planned.shapes.values())} transactions, {len(planned.entries)} entries" + ("" if planned.stopped == "done" else f"; stopped at the ceiling of {planned.stopped}"))
        print("verified" if not bad else f"{bad} contradictions")
        return int(bad > 0)
    else:
        from .plans.policy import load_policy
        from .plans.transform import clean_table

        clean_table(spark.read.parquet(args.source), load_policy(args.policy), args.table, _keys()).write.mode("overwrite").parquet(args.out)
    return 0
