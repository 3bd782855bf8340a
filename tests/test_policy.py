import pytest

from veilstream.plans import policy as P

GOOD = """
on_uncovered_column: halt_topic
tables:
  public.patients:
    patient_id: { op: hmac, domain: patient }
    born: { op: generalize, to: birth_year, cap_age: 89 }
    at: { op: date_shift, anchor: patient_id }
    paid: { op: numeric_jitter, anchor: patient_id, pct: 5 }
    note: { op: redact }
    gone: { op: "null" }
"""


def test_reads_a_policy():
    p = P.read_policy(GOOD, "p.yml")
    assert p.on_uncovered_column == P.HALT
    assert p.rule_for("public.patients", "note").op.value == "[redacted]"
    assert p.covers("public.patients", "at") and not p.covers("public.patients", "nope")
    assert p.hmac_domains() == {"patient": ["public.patients.patient_id"]}
    assert len(list(p.all_rules())) == 6
    with pytest.raises(P.PolicyError):
        p.table("public.nope")
    with pytest.raises(TypeError):
        p.tables["x"] = None


def one(rule, **more):
    rules = ", ".join(f"{k}: {v}" for k, v in {"c": rule, **more}.items())
    return f"tables: {{ public.t: {{ {rules} }} }}"


BAD = [
    ("", P.Malformed, "empty"),
    ("- 1", P.Malformed, "mapping"),
    ("tables: {a: [", P.Malformed, "YAML"),
    ("tables: {}", P.Malformed, "no table"),
    ("on_uncovered_column: halt_topic", P.Malformed, "no tables"),
    ("tables: 5", P.Malformed, "mapping"),
    ("other: 1\ntables: {a.b: {c: {op: drop}}}", P.Malformed, "other"),
    ("source: 1\ntables: {a.b: {c: {op: drop}}}", P.ReservedField, "envelope"),
    ("on_uncovered_column: passthrough\ntables: {a.b: {c: {op: drop}}}", P.InvalidArgument, "never"),
    ("tables: {patients: {c: {op: drop}}}", P.Malformed, "schema.table"),
    ("tables: {a.b: {}}", P.Malformed, "columns"),
    ("tables: {a.b: {ts_ms: {op: drop}}}", P.ReservedField, "envelope"),
    ("tables: {a.b: {source.x: {op: drop}}}", P.ReservedField, "envelope"),
    ("tables: {a.b: {'1c': {op: drop}}}", P.Malformed, "column name"),
    ("tables: {a.b: {c: {op: drop}, c: {op: 'null'}}}", P.DuplicateKey, "twice"),
    (one("{op: hash}"), P.UnknownOp, "hash"),
    (one("{domain: x}"), P.MissingArgument, "op"),
    (one("{op: null}"), P.InvalidArgument, "quotes"),
    (one("drop"), P.Malformed, "mapping"),
    (one("{op: hmac}"), P.MissingArgument, "domain"),
    (one("{op: hmac, domain: ''}"), P.InvalidArgument, "empty"),
    (one("{op: hmac, domain: 5}"), P.InvalidArgument, "str"),
    (one("{op: drop, x: 1}"), P.UnknownArgument, "'x'"),
    (one("{op: fake, kind: face}"), P.InvalidArgument, "face"),
    (one("{op: generalize, to: decade}"), P.InvalidArgument, "decade"),
    (one("{op: generalize, to: zip3, cap_age: 89}"), P.UnknownArgument, "cap_age"),
    (one("{op: generalize, to: age_band, cap_age: 0}"), P.InvalidArgument, "120"),
    (one("{op: generalize, to: age_band, cap_age: true}"), P.InvalidArgument, "bool"),
    (one("{op: redact, value: ''}"), P.InvalidArgument, "empty"),
    (one("{op: date_shift, anchor: c}"), P.InvalidArgument, "own anchor"),
    (one("{op: date_shift, anchor: z}"), P.InvalidArgument, "no rule"),
    (one("{op: date_shift, anchor: b}", a="{op: drop}", b="{op: date_shift, anchor: a}"), P.InvalidArgument, "itself anchored"),
    (one("{op: numeric_jitter, anchor: b, pct: 26}", b="{op: drop}"), P.InvalidArgument, "25"),
]


@pytest.mark.parametrize("text,error,word", BAD)
def test_refuses(text, error, word):
    with pytest.raises(error) as e:
        P.read_policy(text, "p.yml")
    assert type(e.value) is error and word in str(e.value) and str(e.value).startswith("p.yml: ")


def test_error_names_table_and_column():
    with pytest.raises(P.UnknownOp) as e:
        P.read_policy(one("{op: hash}"), "p.yml")
    assert "p.yml: public.t.c: " in str(e.value)


def test_main(tmp_path, capsys):
    f = tmp_path / "p.yml"
    f.write_text(GOOD)
    assert P.main([str(f)]) == 0
    assert "domain patient" in capsys.readouterr().out
    assert P.main([str(tmp_path / "none.yml")]) == 1 and P.main([]) == 2
