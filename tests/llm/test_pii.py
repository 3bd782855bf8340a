import json
import random

import numpy as np
import pytest

from veilstream.llm import pii
from veilstream.llm.boost import BoostedTrees

FIRST, LAST = ["Anna", "Mark", "Hope", "Zélie", "Teo", "Will"], [a + b for a in ("Bren", "Kest", "Thal", "Orl", "Wex") for b in ("wick", "mere", "holt", "quist", "ström")] + ["O'Kestrel", "Pell-Ravick", "de la Kestholt"]
FILL = ["Hope House has a bed.", "Mark the knee before the test.", "Will stop Nuvexa if pain persists.", "Kestholt score 3/12, Orlmere sign absent.", "BP 120/80, pulse 77.", "Lot 303-5550-8387821 of Nuvexa recalled.", "Order #1672996 cancelled.", "Seen at the Wexholt ward.", "Claim ref 900-12-3564695, see the desk.", "4 way stopcock ready."]


def text(r):
    f, s = r.choice(FIRST), r.choice(LAST)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    kind, piece, line = r.choice([
        ("name", f"{f} {s}", "Called {} about it."), ("name", f"{s}, {f}", "cc {}"), ("name", f"{f} X. {s}", "accompanied by {} today"), ("name", s, "Discussed with Dr. {}."), ("name", f, "neighbour {} manages the pills."),
        ("email", f"{f.lower().replace('é', 'e')}.{n(3)}@example.org", "Email: {} please"), ("email", f"x{n(2)} [at] mail [dot] example [dot] com", "contact via {};"),
        ("phone", f"({n(3)}) 555-{n(4)}", "Call back on {}."), ("phone", f"+44 20 {n(4)} {n(4)}", "rang {}"), ("phone", "five five five oh one two three", "Cell: {}"),
        ("identity_number", f"{n(3)}-{n(2)}-{n(4)}", "Gave SSN {} over the phone."), ("identity_number", f"MRN{n(7)}", "Card shows chart no. {}."),
        ("address", f"{1 + int(n(3))} Elm{r.choice(['gate', 'row'])} {r.choice(['Street', 'Rd', 'Ave'])}, Apt {n(1)}B", "Lives at {}"), ("address", f"Calle Elmgate {1 + int(n(2))}", "Home visit: {}"),
    ])
    parts = r.sample(FILL, 3)
    parts.insert(r.randint(0, 3), line.format(piece))
    return " ".join(parts), kind, pii.plain(piece)


@pytest.fixture(scope="module")
def model():
    r = random.Random(1)
    alone = [(f"{f} {s}", "name") for f in FIRST for s in LAST[:8]] + [(s, "reason") for s in FILL]
    return pii.train([(text(r)[0], "") for _ in range(900)] + alone, FIRST, LAST)


def test_held_out_texts(model):
    r = random.Random(2)
    cases = [text(r) for _ in range(600)]
    got = [{(k, pii.plain(t[a:b])) for a, b, k in spans} for (t, _, _), spans in zip(cases, model.detect([(t, "") for t, _, _ in cases]))]
    right = sum((k, p) in g for (_, k, p), g in zip(cases, got))
    assert right / len(cases) > 0.97 and sum(map(len, got)) - right < 0.02 * len(cases)


def test_trees_learn_and_calibrate():
    r = np.random.default_rng(0)
    x = r.normal(size=(4000, 5))
    p = 1 / (1 + np.exp(-2 * (x[:, 0] * (x[:, 1] > 0) + 0.3)))
    y = r.random(4000) < p
    model = BoostedTrees().fit(x[:3000], y[:3000])
    q = model.predict(x[3000:])
    assert np.mean((q - p[3000:]) ** 2) < 0.02 and model.predict(np.zeros((0, 5))).shape == (0,)
    assert np.abs(np.mean(q) - np.mean(p[3000:])) < 0.05


def test_values_of_json():
    assert sorted(pii.values('{"a": "x\\u00e9", "b": [{"c": "y"}, 5551234567, true, null], "d": " "}', True)) == [("5551234567", "b"), ("xé", "a"), ("y", "c")]
    assert pii.values('{"a": "cut', True) == [('{"a": "cut', "")] and pii.values("n/a", True) == [("n/a", "")]
    assert pii.values(None, True) == [] == pii.values("  ", False)


def test_tables(spark, model):
    r = random.Random(3)
    t, kind, piece = text(r)
    rows = [(1, t, "x"), (1, t, "x"), (2, None, None), (3, "", "x"), (4, "nothing here", "x"), (5, "ok. " * 30_000 + t, "x"), (None, t, "x")]
    df = spark.createDataFrame(rows, "id int, body string, found string")
    got = sorted((x.source_table, x.row_id, x.pii_kind, x.found) for x in pii.find(df, "id", "body", False, "notes", model).collect())
    assert got == [("notes", 1, kind, piece), ("notes", 5, kind, piece)]
    red = pii.redact(df, "id", "body", False, model).collect()
    assert len(red) == len(rows) and {x.id: x.redacted for x in red}[4] == "nothing here" and {x.id: x.redacted for x in red}[2] is None
    assert pii.PLACEHOLDERS[kind] in {x.id: x.redacted for x in red}[1]
    js = spark.createDataFrame([(1, json.dumps({"who": {"name": "Anna Brenwick"}, "n": 4, "t": [t]})), (2, "n/a"), (3, '{"a": "cut, called Anna Brenwick about it')], "id int, j string")
    out = {x.id: x.redacted for x in pii.redact(js, "id", "j", True, model).collect()}
    assert json.loads(out[1])["who"] == {"name": "[NAME]"} and json.loads(out[1])["n"] == 4 and out[2] == "n/a" and out[3] == '{"a": "cut, called [NAME] about it'
    assert pii.find(df.limit(0), "id", "body", False, "notes", model).count() == 0


def test_fit_without_anything_finds_nothing(spark):
    empty = spark.createDataFrame([], "id int, body string, f string, l string")
    model = pii.fit([(empty, "id", "body", False)], [(empty, ["f"], ["l"])])
    assert model.detect([("Anna Brenwick, 614-555-0123", "")]) == [[]]


def test_a_name_in_no_table_is_found_by_its_context(model):
    for t, piece in (("Called Anna Zorv about it. BP 120/80, pulse 77.", "annazorv"), ("Discussed with Dr. Xuy. Order #1672996 cancelled.", "xuy")):
        [spans] = model.detect([(t, "")])
        assert [(k, pii.plain(t[a:b])) for a, b, k in spans] == [("name", piece)]


def test_words_of_all_name_rows_are_known(spark):
    n = 45_000
    rows = [(i, "Anna" if i % 2 else "Mark", "Brenwick") for i in range(n)] + [(n + i, "Teo", w) for i, w in enumerate("Abe Ubo Izu Oka Yll Ewe Uxo Pym Kro Vey".split())]
    people = spark.createDataFrame(rows, "id int, first string, last string")
    full = spark.createDataFrame([(1, "Dr. Edda Roqi"), (2, "Zsolt, Una")], "id int, full_name string")
    body = "Called Teo Abe, Teo Ubo, Izu, Oka, Yll, Ewe, Uxo, Pym, Kro and Vey; roqi edda zsolt una; Anna"
    texts = spark.createDataFrame([(1, body)], "id int, body string")
    got = pii.name_words([(texts, "id", "body", False)], [(people, ["first"], ["last"]), (full, [], [], ["full_name"])])
    assert set(got.last) == {"abe", "ubo", "izu", "oka", "yll", "ewe", "uxo", "pym", "kro", "vey", "roqi", "zsolt"}  # Brenwick is in no text
    assert got.first == {"anna": n // 2, "teo": 10, "edda": 1, "una": 1}


def test_kinds_of_few_rows_are_found(spark):
    rows = [(i, f"BP {i % 60 + 90}/80, called Anna Brenwick, phone 614-555-{i % 10000:04d}. Visit no. {i}.") for i in range(8000)]
    rows += [(9001, "Lives at 12 Elmgate Street, Apt 4B"), (9002, "Email: anna.b@example.org please"), (9003, "Gave SSN 994-77-6427 over the phone.")]
    df = spark.createDataFrame(rows, "id int, body string").cache()
    people = spark.createDataFrame([(1, "Anna", "Brenwick")], "id int, first string, last string")
    for sample in (300, 20_000):  # drawn, and read whole
        model = pii.fit([(df, "id", "body", False)], [(people, ["first"], ["last"])], sample=sample)
        got = {(x.row_id, x.pii_kind, x.found) for x in pii.find(df.where("id > 9000"), "id", "body", False, "n", model).collect()}
        assert got == {(9001, "address", "12elmgatestreetapt4b"), (9002, "email", "annabexampleorg"), (9003, "identity_number", "994776427")}


def test_numbers_of_other_things_are_none(model):
    """Shapes of findings in surroundings that the texts of the sample do not have."""
    for t in ("Order 123-45-6789 shipped.", "Ref no 987-65-4321 for the shipment.", "Invoice (614) 555-0123 was paid."):
        assert model.detect([(t, "")]) == [[]], t


def test_typographic_signs_and_runs(model):
    t = "Call back on (614) 555–0123. rang +442079460123 BP 120/80, pulse 77."
    [spans] = model.detect([(t, "")])
    assert [(k, t[a:b]) for a, b, k in spans] == [("phone", "(614) 555–0123"), ("phone", "+442079460123")]


def test_the_most_probable_of_overlapping_spans_is_taken(model):
    [spans] = model.detect([("Called Anna Brenwick about it. BP 120/80, pulse 77.", "")])
    assert [(a, b) for a, b, _ in spans] == [(7, 20)]


def test_names_of_which_half_are_in_no_table():
    """Even with few names to learn from and as many unknown ones, most are found by what stands around them."""
    r = random.Random(7)
    known, unknown = LAST[::2], set(LAST[1::2])
    alone = [(f"{f} {s}", "name") for f in FIRST for s in known[:8]] + [(s, "reason") for s in FILL]
    half = pii.train([(text(r)[0], "") for _ in range(900)] + alone, FIRST, known)
    cases = [x for x in (text(r) for _ in range(900)) if x[1] == "name" and any(pii.plain(s) in x[2] for s in unknown)]
    got = [{pii.plain(t[a:b]) for a, b, k in spans if k == "name"} for (t, *_), spans in zip(cases, half.detect([(t, "") for t, *_ in cases]))]
    assert len(cases) > 80 and sum(p in g for (_, _, p), g in zip(cases, got)) >= 0.5 * len(cases)


def test_one_text_under_two_keys(spark, model):
    js = spark.createDataFrame([(1, json.dumps({"a": "Anna Brenwick", "b": {"name": "Anna Brenwick"}, "n": 5551234567}))], "id int, j string")
    found = pii.find(js, "id", "j", True, "x", model).count()
    [row] = pii.redact(js, "id", "j", True, model).collect()
    assert found >= 1 and json.loads(row.redacted)["b"] == {"name": "[NAME]"}


def test_ordinary_words_are_those_of_all_rows(spark):
    """A word is ordinary by all its cases, wherever they stand; the sample of 300 rows has few of them."""
    body = lambda i: f"BP {i % 60 + 90}/80, called Anna Brenwick. Visit no. {i}."
    rows = [(i, body(i)) for i in range(8000)] + [(8000 + i, f"the qat{chr(97 + i)}ol and Qat{chr(97 + i)}ol, again qat{chr(97 + i)}ol") for i in range(20)] + [(8100 + i, "Zymel. Zymel called") for i in range(3)]
    rows += [(8200, "ALSO QATAOL AND RARIC"), (8201, "raric raric"), (8202, "lower onlysmall onlysmall"), (8203, None), (8204, "Dr. Ofek. Dr. Ofek. Dr. Ofek. Dr. Ofek. Dr. Ofek")]
    df = spark.createDataFrame(rows, "id int, body string").repartition(4).cache()
    people = spark.createDataFrame([(1, "Anna", "Brenwick")], "id int, first string, last string")
    want = {f"qat{chr(97 + i)}ol" for i in range(20)} | {"bp", "visit", "and", "dr", "zymel", "raric"}
    for sample in (300, 20_000):
        assert pii.fit([(df, "id", "body", False)], [(people, ["first"], ["last"])], sample=sample).names.ordinary == want
    assert pii.name_words([(df, "id", "body", False)], []).ordinary == want
    whole = pii.ordinary_words([(t, "") for _, t in rows if t], pii.NameWords.learn(["Anna"], ["Brenwick"]))
    assert want <= whole and "ofek" not in whole and "onlysmall" in whole


def test_words_of_addresses_are_no_cases_of_ordinary_words():
    texts = [f"Zorvale rang. Mail to {a} please" for a in ("zorvale@example.org", "zorvale_7@example.org", "anna.zorvale [at] example.org")] * 2
    counts = pii.count_words({t: texts.count(t) for t in texts})
    assert counts["zorvale"] == [0, 6, 6, 0] and counts["please"][0] == 6 and "example" not in counts
    assert "zorvale" not in pii.ordinary_words([(f"Called Zorvale, {t[14:]}", "") for t in texts], pii.NameWords())
