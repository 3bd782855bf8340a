import numpy as np
import pytest

from veilstream.llm import toxicity, voters
from veilstream.llm.weaklabels import LabelModel, LinearClassifier, fit_linear

PLAIN = ["please bring the form on monday", "the wound was covered with a nude-coloured dressing", "i feel a bit stupid for asking, sorry", "breast exam normal", "the left knee hurts", "could someone tell me whether to stop the tablets", "verbal abuse towards staff is logged", "i could kill for a coffee", "thank you"]
BAD = {"abusive": ["you worthless idiot", "shut up and listen, you moron", "i hope you choke, you clown"], "hateful": ["all foreigners are vermin, send them back where they came from", "every last one of the hill people is a thief and a parasite"], "sexual": ["send me nude pictures, babe", "bend over for me, sexy, i want to taste you"]}


@pytest.mark.parametrize("text,word", [("you 1d107", "idiot"), ("m o r o n here", "moron"), ("c.r.e.t.i.n", "cretin"), ("as​shole", "asshole"), ("bаstаrd", "bastard"), ("a*****e", "asshole"), ("piiiig", "pig"), ("SCUMBAG!!!", "scumbag"), ("p47h371c", "pathetic")])
def test_repair(text, word):
    assert word in voters.repair(text)


def test_repair_leaves_plain_text():
    for s in ("12 tabs at 8.30, 5 mg", "see www.example.org a.b.c", "привет, как дела", "3 x 4 = 12"):
        assert voters.repair(s) == s


def test_label_model_finds_accuracies_and_correlation():
    r = np.random.default_rng(3)
    n = 40_000
    y = r.random(n) < 0.05
    fire = lambda p, q: np.where(y, r.random(n) < p, r.random(n) < q)
    a, b, c = fire(0.7, 0.01), fire(0.6, 0.02), fire(0.8, 0.005)
    copy = a ^ (r.random(n) < 0.01)
    masks = a * 1 + b * 2 + c * 4 + copy * 8
    kinds, counts = np.unique(masks, return_counts=True)
    model = LabelModel(list("abcd"), [0.5] * 4, silence=1.0).fit(kinds, counts)
    assert any({0, 3} <= set(b) for b in model.blocks) and model.together[0, 3] > 0.8
    assert model.fires[1][2] > 10 * model.fires[0][2]
    p = model.posterior(masks)
    assert ((p > 0.5) == y).mean() > 0.97
    assert 0 < LabelModel(["a"], [0.5]).fit(np.zeros(0, int), np.zeros(0)).posterior(np.array([0]))[0] < 0.31


def test_accuracies_come_from_the_votes():
    r = np.random.default_rng(5)
    n = 60_000
    y = r.random(n) < 0.03
    fire = lambda p, q: np.where(y, r.random(n) < p, r.random(n) < q)
    masks = fire(0.7, 0.002) * 1 + fire(0.6, 0.002) * 2 + fire(0.6, 0.002) * 4 + fire(0.05, 0.02) * 8  # all are believed in alike, the last is wrong
    model = LabelModel(list("abcd"), [0.5] * 4, silence=1.0).fit(*np.unique(masks, return_counts=True))
    p = model.posterior(np.array([1, 2, 4, 3, 8]))
    assert p[3] > 0.9 and p[3] > p[:3].max() and p[:3].min() > p[4] and p[4] < 0.5
    assert abs(model.prior - 0.03) < 0.02


def test_linear_classifier_on_held_out_rows():
    r = np.random.default_rng(4)
    rows = [[f"w{r.integers(40)}" for _ in range(6)] + (["bad"] if i % 3 == 0 else []) for i in range(600)]
    y = np.array([float(i % 3 == 0) for i in range(600)])
    model = fit_linear(rows[:400], y[:400, None])[0]
    assert np.mean([(model.score(x) > 0.5) == t for x, t in zip(rows[400:], y[400:])]) > 0.97
    assert 0 <= LinearClassifier().score(["x"]) <= 1
    assert len(fit_linear([], np.zeros((0, 3)))) == 3


def test_long_segments_are_read_in_windows():
    text = " ".join(f"w{i}" for i in range(200))
    got = voters.segments(text)
    assert all(len(s.split()) <= voters.WINDOW for s in got) and {w for s in got for w in s.split()} == set(text.split())
    assert voters.segments(" ".join(text.split()[:30])) == [" ".join(text.split()[:30])]


def test_documents(spark):
    docs = [(i, ". ".join(PLAIN[(i + k) % len(PLAIN)] for k in range(4)), "s" if i % 2 else None) for i in range(150)]
    truth = {}
    for n, (c, lines) in enumerate(BAD.items()):
        for k, s in enumerate(lines * 4):
            i = 1000 + 100 * n + k
            docs.append((i, f"{PLAIN[k % 5]}. {s.upper() if k % 3 == 0 else s}. {PLAIN[0]}", "s"))
            truth[i] = c
    docs += [(5000, None, "s"), (5001, "", "s"), (5002, "  \n ", None), (5003, "x" * 200_000, "s"), (5004, "ok. " * 20_000 + BAD["abusive"][0], "s")]
    df = spark.createDataFrame(docs, "doc_id int, text string, source string")
    model = toxicity.fit(df, sample=500)
    scores = toxicity.score_documents(df, model)
    assert scores.count() == len(docs)
    hits = {(r.doc_id, r.category) for r in toxicity.found(scores).collect()}
    assert set(truth.items()) <= hits and (5004, "abusive") in hits
    assert len({i for i, _ in hits} - truth.keys() - {5004}) == 0
    rates = toxicity.rates(toxicity.score_documents(df, model, keep=("source",))).collect()
    assert {r.source for r in rates} == {"s", None} and sum(r.n_docs for r in rates if r.category == "sexual") == len(docs)
    again = {(r.doc_id, r.category) for r in toxicity.found(toxicity.score_documents(df.repartition(5), toxicity.fit(df.repartition(3), sample=500))).collect()}
    assert again == hits
    empty = df.limit(0)
    assert toxicity.score_documents(empty, toxicity.fit(empty)).count() == 0


def test_the_classifier_alone_scores():
    silent = {c: LinearClassifier({}, -3.0) for c in voters.CATEGORIES}
    certain = {c: LabelModel(voters.VOTERS[c], voters.WORTH[c]).fit(np.array([0, 1]), np.array([99, 1])) for c in voters.CATEGORIES}
    assert max(toxicity.ContentModel(certain, silent).score("you worthless idiot")) < 0.1


def test_the_sample_holds_segments_of_rare_voters(spark):
    docs = [(i, f"you worthless idiot number {i}") for i in range(3000)] + [(9000 + i, f"bend over for me, sexy, i want to taste you {i}") for i in range(3)]
    df = spark.createDataFrame(docs, "doc_id int, text string")
    scores = toxicity.score_documents(df.where("doc_id >= 9000"), toxicity.fit(df, sample=20)).collect()
    assert all(r.sexual >= 0.5 for r in scores)


def test_wording_of_other_words_than_the_voters(spark):
    """Insults that no list holds are found from the words around them; segments without a vote are found too."""
    frames = ["you {} fool, shut up", "shut up you {} idiot", "what a {} moron you are, go to hell", "you are a {} clown and an idiot"]
    odd = ["blathering", "gormless", "snivelling", "witless", "toadying", "vapid"]
    docs = [(i, f"{PLAIN[i % len(PLAIN)]}. {frames[i % 4].format(odd[i % 6])}.") for i in range(200)]
    docs += [(1000 + i, f"{PLAIN[i % len(PLAIN)]}. {PLAIN[(i + 3) % len(PLAIN)]}.") for i in range(600)]
    held = [(5000 + i, f"you {a} {b}") for i, (a, b) in enumerate(zip(odd, odd[1:]))]
    assert all(not voters.votes(voters.words(t))[0] for _, t in held)
    df = spark.createDataFrame(docs, "doc_id int, text string")
    model = toxicity.fit(df, sample=600)
    hits = [model.score(t)[0] >= 0.5 for _, t in held]
    assert sum(hits) >= 0.9 * len(hits)
    calm = [f"{a}. {b}" for a in PLAIN for b in ("the warning light on the dashboard came on", "my grandfather keeps bees")]
    assert sum(model.score(t)[0] >= 0.5 for t in calm) <= 0.1 * len(calm)
