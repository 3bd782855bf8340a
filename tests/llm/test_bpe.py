import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veilstream.llm import bpe
from veilstream.llm.queries import ranks_path

pytestmark = pytest.mark.skipif(not os.path.exists(ranks_path()), reason="the tokenizers' files are not here")


@pytest.fixture(scope="module")
def raw():
    with open(ranks_path(), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def own(raw):
    return bpe.Tokenizer(bpe.read_ranks(raw))


@pytest.fixture(scope="module")
def other(raw):
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("other", pat_str=bpe.SPLIT_PATTERN, mergeable_ranks=bpe.read_ranks(raw), special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text("abcdefgh ", max_size=60) | st.text("\n\t '0aé漢😀", max_size=40))
def test_equals_another_encoder_and_comes_back(own, other, text):
    ids = own.encode(text)
    assert ids == other.encode_ordinary(text) and own.decode(ids) == text


@pytest.mark.parametrize("text", ["a" * 30_000, " " * 5_000, "ab" * 10_000, "=" * 3_000, "<|endoftext|>", "\x00\x01", "don't we'll"])
def test_long_and_odd(own, other, text):
    assert own.encode(text) == other.encode_ordinary(text)


def test_every_token_is_itself(own):
    assert all(own.engine.encode(t) == [i] for t, i in own.engine.ranks.items())


def test_small_vocabulary_by_brute_force():
    tokens = [b"a", b"b", b"c", b"ab", b"bc", b"abc", b"cab", b"aa", b"aab"]
    ranks = {t: i for i, t in enumerate(tokens)}
    engine = bpe.Backtracker(ranks)

    def merge(data):
        parts = [data[i:i + 1] for i in range(len(data))]
        while True:
            pairs = [(ranks.get(a + b, 99), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            best = min(pairs, default=(99, 0))
            if best[0] == 99:
                return [ranks[p] for p in parts]
            i = best[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]

    reachable = [t for t in tokens if merge(t) == [ranks[t]]]
    assert len(reachable) >= 7
    for n in range(3**7):
        text = bytes(b"abc"[n // 3**k % 3] for k in range(7))
        assert engine.encode(text) == merge(text), text


def test_corpus(spark, own):
    df = spark.createDataFrame([(1, "hello world", "x"), (2, "", "y"), (3, None, None), (3, None, None), (4, "ü" * 2000, "z")], "doc_id int, text string, ids string")
    got = sorted((r.doc_id, r.ids) for r in bpe.encode_corpus(df, "doc_id", "text", ranks_path()).collect())
    assert got == [(1, own.encode("hello world")), (2, []), (3, []), (3, []), (4, own.encode("ü" * 2000))]
    back = bpe.decode_corpus(bpe.encode_corpus(df, "doc_id", "text", ranks_path()), "doc_id", "ids", ranks_path())
    assert {r.doc_id: r.text for r in back.collect()} == {1: "hello world", 2: "", 3: "", 4: "ü" * 2000}
    assert sorted(r.n_tokens for r in bpe.count_tokens(df, ["doc_id"], "text", ranks_path()).collect()) == sorted(len(i) for _, i in got)
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text", ranks_path()).count() == 0
