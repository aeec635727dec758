import base64
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from talkmill.llm import tokens

PATH = tokens.vocabulary_path()
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary")


@pytest.fixture(scope="module")
def reference():
    import tiktoken

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def bpe():
    with open(PATH, "rb") as f:
        return tokens.PairIndexBpe(f.read())


def split(bpe, texts):
    ids, n = bpe.encode(texts)
    out, a = [], 0
    for k in n:
        out.append(ids[a : a + k].tolist())
        a += k
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=("Cs",)), max_size=60), max_size=8))
def test_equals_the_public_encoder(bpe, reference, texts):
    assert split(bpe, texts) == [reference.encode_ordinary(t) for t in texts]


def test_hard_texts(bpe, reference):
    texts = ["", "a" * 30_000, " " * 5000, "<|endoftext|> é", "\x1c\x1d x", "ab" * 4000, "R$ 1.234,56\r\n\t👩‍🔧", "don't'll"]
    assert split(bpe, texts) == [reference.encode_ordinary(t) for t in texts]


def test_forgetting_changes_nothing(bpe, reference, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 3)
    texts = [f"palavra{i} outra coisa {i}" for i in range(30)]
    assert [x for t in texts for x in split(bpe, [t])] == [reference.encode_ordinary(t) for t in texts]


def test_table(spark, reference, monkeypatch):
    monkeypatch.setattr(tokens, "CHARS", 50)
    rows = [(1, "olá mundo"), (2, None), (3, ""), (4, "  "), (4, "repetida " * 30), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS key", "3 AS out")
    got = sorted(((r["doc_id"], r["ids"]) for r in tokens.encode(df).collect()), key=str)
    assert got == sorted(((k, reference.encode_ordinary(t or "")) for k, t in rows), key=str)
    assert {r["n_tokens"] for r in tokens.encode(df.where("doc_id = 2"), counts_only=True).collect()} == {0}
    assert tokens.encode(df.where("false")).count() == 0
