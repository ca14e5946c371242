import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from palimpsest.llm.tokens import Encoder, default_path, encode

ENC = Encoder(default_path())
LIB = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
LIB.encode_special_tokens = True


def ids(texts):
    flat, offs, n = ENC.encode(texts)
    cuts = np.cumsum(n)[:-1]
    return [x.tolist() for x in np.split(flat, cuts)], [x.tolist() for x in np.split(offs, cuts)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab Z's'll're 've\t\n\r 'td''1é²½Ⅷ中 　🎉-_!<|endoftext|>\x1c‍", max_size=40), min_size=1, max_size=5))
def test_like_the_library(texts):
    got, _ = ids(texts)
    assert got == [LIB.encode(t, add_special_tokens=False).ids for t in texts]


def test_long_runs():
    rnd = random.Random(1)
    texts = ["a" * 3000, " " * 2000, "é" * 1500, "".join(rnd.choice("abcdefgh") for _ in range(5000)), "", None, "\n" * 99 + "x"]
    assert ids(texts)[0] == [LIB.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_offsets_and_round_trip():
    texts = ["Hello, it's 2024!  Größe <|endoftext|>", "", "x\n\n y"]
    got, offs = ids(texts)
    assert [ENC.decode(g) for g in got] == texts
    for t, g, o in zip(texts, got, offs):
        firsts = sorted(set(o))
        pieces = [t[a:b] for a, b in zip(firsts, [*firsts[1:], len(t)])]
        assert "".join(pieces) == t and all(ENC.decode([i for i, k in zip(g, o) if k == a]) == p for a, p in zip(firsts, pieces))


def test_frame(spark):
    rows = [(1, None), (2, ""), (3, "it's"), (3, "it's"), (None, "a"), (4, "y" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "'x' ids")
    got = [(r.doc_id, len(r.ids)) for r in encode(df).collect()]
    assert len(got) == 6 and got.count((3, 2)) == 2 and (1, 0) in got and (2, 0) in got and (None, 1) in got
    assert encode(df.limit(0)).count() == 0 and [f.name for f in encode(df, offsets=True).schema] == ["doc_id", "ids", "offsets"]


@pytest.mark.parametrize("text", ["\ud800x".encode("utf-16", "surrogatepass").decode("utf-16", "replace")])
def test_odd_code_points(text):
    assert ENC.decode(ids([text])[0][0]) == text


def test_decoded_frames(spark):
    from palimpsest.llm.tokens import decode

    texts = ["Hello, it's 2024!  Größe", "", None, "🎉" * 500, "a" * 5000]
    df = spark.createDataFrame([(i, t, [i]) for i, t in enumerate(texts)], "doc_id long, text string, ids array<int>")
    got = {r.doc_id: r.text for r in decode(encode(df)).collect()}
    assert got == {i: t or "" for i, t in enumerate(texts)}
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.text for r in decode(nulls).collect()} == {1: None, 2: ""} and decode(nulls.limit(0)).count() == 0
