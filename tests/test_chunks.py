from palimpsest.operators import chunks as K
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from palimpsest.operators.chunks import THRESHOLD_BITS, _Entropy, pool, pooled


def entropy(text):
    return _Entropy().add(text)


def brute(texts):
    out, held = [], None
    for t in texts:
        if held is None:
            held = t
        elif entropy(held) > THRESHOLD_BITS:
            out.append(held)
            held = t
        else:
            held += ("\n" if held.endswith(".") else ".\n") + t
    return out + ([held] if held is not None else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab c.d\n", max_size=30), max_size=12))
def test_pool_is_the_fold(texts):
    assert pool(texts) == brute(texts)


def test_pool_long():
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("one two three four five six seven eight nine ten".split()) for _ in range(rnd.randint(0, 9))) + rnd.choice(["", "."]) for _ in range(300)]
    got = pool(texts)
    assert got == brute(texts) and all(entropy(t) > THRESHOLD_BITS for t in got[:-1])


def test_eight_words_keep_absorbing():
    assert pool(["a b c d e f g h", "i"]) == ["a b c d e f g h.\ni"]


def test_pooled_numbers_from_zero(spark):
    rows = spark.createDataFrame([("c", "p", "1", i, t) for i, t in enumerate(["x", None, "a b c d e f g h i j k", "z"])], "company string, policy string, version_ts string, chunk_idx int, text string")
    got = pooled(rows, "company", "policy", "version_ts").orderBy("chunk_idx").collect()
    assert [(r.chunk_idx, r.text) for r in got] == [(0, "x.\na b c d e f g h i j k"), (1, "z")]


def test_empty(spark):
    rows = spark.createDataFrame([], "company string, policy string, version_ts string, chunk_idx int, text string")
    assert pooled(rows, "company", "policy", "version_ts").count() == 0
    assert rows.select(F.count("*")).first()[0] == 0


def test_quantiles(spark):
    """Against numpy, with ties, nulls, a null group, groups of one and of two values."""
    import random

    import numpy as np

    from palimpsest.operators.chunks import quantiles_of

    rnd = random.Random(2)
    groups = {"a": [rnd.random() * 8 for _ in range(500)], "b": [3.25] * 40 + [1.0], "c": [2.0], None: [0.0, 7.5]}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("a", None), ("z", None)]
    df = spark.createDataFrame(rows, "g string, e double")
    got = {r.g: [r.q5, r.q25, r.q50, r.q75, r.q95] for r in quantiles_of(df, "e", "g").collect()}
    assert got.keys() == groups.keys()
    for k, vs in groups.items():
        assert np.allclose(got[k], np.quantile(vs, [0.05, 0.25, 0.5, 0.75, 0.95]), atol=1e-12)
    assert quantiles_of(df.limit(0), "e", "g").count() == 0


def test_entropy(spark):
    df = spark.createDataFrame([("a b",), ("a a",), ("",), (None,), ("a b c d",)], "text string")
    got = [r.entropy for r in K.with_entropy(df).collect()]
    assert [None if x is None else round(x, 6) + 0.0 for x in got] == [1.0, 0.0, 0.0, None, 2.0]
