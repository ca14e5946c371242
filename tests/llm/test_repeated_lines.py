import random
import re
from collections import defaultdict

from palimpsest.llm.repeated_lines import deleted_blocks, lines_to_delete, repeated_blocks, sequences, without_lines

SCHEMA = "chunk_id long, company string, policy string, text string, source string, document string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "d", "b") for r in rows], SCHEMA)


def key(line):
    return re.sub(r"[0-9]+", "0", " ".join(line.split()).lower())


def brute(rows, least=4, share=0.3):
    pages, docs = defaultdict(set), defaultdict(set)
    for _, c, p, t in rows:
        if c is None or p is None:
            continue
        docs[c].add(p)
        for x in (t or "").split("\n"):
            if key(x):
                pages[c, key(x)].add(p)
    return sorted((i, n) for i, c, p, t in rows if None not in (c, p, t) for n, x in enumerate(t.split("\n")) if key(x) and len(pages[c, key(x)]) >= least and len(pages[c, key(x)]) >= share * len(docs[c]) - 1e-9)


def test_against_brute_force(spark):
    rnd = random.Random(8)
    line = lambda: rnd.choice(["Share this page", " share  THIS page ", "© 2020 A", "© 2021 a", "", "  ", "rare %d" % rnd.randint(0, 40), "x", "y", "z"])
    rows = [(i, rnd.choice(["a", "a", "a", "b", None]), rnd.choice([f"p{k}" for k in range(12)] + [None]), rnd.choice([None, ""] + ["\n".join(line() for _ in range(rnd.randint(1, 5)))] * 8)) for i in range(200)]
    got = sorted(map(tuple, lines_to_delete(frame(spark, rows)).collect()))
    assert got == brute(rows) and got


def test_blocks_of_several_lines(spark):
    rows = [(i, "a", f"p{i}", f"own {'abcdefgh'[i]}\nPrint\nShare\nown too {'abcdefgh'[i]}") for i in range(8)]
    df = frame(spark, rows)
    blocks = repeated_blocks(sequences(df, "company", "policy", "chunk_id", "text"), df.selectExpr("company source", "policy document")).collect()
    assert sorted(len(b.block) for b in blocks) == [1, 2] and {b.n_documents for b in blocks} == {8}  # Share alone is the end of Print, Share
    assert sorted(map(tuple, deleted_blocks(df).drop("row").collect())) == [(i, 1, 2) for i in range(8)]
    left = {r.chunk_id: r.text for r in without_lines(df, lines_to_delete(df)).collect()}
    assert left[0] == "own a\nown too a"


def test_long_blocks_are_reported_whole(spark):
    """Blocks far longer than a round compares, one within another, and a part of one elsewhere."""
    notice = [f"clause {chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(75)]
    rows = [(i, "a", f"p{i}", "\n".join([f"own {'abcdefgh'[i]}", *notice, f"end {'abcdefgh'[i]}"])) for i in range(8)]
    rows += [(10 + i, "a", f"p{i}", "\n".join(["x" * (i + 1), *notice[10:20]])) for i in range(3)] + [(20, "a", "p0", "\n".join(notice[:30] + ["zz"] + notice[30:36]))]
    df = frame(spark, rows)
    got = sorted(map(tuple, deleted_blocks(df).drop("row").collect()))
    assert got == [(i, 1, 75) for i in range(8)] + [(10 + i, 1, 10) for i in range(3)] + [(20, 0, 30), (20, 31, 6)]
    assert sorted(map(tuple, lines_to_delete(df).collect())) == brute(rows)


def test_longer_blocks_below_the_share(spark):
    """A line of 8 of 20 documents whose two continuations stand in 4 each, which is below the share of 30 %."""
    rows = [(i, "a", f"p{i}", f"Print\n{'Share' if i < 4 else 'Save'}\nown {chr(97 + i)}" if i < 8 else f"own {chr(97 + i)}") for i in range(20)]
    assert sorted(map(tuple, lines_to_delete(frame(spark, rows)).collect())) == brute(rows) == [(i, 0) for i in range(8)]


def test_many_partitions_share_a_hot_line(spark):
    rows = [(i, "a", f"p{i % 40}", f"Hot line\nbody {chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(600)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert sorted(map(tuple, lines_to_delete(frame(spark, rows)).collect())) == [(i, 0) for i in range(600)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty(spark):
    df = frame(spark, [(1, "a", "p", None)])
    assert lines_to_delete(df).count() == 0 and without_lines(df, lines_to_delete(df)).first().text is None
    assert lines_to_delete(spark.createDataFrame([], SCHEMA)).count() == 0
