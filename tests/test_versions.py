import random
from collections import defaultdict
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from palimpsest.functions.diffs import split_lines
from palimpsest.operators import versions as V

SCHEMA = "chunk_id long, company string, policy string, version_ts string, chunk_idx int, text string, loaded_at string"


def rows(spark, texts, policy="p"):
    return spark.createDataFrame([(i, "c", policy, ts, k, t, "1") for i, (ts, k, t) in enumerate(texts)], SCHEMA)


def test_opcodes_rebuild_both_sides(spark):
    rnd = random.Random(5)
    texts = [(f"{v:03d}", k, rnd.choice(["a", "b", "c\nd", " ", "", "e\u2028f", "longer line"])) for v in range(120) for k in range(rnd.randint(0, 8))]
    docs = V.documents(rows(spark, texts))
    sides = {r.version_ts: r.lines for r in docs.collect()}
    for r in V.raw_diffs(docs).collect():
        assert [x for o in r.diffs for x in o.before] == sides[r.before_ts] and [x for o in r.diffs for x in o.after] == sides[r.version_ts]
        assert all(o.i1 == p.i2 and o.j1 == p.j2 for p, o in zip(r.diffs, r.diffs[1:]))
        for o in r.diffs:
            assert o.sim == SequenceMatcher(str.isspace, o.before, o.after).ratio()
    spans = defaultdict(lambda: ["", ""])
    for s in V.span_diffs(docs).orderBy("version_ts", "line_ord", "ord").collect():
        spans[s.version_ts, s.before_ts][0] += s.before
        spans[s.version_ts, s.before_ts][1] += s.after
    for (after, before), (x, y) in spans.items():
        flat = lambda ls: "".join("".join(line.splitlines()) for line in ls)
        assert x == flat(sides[before]) and y == flat(sides[after])


def test_split_lines(spark):
    texts = ["", "a", "a\n", "\n", "a\n\nb", "a\r\nb\rc\x0bd\x0ce\x1cf\x85g\u2028h\u2029i", "\n\n"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", split_lines(F.col("t")).alias("ls")).collect()
    assert all(r.ls == r.t.splitlines() for r in got)


def test_autojunk_stays_on(spark):
    b = "xy" * 132
    df = rows(spark, [("1", 0, b), ("2", 0, "1234" + b)])
    assert [r.tag for r in V.span_diffs(V.documents(df)).collect()] == ["replace"]


def test_highlight(spark):
    df = rows(spark, [("1", 0, "do good"), ("1", 1, "end"), ("2", 0, "do evil"), ("2", 1, "end"), ("2", 2, "x")])
    a, b = V.highlighted(V.raw_diffs(V.documents(df))).orderBy("index").collect()
    assert a.before_html.startswith('do <span class="diff_sub">') and a.after_html.startswith('do <span class="diff_add">')
    assert (b.before_html, b.after_html) == ("", '<span class="diff_add">x</span>')


def test_neighbours_keep_policies_apart(spark):
    df = rows(spark, [("1", 0, "a"), ("2", 0, "b")], "privacy").unionByName(rows(spark, [("1", 0, "a")], "privacy-policy"))
    got = {(r.policy, r.version_ts): (r.before_ts, r.after_ts) for r in V.neighbours(df.select("company", "policy", "version_ts").distinct()).collect()}
    assert got == {("privacy", "1"): (None, "2"), ("privacy", "2"): ("1", None), ("privacy-policy", "1"): (None, None)}


def test_clean_diff_keeps_numbers(spark):
    df = rows(spark, [("1", 0, "do good"), ("1", 1, "same"), ("1", 2, "end"), ("2", 0, "do evil"), ("2", 1, "same"), ("2", 2, "end"), ("2", 3, "more")])
    got = V.clean_diffs(V.raw_diffs(V.documents(df))).orderBy("index").collect()
    assert [(r["index"], r.before, r.after) for r in got] == [(0, "do good", "do evil"), (2, "", "more")]


def test_equal_and_empty_pairs(spark):
    df = rows(spark, [("1", 0, "a"), ("2", 0, "a"), ("3", 0, None), ("4", 0, None)])
    got = {r.version_ts: (r.has_diff, [o.tag for o in r.diffs]) for r in V.raw_diffs(V.documents(df)).collect()}
    assert got == {"2": (False, ["equal"]), "3": (True, ["delete"]), "4": (False, [])}


def test_late_version_changes_the_next_pair(spark):
    early = V.raw_diffs(V.documents(rows(spark, [("1", 0, "a"), ("3", 0, "c")])))
    late = V.raw_diffs(V.documents(rows(spark, [("1", 0, "a"), ("3", 0, "c"), ("2", 0, "b")])))
    assert {(r.before_ts, r.version_ts) for r in early.collect()} == {("1", "3")} and {(r.before_ts, r.version_ts) for r in late.collect()} == {("1", "2"), ("2", "3")}


def test_manifest(spark):
    m = V.manifest(rows(spark, [("1", 0, "a"), ("2", 0, "b"), ("3", 0, "c")]).select("company", "policy", "version_ts")).first()
    assert m.manifest == {"2.json": "1.json", "3.json": "2.json"}
