from pyspark.sql import functions as F

from palimpsest.functions import answers as A
from palimpsest.operators import prompts as P


def sections(spark, sizes):
    return spark.createDataFrame([("d", i, "x" * a, "y" * b if b is not None else None) for i, (a, b) in enumerate(sizes)], "doc string, index int, before string, after string")


def test_pages_at_and_around_the_limit(spark):
    got = P.paged(sections(spark, [(30, 9), (0, 0), (1, 0), (200, None), (5, 5)]), "doc", page_chars=40).orderBy("index").collect()
    assert [(r.page, r.page_no) for r in got] == [(0, 1), (0, 1), (1, 2), (6, 3), (6, 3)]
    assert P.pages(sections(spark, []), "doc").count() == 0


def test_time_sample(spark):
    schema = "capture_id long, company string, policy string, capture_ts string"
    rows = [(i, "c", "p", f"2020{1 + i // 28:02d}{1 + i % 28:02d}000000") for i in range(100)] + [(200 + i, "c", "q", "20200101000000") for i in range(5)] + [(300 + i, "c", "bad", "2020" if i == 3 else f"202001010000{i:02d}") for i in range(15)]
    got = P.time_sample(spark.createDataFrame(rows, schema)).collect()
    n = {p: sum(r.policy == p for r in got) for p in ("p", "q", "bad")}
    assert n == {"p": 10, "q": 1, "bad": 10} and min(r.capture_id for r in got) == 0
    assert P.time_sample(spark.createDataFrame([], schema)).count() == 0


def test_worked_examples_stop_at_the_budget(spark):
    lab = spark.createDataFrame([(d, t, p) for d, t, p in [("a", 0, 1), ("b", 0, 1), ("c", 1, 1), ("d", 0, 1), ("e", 0, 1)]], "doc string, truth int, pred int")
    lens = spark.createDataFrame([("a", 30), ("b", 10), ("c", 1), ("d", 10), ("e", 999)], "doc string, chars long")
    assert [r.doc for r in P.worked_examples(lab, lens, most_chars=100).orderBy("n").collect()] == ["b", "d", "a"]
    assert [r.doc for r in P.worked_examples(lab, lens, most_chars=50).orderBy("n").collect()] == ["b", "d"]


def test_prompt_and_check(spark):
    p = P.prompt(F.lit("sys"), P.history(F.array(F.lit("q1"))), F.lit("now"))
    r = spark.range(1).select(p.alias("p"), P.prompt_check(p, 50, 100).alias("c")).first()
    assert [m.role for m in r.p.history] == ["user", "assistant"] and r.c.chars == 3 + 2 + len(r.p.history[1].content) + 3
    assert r.c.error is not None and r.c.over_window


def test_failed_pages_stand_in_the_summary(spark):
    rows = spark.createDataFrame([("d", 2, False, None, "no", "raw"), ("d", 1, True, '{"a":1}', "", "")], "doc string, page_no int, success boolean, data string, error string, raw string")
    assert P.collect_answers(rows, "doc").first().summary == '{"chunks": [{"a":1}, {"error":"no","raw":"raw"}]}'


def test_scorer_is_injected(spark):
    rows = spark.range(2).select(P.prompt(F.lit("s"), P.history(F.array().cast("array<string>")), F.col("id").cast("string")).alias("prompt"))
    assert sorted(r.answer for r in P.score(rows, lambda s, c: s + c).collect()) == ["s0", "s1"]


def test_extract():
    ok = lambda t: A.extract(t)[:2]
    assert ok('{"a": 1}') == (True, '{"a": 1}') and ok('say {"a": {"b": [1]}} done') == (True, '{"a": {"b": [1]}}')
    assert ok("x [1, 2] y") == (True, "[1, 2]") and ok("3") == (True, "3")
    assert ok('a {"x": 1,} b {"y": 2}') == (True, '{"y": 2}')
    assert A.extract("")[3].startswith("Invalid input") and A.extract(None)[0] is False and A.extract("none here")[3].startswith("No valid JSON")
    assert A.extract('{"a": 1')[0] is False
    # of three levels only the inner two are found
    assert ok('t {"a": {"b": {"c": 1}}} t') == (True, '{"b": {"c": 1}}')


def test_sanitised():
    assert A.sanitised({"a": ["<b>", 1, True, None], "c": "x & y"}) == {"a": ["<b></b>", 1, True, None], "c": "x &amp; y"}


def test_schemas(spark):
    rows = [("v2", '{"practically_substantive": {"rating": true, "reason": "r"}}', True), ("v2", '{"practically_substantive": {"rating": true}}', False), ("v3", '{"chunks": [{"practically_substantive": {"rating": true, "reason": "r"}}]}', True), ("v3", '{"chunks": [{"error": "e", "raw": "x"}]}', False), ("v9", "{}", False), ("v0", "{}", True), ("v1", "{}", False), (None, "{}", False)]
    got = spark.createDataFrame(rows, "v string, j string, want boolean").select("want", A.valid_for(F.col("v"), F.col("j")).alias("got")).collect()
    assert all(r.want == r.got for r in got)
    v1 = '{"legally_substantive": {"rating": true, "explanation": "l"}, "practically_substantive": {"rating": false, "explanation": "e"}, "change_keywords": [], "subject_keywords": [], "helm_keywords": []}'
    r = spark.range(1).select(A.to_v3(F.lit("v1"), F.lit(v1)).alias("x"), A.valid_for(F.lit("v1"), F.lit(v1)).alias("ok")).first()
    assert r.x.chunks[0].practically_substantive.reason == "e" and r.ok


def test_markup_of_answers():
    from palimpsest.functions.answers import clean_markup as clean

    assert clean("a < b & c &amp; d") == "a &lt; b &amp; c &amp; d" and clean("plain") == "plain"
    assert clean('<b>x</b> <script>y</script> <img src="z">') == '<b>x</b> &lt;script&gt;y&lt;/script&gt; &lt;img src="z"&gt;'
    assert clean('<a href="https://x.org" onclick="f()">t') == '<a href="https://x.org">t</a>' and clean("<a href='javascript:f()'>t</a>") == "<a>t</a>"
    assert clean("</b>x <ul><li>y</ul>") == "x <ul><li>y</li></ul>"


def test_running_sums_by_slices(spark):
    """A key summed slice by slice gives what one window gives: nulls in keys and order, ties, a clashing column."""
    import random

    from pyspark.sql import functions as F

    from palimpsest.operators.prompts import paged, running_sum

    rnd = random.Random(6)
    rows = [(k, rnd.choice(["a", "a", "b", None]), rnd.choice([None, *[f"20{y}0{m}01" for y in (19, 20) for m in (1, 2)]]), "x" * rnd.randint(0, 40), rnd.choice([None, "yy"]), 1) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, company string, version_ts string, before string, after string, page_clash int")
    month = F.coalesce(F.substring("version_ts", 1, 6), F.lit(""))
    one = running_sum(df, F.length("before"), ["company"], ["version_ts", "id"])
    many = running_sum(df, F.length("before"), ["company"], ["version_ts", "id"], month)
    assert sorted(map(tuple, one.select("id", "upto").collect())) == sorted(map(tuple, many.select("id", "upto").collect()))
    pages = [paged(df, "company", index="version_ts", tie="id", page_chars=100, slice_by=s) for s in (None, month)]
    assert len({tuple(sorted(map(tuple, p.select("id", "page", "page_no").collect()))) for p in pages}) == 1
