import itertools
import json
import random

from palimpsest.operators.schema_drift import assign, edit_script, kind_of, leaves_of, one_name, schema_changes, schema_scripts, unified_records

FILES = "file_id long, feed string, produced_at long, path string"
RECORDS = "record_id long, file_id long, line_no int, summary_key string, raw_json string, feed string"


def run(spark, files, records):
    f = spark.createDataFrame([(*x, "clash") for x in files], FILES)
    r = spark.createDataFrame([(i, a, n, k, j, "clash") for i, (a, n, k, j) in enumerate(records)], RECORDS)
    return sorted(map(tuple, schema_changes(r, f).collect())), {x.record_id: x for x in unified_records(r, f).collect()}


def test_assign_is_optimal():
    rnd = random.Random(1)
    for _ in range(100):
        n = rnd.randint(1, 5)
        c = [[rnd.randint(0, 9) for _ in range(n)] for _ in range(n)]
        got = assign(c)
        assert sorted(got) == list(range(n))
        assert sum(c[i][j] for i, j in enumerate(got)) == min(sum(c[i][p[i]] for i in range(n)) for p in itertools.permutations(range(n)))


def test_leaves_and_kinds():
    assert sorted(leaves_of({"a": {"b": 1, "c": {}}, "d": [1]})) == [("a.b", 1), ("d", [1])]
    assert [kind_of(x) for x in (True, 1, 1.5, "s", [], None)] == ["boolean", "integer", "decimal", "string", "array", None]


def test_script_prefers_evidence():
    cost, script = edit_script(["a", "b", "p.x"], ["c", "p.y", "q"], {("a", "c"): 1, ("a", "q"): 5})
    assert script == [("added", "", "c"), ("added", "", "p.y"), ("removed", "b", ""), ("removed", "p.x", ""), ("renamed", "a", "q")]
    assert 0 < cost < 6


def test_moves_and_renamed_objects():
    agree = {("a.x", "b.x"): 2, ("a.y", "b.y"): 1, ("c.z", "z"): 1, ("u", "v"): 1, ("u", "d.u"): 9}
    cost, script = edit_script(["a.x", "a.y", "c.z", "c.w", "u", "k"], ["b.x", "b.y", "c.w", "z", "v", "d.u", "k"], agree)
    assert script == [("added", "", "d.u"), ("moved", "a.x", "b.x"), ("moved", "a.y", "b.y"), ("moved", "c.z", "z"), ("renamed", "u", "v"), ("renamed_node", "a", "b")]
    assert cost < 4.2
    # an object of other leaves is no renamed object, and what does not agree does not move
    assert edit_script(["a.x", "a.y"], ["b.x"], {("a.x", "b.x"): 1})[1] == [("moved", "a.x", "b.x"), ("removed", "a.y", "")]
    assert edit_script(["a.x"], ["b.x"], {})[1] == [("added", "", "b.x"), ("removed", "a.x", "")]


def test_moves_in_feeds(spark):
    """A moved field is told as removed and added; the script names the move."""
    files = spark.createDataFrame([(1, "f", 1, ""), (2, "f", 2, "")], FILES)
    records = spark.createDataFrame([(1, 1, 0, "s", '{"p": {"x": "one"}, "q": 1}', ""), (2, 2, 0, "s", '{"r": {"x": "one"}, "q": 1}', "")], RECORDS)
    assert {(r.change_kind, r.old_field, r.new_field) for r in schema_scripts(records, files).collect()} == {("moved", "p.x", "r.x"), ("renamed_node", "p", "r")}
    assert sorted(map(tuple, schema_changes(records, files).collect())) == [(2, "added", "", "r.x"), (2, "removed", "p.x", "")]


def test_names_are_one_over_feeds(spark):
    """Feed g never renames, but calls the field as feed f does after its rename."""
    assert one_name([("a", "b", 1), ("b", "c", 5)]) == {"a": "b", "b": "b", "c": "b"}
    files = [(1, "f", 1), (2, "f", 2), (3, "g", 1)]
    _, rows = run(spark, files, [(1, 0, "s", '{"why": "x"}'), (2, 0, "s", '{"reason": "x"}'), (3, 0, "t", '{"reason": 5, "Why": true}'), (3, 1, "u", '{"reason": 5, "why": 6}')])
    assert [rows[i]["f__why__2"] for i in range(4)] == ["x", "x", "5", "6"] and rows[2]["f__Why"] is True
    assert rows[3].other == {"reason": "5"}


def test_changes(spark):
    j = json.dumps
    files = [(10, "f", 1), (11, "f", 3), (12, "f", 2), (13, "g", 1), (14, None, 1)]
    records = [
        (10, 0, "s1", j({"p": {"explanation": "one"}, "n": 1, "old": "z"})), (10, 1, "s2", j({"p": {"explanation": "two"}, "n": 2})), (10, 2, "s3", "broken {"), (10, 3, "s4", "null"), (10, 4, None, ""),
        # file 12 comes second: renamed under its parent, one field gone, one new
        (12, 0, "s1", j({"p": {"reason": "one"}, "n": 1, "fresh": True})), (12, 1, "s5", j({"p": {"reason": "five"}, "n": None})),
        # file 11 comes third: the renamed field's type differs from the one it had under its old name
        (11, 0, "s1", j({"p": {"reason": ["one"]}, "n": "1", "fresh": True})),
        (13, 0, "s1", j({"p": 1})), (14, 0, "s1", j({"p": 2})), (99, 0, "s1", j({"p": 3})),
    ]
    got, rows = run(spark, files, records)
    assert got == [
        (11, "retyped", "n", "n"), (11, "retyped", "p.reason", "p.reason"), (12, "added", "", "fresh"), (12, "removed", "old", ""), (12, "renamed", "p.explanation", "p.reason"),
    ]
    # one column under one name, of one type over all files
    assert rows[0]["f__p__explanation"] == ["one"] and rows[5]["f__p__explanation"] == ["one"] and rows[7]["f__p__explanation"] == ["one"]
    assert rows[0]["f__n"] == "1" and rows[6]["f__n"] is None and rows[5]["f__fresh"] is True and 2 not in rows


def test_values_that_disagree_are_no_rename(spark):
    files = [(1, "f", 1), (2, "f", 2)]
    got, _ = run(spark, files, [(1, 0, "a", '{"x": 1}'), (1, 1, "b", '{"x": 2}'), (2, 0, "a", '{"y": 1}'), (2, 1, "b", '{"y": 2.0}')])
    assert got == [(2, "added", "", "y"), (2, "removed", "x", "")]


def test_empty(spark):
    got, rows = run(spark, [], [])
    assert got == [] and rows == {}
