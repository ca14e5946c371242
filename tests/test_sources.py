import pytest
from pyspark.sql import functions as F

from palimpsest.operators.evaluation import joined, metrics, pred_labels, report_html, true_labels
from palimpsest.sources import blobs as B
from palimpsest.sources import web
from palimpsest.sources.web import FakeWeb, Response, fetch


def test_memory_store():
    m = B.MemoryBlobs()
    with pytest.raises(ValueError):
        m.list()
    m.create()
    m.upload("documents/s/c/p/1.json", b"{}", {"a": "1"})
    assert m.list() == ["s/c/p/1.json"] and m.exists("s/c/p/1.json") and m.load("documents/s/c/p/1.json") == b"{}"
    m.upload_metadata("s/c/p/1.json", {"b": "2"})
    m.upload_metadata("nothing", {"b": "2"})
    assert m.load_metadata("s/c/p/1.json") == {"b": "2"}
    m.remove("s/c/p/1.json")
    m.remove("s/c/p/1.json")
    with pytest.raises(ValueError):
        m.load("s/c/p/1.json")


def test_files_and_catalog(spark, tmp_path):
    for name, data in (("s1/c/p/1.json", '{"key": "value"}'), ("s1/c/p/2/run.txt", "text"), ("odd.txt", "x")):
        f = tmp_path / name
        f.parent.mkdir(parents=True, exist_ok=True)
        f.write_text(data)
    rows = B.scan(spark, str(tmp_path))
    assert sorted(r.name for r in rows.select("name").collect()) == ["odd.txt", "s1/c/p/1.json", "s1/c/p/2/run.txt"]
    assert B.load(rows, "s1/c/p/2/run.txt") == b"text" and {r.text for r in B.text(rows).collect()} >= {"text", "x"}
    with pytest.raises(ValueError):
        B.load(rows, "none")
    assert sorted((r.timestamp, r.run_id) for r in B.catalog(rows).collect()) == [("1", None), ("2", "run")]
    assert B.json_rows(spark, str(tmp_path / "s1/c/p/1.json"), "key string").first().key == "value"
    assert B.text_files(spark, str(tmp_path / "s1/c/p/2")).first().value == "text"


def test_write_replaces_partitions_that_occur(spark, tmp_path):
    out = str(tmp_path / "out")
    make = lambda rows: spark.createDataFrame(rows, "company string, v int")
    B.write(make([("a", 1), ("b", 1)]), out, "company")
    B.write(make([("a", 2)]), out, "company")
    assert sorted((r.company, r.v) for r in spark.read.parquet(out).collect()) == [("a", 2), ("b", 1)]


def test_fetch():
    ok, no = Response(200, b"x"), Response(403)
    assert fetch(FakeWeb(ok), "u").content == b"x"
    refusing = FakeWeb(no)
    assert fetch(refusing, "u").status == 403 and len(refusing.calls) == 7 and refusing.calls[-1][1] == {}
    with pytest.raises(RuntimeError):
        fetch(FakeWeb(no), "u", "api")
    with pytest.raises(RuntimeError):
        fetch(FakeWeb(ok, {"u": Response(404)}), "u")
    flaky = FakeWeb(ok, failing=1, error_status=403)
    assert fetch(flaky, "u").status == 200 and len(flaky.calls) == 2


def test_fetched_pages(spark):
    asked = web.seeds(spark, {"c": ["u1", "u2", "u3", "u4"]})
    resp = spark.createDataFrame([("u1", 200, bytearray(b"<body><p>hi</p><nav>n</nav></body>"), "text/html"), ("u2", 403, None, None), ("u3", 500, None, None)], "url string, status int, content binary, content_type string")
    got = {r.url: r for r in web.fetched_pages(asked, resp).collect()}
    assert "hi" in got["u1"].page and "nav" not in got["u1"].page and got["u2"].page is None and got["u2"].error is None
    assert got["u3"].error.message == "HTTP 500" and got["u4"].status == 200 and got["u4"].page is None


def test_scores(spark):
    g = spark.createDataFrame([("c", "p", str(i), "m", "p1", "v2", t, "True") for i, t in enumerate(["True", "True", "False", "False", "unsure", None])], "company string, policy string, version_ts string, model_version string, prompt_version string, schema_version string, practically_substantive string, suggestion string")
    js = ['{"practically_substantive": {"rating": true}}', '{"practically_substantive": {"rating": false}}', '{"chunks": [{"practically_substantive": {"rating": true}}, {}]}', "broken"]
    p = spark.createDataFrame([("c", "p", str(i), f"r{i}", "p9", "v2", j) for i, j in enumerate(js)], "company string, policy string, version_ts string, run_id string, prompt_version string, schema_version string, raw_json string")
    assert true_labels(g).count() == 4
    r = metrics(joined(true_labels(g), pred_labels(p))).collect()
    assert len(r) == 1 and (r[0].tp, r[0].fp, r[0].fn, r[0].tn) == (1, 1, 1, 0) and (r[0].accuracy, r[0].precision, r[0].f1) == (0.33, 0.5, 0.5)
    assert "<table" in report_html(metrics(joined(true_labels(g), pred_labels(p)))) and report_html(spark.range(0).select(F.col("id"))) == "No labels to evaluate."
