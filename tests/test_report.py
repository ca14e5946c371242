from palimpsest.operators.evaluation import report_html


def test_report_says_what_is_left_out(spark):
    scores = spark.createDataFrame([(f"m{i}", i) for i in (3, 1, 2)], "model_version string, tp long")
    got = report_html(scores, most_rows=2)
    assert "First 2 of 3 rows." in got and "m1" in got and "m2" in got and "m3" not in got
    assert "First" not in report_html(scores, most_rows=3) and report_html(scores.limit(0)) == "No labels to evaluate."
