import pytest
from pyspark.sql import functions as F

from palimpsest.functions import columns as C


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "url, want",
    [
        ("https://example.com", "example.com"), ("https://www.example.com/", "example.com"), ("https://example.com/a/b/privacy", "privacy"), ("https://example.com/a/privacy/", "privacy"),
        ("https://sub.example.com", "sub.example.com"), ("https://example.com/terms.html", "terms"), ("https://example.com/terms?x=1#y", "terms"), ("https://example.com:8080/p", "p"),
        ("https://example.com:8080", "example.com_8080"), ("https://example.com/ .. ", "default"), ("https://example.com/a|b", "a_b"), ("", "default"),
    ],
)
def test_policy_of_url(spark, url, want):
    assert value(spark, C.policy_of_url(F.lit(url))) == want


@pytest.mark.parametrize("url, want", [("https://example.com/a", True), ("http://example.com", True), ("example.com", False), ("javascript:alert(1)", False), ("", False), ("//example.com", False), ("https://localhost:80/x", True), (None, False)])
def test_valid_url(spark, url, want):
    assert value(spark, C.valid_url(F.lit(url).cast("string"))) is want


@pytest.mark.parametrize("path, want", [
    ("stage1/c/p/2024-01-01.txt", ("stage1", "c", "p", "2024-01-01", None)), ("documents/stage1/c/p/20240101/run.1.txt", ("stage1", "c", "p", "20240101", "run.1")),
    ("a/b/c", None), ("a/b/c/d/e/f.json", None), ("s/c/p/.hidden", ("s", "c", "p", ".hidden", None)),
])
def test_blob_path(spark, path, want):
    got = value(spark, C.blob_path(F.lit(path)))
    assert (tuple(got) if got is not None else None) == want


def test_unparse_loses_the_extension(spark):
    assert value(spark, C.unparse(C.blob_path(F.lit("s/c/p/2024/run.json")))) == "s/c/p/2024/run"


@pytest.mark.parametrize("ts, status, want", [("20240101000000", "200", True), ("", "200", False), (None, "200", False), ("2024", "404", False), ("2024", "-", False), ("2024", None, False), ("2024", "1000", True), ("2024", "99", False)])
def test_valid_capture(spark, ts, status, want):
    assert value(spark, C.valid_capture(F.lit(ts).cast("string"), F.lit(status).cast("string"))) is want


def test_cdx_rows_cut_to_the_shorter(spark):
    got = value(spark, C.cdx_rows(F.lit('[["a","b"],["1","2"],["3"],["4","5","6"]]')))
    assert got == [{"a": "1", "b": "2"}, {"a": "3"}, {"a": "4", "b": "5"}]
    assert value(spark, C.cdx_rows(F.lit('[["a","b"]]'))) == []
