"""Web responses as a table. Fetching is a side effect and stays on the driver behind a protocol; plans join responses."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.pages import decode_udf, main_text_udf

# What clients call themselves, the first for pages, then those tried after a refusal.
AGENTS = ["Mozilla/5.0 (Windows NT 10.0; Win64; x64)", "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7)", "Mozilla/5.0 (X11; Linux x86_64)", "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X)", "curl/8.0"]


@dataclass
class Response:
    status: int
    content: bytes = b""
    headers: dict[str, str] = field(default_factory=dict)

    def raise_for_status(self) -> Response:
        if self.status >= 400:
            raise RuntimeError(f"HTTP {self.status}")
        return self


def fetch(send: Callable[[str, dict[str, str]], Response], url: str, mode: str = "browser") -> Response:
    """One response; pages that are refused (403) are asked for again as other agents, with a referrer, and at last bare."""
    first = {"User-Agent": AGENTS[0]} if mode == "browser" else {"Accept": "application/json"}
    r = send(url, first)
    if mode != "browser" or r.status != 403:
        return r.raise_for_status()
    for headers in [*({"User-Agent": a} for a in AGENTS[1:]), {"User-Agent": AGENTS[0], "Referer": url}]:
        r = send(url, headers)
        if r.status != 403:
            return r.raise_for_status()
    return send(url, {})


class FakeWeb:
    """Answers by URL, else by default; the first `failing` calls fail, whatever the URL."""

    def __init__(self, default: Response | None = None, pages: dict[str, Response] | None = None, failing: int = 0, error_status: int = 500):
        self.default, self.pages, self.failing, self.error_status, self.calls = default or Response(200), pages or {}, failing, error_status, []

    def __call__(self, url: str, headers: dict[str, str]) -> Response:
        self.calls.append((url, headers))
        return Response(self.error_status) if len(self.calls) <= self.failing else self.pages.get(url, self.default)


def answered(requests: DataFrame, responses: DataFrame, default_status: int = 200) -> DataFrame:
    """Each request with its response, or the default."""
    return requests.join(responses.select("url", "status", "content", "content_type"), "url", "left").withColumn("status", F.coalesce("status", F.lit(default_status)))


def fetched_pages(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Main text of each request that was answered; a refusal (403) gives a null page, other failures an error value."""
    got = answered(requests, responses).withColumn("d", decode_udf("content", "content_type"))
    page = F.when(F.col("status") < 400, main_text_udf("d.html"))
    error = F.when((F.col("status") >= 400) & (F.col("status") != 403), F.struct(F.lit("web").alias("app"), F.lit("http").alias("error_type"), F.format_string("HTTP %d", "status").alias("message")))
    return got.select(*requests.columns, "status", page.alias("page"), F.col("d.encoding").alias("encoding"), error.alias("error"))


def seeds(spark: SparkSession, urls: dict[str, list[str]]) -> DataFrame:
    """(company, url) rows of a static list of pages."""
    flat = [(c, u) for c, us in urls.items() for u in us]
    return spark.createDataFrame(flat, "company string, url string")
