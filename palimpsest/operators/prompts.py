"""Captures to fetch, pages of sections, worked examples, prompts and their answers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.answers import extract_udf, sanitise_udf, valid_for
from palimpsest.functions.columns import capture_time, valid_capture

PAGE_CHARS, PROMPT_CHARS, WINDOW_CHARS = 40_000, 50_000, 200_000
EXAMPLE_ANSWER = '{"practically_substantive":{"rating":false,"reason":"The change does not affect what users may do or what happens to their data."}}'


def valid_captures(index: DataFrame) -> DataFrame:
    return index.where(valid_capture(F.col("capture_ts"), F.col("statuscode")))


def time_sample(captures: DataFrame, bins: int = 10, order: str = "capture_id") -> DataFrame:
    """Up to `bins` captures of each document: the first of each of min(bins, n) equal, right-closed stretches of time.

    Of a stretch each column gives its first value that is not null, so a row may draw on several captures. If any time of a
    document can't be read, its first `bins` captures are taken instead, as they are.
    """
    key = ["company", "policy"]
    whole = Window.partitionBy(*key)
    t = F.unix_micros(capture_time(F.col("capture_ts"))).cast("double")
    rows = captures.withColumn("t", t).withColumn("n", F.count("*").over(whole)).withColumn("low", F.min("t").over(whole)).withColumn("high", F.max("t").over(whole)).withColumn("bad", F.max(F.col("t").isNull()).over(whole))
    k = F.least(F.lit(bins), F.col("n"))
    place = F.when(F.col("high") > F.col("low"), F.greatest(F.lit(0), F.least(k - 1, (F.ceil((F.col("t") - F.col("low")) * k / (F.col("high") - F.col("low"))) - 1)))).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("bin", F.when(~F.col("bad"), place)).withColumn("in_bin", F.row_number().over(Window.partitionBy(*key, "bin").orderBy(order))).withColumn("in_key", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    within = Window.partitionBy(*key, "bin").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns({c: F.when(F.col("bad"), F.col(c)).otherwise(F.first(c, ignorenulls=True).over(within)) for c in captures.columns if c not in (*key, order)})
    return rows.where((~F.col("bad") & (F.col("in_bin") == 1)) | (F.col("bad") & (F.col("in_key") <= bins))).drop("t", "n", "low", "high", "bad", "in_bin", "in_key")


def running_sum(rows: DataFrame, value: Column, key: list[str], order: list[str], slice_by: Column | None = None, name: str = "upto") -> DataFrame:
    """Rows with the sum of `value` up to and with them in their key's order (nulls first).

    slice_by: never falling in that order. With it a key is summed slice by slice, each starting from the sum of those before it,
    so that a key with many rows is not one task.
    """
    if slice_by is None:
        return rows.withColumn(name, F.sum(value).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    part = rows.withColumns({"_slice": slice_by, "_value": value, **{f"_k{i}": F.coalesce(F.col(c).cast("string"), F.lit("\0")) for i, c in enumerate(key)}})
    keys = [f"_k{i}" for i in range(len(key))]
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = part.groupBy(*keys, "_slice").agg(F.sum("_value").alias("_sum")).select(*keys, "_slice", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    got = part.join(starts, [*keys, "_slice"]).withColumn(name, F.col("_start") + F.sum("_value").over(within))
    return got.drop("_slice", "_value", "_start", *keys)


def paged(sections: DataFrame, *doc: str, index: str = "index", tie: str | None = None, page_chars: int = PAGE_CHARS, slice_by: Column | None = None) -> DataFrame:
    """Sections with their page: the whole pages the characters up to and with them fill. page_no counts the pages in use.

    Sections go by index, those of one index by `tie`. A null side counts no characters. slice_by: see running_sum.
    """
    size = F.coalesce(F.length("before"), F.lit(0)) + F.coalesce(F.length("after"), F.lit(0))
    rows = running_sum(sections, size, list(doc), [index, *([tie] if tie else [])], slice_by, "_upto").withColumn("page", F.floor(F.col("_upto") / page_chars).cast("int")).drop("_upto")
    if slice_by is None:
        return rows.withColumn("page_no", F.dense_rank().over(Window.partitionBy(*doc).orderBy("page")))
    used = rows.select(*[F.col(c).alias(f"_d{i}") for i, c in enumerate(doc)], F.col("page").alias("_page")).distinct()
    keys = [f"_d{i}" for i in range(len(doc))]
    used = used.withColumn("page_no", F.row_number().over(Window.partitionBy(*keys).orderBy("_page")))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in zip(doc, keys)] + [F.col("page") == F.col("_page")]
    return rows.join(used, same).drop(*keys, "_page")


def pages(sections: DataFrame, *doc: str, index: str = "index", tie: str | None = None, page_chars: int = PAGE_CHARS, slice_by: Column | None = None) -> DataFrame:
    """One row a page with its sections in order and its characters."""
    s = F.struct(F.col(index).alias("index"), *([tie] if tie else []), "before", "after")
    rows = paged(sections, *doc, index=index, tie=tie, page_chars=page_chars, slice_by=slice_by).groupBy(*doc, "page_no").agg(F.array_sort(F.collect_list(s)).alias("sections"), F.count("*").alias("n_sections"))
    return rows.withColumn("content", F.to_json(F.struct(F.col("sections").alias("diffs"))))


def worked_examples(labelled: DataFrame, lengths: DataFrame, k: int = 3, most_chars: int = PROMPT_CHARS) -> DataFrame:
    """False positives with a clean diff, shortest first: at most k, and only while their lengths together stay below most_chars.

    labelled: doc, truth, pred. lengths: doc, chars (the documents that have a clean diff). Ties go by doc.
    """
    wrong = labelled.where((F.col("truth") == 0) & (F.col("pred") == 1)).select("doc").distinct().join(lengths, "doc")
    # only the k shortest can be taken, so the window sees k rows
    first = wrong.orderBy("chars", "doc").limit(k)
    by = Window.orderBy("chars", "doc")
    return first.withColumn("n", F.row_number().over(by)).withColumn("upto", F.sum("chars").over(by.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("upto") < most_chars)


def history(queries: Column) -> Column:
    """Queries and the fixed answer to each, in turn, as messages."""
    say = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    return F.flatten(F.transform(queries, lambda q: F.array(say("user", q), say("assistant", F.lit(EXAMPLE_ANSWER)))))


def prompt(system: Column, earlier: Column, current: Column) -> Column:
    return F.struct(system.alias("system"), earlier.alias("history"), F.struct(F.lit("user").alias("role"), current.alias("content")).alias("current"))


def prompt_check(p: Column, most: int = PROMPT_CHARS, window: int = WINDOW_CHARS) -> Column:
    """struct(chars, over_window, error): the error of a prompt that is too long, as a value."""
    chars = F.length(p["system"]) + F.coalesce(F.aggregate(p["history"], F.lit(0), lambda a, m: a + F.length(m["content"])), F.lit(0)) + F.length(p["current"]["content"])
    return F.struct(chars.alias("chars"), (chars >= window).alias("over_window"), F.when(chars >= most, F.format_string("Prompt length %d exceeds rate limit of %d / minute.", chars, F.lit(most))).alias("error"))


def collect_answers(answers: DataFrame, *doc: str) -> DataFrame:
    """{"chunks": [...]} of each document from its pages' answers in order; a page that failed stands as {error, raw}.

    answers: doc columns, page_no, success, data (JSON text), error, raw.
    """
    failed = F.to_json(F.struct(F.col("error").alias("error"), F.col("raw").alias("raw")))
    one = F.struct("page_no", F.when(F.col("success"), F.col("data")).otherwise(failed).alias("j"))
    got = answers.groupBy(*doc).agg(F.array_sort(F.collect_list(one)).alias("a"))
    return got.select(*doc, F.concat(F.lit('{"chunks": ['), F.array_join(F.transform("a", lambda x: x["j"]), ", "), F.lit("]}")).alias("summary"))


def constant(system: str, content: str) -> str:
    """The model that always says the same."""
    return "Hello world"


def call_unsafe(prompts: DataFrame, scorer: Callable[[str, str], str]) -> DataFrame:
    """Answers of an injected model as they come, null for a prompt whose parts are not both there (which is not sent).

    The model runs in Arrow batches, never in the plan by itself.
    """
    @F.pandas_udf("string")
    def run(system: pd.Series, content: pd.Series) -> pd.Series:
        return pd.Series([scorer(s, c) if s and c else None for s, c in zip(system, content)], dtype=object)

    return prompts.withColumn("answer", run("prompt.system", "prompt.current.content"))


def score(prompts: DataFrame, scorer: Callable[[str, str], str]) -> DataFrame:
    """Answers of an injected model; a prompt without system text or content is an error."""
    whole = (F.coalesce(F.length("prompt.system"), F.lit(0)) > 0) & (F.coalesce(F.length("prompt.current.content"), F.lit(0)) > 0)
    checked = F.when(whole, F.col("prompt")).otherwise(F.raise_error(F.lit("system prompt and content must not be empty")).cast(prompts.schema["prompt"].dataType))
    return call_unsafe(prompts.withColumn("prompt", checked), scorer)


def call_and_validate(prompts: DataFrame, scorer: Callable[[str, str], str], version: str) -> DataFrame:
    """Answers of an injected model with `clean`, the JSON text of a valid answer with markup escaped, and `error` as a value otherwise."""
    x = call_unsafe(prompts, scorer).withColumn("x", extract_udf("answer"))
    listed = F.coalesce(F.col("x.data").startswith("["), F.lit(False))
    valid = F.col("x.success") & ~listed & valid_for(F.lit(version), F.col("x.data"))
    error = F.when(~F.col("x.success"), F.concat(F.lit("no JSON in the answer: "), F.col("x.error"))).when(listed, "a list, not an object").when(~valid, f"not of schema {version}")
    return x.withColumns({"clean": F.when(valid, sanitise_udf("x.data")), "error": error}).drop("x")


def latest_runs(runs: DataFrame, *doc: str, order: str = "run_ts", tie: str = "run_id") -> DataFrame:
    """The latest run of each document: a view over the appended runs instead of a second file."""
    rest = [c for c in runs.columns if c not in doc]
    return runs.groupBy(*doc).agg(F.max_by(F.struct(*rest), F.struct(order, tie)).alias("r")).select(*doc, "r.*")
