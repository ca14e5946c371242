"""Scores of predictions against human labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.columns import label_value

DOC = ["company", "policy", "version_ts"]


def true_labels(labels: DataFrame) -> DataFrame:
    """Labels with 1 or 0 for True or False; rows with a null in any column, 'unsure' among them, are left out."""
    named = labels.select(*DOC, "model_version", "prompt_version", "schema_version", label_value("practically_substantive").alias("truth"), label_value("suggestion").alias("suggested"))
    return named.dropna(how="any")


def rating_of(data: Column) -> Column:
    """Rating of an answer of any version; for several chunks, whether any is rated so."""
    flat = F.get_json_object(data, "$.practically_substantive.rating")
    many = F.from_json(data, "struct<chunks:array<struct<practically_substantive:struct<rating:boolean>>>>")["chunks"]
    return F.coalesce(flat.try_cast("boolean"), F.exists(many, lambda c: F.coalesce(c["practically_substantive"]["rating"], F.lit(False))))


def pred_labels(records: DataFrame) -> DataFrame:
    """Predictions from answers: parse_error for those that are no JSON object or lack a rating, else 1.0 or 0.0.

    records: doc columns, run_id, prompt_version, schema_version, raw_json.
    """
    ok = F.try_parse_json("raw_json").isNotNull() & F.ltrim("raw_json").startswith("{")
    rating = F.when(ok, rating_of(F.col("raw_json")))
    return records.select(*DOC, "run_id", "prompt_version", "schema_version", rating.isNull().alias("parse_error"), rating.cast("double").alias("pred"))


def joined(gold: DataFrame, pred: DataFrame) -> DataFrame:
    """Every label with the predictions for its version (left outer), clashing names marked _true and _pred."""
    g = gold.withColumnsRenamed({"prompt_version": "prompt_version_true", "schema_version": "schema_version_true"})
    p = pred.withColumnsRenamed({"prompt_version": "prompt_version_pred", "schema_version": "schema_version_pred"})
    return g.join(p, DOC, "left")


GROUP = ["model_version", "prompt_version_pred", "schema_version_pred"]


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, F.bround(a / b, 2)).otherwise(F.lit(0.0)).cast("double")


def totals(both: DataFrame) -> DataFrame:
    return both.groupBy("model_version").agg(F.count_distinct(*DOC).alias("n_documents"))


def json_rates(both: DataFrame) -> DataFrame:
    """Per group the share of documents of its model with a run, and of those whose answer fits."""
    got = both.groupBy(*GROUP).agg(F.count_distinct("run_id").alias("n_runs"), F.count_if(~F.col("parse_error")).alias("n_valid"))
    return got.join(totals(both), "model_version").select(*GROUP, "n_runs", "n_valid", _ratio(F.col("n_runs"), F.col("n_documents")).alias("json_rate"), _ratio(F.col("n_valid"), F.col("n_documents")).alias("schema_rate"))


def metrics(both: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 of each group in one pass; a zero denominator gives 0."""
    hit = lambda t, p: F.count_if((F.col("truth") == t) & (F.col("pred") == p))
    got = both.where("pred is not null").groupBy(*GROUP).agg(hit(1, 1).alias("tp"), hit(0, 1).alias("fp"), hit(1, 0).alias("fn"), hit(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return got.select(*GROUP, "tp", "fp", "fn", "tn", _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def all_scores(both: DataFrame) -> DataFrame:
    """Rates and metrics of each group in one row."""
    m = metrics(both).select(*[F.col(c).alias(f"m_{c}") for c in GROUP], "accuracy", "precision", "recall", "f1")
    r = json_rates(both)
    return r.join(m, [F.col(c).eqNullSafe(F.col(f"m_{c}")) for c in GROUP], "left").select(*r.columns, "accuracy", "precision", "recall", "f1")


def report_html(scores: DataFrame, most_rows: int = 1000) -> str:
    """The scores in order as an HTML table, or a message where there are none; beyond `most_rows` it says how many there are."""
    rows = scores.orderBy(*scores.columns).limit(most_rows + 1).toPandas()
    more = f"<p>First {most_rows} of {scores.count()} rows.</p>" if len(rows) > most_rows else ""
    return more + rows[:most_rows].to_html(index=False) if len(rows) else "No labels to evaluate."
