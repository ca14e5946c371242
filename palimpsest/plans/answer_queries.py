"""Queries over sections, prompts, answers, scores and the control plane (E2-E10, F, G1-G2, H, I6-I9, S)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import answers as A
from palimpsest.operators import audit, control, evaluation, prompts
from palimpsest.session import table
from palimpsest.streaming import manage, stages

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


DOC = ["company", "policy", "version_ts"]


def _sections(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "diff_sections")


def _month():
    """Slices of a company's sections in the order of their versions; a null version comes first."""
    return F.coalesce(F.substring("version_ts", 1, 6), F.lit(""))


SIZE = "coalesce(length(before), 0) + coalesce(length(\"after\"), 0)"
PAGED = f"""SELECT *, dense_rank() OVER (PARTITION BY company ORDER BY page) AS page_no FROM (
  SELECT *, (sum({SIZE}) OVER (PARTITION BY company ORDER BY version_ts, section_id ROWS UNBOUNDED PRECEDING) // 40000)::INT AS page FROM diff_sections)"""


@query("E2_prompt_pages", f"SELECT section_id, page, page_no::INT AS page_no FROM ({PAGED})")
def e2(spark, d):
    return prompts.paged(_sections(spark, d), "company", index="version_ts", tie="section_id", slice_by=_month()).select("section_id", "page", "page_no")


@query("E2_page_sizes", f"SELECT company, page_no::INT AS page_no, count(*) AS n_sections FROM ({PAGED}) GROUP BY 1, 2")
def e2b(spark, d):
    return prompts.pages(_sections(spark, d), "company", index="version_ts", tie="section_id", slice_by=_month()).select("company", "page_no", F.col("n_sections"))


def _labelled(spark, d):
    """Labels with the prediction beside them: the human truth, and the suggestion made to the human as prediction."""
    rows = evaluation.true_labels(table(spark, d, "gold_labels"))
    return rows.select(F.concat_ws("/", *DOC).alias("doc"), "truth", F.col("suggested").alias("pred"))


WRONG = f"""SELECT w.doc, chars FROM (SELECT DISTINCT company || '/' || policy || '/' || version_ts AS doc FROM gold_labels WHERE practically_substantive = 'False' AND suggestion = 'True'
  AND model_version IS NOT NULL AND prompt_version IS NOT NULL AND schema_version IS NOT NULL) w
  JOIN (SELECT company || '/' || policy || '/' || version_ts AS doc, sum({SIZE})::BIGINT AS chars FROM diff_sections GROUP BY 1) USING (doc)"""


@query("E3_worked_examples", f"SELECT doc, chars FROM (SELECT *, row_number() OVER (ORDER BY chars, doc) AS n, sum(chars) OVER (ORDER BY chars, doc ROWS UNBOUNDED PRECEDING) AS upto FROM ({WRONG})) WHERE n <= 3 AND upto < 50000")
def e3(spark, d):
    size = F.coalesce(F.length("before"), F.lit(0)) + F.coalesce(F.length("after"), F.lit(0))
    lengths = _sections(spark, d).groupBy(F.concat_ws("/", *DOC).alias("doc")).agg(F.sum(size).cast("bigint").alias("chars"))
    return prompts.worked_examples(_labelled(spark, d), lengths).select("doc", "chars")


def _prompts(spark, d):
    pages = prompts.pages(_sections(spark, d).withColumn("index", F.col("section_idx")), *DOC, tie="section_id", page_chars=6000)
    return pages.withColumn("prompt", prompts.prompt(F.lit("Say whether the change matters."), prompts.history(F.array(F.lit("first query"), F.lit("second query"))), F.col("content")))


P6000 = f"""SELECT *, dense_rank() OVER (PARTITION BY company, policy, version_ts ORDER BY page) AS page_no FROM (
  SELECT *, sum({SIZE}) OVER (PARTITION BY company, policy, version_ts ORDER BY section_idx, section_id ROWS UNBOUNDED PRECEDING) // 6000 AS page FROM diff_sections)"""
# the sections of a page as JSON; null sides are left out
_SECTION = """'{"index":' || section_idx || ',"section_id":' || section_id || coalesce(',"before":' || to_json("before")::VARCHAR, '') || coalesce(',"after":' || to_json("after")::VARCHAR, '') || '}'"""
CONTENT = f"""SELECT company, policy, version_ts, page_no::INT AS page_no, count(*) AS n_sections, '{{"diffs":[' || string_agg({_SECTION}, ',' ORDER BY section_idx, section_id) || ']}}' AS content FROM ({P6000}) GROUP BY ALL"""


@query("E5_history", f"""SELECT company, policy, version_ts, page_no, n, CASE WHEN n % 2 = 0 THEN 'user' ELSE 'assistant' END AS role, CASE n WHEN 0 THEN 'first query' WHEN 2 THEN 'second query' ELSE '{prompts.EXAMPLE_ANSWER}' END AS content
FROM (SELECT DISTINCT company, policy, version_ts, page_no::INT AS page_no FROM ({P6000})) CROSS JOIN (SELECT unnest([0, 1, 2, 3])::INT AS n)""")
def e5(spark, d):
    return _prompts(spark, d).select(*DOC, "page_no", F.posexplode("prompt.history").alias("n", "m")).select(*DOC, "page_no", "n", "m.role", "m.content")


@query("E6_prompts", f"SELECT company, policy, version_ts, page_no, n_sections, length(content)::INT AS n_chars FROM ({CONTENT})")
def e6(spark, d):
    return _prompts(spark, d).select(*DOC, "page_no", "n_sections", F.length("prompt.current.content").alias("n_chars"))


@query("E7_prompt_check", """SELECT doc_id, n AS chars, n >= 200000 AS over_window, CASE WHEN n >= 50000 THEN 'Prompt length ' || n || ' exceeds rate limit of 50000 / minute.' END AS error
  FROM (SELECT doc_id, (200 * length(text) + 31)::INT AS n FROM documents WHERE text IS NOT NULL)""")
def e7(spark, d):
    """Every text 200 times over as one prompt."""
    p = prompts.prompt(F.lit("Say whether the change matters."), F.array().cast("array<struct<role:string,content:string>>"), F.repeat("text", F.lit(200)))
    return table(spark, d, "documents").where("text is not null").select("doc_id", prompts.prompt_check(p).alias("c")).select("doc_id", "c.*")


@query("E4_example_answers", f"SELECT doc, FALSE AS rating, TRUE AS valid FROM (SELECT *, row_number() OVER (ORDER BY chars, doc) AS n, sum(chars) OVER (ORDER BY chars, doc ROWS UNBOUNDED PRECEDING) AS upto FROM ({WRONG})) WHERE n <= 3 AND upto < 50000")
def e4(spark, d):
    """The fixed answer beside each worked example, read back by the schema it must fit."""
    a = F.lit(prompts.EXAMPLE_ANSWER)
    return e3(spark, d).select("doc", F.from_json(a, A.V2)["practically_substantive"]["rating"].alias("rating"), A.valid_for(F.lit("v2"), a).alias("valid"))


@query("I6_running_sums", f"SELECT section_id, sum({SIZE}) OVER (PARTITION BY company ORDER BY version_ts, section_id ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM diff_sections")
def i6(spark, d):
    size = F.coalesce(F.length("before"), F.lit(0)) + F.coalesce(F.length("after"), F.lit(0))
    return prompts.running_sum(_sections(spark, d), size, ["company"], ["version_ts", "section_id"], _month()).select("section_id", "upto")


def _answers(spark, d):
    """Stored answers as page answers of their version."""
    rows = table(spark, d, "summary_records").where("version_ts is not null")
    return rows.withColumn("x", A.extract_udf("raw_json")).select(*DOC, F.col("record_id").alias("page_no"), F.col("x.success").alias("success"), F.col("x.data").alias("data"), F.col("x.error").alias("error"), F.col("raw_json").alias("raw"))


@query("E8_collected_answers", "SELECT company, policy, version_ts, count(*)::INT AS n_chunks FROM summary_records WHERE version_ts IS NOT NULL GROUP BY ALL")
def e8(spark, d):
    got = prompts.collect_answers(_answers(spark, d), *DOC)
    return got.select(*DOC, F.size(F.from_json("summary", "struct<chunks:array<string>>")["chunks"]).alias("n_chunks"))


@query("E9_scored_prompts", f"""SELECT company, policy, version_ts, page_no, '{{"practically_substantive": {{"rating": ' || contains(content, 'after') || ', "reason": "length ' || length(content) || '"}}}}' AS answer,
  'run-' || substr(md5(concat_ws('/', company, policy, version_ts, page_no)), 1, 16) AS run_id, 'p1' AS prompt_version, 'v2' AS schema_version FROM ({CONTENT})""")
def e9(spark, d):
    """Prompts answered by an injected scorer, with the run's identifiers."""
    got = prompts.score(_prompts(spark, d), lambda system, content: f'{{"practically_substantive": {{"rating": {str("after" in content).lower()}, "reason": "length {len(content)}"}}}}')
    return got.select(*DOC, "page_no", "answer", F.concat(F.lit("run-"), F.substring(F.md5(F.concat_ws("/", *DOC, "page_no")), 1, 16)).alias("run_id"), F.lit("p1").alias("prompt_version"), F.lit("v2").alias("schema_version"))


@query("E10_latest_runs", "SELECT summary_key, arg_max(record_id, file_id * 1000000 + line_no) AS record_id FROM summary_records GROUP BY summary_key")
def e10(spark, d):
    runs = table(spark, d, "summary_records", "summary_key", "record_id", "file_id", "line_no")
    return prompts.latest_runs(runs, "summary_key", order="file_id", tie="line_no").select("summary_key", "record_id")


def _records(spark, d):
    files = table(spark, d, "summary_files", "file_id", "schema_version")
    return table(spark, d, "summary_records").join(files, "file_id")


# every candidate in order: the whole answer, then each object, then each array; the first that parses is the answer
_CANDIDATES = f"list_concat([w], list_concat(regexp_extract_all(w, '{A.OBJECT}'), regexp_extract_all(w, '{A.ARRAY}')))"
_EXTRACTED = f"""SELECT record_id, len(ok) > 0 AS success, CASE WHEN len(ok) > 0 THEN json(ok[1])::VARCHAR END AS data, len(ok) > 0 AND NOT refused AS clean FROM (
  SELECT record_id, list_filter(list_transform({_CANDIDATES}, lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: json_valid(x)) AS ok,
    NOT coalesce(json_valid(trim(regexp_replace(regexp_extract_all(w, '{A.OBJECT}')[1], '\\s+', ' ', 'g'))), TRUE) AS refused
  FROM (SELECT record_id, $w AS w FROM summary_records))"""
EXTRACTED = _EXTRACTED.replace("$w", "'Here is the result:' || chr(10) || raw_json || chr(10) || 'Best regards'")


@query("F1_extract_json", EXTRACTED)
def f1(spark, d):
    rows = table(spark, d, "summary_records", "record_id", "raw_json").withColumn("wrapped", F.concat(F.lit("Here is the result:\n"), "raw_json", F.lit("\nBest regards")))
    return rows.withColumn("x", A.extract_udf("wrapped")).select("record_id", "x.success", F.get_json_object("x.data", "$").alias("data"), (F.col("x.success") & (F.col("x.error") == "")).alias("clean"))


V2_OK = "json_valid(raw_json) AND json_type(raw_json, '$.practically_substantive.rating') = 'BOOLEAN' AND json_type(raw_json, '$.practically_substantive.reason') NOT IN ('NULL')"


@query("F2_valid_v2", f"SELECT record_id, coalesce(CASE WHEN json_valid(raw_json) THEN {V2_OK} END, FALSE) AS valid FROM summary_records")
def f2(spark, d):
    whole = F.try_parse_json("raw_json").isNotNull() & F.ltrim("raw_json").startswith("{")
    return table(spark, d, "summary_records").select("record_id", F.when(whole, A.valid_for(F.lit("v2"), F.col("raw_json"))).otherwise(F.lit(False)).alias("valid"))


@query("F3_sanitised", f"""SELECT record_id, replace(replace(regexp_replace(data, '&([^#\\w]|$)', '&amp;\\1', 'g'), '<', '&lt;'), '>', '&gt;') AS clean FROM ({_EXTRACTED.replace('$w', 'raw_json')}) WHERE success""")
def f3(spark, d):
    rows = table(spark, d, "summary_records", "record_id", "raw_json").withColumn("x", A.extract_udf("raw_json")).where("x.success")
    return rows.select("record_id", F.get_json_object(A.sanitise_udf("x.data"), "$").alias("clean"))


def _is(path: str, kind: str) -> str:
    return f"coalesce(json_type(j, '$.{path}') = '{kind}', FALSE)"


def _some(path: str) -> str:
    return f"coalesce(json_type(j, '$.{path}') <> 'NULL', FALSE)"


_V1 = " AND ".join([f"{_is(f'{p}.rating', 'BOOLEAN')} AND {_some(f'{p}.explanation')}" for p in ("legally_substantive", "practically_substantive")] + [_is(f"{k}_keywords", "ARRAY") for k in ("change", "subject", "helm")])
_V2 = f"{_is('practically_substantive.rating', 'BOOLEAN')} AND {_some('practically_substantive.reason')}"
JSON_ROWS = "SELECT record_id, schema_version, CASE WHEN json_valid(raw_json) THEN raw_json::JSON END AS j FROM summary_records JOIN summary_files USING (file_id)"


@query("F5_valid_by_version", f"""SELECT record_id, schema_version, coalesce(CASE schema_version WHEN 'v0' THEN j IS NOT NULL WHEN 'v1' THEN {_V1} WHEN 'v2' THEN {_V2} WHEN 'v3' THEN {_is('chunks', 'ARRAY')} END, FALSE) AS valid FROM ({JSON_ROWS})""")
def f5(spark, d):
    return _records(spark, d).select("record_id", "schema_version", A.valid_for(F.col("schema_version"), F.col("raw_json")).alias("valid"))


MIGRATED = """SELECT record_id, CASE WHEN json_type(raw_json, '$.practically_substantive.rating') = 'BOOLEAN' THEN json_extract_string(raw_json, '$.practically_substantive.rating') = 'true' END AS rating,
  json_extract_string(raw_json, '$.practically_substantive.explanation') AS reason FROM summary_records WHERE json_valid(raw_json) AND starts_with(raw_json, '{')
  AND json_type(raw_json, '$.practically_substantive.explanation') = 'VARCHAR' AND json_type(raw_json, '$.practically_substantive.rating') = 'BOOLEAN'"""


@query("F6_migrate_v1", MIGRATED)
def f6(spark, d):
    rows = table(spark, d, "summary_records").where(F.try_parse_json("raw_json").isNotNull() & F.col("raw_json").startswith("{"))
    v = F.try_parse_json("raw_json")
    kind = lambda p: F.schema_of_variant(F.try_variant_get(v, p, "variant"))
    rows = rows.where((kind("$.practically_substantive.explanation") == "STRING") & (kind("$.practically_substantive.rating") == "BOOLEAN"))
    one = F.struct(F.from_json("raw_json", "struct<practically_substantive:struct<rating:boolean,explanation:string>>")["practically_substantive"].alias("practically_substantive"))
    two = A.v1_to_v2(one)["practically_substantive"]
    return rows.select("record_id", two["rating"].alias("rating"), two["reason"].alias("reason"))


def _first_chunk(v3):
    finding = F.get(v3["chunks"], F.lit(0))["practically_substantive"]
    return F.size(v3["chunks"]).alias("n_chunks"), finding["rating"].alias("rating"), finding["reason"].alias("reason")


def _finding(old: str) -> str:
    return f"""CASE WHEN json_type(j, '$.practically_substantive.rating') = 'BOOLEAN' THEN (j->>'$.practically_substantive.rating') = 'true' END AS rating, CASE WHEN {_some(f'practically_substantive.{old}')} THEN j->>'$.practically_substantive.{old}' END AS reason"""


@query("F7_migrate_v2", f"SELECT record_id, 1 AS n_chunks, {_finding('reason')} FROM ({JSON_ROWS})")
def f7(spark, d):
    return _records(spark, d).withColumn("v3", A.v2_to_v3(F.from_json("raw_json", A.REGISTRY["v2"]))).select("record_id", *_first_chunk(F.col("v3")))


@query("F8_migrate_all", f"""SELECT record_id, schema_version, 1 AS n_chunks, {_finding('explanation')} FROM ({JSON_ROWS}) WHERE schema_version = 'v1'
UNION ALL SELECT record_id, schema_version, 1, {_finding('reason')} FROM ({JSON_ROWS}) WHERE schema_version = 'v2'
UNION ALL SELECT record_id, schema_version, CASE WHEN json_type(j, '$.chunks') = 'ARRAY' THEN json_array_length(j, '$.chunks')::INT END, CASE WHEN json_type(j, '$.chunks[0].practically_substantive.rating') = 'BOOLEAN' THEN (j->>'$.chunks[0].practically_substantive.rating') = 'true' END,
  j->>'$.chunks[0].practically_substantive.reason' FROM ({JSON_ROWS}) WHERE schema_version IS NULL OR schema_version NOT IN ('v1', 'v2')""")
def f8(spark, d):
    """Chunks of every answer as v3, whatever version it was given in."""
    rows = _records(spark, d).withColumn("v3", A.to_v3(F.col("schema_version"), F.col("raw_json")))
    return rows.select("record_id", "schema_version", *_first_chunk(F.col("v3")))


@query("F4_call_and_validate", f"SELECT doc_id, coalesce(length(text) > 0, FALSE) AS called, coalesce(length(text) > 0 AND length(text) % 3 = 0, FALSE) AS valid FROM documents")
def f4(spark, d):
    """An injected model called on each text: empty texts are refused before the call, answers of another shape after it."""
    answer = lambda system, content: '{"practically_substantive": {"rating": true, "reason": "<b>' + str(len(content)) + '</b>"}}' if len(content) % 3 == 0 else "no answer"
    p = prompts.prompt(F.lit("Say whether the change matters."), F.array().cast("array<struct<role:string,content:string>>"), F.col("text"))
    rows = prompts.call_and_validate(table(spark, d, "documents", "doc_id", "text").withColumn("prompt", p), answer, "v2")
    return rows.select("doc_id", F.col("answer").isNotNull().alias("called"), F.col("clean").isNotNull().alias("valid"))


@query("A16_constant_model", "SELECT doc_id, CASE WHEN text IS NOT NULL AND text <> '' THEN 'Hello world' END AS answer FROM documents")
def a16(spark, d):
    """The model that always says the same."""
    p = prompts.prompt(F.lit("s"), F.array().cast("array<struct<role:string,content:string>>"), F.col("text"))
    return prompts.call_unsafe(table(spark, d, "documents", "doc_id", "text").withColumn("prompt", p), prompts.constant).select("doc_id", "answer")


@query("F9_chunk_records", "SELECT company, policy, version_ts, chunk_idx, text FROM doc_chunks WHERE version_ts IS NOT NULL")
def f9(spark, d):
    rows = table(spark, d, "doc_chunks").where("version_ts is not null")
    enc = rows.groupBy(*DOC).agg(F.to_json(F.collect_list(F.to_json(F.struct(*DOC, "chunk_idx", "text")))).alias("j"))
    return enc.select(F.explode(A.chunk_record(F.col("j"))).alias("c")).select("c.*")


def _both(spark, d):
    gold = evaluation.true_labels(table(spark, d, "gold_labels"))
    rows = _records(spark, d).where("version_ts is not null").withColumn("run_id", F.col("summary_key")).withColumn("prompt_version", F.coalesce(F.when(F.try_parse_json("raw_json").isNotNull(), F.get_json_object("raw_json", "$.prompt_version")), F.lit("none")))
    return evaluation.joined(gold, evaluation.pred_labels(rows))


GOLD = """SELECT company, policy, version_ts, model_version, (practically_substantive = 'True')::INT AS truth FROM gold_labels WHERE practically_substantive IN ('True', 'False') AND suggestion IN ('True', 'False')
  AND company IS NOT NULL AND policy IS NOT NULL AND version_ts IS NOT NULL AND model_version IS NOT NULL AND prompt_version IS NOT NULL AND schema_version IS NOT NULL"""
RATED = "CASE WHEN json_valid(raw_json) AND starts_with(ltrim(raw_json), '{') THEN CASE lower(json_extract_string(raw_json, '$.practically_substantive.rating')) WHEN 'true' THEN 1.0 WHEN 'yes' THEN 1.0 WHEN 'y' THEN 1.0 WHEN 't' THEN 1.0 WHEN '1' THEN 1.0 WHEN 'false' THEN 0.0 WHEN 'no' THEN 0.0 WHEN 'n' THEN 0.0 WHEN 'f' THEN 0.0 WHEN '0' THEN 0.0 END END"
PRED = f"""SELECT company, policy, version_ts, summary_key AS run_id, coalesce(CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.prompt_version') END, 'none') AS prompt_version_pred,
  schema_version AS schema_version_pred, {RATED} AS pred FROM summary_records JOIN summary_files USING (file_id) WHERE version_ts IS NOT NULL"""
BOTH = f"SELECT g.*, p.run_id, p.prompt_version_pred, p.schema_version_pred, p.pred, p.run_id IS NOT NULL AND p.pred IS NULL AS parse_error FROM ({GOLD}) g LEFT JOIN ({PRED}) p USING (company, policy, version_ts)"


@query("G1_labels_with_predictions", f"SELECT company, policy, version_ts, truth, run_id, pred::DOUBLE AS pred FROM ({BOTH})")
def g1(spark, d):
    return _both(spark, d).select(*DOC, "truth", "run_id", "pred")


@query("H2_predictions", f"SELECT run_id, prompt_version_pred AS prompt_version, pred IS NULL AS parse_error, pred::DOUBLE AS pred FROM ({PRED})")
def h2(spark, d):
    rows = _records(spark, d).where("version_ts is not null").withColumn("run_id", F.col("summary_key")).withColumn("prompt_version", F.coalesce(F.when(F.try_parse_json("raw_json").isNotNull(), F.get_json_object("raw_json", "$.prompt_version")), F.lit("none")))
    return evaluation.pred_labels(rows).select("run_id", "prompt_version", "parse_error", "pred")


@query("H3_totals", f"SELECT model_version, count(DISTINCT (company, policy, version_ts)) AS n_documents FROM ({BOTH}) GROUP BY model_version")
def h3(spark, d):
    return evaluation.totals(_both(spark, d))


RATES = f"""WITH b AS ({BOTH}), t AS (SELECT model_version, count(DISTINCT (company, policy, version_ts)) AS n FROM b GROUP BY 1)
SELECT model_version, prompt_version_pred, schema_version_pred, count(DISTINCT run_id) AS n_runs, count(*) FILTER (pred IS NOT NULL) AS n_valid,
  round_even(count(DISTINCT run_id)::DOUBLE / max(n), 2) AS json_rate, round_even(count(*) FILTER (pred IS NOT NULL)::DOUBLE / max(n), 2) AS schema_rate
FROM b JOIN t USING (model_version) GROUP BY 1, 2, 3"""


@query("H4_json_and_schema_rates", RATES)
def h4(spark, d):
    return evaluation.json_rates(_both(spark, d))


METRICS = f"""WITH c AS (SELECT model_version, prompt_version_pred, schema_version_pred, count(*) FILTER (truth = 1 AND pred = 1) AS tp, count(*) FILTER (truth = 0 AND pred = 1) AS fp,
  count(*) FILTER (truth = 1 AND pred = 0) AS fn, count(*) FILTER (truth = 0 AND pred = 0) AS tn FROM ({BOTH}) WHERE pred IS NOT NULL GROUP BY 1, 2, 3)
SELECT *, round_even((tp + tn)::DOUBLE / (tp + fp + fn + tn), 2) AS accuracy, CASE WHEN tp + fp > 0 THEN round_even(tp::DOUBLE / (tp + fp), 2) ELSE 0.0::DOUBLE END AS precision,
  CASE WHEN tp + fn > 0 THEN round_even(tp::DOUBLE / (tp + fn), 2) ELSE 0.0::DOUBLE END AS recall, CASE WHEN 2 * tp + fp + fn > 0 THEN round_even(2 * tp::DOUBLE / (2 * tp + fp + fn), 2) ELSE 0.0::DOUBLE END AS f1 FROM c"""


@query("H6_metrics", METRICS)
def h6(spark, d):
    return evaluation.metrics(_both(spark, d))


@query("G2_totals_with_rates", f"SELECT r.model_version, r.prompt_version_pred, r.schema_version_pred, t.n_documents, r.n_runs, r.n_valid FROM ({RATES}) r JOIN (SELECT model_version, count(DISTINCT (company, policy, version_ts)) AS n_documents FROM ({BOTH}) GROUP BY 1) t USING (model_version)")
def g2(spark, d):
    both = _both(spark, d)
    return evaluation.json_rates(both).join(evaluation.totals(both), "model_version").select(*evaluation.GROUP, "n_documents", "n_runs", "n_valid")


@query("H5_schema_rate", f"SELECT model_version, prompt_version_pred, schema_version_pred, schema_rate FROM ({RATES})")
def h5(spark, d):
    return evaluation.json_rates(_both(spark, d)).select(*evaluation.GROUP, "schema_rate")


@query("H12_all_scores", f"SELECT r.*, m.accuracy, m.precision, m.recall, m.f1 FROM ({RATES}) r LEFT JOIN ({METRICS}) m ON r.model_version = m.model_version AND r.prompt_version_pred IS NOT DISTINCT FROM m.prompt_version_pred AND r.schema_version_pred IS NOT DISTINCT FROM m.schema_version_pred")
def h12(spark, d):
    """All scores of a group side by side; a group without a rated answer has no metrics."""
    both = _both(spark, d)
    return evaluation.all_scores(both)


@query("H8_report", f"SELECT count(*) AS n_rows, FALSE AS cut, NULL::VARCHAR AS message FROM ({RATES})")
def h8(spark, d):
    """The HTML report of the scores: its rows, and whether it says that some are left out."""
    html = evaluation.report_html(evaluation.json_rates(_both(spark, d)))
    return spark.createDataFrame([(html.count("<tr>"), "First " in html, None)], "n_rows long, cut boolean, message string")


@query("H7_empty_report", "SELECT 'No labels to evaluate.' AS message")
def h7(spark, d):
    return spark.createDataFrame([(evaluation.report_html(evaluation.json_rates(_both(spark, d).limit(0))),)], "message string")


@query("H1_true_labels", f"SELECT company, policy, version_ts, model_version, truth FROM ({GOLD})")
def h1(spark, d):
    return evaluation.true_labels(table(spark, d, "gold_labels")).select(*DOC, "model_version", "truth")


@query("I4_examples_to_label", f"SELECT version_ts, count(*)::INT AS n FROM ({PRED}) WHERE pred = 1 GROUP BY version_ts ORDER BY n DESC, version_ts LIMIT 20")
def i4(spark, d):
    """A report with a limit of its own: the 20 versions rated substantive most often."""
    rows = _records(spark, d).where("version_ts is not null").withColumn("run_id", F.col("summary_key")).withColumn("prompt_version", F.lit(""))
    return evaluation.pred_labels(rows).where("pred = 1").groupBy("version_ts").agg(F.count("*").cast("int").alias("n")).orderBy(F.desc("n"), "version_ts").limit(20)


@query("I8_page_breaks", f"SELECT company, count(*) FILTER (was IS NULL OR was <> page) AS n_pages FROM (SELECT *, lag(page) OVER (PARTITION BY company ORDER BY version_ts, section_id) AS was FROM ({PAGED})) GROUP BY 1")
def i8(spark, d):
    """Where the running page changes a new one begins; as it never falls, these are as many as the distinct pages."""
    rows = prompts.paged(_sections(spark, d), "company", index="version_ts", tie="section_id", slice_by=_month())
    return rows.groupBy("company").agg(F.count_distinct("page").alias("n_pages"))


OPS = "SELECT 'w' || (user_id % 4) AS workflow, ts, event_id AS seq, CASE event_type WHEN 'error' THEN 'TRIP' WHEN 'signup' THEN 'RESET' ELSE 'GET_STATUS' END AS op, props FROM events"


@query("S2_breaker_replay", f"""WITH o AS (SELECT *, sum((op = 'RESET')::INT) OVER (PARTITION BY workflow ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS epoch FROM ({OPS})),
t AS (SELECT *, sum((op = 'TRIP')::INT) OVER w AS trips, last_value(CASE WHEN op = 'TRIP' THEN props END IGNORE NULLS) OVER w AS err FROM o WINDOW w AS (PARTITION BY workflow, epoch ORDER BY ts, seq ROWS UNBOUNDED PRECEDING))
SELECT workflow, seq, op, greatest(0, 3 - trips)::INT AS strikes, trips >= 3 AS is_open, CASE WHEN trips >= 3 THEN err END AS error_message FROM t""")
def s2(spark, d):
    return control.breaker_replay(stages.operations(table(spark, d, "events"))).select("workflow", "seq", "op", "strikes", "is_open", "error_message")


# the limiter call by call: each row of a workflow goes on from the state after the one before
LIMITER = """WITH RECURSIVE calls AS (SELECT *, epoch_us(ts) AS us, floor(epoch(ts) / {period})::BIGINT AS win, row_number() OVER (PARTITION BY workflow ORDER BY ts, seq) AS k FROM ({ops})),
run(workflow, k, seq, allowed, prev, cur, remaining, last_win) AS (
  SELECT workflow, 0::BIGINT, NULL::BIGINT, FALSE, 0::BIGINT, 0::BIGINT, {rpm}::BIGINT, NULL::BIGINT FROM (SELECT DISTINCT workflow FROM calls)
  UNION ALL
  SELECT workflow, k, seq, ok, p, c + ok::BIGINT, CASE WHEN ok THEN {rpm} - (c + 1) - p ELSE remaining END, CASE WHEN ok OR last_win IS NULL THEN win ELSE last_win END FROM (
    SELECT *, ceil(p * ({period} - sec)::DOUBLE / {period} + c) < {rpm} AS ok FROM (
      SELECT r.workflow, c.k, c.seq, c.win, r.last_win, r.remaining, date_part('second', c.ts) AS sec,
        CASE WHEN coalesce(r.last_win, c.win) = c.win - 1 THEN r.cur WHEN coalesce(r.last_win, c.win) <> c.win THEN 0 ELSE r.prev END AS p,
        CASE WHEN coalesce(r.last_win, c.win) <> c.win THEN 0 ELSE r.cur END AS c
      FROM run r JOIN calls c ON c.workflow = r.workflow AND c.k = r.k + 1)))
SELECT workflow, seq, allowed, prev::INT AS used_previous, cur::INT AS used_current, remaining::INT AS remaining FROM run WHERE k > 0"""


@query("S1_limiter_replay", LIMITER.format(rpm=2, period=3600, ops=OPS))
def s1(spark, d):
    return control.limiter_replay(stages.operations(table(spark, d, "events")), rpm=2, period=3600).drop("ts")


@query("S2_breaker_stream", f"""WITH o AS (SELECT *, sum((op = 'RESET')::INT) OVER (PARTITION BY workflow ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS epoch FROM ({OPS})),
t AS (SELECT *, sum((op = 'TRIP')::INT) OVER (PARTITION BY workflow, epoch ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS trips FROM o)
SELECT workflow, seq, op, greatest(0, 3 - trips)::INT AS strikes, trips >= 3 AS is_open FROM t""")
def s2_stream(spark, d):
    events = stages.arrivals(spark, d, table(spark, d, "events").schema, pattern="events.parquet")
    return stages.run_available(stages.breaker_stream(stages.operations(events)), stages.shared_folder(spark)).select("workflow", "seq", "op", "strikes", "is_open")


@query("S1_limiter_stream", LIMITER.format(rpm=10, period=60, ops=OPS))
def s1_stream(spark, d):
    events = stages.arrivals(spark, d, table(spark, d, "events").schema, pattern="events.parquet")
    return stages.run_available(stages.limiter_stream(stages.operations(events)), stages.shared_folder(spark)).drop("ts")


@query("S3_orchestrated")
def s3(spark, d):
    """Events as tasks of four workflows, run through breaker, limiter and retries: errors fail always, searches once."""
    fails = F.when(F.col("event_type") == "error", 99).when(F.col("event_type") == "search", 1).otherwise(0)
    tasks = table(spark, d, "events").select(F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workflow"), F.col("event_id").cast("string").alias("task_id"), "ts", fails.alias("failures"))
    return control.orchestrated(tasks)


@query("S4_waiting_for_circuit", f"""WITH o AS (SELECT 'w' || (user_id % 4) AS workflow, event_id, ts, event_type FROM events), e AS (
  SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY workflow ORDER BY ts, event_id::VARCHAR ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o)
SELECT workflow, event_id::VARCHAR AS task_id, CASE WHEN before >= 3 THEN 'Waiting for circuit' WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS status FROM e""")
def s4(spark, d):
    """Tasks that are tried once and never throttled: three that fail open the circuit, and all after them wait for it."""
    tasks = table(spark, d, "events").select(F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workflow"), F.col("event_id").cast("string").alias("task_id"), "ts", F.when(F.col("event_type") == "error", 9).otherwise(0).alias("failures"))
    return control.orchestrated(tasks, (10**9, 60, 20, 1, 60)).select("workflow", "task_id", "status")


@query("S5_throttled", """WITH w AS (SELECT 'w' || (user_id % 4) AS workflow, min(ts) AS low, count(*) AS n FROM events GROUP BY 1)
SELECT workflow, n, n AS done FROM w""")
def s5(spark, d):
    """Tasks that all come at once under a limit of five a minute are all done in the end, each after its waits."""
    rows = table(spark, d, "events").select(F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workflow"), F.col("event_id").cast("string").alias("task_id"), F.lit("2024-01-01").cast("timestamp").alias("ts"), F.lit(0).alias("failures"))
    got = control.orchestrated(rows, (50, 60, 20, 1, 60))
    return got.groupBy("workflow").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "done").alias("done"))


@query("S7_breaker_states", f"""SELECT workflow, arg_max(strikes, (ts, seq))::INT AS strikes, arg_max(strikes, (ts, seq)) <= 0 AS is_open FROM (WITH o AS (SELECT *, sum((op = 'RESET')::INT) OVER (PARTITION BY workflow ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS epoch FROM ({OPS}))
SELECT workflow, ts, seq, greatest(0, 3 - sum((op = 'TRIP')::INT) OVER (PARTITION BY workflow, epoch ORDER BY ts, seq ROWS UNBOUNDED PRECEDING)) AS strikes FROM o) GROUP BY workflow""")
def s7(spark, d):
    """The breakers as the state store holds them after the stream has taken in all operations."""
    out = stages.shared_folder(spark)
    stages.run_available(stages.breaker_stream(stages.operations(stages.arrivals(spark, d, table(spark, d, "events").schema, pattern="events.parquet"))), out)
    return manage.breaker_states(spark, f"{out}-state")


@query("S9_in_flight_page", "SELECT event_id::VARCHAR AS task_id FROM events WHERE event_type = 'click' AND event_id::VARCHAR > '2' ORDER BY 1 LIMIT 100")
def s9(spark, d):
    """The page of running tasks after a token: a limit is the feature."""
    tasks = table(spark, d, "events").select(F.col("event_id").cast("string").alias("task_id"), F.when(F.col("event_type") == "click", "Running").otherwise("Done").alias("status"))
    return manage.in_flight_page(tasks, "2").select("task_id")


@query("A19_stage_chain", f"""SELECT company, policy, version_ts, sum({SIZE})::BIGINT AS chars, count(*) AS n FROM diff_sections WHERE coalesce("before", '') <> coalesce("after", '') GROUP BY ALL""")
def a19(spark, d):
    """Seven stages set off by the files of the one before: names, clean sections, lengths, flags, prompts, checks, results."""
    steps = {
        "01-names": lambda s: s.withColumn("name", F.concat_ws("/", *DOC)),
        "02-sides": lambda s: s.withColumns({c: F.coalesce(c, F.lit("")) for c in ("before", "after")}),
        "03-changed": lambda s: s.where(F.col("before") != F.col("after")),
        "04-lengths": lambda s: s.withColumn("chars", F.length("before") + F.length("after")),
        "05-prompts": lambda s: s.withColumn("prompt", F.to_json(F.struct("before", "after"))).drop("before", "after"),  # the prompt holds both
        "06-checks": lambda s: s.withColumn("error", prompts.prompt_check(prompts.prompt(F.lit("s"), F.array().cast("array<struct<role:string,content:string>>"), F.col("prompt")))["error"]),
        "07-results": lambda s: s.select(*DOC, "section_id", "chars"),
    }
    folders = stages.chain(spark, d, table(spark, d, "diff_sections").schema, steps, stages.shared_folder(spark), "diff_sections.parquet")
    return spark.read.parquet(folders["07-results"]).groupBy(*DOC).agg(F.sum("chars").cast("bigint").alias("chars"), F.count("*").alias("n"))


TASKS = "SELECT event_id, user_id, event_type FROM events"


@query("S8_tasks_by_status", "SELECT 't' || event_id AS task_id, 'w' || (user_id % 4) AS workflow FROM events WHERE event_type = 'error' AND user_id % 4 = 1")
def s8(spark, d):
    once = F.to_json(F.struct(F.concat(F.lit("t"), "event_id").alias("task_id"), F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workflow_type")))
    twice = F.concat(F.lit('"'), F.replace(once, F.lit('"'), F.lit('\\"')), F.lit('"'))
    rows = table(spark, d, "events").select(F.col("event_type").alias("status"), F.when(F.col("event_id") % 2 == 0, once).otherwise(twice).alias("input"))
    return control.tasks_with(rows, "error", "w1").select("data.task_id", F.col("data.workflow_type").alias("workflow"))


@query("S10_to_kill", "SELECT event_id FROM events WHERE user_id % 4 = 2 AND event_type = 'click' AND value > 50")
def s10(spark, d):
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workflow"), F.when(F.col("event_type") == "click", "Running").otherwise("Done").alias("status"), F.when(F.col("value") > 50, "Waiting for circuit").otherwise("").alias("custom_status"))
    return control.to_kill(rows, "w2").select("event_id")
