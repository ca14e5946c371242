"""Queries over names, captures, responses and audits (A, B, G, H9-H13 and E1 of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions import columns as C
from palimpsest.operators import audit, prompts
from palimpsest.operators.control import as_error
from palimpsest.session import table
from palimpsest.sources import blobs as B
from palimpsest.sources import web
from palimpsest.streaming.manage import due_again

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


NAMES = "SELECT DISTINCT 'documents/04-doclines/' || company || '/' || policy || '/' || version_ts || '.json' AS name FROM doc_chunks WHERE version_ts IS NOT NULL"


def _names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "doc_chunks", "company", "policy", "version_ts").where("version_ts is not null").distinct()
    return rows.select(F.concat_ws("/", F.lit("documents/04-doclines"), "company", "policy", F.concat("version_ts", F.lit(".json"))).alias("name"))


def _index(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "snapshot_index")


def _blobs(spark: SparkSession, d: str) -> DataFrame:
    """Each capture as a blob with metadata."""
    meta = F.map_from_arrays(F.array(F.lit("status"), F.lit("digest")), F.array("statuscode", "digest"))
    return _index(spark, d).select(F.concat(F.lit("documents/02-snapshots/"), F.col("capture_id").cast("string")).alias("name"), meta.alias("metadata"), "capture_id")


BLOBS = "SELECT 'documents/02-snapshots/' || capture_id AS name, statuscode AS status, digest, capture_id FROM snapshot_index"


@query("A1_list_names", f"SELECT DISTINCT substr(name, 11) AS name FROM ({NAMES})")
def a1(spark, d):
    return B.names(_names(spark, d))


@query("A5_metadata", f"SELECT name, status, digest FROM ({BLOBS})")
def a5(spark, d):
    return _blobs(spark, d).select("name", F.col("metadata")["status"].alias("status"), F.col("metadata")["digest"].alias("digest"))


@query("A6_overwrite_by_key", f"SELECT name, CASE WHEN capture_id % 7 = 0 THEN 'new' ELSE digest END AS digest FROM ({BLOBS})")
def a6(spark, d):
    rows = _blobs(spark, d).select("name", "capture_id", F.col("metadata")["digest"].alias("digest"))
    return B.upsert(rows, rows.where("capture_id % 7 = 0").withColumn("digest", F.lit("new")), "name").select("name", "digest")


@query("A7_replace_metadata", f"SELECT name, CASE WHEN capture_id % 5 = 0 THEN 'seen' ELSE status END AS status FROM ({BLOBS})")
def a7(spark, d):
    rows = _blobs(spark, d)
    changes = rows.where("capture_id % 5 = 0").select("name", F.map_from_arrays(F.array(F.lit("status")), F.array(F.lit("seen"))).alias("metadata"))
    unknown = changes.select(F.concat("name", F.lit("-none")).alias("name"), "metadata")
    return B.replace_metadata(rows, changes.unionByName(unknown)).select("name", F.col("metadata")["status"].alias("status"))


@query("A8_remove", f"SELECT name FROM ({BLOBS}) WHERE coalesce(status, '') <> '404'")
def a8(spark, d):
    rows = _blobs(spark, d)
    return B.remove(rows, rows.where(F.col("metadata")["status"] == "404")).select("name")


@query("A11_strip_container", f"SELECT name, regexp_replace(name, '^documents/', '') AS inner_name FROM ({NAMES})")
def a11(spark, d):
    return _names(spark, d).select("name", C.strip_container("name").alias("inner_name"))


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """One response an address: that of its last capture with a status of three digits."""
    rows = _index(spark, d).where(F.col("statuscode").rlike("^[1-9][0-9]{2}$"))
    got = rows.groupBy(F.col("original").alias("url")).agg(F.max_by("statuscode", "capture_id").cast("int").alias("status"))
    page = F.concat(F.lit("<html><body><nav>Menu</nav><p>Page at "), F.col("url"), F.lit("</p></body></html>"))
    return got.select("url", "status", F.encode(page, "UTF-8").alias("content"), F.lit("text/html; charset=utf-8").alias("content_type"))


RESPONSES = "SELECT original AS url, arg_max(statuscode, capture_id)::INT AS status FROM snapshot_index WHERE regexp_matches(statuscode, '^[1-9][0-9]{2}$') GROUP BY original"


@query("A13_good_responses", f"SELECT url, status FROM ({RESPONSES}) WHERE status < 400")
def a13(spark, d):
    return _responses(spark, d).where("status < 400").select("url", "status")


@query("A14_answers_or_default", f"SELECT capture_id, coalesce(status, 418) AS status FROM snapshot_index LEFT JOIN ({RESPONSES}) ON url = original")
def a14(spark, d):
    asked = _index(spark, d).select("capture_id", F.col("original").alias("url"))
    return web.answered(asked, _responses(spark, d), 418).select("capture_id", "status")


PARSED = "SELECT DISTINCT company, policy, version_ts FROM doc_chunks WHERE version_ts IS NOT NULL"


@query("A17_captures_not_parsed", f"SELECT capture_id FROM snapshot_index s WHERE NOT EXISTS (SELECT 1 FROM ({PARSED}) p WHERE p.company = s.company AND p.policy = s.policy AND p.version_ts = s.capture_ts)")
def a17(spark, d):
    done = table(spark, d, "doc_chunks", "company", "policy", F.col("version_ts").alias("capture_ts"))
    return audit.not_yet(_index(spark, d), done, "company", "policy", "capture_ts").select("capture_id")


@query("A18_fetch_pages", f"""SELECT capture_id, coalesce(status, 200) AS status, CASE WHEN coalesce(status, 200) >= 400 AND status <> 403 THEN 'http' END AS error_type,
  CASE WHEN status < 400 THEN strpos(original, '&') = 0 ELSE NULL END AS plain FROM snapshot_index LEFT JOIN ({RESPONSES}) ON url = original""")
def a18(spark, d):
    asked = _index(spark, d).select("capture_id", F.col("original").alias("url"))
    got = web.fetched_pages(asked, _responses(spark, d))
    return got.select("capture_id", "status", F.col("error.error_type").alias("error_type"), F.col("page").contains(F.col("url")).alias("plain"))


@query("A20_seeds", "SELECT DISTINCT company, original AS url FROM snapshot_index")
def a20(spark, d):
    lists = _index(spark, d).groupBy("company").agg(F.collect_set("original").alias("urls"))
    return lists.select("company", F.explode("urls").alias("url"))


@query("A21_labels_export", """SELECT label_id, 'True' = practically_substantive AS yes FROM gold_labels WHERE practically_substantive IS NOT NULL""")
def a21(spark, d):
    rows = table(spark, d, "gold_labels")
    nested = F.to_json(F.struct(F.struct("label_id", "model_version").alias("metadata"), F.map_from_arrays(F.array(F.lit("practically_substantive")), F.array(F.array(F.struct(F.col("practically_substantive").alias("value"))))).alias("responses")))
    shape = "struct<metadata:struct<label_id:bigint,model_version:string>,responses:map<string,array<struct<value:string>>>>"
    back = rows.select(F.from_json(nested, shape).alias("j")).select("j.metadata.label_id", F.col("j.responses")["practically_substantive"][0]["value"].alias("v"))
    return back.where("v is not null").select("label_id", (F.col("v") == "True").alias("yes"))


@query("B1_blob_path", f"""SELECT name, split_part(substr(name, 11), '/', 1) AS stage, split_part(substr(name, 11), '/', 2) AS company, split_part(substr(name, 11), '/', 3) AS policy,
  regexp_replace(split_part(substr(name, 11), '/', 4), '\\.[^.]*$', '') AS "timestamp" FROM ({NAMES})""")
def b1(spark, d):
    p = C.blob_path("name")
    return _names(spark, d).select("name", p["stage"].alias("stage"), p["company"].alias("company"), p["policy"].alias("policy"), p["timestamp"].alias("timestamp"))


@query("B2_unparse", f"SELECT name, regexp_replace(substr(name, 11), '\\.[^.]*$', '') AS joined FROM ({NAMES})")
def b2(spark, d):
    return _names(spark, d).select("name", C.unparse(C.blob_path("name")).alias("joined"))


@query("B3_policy_of_url", r"""SELECT capture_id, coalesce(nullif(regexp_replace(regexp_replace(trim(regexp_replace(
  list_last(list_filter(string_split(regexp_replace(regexp_replace(original, '[?#].*$', ''), '^[a-z]+://', ''), '/'), lambda p: p <> '')), '[<>:"/\\|?*]', '_', 'g'), ' .'), '^www\.', ''), '\.html$', ''), ''), 'default') AS policy FROM snapshot_index""")
def b3(spark, d):
    return _index(spark, d).select("capture_id", C.policy_of_url("original").alias("policy"))


@query("B4_sanitise", r"""SELECT record_id, coalesce(nullif(regexp_replace(regexp_replace(trim(regexp_replace(raw_json, '[<>:"/\\|?*]', '_', 'g'), ' .'), '^www\.', ''), '\.html$', ''), ''), 'default') AS name FROM summary_records""")
def b4(spark, d):
    return table(spark, d, "summary_records", "record_id", "raw_json").select("record_id", C.sanitise("raw_json").alias("name"))


@query("B5_valid_url", r"SELECT capture_id, regexp_matches(original, '^https?://[^\s/]+\.[a-z]{2,}(/\S*)?$') AS valid FROM snapshot_index")
def b5(spark, d):
    return _index(spark, d).select("capture_id", C.valid_url("original").alias("valid"))


@query("B6_capture_rows", "SELECT capture_ts, original, statuscode FROM snapshot_index")
def b6(spark, d):
    head = F.array(*[F.lit(c) for c in ("timestamp", "original", "statuscode")])
    raw = _index(spark, d).groupBy("company", "policy").agg(F.to_json(F.concat(F.array(head), F.collect_list(F.array("capture_ts", "original", "statuscode")))).alias("raw"))
    rows = raw.select(F.explode(C.cdx_rows("raw")).alias("r"))
    return rows.select(F.col("r")["timestamp"].alias("capture_ts"), F.col("r")["original"].alias("original"), F.col("r")["statuscode"].alias("statuscode"))


VALID = "capture_ts <> '' AND regexp_matches(statuscode, '^[0-9]+$') AND statuscode < '400'"


@query("B7_valid_captures", f"SELECT capture_id, statuscode FROM snapshot_index WHERE {VALID}")
def b7(spark, d):
    return prompts.valid_captures(_index(spark, d)).select("capture_id", "statuscode")


@query("B8_archive_url", "SELECT capture_id, concat_ws('/', 'https://web.archive.org/web', capture_ts, original) AS url FROM snapshot_index")
def b8(spark, d):
    return _index(spark, d).select("capture_id", C.archive_url(F.col("capture_ts"), F.col("original")).alias("url"))


@query("B9_restage", f"SELECT name, replace(name, '04-doclines', '05-diffs-raw') AS target FROM ({NAMES})")
def b9(spark, d):
    return _names(spark, d).select("name", C.restage("name", "04-doclines", "05-diffs-raw").alias("target"))


@query("B10_known_fields", "SELECT capture_id::VARCHAR AS task_id, 'scraper' AS workflow_type, company, policy, capture_ts AS \"timestamp\" FROM snapshot_index")
def b10(spark, d):
    rows = _index(spark, d).withColumnRenamed("capture_ts", "timestamp").withColumn("task_id", F.col("capture_id").cast("string")).withColumn("workflow_type", F.lit("scraper"))
    return rows.select("task_id", "workflow_type", "company", "policy", "timestamp")


@query("B11_label_values", "SELECT label_id, CASE practically_substantive WHEN 'True' THEN 1 WHEN 'False' THEN 0 END AS value FROM gold_labels")
def b11(spark, d):
    return table(spark, d, "gold_labels").select("label_id", C.label_value("practically_substantive").alias("value"))


_SAMPLE = f"""
WITH v AS (SELECT *, CASE WHEN regexp_matches(capture_ts, '^[0-9]{{14}}$') THEN epoch_us(try_strptime(capture_ts, '%Y%m%d%H%M%S'))::DOUBLE END AS t FROM snapshot_index WHERE {VALID}),
w AS (SELECT *, count(*) OVER p AS n, min(t) OVER p AS low, max(t) OVER p AS high, max(CASE WHEN t IS NULL THEN 1 ELSE 0 END) OVER p AS bad FROM v WINDOW p AS (PARTITION BY company, policy)),
b AS (SELECT *, CASE WHEN bad = 1 THEN NULL WHEN high > low THEN greatest(0, least(least(10, n) - 1, ceil((t - low) * least(10, n) / (high - low)) - 1))::INT ELSE 0 END AS bin FROM w),
s AS (SELECT company, policy, capture_id, bin, bad, row_number() OVER (PARTITION BY company, policy, bin ORDER BY capture_id) AS k, row_number() OVER (PARTITION BY company, policy ORDER BY capture_id) AS j,
  {', '.join(f"CASE WHEN bad = 1 THEN {c} ELSE first_value({c} IGNORE NULLS) OVER (PARTITION BY company, policy, bin ORDER BY capture_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS {c}" for c in ("mimetype", "digest", "length_bytes"))} FROM b)"""
_TAKEN = "FROM s WHERE (bad = 0 AND k = 1) OR (bad = 1 AND j <= 10)"


@query("E1a_first_values", f"{_SAMPLE} SELECT company, policy, capture_id, mimetype, digest, length_bytes {_TAKEN}")
def e1a(spark, d):
    return prompts.time_sample(prompts.valid_captures(_index(spark, d))).select("company", "policy", "capture_id", "mimetype", "digest", "length_bytes")


@query("E1_time_sample", f"{_SAMPLE} SELECT company, policy, capture_id, bin {_TAKEN}")
def e1(spark, d):
    return prompts.time_sample(prompts.valid_captures(_index(spark, d))).select("company", "policy", "capture_id", "bin")


def _keys(spark, d, name, ts="version_ts"):
    return table(spark, d, name).select("company", "policy", F.col(ts).alias("version_ts"))


@query("G4_missing_outputs", f"""SELECT DISTINCT company, policy, capture_ts AS version_ts FROM snapshot_index s WHERE {VALID}
  AND NOT EXISTS (SELECT 1 FROM ({PARSED}) p WHERE p.company = s.company AND p.policy = s.policy AND p.version_ts = s.capture_ts)""")
def g4(spark, d):
    wanted = prompts.valid_captures(_index(spark, d)).select("company", "policy", F.col("capture_ts").alias("version_ts")).distinct()
    return audit.not_yet(wanted, _keys(spark, d, "doc_chunks"), "company", "policy", "version_ts")


@query("G5_not_labelled", "SELECT DISTINCT company, policy, version_ts FROM summary_records s WHERE version_ts IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gold_labels g WHERE g.company = s.company AND g.policy = s.policy AND g.version_ts = s.version_ts)")
def g5(spark, d):
    return audit.not_yet(_keys(spark, d, "summary_records").dropna().distinct(), _keys(spark, d, "gold_labels"), "company", "policy", "version_ts")


@query("G6_summaries_with_diffs", "SELECT record_id FROM summary_records s WHERE EXISTS (SELECT 1 FROM diff_sections x WHERE x.company = s.company AND x.policy = s.policy AND x.version_ts = s.version_ts)")
def g6(spark, d):
    return audit.only_existing(table(spark, d, "summary_records"), _keys(spark, d, "diff_sections"), "company", "policy", "version_ts").select("record_id")


@query("G3_labels_with_diffs", "SELECT label_id FROM gold_labels s WHERE EXISTS (SELECT 1 FROM diff_sections x WHERE x.company = s.company AND x.policy = s.policy AND x.version_ts = s.version_ts)")
def g3(spark, d):
    return audit.only_existing(table(spark, d, "gold_labels"), _keys(spark, d, "diff_sections"), "company", "policy", "version_ts").select("label_id")


@query("G8_not_cached", f"SELECT capture_id FROM snapshot_index s WHERE {VALID} AND NOT EXISTS (SELECT 1 FROM ({PARSED}) p WHERE p.company = s.company AND p.policy = s.policy AND p.version_ts = s.capture_ts)")
def g8(spark, d):
    done = table(spark, d, "doc_chunks", "company", "policy", F.col("version_ts").alias("capture_ts"))
    return audit.not_yet(prompts.valid_captures(_index(spark, d)), done, "company", "policy", "capture_ts").select("capture_id")


@query("G9_diffs_of_labelled", "SELECT section_id FROM diff_sections x WHERE EXISTS (SELECT 1 FROM gold_labels g WHERE g.company = x.company AND g.policy = x.policy AND starts_with(x.version_ts, substr(g.version_ts, 1, 8)))")
def g9(spark, d):
    days = table(spark, d, "gold_labels").select("company", "policy", F.substring("version_ts", 1, 8).alias("day")).dropna().distinct()
    rows = table(spark, d, "diff_sections").withColumn("day", F.substring("version_ts", 1, 8))
    return rows.join(days, ["company", "policy", "day"], "left_semi").select("section_id")


@query("H9_task_counters", """SELECT dimension, value, count(*) AS n FROM (SELECT unnest(['company', 'mimetype', 'statuscode']) AS dimension, unnest([company, mimetype, statuscode]) AS value FROM snapshot_index) GROUP BY 1, 2""")
def h9(spark, d):
    return audit.task_counters(_index(spark, d), "company", "mimetype", "statuscode")


@query("H10_missing_report", f"""WITH e AS (SELECT DISTINCT unnest(['04-doclines', '05-diffs-clean', '09-labels']) AS stage, company, policy, capture_ts AS version_ts FROM snapshot_index WHERE {VALID}),
h AS (SELECT DISTINCT '04-doclines' AS stage, company, policy, version_ts FROM doc_chunks UNION ALL SELECT DISTINCT '05-diffs-clean', company, policy, version_ts FROM diff_sections UNION ALL SELECT DISTINCT '09-labels', company, policy, version_ts FROM gold_labels)
SELECT stage, count(*) FILTER (h.company IS NULL) AS n_missing, count(*) AS n_total, 'missing ' || count(*) FILTER (h.company IS NULL) || '/' || count(*) AS report
FROM e LEFT JOIN h USING (stage, company, policy, version_ts) GROUP BY stage""")
def h10(spark, d):
    wanted = audit.expected_outputs(prompts.valid_captures(_index(spark, d)).withColumnRenamed("capture_ts", "version_ts"), ["04-doclines", "05-diffs-clean", "09-labels"])
    have = None
    for stage, name in (("04-doclines", "doc_chunks"), ("05-diffs-clean", "diff_sections"), ("09-labels", "gold_labels")):
        part = _keys(spark, d, name).withColumn("stage", F.lit(stage))
        have = part if have is None else have.unionByName(part)
    return audit.missing_outputs(wanted, have, "company", "policy", "version_ts")


@query("H11_nested_listing", f"SELECT '04-doclines' AS stage, company, count(DISTINCT policy) AS n_policies, count(*) AS n_blobs FROM ({PARSED}) GROUP BY company")
def h11(spark, d):
    return audit.nested_listing(_names(spark, d)).select("stage", "company", F.size("policies").cast("bigint").alias("n_policies"), "n_blobs")


@query("S6_errors_as_values", "SELECT capture_id, CASE WHEN statuscode IN ('403', '404', '503') THEN 'http' END AS error_type, CASE WHEN statuscode IN ('403', '404', '503') THEN 'status ' || statuscode END AS message FROM snapshot_index")
def s6(spark, d):
    ok = F.coalesce(~F.col("statuscode").isin("403", "404", "503"), F.lit(True))
    err = as_error(ok, "scraper", F.lit("http"), F.concat(F.lit("status "), "statuscode"))
    return _index(spark, d).withColumn("e", err).select("capture_id", F.col("e.error_type").alias("error_type"), F.col("e.message").alias("message"))


@query("S12_fan_out", f"SELECT 'scraper' AS workflow, company || '/' || policy || '/' || capture_ts AS task_id FROM snapshot_index WHERE {VALID}")
def s12(spark, d):
    return prompts.valid_captures(_index(spark, d)).select(F.lit("scraper").alias("workflow"), F.concat_ws("/", "company", "policy", "capture_ts").alias("task_id"))


@query("S13_touch", f"SELECT substr(name, 11) AS name, '2024-05-01T00:00:00' AS touched FROM ({NAMES}) WHERE starts_with(split_part(name, '/', 5), '2019')")
def s13(spark, d):
    cat = B.catalog(_names(spark, d).withColumn("metadata", F.lit(None).cast(B.META)))
    got = audit.touched(cat, F.lit("2024-05-01 00:00:00").cast("timestamp"), stage="04-doclines", timestamp="2019")
    return got.select(C.strip_container("name").alias("name"), F.col("metadata")["touched"].alias("touched"))


@query("I2_shortest", "SELECT company, section_id FROM (SELECT *, row_number() OVER (PARTITION BY company ORDER BY coalesce(length(before), 0) + coalesce(length(\"after\"), 0), section_id) AS k FROM diff_sections) WHERE k <= 3")
def i2(spark, d):
    size = F.coalesce(F.length("before"), F.lit(0)) + F.coalesce(F.length("after"), F.lit(0))
    return audit.first_per(table(spark, d, "diff_sections").withColumn("size", size), 3, ["company"], "size", "section_id").select("company", "section_id")


@query("I3_first_ten", "SELECT capture_id FROM (SELECT *, row_number() OVER (PARTITION BY company, policy ORDER BY capture_id) AS k FROM snapshot_index) WHERE k <= 10")
def i3(spark, d):
    return audit.first_per(_index(spark, d), 10, ["company", "policy"], "capture_id").select("capture_id")


@query("I5_label_union", "SELECT label_id, practically_substantive FROM gold_labels WHERE model_version IS NOT NULL UNION ALL SELECT label_id, practically_substantive FROM gold_labels WHERE model_version IS NULL")
def i5(spark, d):
    rows = table(spark, d, "gold_labels", "label_id", "model_version", "practically_substantive")
    return rows.where("model_version is not null").unionByName(rows.where("model_version is null")).select("label_id", "practically_substantive")


@query("S11_due_again", """SELECT company, policy FROM snapshot_index GROUP BY company, policy
  HAVING max(CASE WHEN regexp_matches(capture_ts, '^[0-9]{14}$') THEN try_strptime(capture_ts, '%Y%m%d%H%M%S') END) IS NULL
  OR max(CASE WHEN regexp_matches(capture_ts, '^[0-9]{14}$') THEN try_strptime(capture_ts, '%Y%m%d%H%M%S') END) <= TIMESTAMP '2022-12-25 00:00:00'""")
def s11(spark, d):
    return due_again(_index(spark, d), F.lit("2023-01-01 00:00:00").cast("timestamp")).select("company", "policy")


def _files(spark: SparkSession, d: str) -> DataFrame:
    """Every record of the summaries as a blob of its own."""
    rows = table(spark, d, "summary_records", "record_id", "raw_json").where("raw_json is not null")
    return rows.select(F.concat(F.lit("documents/07-summary-raw/"), F.col("record_id").cast("string")).alias("name"), F.encode("raw_json", "UTF-8").alias("content"))


_FILES = "SELECT 'documents/07-summary-raw/' || record_id AS name, raw_json FROM summary_records WHERE raw_json IS NOT NULL"


@query("A2_load_bytes", f"SELECT name, octet_length(encode(raw_json))::INT AS n_bytes, md5(raw_json) AS digest FROM ({_FILES})")
def a2(spark, d):
    return _files(spark, d).select("name", F.octet_length("content").alias("n_bytes"), F.md5("content").alias("digest"))


@query("A3_load_json", f"SELECT name, json_valid(raw_json) AS valid, CASE WHEN json_valid(raw_json) THEN json_extract_string(raw_json, '$.run_id') END AS run_id FROM ({_FILES})")
def a3(spark, d):
    j = F.try_parse_json("text")
    return B.text(_files(spark, d)).select("name", j.isNotNull().alias("valid"), F.try_variant_get(j, "$.run_id", "string").alias("run_id"))


@query("A4_load_text", f"SELECT name, raw_json AS text FROM ({_FILES})")
def a4(spark, d):
    return B.text(_files(spark, d))


@query("I9_first_of_bins", f"{_SAMPLE} SELECT company, policy, bin, min(capture_id) AS first_id {_TAKEN} GROUP BY company, policy, bin")
def i9(spark, d):
    return prompts.time_sample(prompts.valid_captures(_index(spark, d))).groupBy("company", "policy", "bin").agg(F.min("capture_id").alias("first_id"))


@query("I10_names_present", f"SELECT name, name IN (SELECT substr(name, 11) FROM ({NAMES})) AS present FROM (SELECT DISTINCT '04-doclines/' || company || '/' || policy || '/' || capture_ts || '.json' AS name FROM snapshot_index WHERE capture_ts IS NOT NULL)")
def i10(spark, d):
    asked = _index(spark, d).where("capture_ts is not null").select(F.concat_ws("/", F.lit("04-doclines"), "company", "policy", F.concat("capture_ts", F.lit(".json"))).alias("name")).distinct()
    held = B.names(_names(spark, d)).withColumn("present", F.lit(True))
    return asked.join(held, "name", "left").select("name", F.coalesce("present", F.lit(False)).alias("present"))
