"""Queries over pages, chunks and differences of versions (C, D and I of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.pages import decode_udf, main_text_udf, tree_json_udf, tree_nodes_udf
from palimpsest.operators import chunks as K
from palimpsest.operators import versions as V
from palimpsest.session import cut, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _escaped(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    """Each text of the domain as a page: its lines as paragraphs beside navigation, an advertisement and a footer."""
    docs = table(spark, d, "documents").where("text is not null")
    lines = F.transform(F.split("text", "\n"), lambda x: F.concat(F.lit("<p>"), _escaped(x), F.lit("</p>")))
    html = F.concat(F.lit('<html><body><nav>Menu</nav><div class="ad">Buy</div><section>'), F.array_join(lines, ""), F.lit("</section><footer>End</footer></body></html>"))
    return docs.select("doc_id", F.coalesce("company", F.lit("")).alias("company"), F.coalesce("policy", F.lit("")).alias("policy"), F.coalesce("version_ts", F.lit("")).alias("version_ts"), html.alias("html"))


@query("C1_decode", """SELECT doc_id, length(text)::INT AS n, md5(text) AS digest, CASE WHEN doc_id % 4 = 1 AND regexp_full_match(text, '[\\x{01}-\\x{ff}\\n\\r]*') THEN 'iso-8859-1' WHEN doc_id % 4 = 2 THEN 'utf-16' ELSE 'utf-8' END AS encoding FROM documents WHERE text IS NOT NULL""")
def c1(spark, d):
    """Texts in three encodings, two of them named in the header; those without a name are found out."""
    latin = (F.col("doc_id") % 4 == 1) & F.col("text").rlike(r"^[\x01-\xff]*\z")
    wide = F.col("doc_id") % 4 == 2
    content = F.when(latin, F.encode("text", "ISO-8859-1")).when(wide, F.encode("text", "UTF-16")).otherwise(F.encode("text", "UTF-8"))
    kind = F.when(latin, 'text/html; charset="ISO-8859-1"').when(wide, "text/html;charset=UTF-16").when(F.col("doc_id") % 4 == 0, "text/html; charset=UTF-8")
    rows = table(spark, d, "documents").where("text is not null").select("doc_id", content.alias("content"), kind.alias("content_type"))
    return rows.withColumn("d", decode_udf("content", "content_type")).select("doc_id", F.length("d.html").alias("n"), F.md5("d.html").alias("digest"), F.col("d.encoding").alias("encoding"))


SPACES = r"[\s\x1c-\x1f\x{85}\p{Z}\x{b}]+"
_ESCAPED_SQL = "replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _stripped(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACES}|{SPACES}$', '', 'g')"


@query("C2_main_text", f"""SELECT doc_id, '<body>' || chr(10) || ' <section>' || chr(10) || array_to_string(list_transform(string_split(text, chr(10)), lambda x: '  <p>' || chr(10)
  || CASE WHEN {_stripped('x')} = '' THEN '' ELSE '   ' || {_stripped(_ESCAPED_SQL)} || chr(10) END || '  </p>'), chr(10)) || chr(10) || ' </section>' || chr(10) || '</body>' AS main FROM documents WHERE text IS NOT NULL""")
def c2(spark, d):
    return _pages(spark, d).select("doc_id", main_text_udf("html").alias("main"))


def _node_sql(columns: str) -> str:
    return rf"""SELECT {columns} FROM (
  SELECT doc_id, l, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM (
    SELECT doc_id, i, trim(regexp_replace(replace(replace(replace(x, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '{SPACES}', ' ', 'g')) AS l
    FROM (SELECT doc_id, unnest(ls) AS x, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)))
  WHERE l <> '')"""


@query("C3_tree_leaves", _node_sql("doc_id, (k - 1)::INT AS ord, l AS text"))
def c3(spark, d):
    clean = F.regexp_replace("html", r'<nav>Menu</nav><div class="ad">Buy</div>', "")
    n = _pages(spark, d).select("doc_id", F.explode(tree_nodes_udf(clean)).alias("n"))
    return n.select("doc_id", F.col("n.node_ord").alias("ord"), F.col("n.text").alias("text"))


def _sections_page(spark: SparkSession, d: str) -> DataFrame:
    """Each version as a page with headings of two ranks, a list, a table and a division, the navigation and a script beside them."""
    docs = V.documents(table(spark, d, "doc_chunks")).withColumn("flat", F.transform("lines", lambda x: _escaped(F.regexp_replace(x, r"\s+", " "))))
    inside = lambda tag: F.array_join(F.transform("flat", lambda x: F.concat(F.lit(f"<{tag}>"), x, F.lit(f"</{tag}>"))), "")
    html = F.concat(
        F.lit("<html><body><script>x()</script><h1>"), _escaped(F.col("company")), F.lit("</h1><h2>"), _escaped(F.col("policy")), F.lit("</h2>"), inside("p"),
        F.lit("<ul>"), inside("li"), F.lit("</ul><table><tr><td>"), F.col("version_ts"), F.lit("</td></tr></table><footer>End</footer></body></html>"),
    )
    return docs.select("company", "policy", "version_ts", html.alias("html"))


DOCS = """SELECT company, policy, version_ts, list(text ORDER BY chunk_idx) FILTER (text IS NOT NULL) AS ls FROM (
  SELECT * FROM doc_chunks WHERE version_ts IS NOT NULL AND chunk_idx IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company, policy, version_ts, chunk_idx ORDER BY loaded_at DESC NULLS LAST, chunk_id DESC) = 1) GROUP BY 1, 2, 3"""
# the second heading, the paragraphs and the list lie below the first heading, the cell of the table beside it; the second item's context already ends in a joint
_LEAF = f"list_filter(list_transform(coalesce(ls, []), lambda x: trim(regexp_replace({_ESCAPED_SQL}, '{SPACES}', ' ', 'g'))), lambda x: x <> '')"
PAGE_NODES = f"""SELECT company, policy, version_ts, (row_number() OVER (PARTITION BY company, policy, version_ts ORDER BY a, b) - 1)::INT AS ord, tag, text, CASE WHEN context = '' THEN text ELSE context || CASE WHEN ends_with(context, '.') THEN '' ELSE '.' END || chr(10) || text END AS passage, a FROM (
  SELECT company, policy, version_ts, 'h1' AS tag, company AS text, '' AS context, 0 AS a, 0 AS b FROM ({DOCS})
  UNION ALL SELECT company, policy, version_ts, 'h2', policy, company, 1, 0 FROM ({DOCS})
  UNION ALL SELECT company, policy, version_ts, 'p', unnest(l), company, 2, unnest(range(len(l))) FROM (SELECT *, {_LEAF} AS l FROM ({DOCS}))
  UNION ALL SELECT company, policy, version_ts, 'li', unnest(l), company, 3, unnest(range(len(l))) FROM (SELECT *, {_LEAF} AS l FROM ({DOCS}))
  UNION ALL SELECT company, policy, version_ts, 'text', version_ts, '', 4, 0 FROM ({DOCS}))"""


@query("C7_context_walk", f"SELECT company, policy, version_ts, ord AS node_ord, CASE WHEN a = 4 THEN 1 ELSE ord END::INT AS read_idx, tag, passage FROM ({PAGE_NODES})")
def c7(spark, d):
    n = _sections_page(spark, d).select("company", "policy", "version_ts", F.explode(tree_nodes_udf("html")).alias("n"))
    return n.select("company", "policy", "version_ts", "n.node_ord", "n.read_idx", "n.tag", "n.passage")


@query("C4_leaf_text", _node_sql("doc_id, (k - 1)::INT AS ord, length(l)::INT AS n_chars"))
def c4(spark, d):
    return c3(spark, d).select("doc_id", "ord", F.length("text").alias("n_chars"))


@query("C5_placement", f"SELECT company, policy, version_ts, ord, tag, CASE tag WHEN 'h1' THEN 1 WHEN 'h2' THEN 2 ELSE -1 END AS level, CASE tag WHEN 'h1' THEN 3 WHEN 'li' THEN 5 WHEN 'text' THEN 6 ELSE 4 END AS depth FROM ({PAGE_NODES})")
def c5(spark, d):
    """How deep each node comes to lie, and its rank."""
    n = _sections_page(spark, d).select("company", "policy", "version_ts", F.explode(tree_nodes_udf("html")).alias("n"))
    return n.select("company", "policy", "version_ts", F.col("n.node_ord").alias("ord"), "n.tag", "n.level", "n.depth")


@query("C6_flat_walk", f"SELECT company, policy, version_ts, string_agg(text, chr(31) ORDER BY ord) AS texts FROM ({PAGE_NODES}) GROUP BY ALL")
def c6(spark, d):
    return _sections_page(spark, d).select("company", "policy", "version_ts", F.array_join(F.transform(tree_nodes_udf("html"), lambda n: n["text"]), "\x1f").alias("texts"))


@query("C8_find", f"SELECT company, policy, version_ts, min_by(text, ord) AS text FROM ({PAGE_NODES}) WHERE ord = 1 GROUP BY ALL")
def c8(spark, d):
    """The node that is read second on each page."""
    nodes = _sections_page(spark, d).withColumn("n", tree_nodes_udf("html"))
    return nodes.select("company", "policy", "version_ts", F.get(F.filter("n", lambda n: n["read_idx"] == 1), F.lit(0))["text"].alias("text"))


@query("C9_tree_json", f"SELECT company, policy, version_ts, (10 + 2 * len({_LEAF}))::INT AS size, 7 AS depth FROM ({DOCS})")
def c9(spark, d):
    """Trees as JSON and back: their nodes and depth."""
    t = _sections_page(spark, d).select("company", "policy", "version_ts", tree_json_udf("html").alias("tree"))
    return t.select("company", "policy", "version_ts", F.get_json_object("tree", "$.size").cast("int").alias("size"), F.get_json_object("tree", "$.depth").cast("int").alias("depth"))


@query("C10_annotate", f"SELECT company, policy, version_ts, CASE WHEN a = 4 THEN 1 ELSE ord END::INT AS chunk_idx, ord, text FROM ({PAGE_NODES})")
def c10(spark, d):
    return K.annotate(_sections_page(spark, d))


TOKENS = rf"list_filter(regexp_split_to_array(text, '{SPACES}'), lambda w: w <> '')"


@query("C11_word_entropy", f"""WITH w AS (SELECT chunk_id, unnest({TOKENS}) AS w FROM doc_chunks WHERE text IS NOT NULL),
c AS (SELECT chunk_id, w, count(*)::DOUBLE AS k FROM w GROUP BY 1, 2), n AS (SELECT chunk_id, sum(k) AS n FROM c GROUP BY 1),
e AS (SELECT chunk_id, -sum(k / n * log2(k / n + 1e-12)) AS e FROM c JOIN n USING (chunk_id) GROUP BY 1)
SELECT chunk_id, round(coalesce(e, 0), 6) + 0.0 AS entropy FROM doc_chunks LEFT JOIN e USING (chunk_id) WHERE text IS NOT NULL""")
def c11(spark, d):
    rows = K.with_entropy(table(spark, d, "doc_chunks", "chunk_id", "text")).where("text is not null")
    return rows.select("chunk_id", (F.round("entropy", 6) + F.lit(0.0).cast("double")).alias("entropy"))


# texts are joined one by one; the bits of a text are those of its words
_BITS = f"coalesce(list_sum(list_transform(map_values(list_aggregate({TOKENS.replace('text', '$t')}, 'histogram')), lambda k: -(k / len({TOKENS.replace('text', '$t')})) * log2(k / len({TOKENS.replace('text', '$t')}) + 1e-12))), 0)"
POOLED = f"""WITH RECURSIVE r AS (SELECT company, policy, version_ts, text, row_number() OVER (PARTITION BY company, policy, version_ts ORDER BY chunk_idx, text) AS k FROM doc_chunks
  WHERE company IS NOT NULL AND policy IS NOT NULL AND version_ts IS NOT NULL AND text IS NOT NULL),
p(company, policy, version_ts, k, n, held) AS (
  SELECT company, policy, version_ts, k, 0, text FROM r WHERE k = 1
  UNION ALL
  SELECT p.company, p.policy, p.version_ts, r.k, p.n + is_full::INT, CASE WHEN is_full THEN r.text ELSE p.held || CASE WHEN ends_with(p.held, '.') THEN chr(10) ELSE '.' || chr(10) END || r.text END
  FROM (SELECT *, {_BITS.replace('$t', 'held')} > 3.0 AS is_full FROM p) p JOIN r ON r.company = p.company AND r.policy = p.policy AND r.version_ts = p.version_ts AND r.k = p.k + 1)
SELECT company, policy, version_ts, n::INT AS chunk_idx, arg_max(held, k) AS text FROM p GROUP BY company, policy, version_ts, n"""


@query("C12_entropy_pooling", POOLED)
def c12(spark, d):
    rows = table(spark, d, "doc_chunks").dropna(subset=["company", "policy", "version_ts"])
    return K.pooled(rows, "company", "policy", "version_ts")


@query("C13_length_stats", "SELECT company, count(text) AS n_chunks, coalesce(trunc(quantile_cont(length(text), 0.5)), 0)::INT AS p50, coalesce(trunc(quantile_cont(length(text), 0.9)), 0)::INT AS p90 FROM doc_chunks GROUP BY company")
def c13(spark, d):
    return K.length_stats(table(spark, d, "doc_chunks", "company", "text"), "company")


@query("C14_overlong", "SELECT doc_id, length(text)::INT AS n FROM documents WHERE length(text) > 8192")
def c14(spark, d):
    return K.overlong(table(spark, d, "documents", "doc_id", "text")).select("doc_id", F.length("text").alias("n"))


@query("C15_entropy_quantiles", f"""WITH w AS (SELECT chunk_id, unnest({TOKENS}) AS w FROM doc_chunks WHERE text IS NOT NULL),
c AS (SELECT chunk_id, w, count(*)::DOUBLE AS k FROM w GROUP BY 1, 2), n AS (SELECT chunk_id, sum(k) AS n FROM c GROUP BY 1),
e AS (SELECT chunk_id, -sum(k / n * log2(k / n + 1e-12)) AS e FROM c JOIN n USING (chunk_id) GROUP BY 1),
a AS (SELECT company, coalesce(e, 0) AS e FROM doc_chunks LEFT JOIN e USING (chunk_id) WHERE text IS NOT NULL)
SELECT company, round(quantile_cont(e, 0.05), 5) AS q5, round(quantile_cont(e, 0.25), 5) AS q25, round(quantile_cont(e, 0.5), 5) AS q50, round(quantile_cont(e, 0.75), 5) AS q75, round(quantile_cont(e, 0.95), 5) AS q95 FROM a GROUP BY company""")
def c15(spark, d):
    q = K.entropy_quantiles(table(spark, d, "doc_chunks", "company", "text"), "company")
    return q.select("company", *[F.round(c, 5).alias(c) for c in ("q5", "q25", "q50", "q75", "q95")])


VERSIONS = "SELECT DISTINCT company, policy, version_ts FROM doc_chunks WHERE version_ts IS NOT NULL"


@query("D1_neighbours", f"SELECT company, policy, version_ts, lag(version_ts) OVER w AS before_ts, lead(version_ts) OVER w AS after_ts FROM ({VERSIONS}) WINDOW w AS (PARTITION BY company, policy ORDER BY version_ts)")
def d1(spark, d):
    return V.neighbours(table(spark, d, "doc_chunks", "company", "policy", "version_ts").dropna().distinct())


def _docs(spark, d):
    return V.documents(table(spark, d, "doc_chunks"))


@query("D5_has_diff", f"SELECT company, policy, version_ts, before_ts, coalesce(was, []) <> coalesce(ls, []) AS has_diff FROM (SELECT *, lag(version_ts) OVER w AS before_ts, lag(ls) OVER w AS was FROM ({DOCS}) WINDOW w AS (PARTITION BY company, policy ORDER BY version_ts)) WHERE before_ts IS NOT NULL")
def d5(spark, d):
    return V.pairs(_docs(spark, d)).select("company", "policy", "version_ts", "before_ts", "has_diff")


PAIRS = f"SELECT company, policy, version_ts, coalesce(was, []) AS was, coalesce(ls, []) AS ls FROM (SELECT *, lag(version_ts) OVER w AS before_ts, lag(ls) OVER w AS was FROM ({DOCS}) WINDOW w AS (PARTITION BY company, policy ORDER BY version_ts)) WHERE before_ts IS NOT NULL"


def _rebuilt_sql(sep: str) -> str:
    return f"SELECT company, policy, version_ts, md5(array_to_string(was, {sep})) AS before_md5, md5(array_to_string(ls, {sep})) AS after_md5 FROM ({PAIRS})"


def _rebuilt(raw: DataFrame, changed: DataFrame | None, sep: str) -> DataFrame:
    """Both sides of every pair put together from its sections: the equal ones of the opcodes, all others from `changed`."""
    key = [*V.KEY, "version_ts"]
    rows = raw.select(*key, F.posexplode_outer("diffs").alias("index", "o"))
    if changed is not None:
        rows = rows.join(changed.select(*key, "index", F.col("before").alias("b"), F.col("after").alias("a"), F.lit(True).alias("hit")), [*key, "index"], "left")
        text = lambda side, own: F.when(F.col("o.tag") == "equal", F.array_join(f"o.{side}", sep)).otherwise(F.when(F.col("hit"), F.col(own)))
    else:
        text = lambda side, own: F.array_join(f"o.{side}", sep)
    side = lambda s, own: F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.size(f"o.{s}") > 0, F.struct("index", text(s, own).alias("t"))))), lambda x: x["t"]), sep)).alias(f"{s}_md5")
    return rows.groupBy(*key).agg(side("before", "b"), side("after", "a"))


@query("D2_sides_rebuilt", _rebuilt_sql("chr(31)"))
def d2b(spark, d):
    """The lines of both versions, put together from the slices of the line opcodes."""
    return _rebuilt(V.raw_diffs(_docs(spark, d)), None, "\x1f")


_LINE_END = r"[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


@query("D3_sides_rebuilt", f"SELECT company, policy, version_ts, md5(regexp_replace(array_to_string(was, chr(10)), '{_LINE_END}', '', 'g')) AS before_md5, md5(regexp_replace(array_to_string(ls, chr(10)), '{_LINE_END}', '', 'g')) AS after_md5 FROM ({PAIRS}) WHERE was <> ls")
def d3b(spark, d):
    """The characters of both versions, put together from the slices of the character opcodes."""
    side = lambda s: F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_ord", "ord", F.col(s).alias("t")))), lambda x: x["t"]), "")).alias(f"{s}_md5")
    return V.span_diffs(_docs(spark, d)).groupBy(*V.KEY, "version_ts").agg(side("before"), side("after"))


@query("D6_sides_rebuilt", _rebuilt_sql("' '"))
def d6b(spark, d):
    """Both versions, put together from the clean sections and what is equal."""
    raw = cut(V.raw_diffs(_docs(spark, d)))
    return _rebuilt(raw, V.clean_diffs(raw), " ")


def _unmarked(c: str):
    return F.regexp_replace(c, r'<span class="diff_(?:sub|add)">|</span>', "")


@query("D8_sides_rebuilt", _rebuilt_sql("chr(10)"))
def d8b(spark, d):
    """Both versions, put together from the highlighted sections without their spans."""
    raw = cut(V.raw_diffs(_docs(spark, d)))
    return _rebuilt(raw, V.highlighted(raw).select(*V.KEY, "version_ts", "index", _unmarked("before_html").alias("before"), _unmarked("after_html").alias("after")), "\n")


@query("D9_sides_rebuilt", _rebuilt_sql("chr(10)"))
def d9b(spark, d):
    """Both versions, put together from the template's map of sections by number."""
    raw = cut(V.raw_diffs(_docs(spark, d)))
    m = V.template_map(V.highlighted(raw)).select(*V.KEY, "version_ts", F.explode("sections").alias("n", "s"))
    return _rebuilt(raw, m.select(*V.KEY, "version_ts", F.col("n").cast("int").alias("index"), _unmarked("s.before").alias("before"), _unmarked("s.after").alias("after")), "\n")


@query("D2_line_diffs")
def d2(spark, d):
    return V.raw_diffs(_docs(spark, d)).select("company", "policy", "version_ts", F.posexplode("diffs").alias("idx", "o")).select("company", "policy", "version_ts", "idx", "o.tag", "o.i1", "o.i2", "o.j1", "o.j2", "o.sim")


@query("D3_span_diffs")
def d3(spark, d):
    return V.span_diffs(_docs(spark, d))


@query("D4_pairs_rebuilt", f"SELECT company, policy, version_ts, len(coalesce(was, []))::INT AS n_before, len(coalesce(ls, []))::INT AS n_after FROM (SELECT *, lag(version_ts) OVER w AS before_ts, lag(ls) OVER w AS was FROM ({DOCS}) WINDOW w AS (PARTITION BY company, policy ORDER BY version_ts)) WHERE before_ts IS NOT NULL")
def d4(spark, d):
    """The slices of a pair's opcodes put together again have as many lines as both versions."""
    total = lambda side: F.aggregate("diffs", F.lit(0), lambda a, o: a + F.size(o[side]))
    return V.raw_diffs(_docs(spark, d)).select("company", "policy", "version_ts", total("before").alias("n_before"), total("after").alias("n_after"))


@query("D6_clean_diffs")
def d6(spark, d):
    return V.clean_diffs(V.raw_diffs(_docs(spark, d)))


@query("D7_manifest", f"SELECT company, policy, version_ts || '.json' AS file, before_ts || '.json' AS before_file FROM (SELECT *, lag(version_ts) OVER (PARTITION BY company, policy ORDER BY version_ts) AS before_ts FROM ({VERSIONS})) WHERE before_ts IS NOT NULL")
def d7(spark, d):
    m = V.manifest(table(spark, d, "doc_chunks", "company", "policy", "version_ts").dropna().distinct())
    return m.select("company", "policy", F.explode("manifest").alias("file", "before_file"))


@query("D8_highlighted")
def d8(spark, d):
    return V.highlighted(V.raw_diffs(_docs(spark, d)))


@query("D9_template_sections")
def d9(spark, d):
    m = V.template_map(V.highlighted(V.raw_diffs(_docs(spark, d))))
    return m.select("company", "policy", "version_ts", F.size("sections").alias("n_sections"))


@query("G7_adjacent_pairs", f"SELECT company, policy, version_ts, before_ts FROM (SELECT *, lag(version_ts) OVER (PARTITION BY company, policy ORDER BY version_ts) AS before_ts FROM ({VERSIONS})) WHERE before_ts IS NOT NULL")
def g7(spark, d):
    return V.neighbours(table(spark, d, "doc_chunks", "company", "policy", "version_ts").dropna().distinct()).where("before_ts is not null").drop("after_ts")


@query("I7_lag_and_lead", f"SELECT company, policy, version_ts, lag(version_ts) OVER w IS NULL AS is_first, lead(version_ts) OVER w IS NULL AS is_last FROM ({VERSIONS}) WINDOW w AS (PARTITION BY company, policy ORDER BY version_ts)")
def i7(spark, d):
    n = V.neighbours(table(spark, d, "doc_chunks", "company", "policy", "version_ts").dropna().distinct())
    return n.select("company", "policy", "version_ts", F.col("before_ts").isNull().alias("is_first"), F.col("after_ts").isNull().alias("is_last"))


@query("I1_sorted_versions", f"SELECT company, policy, version_ts, row_number() OVER (PARTITION BY company, policy ORDER BY version_ts)::INT AS n FROM ({VERSIONS})")
def i1(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "doc_chunks", "company", "policy", "version_ts").dropna().distinct()
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("company", "policy").orderBy("version_ts")))


def pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Pages to chunks to pooled chunks to pairs to clean sections, in one lineage."""
    rows = table(spark, d, "doc_chunks").dropna(subset=["company", "policy", "version_ts"])
    pooled = K.pooled(rows, "company", "policy", "version_ts")
    docs = pooled.groupBy("company", "policy", "version_ts").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk_idx", "text"))), lambda p: p["text"]).alias("lines"))
    return V.clean_diffs(V.raw_diffs(cut(docs)))


QUERIES["pipeline_clean_diffs"] = pipeline
