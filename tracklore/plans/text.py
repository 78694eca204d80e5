"""Queries of text functions, log cleaning, search and parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.functions import formats, redact, text
from tracklore.operators import search
from tracklore.plans.registry import query


def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_SECRETS = (
    "' HF_TOKEN=hf_' || repeat('A', 35)", "' sk-ant-' || repeat('b', 25)", "' sk-' || repeat('C', 45)", "' ghp_' || repeat('d', 36)",
    "' github_pat_' || repeat('E', 40)", "' AKIA' || repeat('F', 16) || ' '", "' Bearer ' || repeat('g', 24)", "' PASSWORD: hunter2'",
)
_INJECT = "CASE doc_id % 8 " + " ".join(f"WHEN {i} THEN text || {s}" for i, s in enumerate(_SECRETS)) + " END"


_REDACTED = f"""WITH a AS (SELECT doc_id, {_INJECT} AS t FROM documents), b AS (SELECT doc_id, regexp_replace(t, 'hf_[A-Za-z0-9]{{30,}}', '[REDACTED_HF_TOKEN]', 'g') AS t FROM a),
c AS (SELECT doc_id, regexp_replace(t, 'sk-ant-[A-Za-z0-9_-]{{20,}}', '[REDACTED_ANTHROPIC_KEY]', 'g') AS t FROM b), d AS (SELECT doc_id, regexp_replace(t, 'sk-[A-Za-z0-9_-]{{40,}}', '[REDACTED_OPENAI_KEY]', 'g') AS t FROM c),
e AS (SELECT doc_id, regexp_replace(t, 'gh[pousr]_[A-Za-z0-9]{{36,}}|github_pat_[A-Za-z0-9_]{{36,}}', '[REDACTED_GITHUB_TOKEN]', 'g') AS t FROM d), f AS (SELECT doc_id, regexp_replace(t, '\\b(AKIA|ASIA)[A-Z0-9]{{16}}\\b', '[REDACTED_AWS_KEY_ID]', 'g') AS t FROM e),
g AS (SELECT doc_id, regexp_replace(t, '(?i)bearer\\s+[A-Za-z0-9_.=-]{{20,}}', 'Bearer [REDACTED]', 'g') AS t FROM f)
SELECT doc_id, regexp_replace(t, '(?i)\\b(hf_token|huggingfacehub_api_token|anthropic_api_key|openai_api_key|github_token|aws_secret_access_key|aws_access_key_id|password|secret|api_key)\\s*[:=]\\s*[^\\s"'']+', '\\1=[REDACTED]', 'g') AS text FROM g"""


@query("redact_text", _REDACTED)
def redact_text(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", redact.redacted(F.expr(_INJECT)).alias("text"))


@query("ansi_strip", r"SELECT doc_id, regexp_replace(chr(27) || '[31m' || text || chr(27) || '[0m', '\x1b\[[0-9;?]*[A-Za-z]|\x1b\][^\x07]*\x07', '', 'g') AS text FROM documents")
def ansi_strip(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.strip_ansi(F.concat(F.lit("\x1b[31m"), "text", F.lit("\x1b[0m"))).alias("text"))


@query("head_tail_truncate", "SELECT doc_id, CASE WHEN length(text) > 1000 THEN left(text, 250) || chr(10) || '... [' || (length(text) - 1000) || ' characters omitted] ...' || chr(10) || right(text, 750) ELSE text END AS text FROM documents")
def head_tail_truncate(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", text.head_tail(F.col("text"), 1000).alias("text"))


@query("glimpse", "SELECT doc_id, CASE WHEN length(text) > 200 THEN left(text, 200) || '...' ELSE text END AS glimpse, left(md5(text), 12) AS digest FROM documents")
def glimpse(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", formats.ellipsis(F.col("text"), 200).alias("glimpse"), F.left(F.md5("text"), F.lit(12)).alias("digest"))


_LINES = "l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT AS n FROM documents)"


@query("line_range_read", f"WITH {_LINES} SELECT doc_id, n, left(line, 4000) AS line FROM l WHERE n BETWEEN 2 AND 4")
def line_range_read(spark, sf_dir):
    return text.line_range(documents(spark, sf_dir), 2, 4, "doc_id")


@query(
    "log_line_collapse",
    f"""WITH {_LINES}, k AS (SELECT *, CASE WHEN length(line) % 3 = 0 THEN 'a' WHEN length(line) % 3 = 1 THEN 'b' END AS kind FROM l),
n AS (SELECT *, lead(kind) OVER (PARTITION BY doc_id ORDER BY n) AS nx FROM k) SELECT doc_id, n, line FROM n WHERE kind IS NULL OR nx IS NULL OR kind <> nx""",
)
def log_line_collapse(spark, sf_dir):
    kind = F.when(F.length("line") % 3 == 0, "a").when(F.length("line") % 3 == 1, "b")
    return text.collapse(text.lines(documents(spark, sf_dir), "doc_id"), kind, "doc_id")


@query("cr_last_segment", f"WITH {_LINES} SELECT doc_id, n, coalesce(list_filter(string_split(replace(line, ' ', chr(13)), chr(13)), lambda x: x <> '')[-1], '') AS shown FROM l")
def cr_last_segment(spark, sf_dir):
    rows = text.lines(documents(spark, sf_dir), "doc_id")
    return rows.select("doc_id", "n", text.last_segment(F.regexp_replace("line", F.lit(" "), F.lit("\r"))).alias("shown"))


@query("install_trim", f"WITH {_LINES}, s AS (SELECT *, coalesce(min(n) FILTER (n > 1 AND regexp_matches(line, '[0-9]')) OVER (PARTITION BY doc_id), 0) AS st FROM l) SELECT doc_id, count(*) AS lines_left FROM s WHERE n >= st GROUP BY doc_id")
def install_trim(spark, sf_dir):
    return text.from_first(text.lines(documents(spark, sf_dir), "doc_id"), "[0-9]", "doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines_left"))


@query("squeeze_text", r"SELECT doc_id, trim(regexp_replace(regexp_replace(replace(replace(text, '. ', '.' || chr(10) || chr(10)), ', ', chr(9) || chr(9)), '\t+', ' ', 'g'), '\n{2,}', chr(10), 'g')) AS text FROM documents")
def squeeze_text(spark, sf_dir):
    raw = F.replace(F.replace(F.col("text"), F.lit(". "), F.lit(".\n\n")), F.lit(", "), F.lit("\t\t"))
    return documents(spark, sf_dir).select("doc_id", text.squeeze(raw).alias("text"))


@query("size_labels", "SELECT p_partkey, CASE WHEN s < 1024 THEN printf('%.1f', s) || ' B' WHEN s < 1048576 THEN printf('%.1f', s / 1024) || ' KB' ELSE printf('%.1f', s / 1048576) || ' MB' END AS label FROM (SELECT p_partkey, p_retailprice * p_size * 16 + 1.37 AS s FROM part)")
def size_labels(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", text.size_label(F.col("p_retailprice") * F.col("p_size") * 16 + 1.37).alias("label"))


@query(
    "doc_search_bm25",
    """WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM documents),
n AS (SELECT doc_id, count(*) AS len FROM t GROUP BY doc_id), s AS (SELECT count(*)::DOUBLE AS docs, avg(len) AS mean FROM n),
f AS (SELECT doc_id, w, count(*) AS tf FROM t WHERE w IN ('the', 'and', 'with', 'erth') GROUP BY ALL), d AS (SELECT w, count(*) AS df FROM f GROUP BY w),
r AS (SELECT doc_id, round(sum(ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 4) AS score
  FROM f JOIN d USING (w) JOIN n USING (doc_id), s GROUP BY doc_id)
SELECT doc_id, score FROM r ORDER BY score DESC, doc_id LIMIT 20""",
)
def doc_search_bm25(spark, sf_dir):
    return search.bm25(documents(spark, sf_dir), "doc_id", "text", ["the", "and", "with", "erth"], 20)


_ENDING = "CASE WHEN w LIKE '%sses' AND length(w) >= 6 THEN left(w, length(w) - 2) WHEN w LIKE '%ies' AND length(w) >= 6 THEN left(w, length(w) - 3) || 'y' WHEN w LIKE '%ing' AND length(w) >= 7 THEN left(w, length(w) - 3) WHEN w LIKE '%ed' AND length(w) >= 6 THEN left(w, length(w) - 2) WHEN w LIKE '%ly' AND length(w) >= 6 THEN left(w, length(w) - 2) WHEN w LIKE '%es' AND length(w) >= 6 THEN left(w, length(w) - 2) WHEN w LIKE '%s' AND w NOT LIKE '%ss' AND length(w) >= 5 THEN left(w, length(w) - 1) ELSE w END"


@query(
    "docs_search",
    f"""WITH d AS (SELECT doc_id, left(text, 60) AS title, text AS content FROM documents), t AS (SELECT doc_id, 0 AS f, 2.0 AS weight, unnest(regexp_extract_all(lower(title), '[a-z]+')) AS w FROM d UNION ALL SELECT doc_id, 1, 1.0, unnest(regexp_extract_all(lower(content), '[a-z]+')) FROM d),
r AS (SELECT doc_id, f, weight, {_ENDING} AS w FROM t), n AS (SELECT doc_id, f, count(*) AS len FROM r GROUP BY ALL), s AS (SELECT f, count(*)::DOUBLE AS docs, avg(len) AS mean FROM n GROUP BY f),
q AS (SELECT doc_id, f, any_value(weight) AS weight, w, count(*) AS tf FROM r WHERE w IN ('with', 'erth') GROUP BY doc_id, f, w), g AS (SELECT f, w, count(*) AS df FROM q GROUP BY ALL)
SELECT doc_id, round(sum(weight * ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))), 4)::DOUBLE AS score FROM q JOIN g USING (f, w) JOIN n USING (doc_id, f) JOIN s USING (f) GROUP BY doc_id ORDER BY score DESC, doc_id LIMIT 20""",
)
def docs_search(spark, sf_dir):
    pages = documents(spark, sf_dir).select("doc_id", F.left("text", F.lit(60)).alias("title"), F.col("text").alias("content"))
    return search.docs_search(pages, "doc_id", "Erths with")


@query("docs_search_fallback", "SELECT doc_id, NULL::DOUBLE AS score FROM documents ORDER BY doc_id LIMIT 20")
def docs_search_fallback(spark, sf_dir):
    pages = documents(spark, sf_dir).select("doc_id", F.lit("").alias("title"), F.col("text").alias("content"))
    return search.docs_search(pages, "doc_id", "qqqqzzzz")


_ENDPOINTS = ("concat('/', p_partkey) AS path", "'get' AS method", "p_name AS summary", "p_type AS operationId", "p_brand AS description", "CASE WHEN p_size % 2 = 0 THEN 'hub even' ELSE 'odd' END AS tags", "'' AS param_names")


@query("endpoint_search")
def endpoint_search(spark, sf_dir):
    return search.endpoint_search(spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*_ENDPOINTS), "blue gears", "even")


@query("endpoint_search_by_tag", "SELECT '/' || p_partkey AS path, p_name AS summary, NULL::DOUBLE AS score FROM part WHERE p_size % 2 = 0")
def endpoint_search_by_tag(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(*_ENDPOINTS)
    return search.endpoint_search(rows, "qqqqzzzz", "even").select("path", "summary", "score")


@query("paper_outline")
def paper_outline(spark, sf_dir):
    return search.papers(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "html")


_NAV = "n AS (SELECT page_id, regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1) AS nav FROM pages)"


@query("nav_links", f"""WITH {_NAV}, l AS (SELECT page_id, unnest(regexp_extract_all(nav, '<a href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(nav, '<a href="([^"]*)"', 1), 1)::INT - 1 AS index FROM n)
SELECT page_id, index, CASE WHEN starts_with(href, '/') THEN 'https://x' ELSE '' END || href AS url FROM l""")
def nav_links(spark, sf_dir):
    return search.nav_links(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "html", "https://x").select("page_id", "index", "url")


@query("page_title", "SELECT page_id, regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS title, len(regexp_extract_all(html, '<p[ >]'))::INT AS paragraphs FROM pages")
def page_title(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1).alias("title"), F.regexp_count("html", F.lit("<p[ >]")).alias("paragraphs"))


@query("page_sections")
def page_sections(spark, sf_dir):
    return search.sections(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id", "html")


@query("fuzzy_close_match")
def fuzzy_close_match(spark, sf_dir):
    return search.close_matches(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_partkey", "p_name", "small rings", 10)
