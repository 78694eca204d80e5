"""Queries of catalogs, papers, datasets, repositories and of how values are shown."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.functions import formats
from tracklore.operators import catalog, datasets, messages, papers, repos
from tracklore.operators import sequences as S
from tracklore.plans.kpi import USER_LOG, events
from tracklore.plans.registry import query


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_PROVIDERS = """array(named_struct('provider', p_brand, 'status', CASE WHEN p_size % 2 = 0 THEN 'live' ELSE 'down' END, 'context_length', cast(p_size * 100 AS int), 'supports_tools', p_size % 3 = 0),
  named_struct('provider', 'other', 'status', CASE WHEN p_size % 5 = 0 THEN 'live' END, 'context_length', CASE WHEN p_size > 20 THEN 5000 END, 'supports_tools', cast(NULL AS boolean)))"""


@query(
    "live_providers",
    """WITH p AS (SELECT p_partkey, p_size % 2 = 0 AS a, p_size % 5 = 0 AS b, p_size AS s, p_brand FROM part)
SELECT p_partkey, (a::INT + b::INT) AS n, CASE WHEN a AND s > 0 THEN greatest(s * 100, CASE WHEN b AND s > 20 THEN 5000 ELSE 0 END) WHEN b AND s > 20 THEN 5000 END::INT AS longest, a AND s % 3 = 0 AS tools,
  CASE s % 4 WHEN 0 THEN true WHEN 1 THEN a WHEN 2 THEN true ELSE b END AS served FROM p""",
)
def live_providers(spark, sf_dir):
    pin = F.expr("CASE p_size % 4 WHEN 0 THEN 'fastest' WHEN 1 THEN p_brand WHEN 3 THEN 'other' END")
    rows = read(spark, sf_dir, "part").select("p_partkey", pin.alias("pin"), F.expr(_PROVIDERS).alias("x"))
    x = F.col("x")
    return rows.select("p_partkey", F.size(catalog.live(x)).alias("n"), catalog.longest_context(x).alias("longest"), catalog.any_with_tools(x).alias("tools"), catalog.pin_served(x, F.col("pin")).alias("served"))


@query("effort_cascade", "SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'medium' WHEN 1 THEN 'low' WHEN 2 THEN 'low' END AS level FROM part")
def effort_cascade(spark, sf_dir):
    asked = F.expr("CASE p_size % 4 WHEN 0 THEN 'max' WHEN 1 THEN 'minimal' WHEN 2 THEN 'low' ELSE 'odd' END")
    return read(spark, sf_dir, "part").select("p_partkey", catalog.first_effort(asked, F.array(F.lit("medium"), F.lit("low"))).alias("level"))


@query("expired_sweep", "SELECT event_id FROM events WHERE ts + INTERVAL 300 SECOND > TIMESTAMP '2024-01-20 00:00:00'")
def expired_sweep(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", (F.col("ts").cast("timestamp") + F.expr("INTERVAL 300 SECOND")).alias("expires_at"))
    return catalog.unexpired(rows, F.lit("2024-01-20 00:00:00").cast("timestamp")).select("event_id")


@query(
    "fresh_or_stale",
    """WITH o AS (SELECT c_custkey AS k, c_name AS v, c_custkey % 600 AS age FROM customer WHERE c_custkey % 4 <> 0), n AS (SELECT c_custkey AS k, c_mktsegment AS v FROM customer WHERE c_custkey % 3 <> 0)
SELECT k, CASE WHEN age < 300 THEN o.v ELSE coalesce(n.v, o.v) END AS value, coalesce(age >= 300, true) AND n.v IS NULL AS stale FROM o FULL JOIN n USING (k)""",
)
def fresh_or_stale(spark, sf_dir):
    customers, now = read(spark, sf_dir, "customer"), F.lit("2024-01-20 00:00:00").cast("timestamp")
    cached = customers.filter("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("value"), F.timestamp_seconds(F.unix_seconds(now) - F.col("c_custkey") % 600).alias("at"))
    fetched = customers.filter("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("value"))
    return catalog.fresh_or_stale(cached, fetched, now, "k")


@query("result_limit", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 20 ELSE least(p_size * 2, 50) END::INT AS shown, CASE WHEN p_size % 3 = 0 THEN 'Showing top 20 results (set max_results to adjust).' WHEN p_size * 2 > 50 THEN 'Requested ' || (p_size * 2) || ' but showing top 50 (maximum).' END AS note FROM part")
def result_limit(spark, sf_dir):
    asked = F.expr("CASE WHEN p_size % 3 <> 0 THEN cast(p_size * 2 AS int) END")
    return read(spark, sf_dir, "part").select("p_partkey", catalog.capped(asked).alias("shown"), catalog.cap_note(asked).alias("note"))


@query(
    "paper_resources",
    """WITH l AS (SELECT c_custkey, 'dataset' AS kind, o_orderkey AS id, o_totalprice AS weight FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
  UNION ALL SELECT c_custkey, 'model', o_orderkey, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'O' UNION ALL SELECT c_custkey, 'collection', c_nationkey, c_acctbal FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY c_custkey, kind ORDER BY weight DESC, id)::INT AS rank FROM l) SELECT c_custkey, kind, id, weight, rank FROM r WHERE rank <= 3""",
)
def paper_resources(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").cast("long").alias("id"), F.col("o_totalprice").alias("weight"), "o_orderstatus")
    customers = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("long").alias("id"), F.col("c_acctbal").alias("weight"))
    linked = {"dataset": orders.filter("o_orderstatus = 'F'"), "model": orders.filter("o_orderstatus = 'O'"), "collection": customers}
    return papers.resources(customers, linked, "c_custkey", "weight", 3)


@query(
    "paper_lines",
    """SELECT p_partkey, coalesce(CASE WHEN p_size % 7 > 0 THEN p_name END, 'Unknown') AS title, coalesce(CASE WHEN p_size % 5 > 0 THEN p_size END, 0)::INT AS upvotes, 'a, b, ' || p_brand || ', d, e' AS keywords,
  CASE WHEN p_size % 2 = 0 THEN p_type WHEN length(repeat(p_name, 40)) > 300 THEN left(repeat(p_name, 40), 300) || '...' ELSE repeat(p_name, 40) END AS summary,
  CASE p_size % 3 WHEN 0 THEN 'likes' WHEN 1 THEN 'trendingScore' ELSE 'downloads' END AS sort, 'x, y (+1 more)' AS authors FROM part""",
)
def paper_lines(spark, sf_dir):
    keywords = F.array(F.lit("a"), F.lit("b"), F.col("p_brand"), F.lit("d"), F.lit("e"), F.lit("f"))
    line = papers.paper_line(F.expr("CASE WHEN p_size % 7 > 0 THEN p_name END"), F.expr("CASE WHEN p_size % 5 > 0 THEN p_size END"), keywords, F.expr("CASE WHEN p_size % 2 = 0 THEN p_type ELSE '' END"), F.repeat("p_name", F.lit(40)))
    asked = F.expr("CASE p_size % 3 WHEN 0 THEN 'likes' WHEN 1 THEN 'trending' ELSE 'odd' END")
    rows = read(spark, sf_dir, "part").select("p_partkey", line.alias("x"), papers.sort_key(asked).alias("sort"), papers.authors_line(F.array(F.lit("x"), F.lit("y"), F.lit("z")), 2).alias("authors"))
    return rows.select("p_partkey", "x.*", "sort", "authors")


@query(
    "citation_entries",
    """SELECT o_orderkey, '- **' || CASE WHEN o_orderkey % 4 = 0 THEN '(untitled)' ELSE o_orderpriority END || '** (' || CASE WHEN o_orderkey % 3 = 0 THEN '?' ELSE '2020' END || ', ' || CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE o_orderkey % 5 END || ' cites)'
  || CASE WHEN o_orderstatus = 'F' THEN ' **[influential]**' ELSE '' END || CASE WHEN o_orderkey % 2 = 0 THEN '  arxiv:' || o_orderkey ELSE '' END AS line, 'background, method' AS intents,
  o_orderpriority || chr(10) || repeat('c', 200) || '...' AS contexts FROM orders""",
)
def citation_entries(spark, sf_dir):
    entry = F.expr("""named_struct('title', CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderpriority END, 'year', CASE WHEN o_orderkey % 3 > 0 THEN 2020 END, 'cites', CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 5 END,
      'arxiv', CASE WHEN o_orderkey % 2 = 0 THEN cast(o_orderkey AS string) ELSE '' END, 'influential', o_orderstatus = 'F', 'intents', array('background', 'method'), 'contexts', array(o_orderpriority, repeat('c', 250), 'third'))""")
    return read(spark, sf_dir, "orders").select("o_orderkey", entry.alias("e")).select("o_orderkey", papers.citation_entry(F.col("e")).alias("x")).select("o_orderkey", "x.*")


@query(
    "paper_keys",
    """SELECT p_partkey, 'ARXIV:' || p_partkey || ',ARXIV:' || p_size AS positive, '' AS negative, p_type || ':((''limit'', ''' || p_size || '''), (''query'', ''' || p_brand || '''))' AS cache_key,
  CASE WHEN p_size % 2 = 0 THEN 'A' || p_size || '.1' ELSE '' END AS section FROM part""",
)
def paper_keys(spark, sf_dir):
    lists = papers.id_lists(F.concat_ws(" , ", F.col("p_partkey").cast("string"), F.lit(""), F.col("p_size").cast("string")), F.lit(None).cast("string"))
    params = F.create_map(F.lit("query"), F.col("p_brand"), F.lit("limit"), F.col("p_size").cast("string"))
    heading = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("A"), F.col("p_size").cast("string"), F.lit(".1 Title"))).otherwise(F.lit("Title 3"))
    rows = read(spark, sf_dir, "part").select("p_partkey", lists.alias("x"), papers.cache_key(F.col("p_type"), params).alias("cache_key"), papers.section_number(heading).alias("section"))
    return rows.select("p_partkey", F.array_join("x.positive", ",").alias("positive"), F.array_join("x.negative", ",").alias("negative"), "cache_key", "section")


@query(
    "dataset_structure",
    """WITH f AS (SELECT lang, source, min(doc_id) AS pos FROM documents GROUP BY ALL), g AS (SELECT *, min(pos) OVER (PARTITION BY lang) AS first FROM f)
SELECT lang, source, (SELECT count(*) FROM f) AS total FROM g ORDER BY first, pos, lang, source LIMIT 4""",
)
def dataset_structure(spark, sf_dir):
    return datasets.structure(read(spark, sf_dir, "documents"), "lang", "source", "doc_id", 4)


@query("dataset_status", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'valid: viewer, search' WHEN p_size % 3 = 0 THEN 'valid: search' ELSE 'may have issues' END AS status FROM part")
def dataset_status(spark, sf_dir):
    even = F.col("p_size") % 2 == 0
    return read(spark, sf_dir, "part").select("p_partkey", datasets.status({"viewer": even, "search": even | (F.col("p_size") % 3 == 0), "filter": F.lit(None).cast("boolean")}).alias("status"))


@query("feature_types", "SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'ClassLabel (no=0, yes=1)' WHEN p_size % 3 = 1 THEN 'ClassLabel (6 classes)' WHEN p_size % 2 = 0 THEN 'int64' ELSE 'Image' END AS kind FROM part")
def feature_types(spark, sf_dir):
    kind = F.expr("CASE WHEN p_size % 3 < 2 THEN 'ClassLabel' ELSE 'Image' END")
    dtype = F.expr("CASE WHEN p_size % 2 = 0 THEN 'int64' ELSE '' END")
    names = F.expr("CASE p_size % 3 WHEN 0 THEN array('no', 'yes') WHEN 1 THEN array('a', 'b', 'c', 'd', 'e', 'f') END")
    return read(spark, sf_dir, "part").select("p_partkey", datasets.type_name(kind, dtype, names).alias("kind"))


@query("sample_rows", "SELECT doc_id::VARCHAR AS doc_id, CASE WHEN length(text) > 150 THEN left(text, 150) || '...' ELSE text END AS text FROM documents ORDER BY documents.doc_id LIMIT 3")
def sample_rows(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return datasets.samples(docs, ["doc_id"])


@query(
    "messages_format",
    """SELECT conv_id, array_to_string(list_sort(list_distinct(list(role))), ',') AS roles, 'role,content,tool_call_id' AS keys, false AS has_tool_calls, bool_or(role = 'tool' OR turn % 4 = 3) AS has_tool_results FROM conversations GROUP BY conv_id""",
)
def messages_format(spark, sf_dir):
    message = F.to_json(F.struct("role", F.col("text").alias("content"), F.when(F.col("turn") % 4 == 3, "id").otherwise("").alias("tool_call_id")))
    rows = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.concat(F.lit("[5,"), F.array_join(F.collect_list(message), ","), F.lit("]")).alias("m"))
    found = rows.select("conv_id", datasets.messages_format(F.try_parse_json("m")).alias("x"))
    return found.select("conv_id", F.array_join("x.roles", ",").alias("roles"), F.array_join("x.keys", ",").alias("keys"), "x.has_tool_calls", "x.has_tool_results")


@query(
    "example_message",
    """WITH c AS (SELECT conv_id, turn, role, CASE WHEN conv_id % 3 = 0 AND turn = 2 THEN 0 WHEN role = 'assistant' THEN 1 WHEN role IS DISTINCT FROM 'system' THEN 2 END AS tier FROM conversations)
SELECT conv_id, arg_min(turn, (tier, turn)) AS turn, arg_min(role, (tier, turn)) AS role FROM c WHERE tier IS NOT NULL GROUP BY conv_id""",
)
def example_message(spark, sf_dir):
    return datasets.example_message(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", (F.col("conv_id") % 3 == 0) & (F.col("turn") == 2))


@query(
    "path_priority",
    """WITH p AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'examples/' WHEN 1 THEN 'src/scripts/' WHEN 2 THEN 'Example/demos/' WHEN 3 THEN 'src/examples/notebook/' ELSE '' END || p_type || '.py' AS path FROM part)
SELECT p_partkey, CASE WHEN path LIKE 'examples/%' OR path LIKE 'Example/%' THEN 0 ELSE 1 END AS outside, CASE WHEN path LIKE 'examples/%' THEN 1 WHEN path LIKE 'src/scripts/%' THEN 0 WHEN path LIKE 'Example/%' THEN 14 WHEN path LIKE 'src/ex%' THEN 4 ELSE 999 END AS pattern,
  len(string_split(path, '/'))::INT AS depth FROM p""",
)
def path_priority(spark, sf_dir):
    path = F.expr("concat(CASE p_size % 5 WHEN 0 THEN 'examples/' WHEN 1 THEN 'src/scripts/' WHEN 2 THEN 'Example/demos/' WHEN 3 THEN 'src/examples/notebook/' ELSE '' END, p_type, '.py')")
    return read(spark, sf_dir, "part").select("p_partkey", repos.path_priority(path).alias("x")).select("p_partkey", "x.*")


def _tree(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.expr("concat(CASE p_size % 4 WHEN 0 THEN 'examples/' WHEN 1 THEN 'src/scripts/' WHEN 2 THEN 'lib/' ELSE 'demo/' END, replace(p_name, ' ', '_'), '.py')").alias("path"))


@query("example_files")
def example_files(spark, sf_dir):
    return repos.example_files(_tree(spark, sf_dir), "p_partkey", "path", 30)


@query("example_files_by_keyword")
def example_files_by_keyword(spark, sf_dir):
    return repos.example_files(_tree(spark, sf_dir), "p_partkey", "path", 30, "blue gear")


@query("similar_names", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'gear') OR contains(lower(p_name), 'hot') ORDER BY p_retailprice DESC, p_name LIMIT 10")
def similar_names(spark, sf_dir):
    return repos.similar_names(read(spark, sf_dir, "part"), "p_partkey", "Hot-Gear", "p_name", "p_retailprice").select("p_partkey", "p_name")


@query(
    "discussion_list",
    "SELECT o_orderkey AS num, CASE o_orderstatus WHEN 'F' THEN '[MERGED]' WHEN 'O' THEN '[OPEN]' ELSE '[CLOSED]' END AS label, CASE WHEN o_orderkey % 2 = 0 THEN 'PR' ELSE 'D' END AS kind, o_orderpriority AS title FROM orders ORDER BY o_orderkey LIMIT 20",
)
def discussion_list(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").selectExpr("o_orderkey AS num", "CASE o_orderstatus WHEN 'F' THEN 'merged' WHEN 'O' THEN 'open' ELSE 'odd' END AS status", "o_orderkey % 2 = 0 AS is_pull_request", "o_orderpriority AS title")
    return repos.discussions(rows, F.lit("all"))


@query(
    "reference_names",
    """SELECT n_regionkey, coalesce(string_agg(n_name, ', ' ORDER BY n_name) FILTER (n_nationkey % 2 = 0), 'none') AS branches, count_if(n_nationkey % 2 = 0)::INT AS n_branches,
  coalesce(string_agg(n_name, ', ' ORDER BY n_name) FILTER (n_nationkey % 2 = 1), 'none') AS tags, count_if(n_nationkey % 2 = 1)::INT AS n_tags FROM nation GROUP BY n_regionkey""",
)
def reference_names(spark, sf_dir):
    refs = read(spark, sf_dir, "nation").selectExpr("n_regionkey", "n_name AS name", "CASE WHEN n_nationkey % 2 = 0 THEN 'branch' ELSE 'tag' END AS kind")
    return repos.references(refs, "n_regionkey")


@query(
    "flat_jobs",
    """SELECT event_id AS id, event_type AS stage, props AS message, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS created_at, 'img' AS docker_image, 'u' || user_id AS owner, CASE WHEN event_id % 2 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS last_run,
  0 AS n_command, CASE WHEN event_id % 3 = 0 THEN 'cpu-basic' ELSE 't4-small' END AS hardware_flavor FROM events""",
)
def flat_jobs(spark, sf_dir):
    rows = read(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "named_struct('stage', event_type, 'message', props) AS status", "array('run') AS command", "cast(ts AS timestamp) AS created_at", "'img' AS docker_image", "cast(NULL AS string) AS space_id", "'t4-small' AS flavor", "named_struct('name', concat('u', user_id)) AS owner",
    )
    plans = read(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "'@daily' AS schedule", "false AS suspend", "CASE WHEN event_id % 2 = 0 THEN named_struct('last_job', named_struct('created_at', cast(ts AS timestamp)), 'next_job_run_at', cast(NULL AS timestamp)) END AS status",
        "named_struct('docker_image', 'img', 'space_id', cast(NULL AS string), 'command', cast(NULL AS array<string>), 'flavor', CASE WHEN event_id % 3 > 0 THEN 't4-small' ELSE '' END) AS job_spec",
    )
    flat = repos.flat_jobs(rows).select("id", "stage", "message", "created_at", "docker_image", "owner")
    return flat.join(repos.flat_scheduled(plans).select("id", "last_run", F.size("command").alias("n_command"), "hardware_flavor"), "id")


@query("total_size", "SELECT lang, sum(n_chars)::BIGINT AS size FROM documents GROUP BY lang UNION ALL SELECT 'all', sum(n_chars)::BIGINT FROM documents")
def total_size(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return docs.rollup("lang").agg(F.sum("n_chars").alias("size")).select(F.coalesce("lang", F.lit("all")).alias("lang"), "size")


@query(
    "shown_values",
    """WITH o AS (SELECT o_orderkey, o_orderkey % 4 AS c, o_totalprice FROM orders)
SELECT o_orderkey, CASE c WHEN 0 THEN '2024-01-02 03:04:05' WHEN 1 THEN 'N/A' WHEN 2 THEN 'soon' ELSE '2024-01-02 00:00:00' END AS date, CASE WHEN c = 0 THEN 'N/A' ELSE 'python a.py' END AS command,
  CASE c WHEN 0 THEN 'space' WHEN 1 THEN 'image' ELSE 'N/A' END AS image, CASE WHEN c = 0 THEN 'A title' ELSE repeat('x', 50) || '…' END AS title, '{"a":1,"b":' || c || '}' AS json FROM o""",
)
def shown_values(spark, sf_dir):
    pick = lambda *values: F.expr("CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", formats.date(pick("'2024-01-02T03:04:05.123Z'", "''", "'soon'", "'2024-01-02'")).alias("date"),
        formats.command(pick("array()", *["array('python', 'a.py')"] * 3)).alias("command"), formats.image_or_space(pick("'space'", "''", "NULL", "''"), pick("'image'", "'image'", "NULL", "''")).alias("image"),
        formats.title(pick("""' "**A title**" '""", *["repeat('x', 60)"] * 3)).alias("title"), formats.sorted_json(F.create_map(F.lit("b"), F.col("o_orderkey").cast("int") % 4, F.lit("a"), F.lit(1))).alias("json"),
    )


@query(
    "output_shortened",
    """SELECT doc_id, CASE WHEN length(text) > 800 THEN left(text, 200) || chr(10) || chr(10) || '... (' || format('{:,}', length(text) - 800) || ' of ' || format('{:,}', length(text)) || ' chars omitted, showing first 200 + last 600) ...' || chr(10) || right(text, 600) ELSE text END AS text FROM documents""",
)
def output_shortened(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", formats.shortened(F.col("text"), 800).alias("text"))


@query(
    "job_commands",
    """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'uv run --with a --with hf-transfer -p 3.12 https://x/y.py --v 1' WHEN 1 THEN 'uv run --with a --with hf-transfer -p 3.12 run.py --v 1'
  ELSE '/bin/sh -lc echo "' || base64(('print(1)' || chr(10) || p_name)::BLOB) || '" | base64 -d | uv run --with a --with hf-transfer -p 3.12 - --v 1' END AS command FROM part""",
)
def job_commands(spark, sf_dir):
    script = F.expr(r"CASE p_size % 3 WHEN 0 THEN 'https://x/y.py' WHEN 1 THEN 'run.py' ELSE concat('print(1)\n', p_name) END")
    packages = formats.with_transfer(F.array(F.lit("a")))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(formats.job_command(script, packages, F.lit("3.12"), F.array(F.lit("--v"), F.lit("1"))), " ").alias("command"))


@query("numbered_read", """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT AS n FROM documents)
SELECT doc_id, n, lpad(n::VARCHAR, 6, ' ') || chr(9) || CASE WHEN length(line) > 400 THEN left(line, 400) || '...' ELSE line END AS shown, CASE WHEN length(line) > 400 THEN left(line, 400) || '...' ELSE line END AS bare FROM l WHERE n BETWEEN 1 AND 2000""")
def numbered_read(spark, sf_dir):
    from tracklore.functions import text

    rows = text.lines(read(spark, sf_dir, "documents"), "doc_id").filter(F.col("n").between(1, 2000))
    return rows.select("doc_id", "n", formats.numbered(F.col("line"), F.col("n"), 400).alias("shown")).withColumn("bare", formats.unnumbered(F.col("shown")))


_CONV = "SELECT conv_id AS session_id, turn AS pos, role, text FROM conversations"


@query("seed_messages", f"WITH c AS ({_CONV}) SELECT session_id, pos FROM c WHERE role IN ('user', 'assistant', 'tool')")
def seed_messages(spark, sf_dir):
    return messages.seeds(read(spark, sf_dir, "conversations").selectExpr("conv_id AS session_id", "turn AS pos", "role")).select("session_id", "pos")


@query(
    "session_info",
    """SELECT conv_id AS session_id, count(*)::INT AS message_count, CASE WHEN conv_id % 3 = 0 THEN 'plan|' || CASE WHEN conv_id % 2 = 0 THEN '{"a":1}' ELSE '{}' END END AS pending FROM conversations GROUP BY conv_id""",
)
def session_info(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("session_id")).agg(F.collect_list("role").alias("messages"))
    calls = F.expr("CASE WHEN session_id % 3 = 0 THEN array(named_struct('name', 'plan', 'id', 'i', 'arguments', CASE WHEN session_id % 2 = 0 THEN '{\"a\": 1}' ELSE '{bad' END)) ELSE array() END")
    found = messages.session_info(rows.withColumns({"user_id": F.lit("u"), "calls": calls}))
    return found.select("session_id", "message_count", F.when(F.col("pending").isNotNull(), F.array_join(F.transform("pending", lambda c: F.concat(c.tool, F.lit("|"), c.arguments)), ",")).alias("pending"))


@query("cache_breakpoints", "SELECT conv_id, string_agg(CASE WHEN turn = first THEN 'cached:' || role ELSE role END || CASE WHEN turn = last THEN '!' ELSE '' END, ',' ORDER BY turn) AS roles FROM (SELECT *, min(turn) OVER w AS first, max(turn) OVER w AS last FROM conversations WINDOW w AS (PARTITION BY conv_id)) GROUP BY conv_id")
def cache_breakpoints(spark, sf_dir):
    roles = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x.role)
    rows = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(roles.alias("r"))
    marked = messages.cache_marked(messages.cache_marked(F.col("r"), True, lambda x: F.concat(F.lit("cached:"), x)), False, lambda x: F.concat(x, F.lit("!")))
    return rows.select("conv_id", F.array_join(marked, ",").alias("roles"))


@query(
    "calls_in_order",
    "SELECT l_orderkey AS session_id, array_to_string(list(l_partkey || ':' || l_quantity::INT ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity), ',') AS calls FROM lineitem GROUP BY l_orderkey",
)
def calls_in_order(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS session_id", "struct(l_linenumber, l_partkey, l_suppkey, l_quantity) AS index", "cast(l_suppkey AS string) AS id", "cast(l_partkey AS string) AS name", "cast(cast(l_quantity AS int) AS string) AS arguments")
    return messages.ordered_calls(rows).select("session_id", F.array_join(F.transform("calls", lambda c: F.concat(c["name"], F.lit(":"), c["arguments"])), ",").alias("calls"))


_CALLS = f"""WITH {USER_LOG}, m AS (SELECT session_id, pos, CASE kind WHEN 'tool_call' THEN 'call' WHEN 'tool_output' THEN 'result' ELSE 'other' END AS kind, k % 4 AS id, 'tool_' || (k % 2) AS name, (k % 3)::VARCHAR AS text FROM log),
b AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY pos DESC) AS back FROM m), r AS (SELECT * FROM b WHERE back <= 30),
t AS (SELECT *, min(pos) FILTER (kind <> 'result') OVER (PARTITION BY session_id ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS turn FROM r),
s AS (SELECT t.session_id, t.pos, t.name, any_value(t.name || '/' || left(md5(t.text), 12)) || '/' || coalesce(left(md5(arg_min(q.text, q.pos)), 12), '-') AS sig
  FROM t LEFT JOIN t q ON q.session_id = t.session_id AND q.kind = 'result' AND q.id = t.id AND q.pos > t.pos AND q.pos < coalesce(t.turn, 1000000000) WHERE t.kind = 'call' GROUP BY ALL)"""


def _signatures(spark, sf_dir):
    log = events(spark, sf_dir, by_day=False).selectExpr("session_id", "pos", "CASE kind WHEN 'tool_call' THEN 'call' WHEN 'tool_output' THEN 'result' ELSE 'other' END AS kind", "pos AS message", "k % 4 AS id", "concat('tool_', k % 2) AS name", "cast(k % 3 AS string) AS text")
    return S.call_signatures(log)


@query("call_signatures", f"{_CALLS} SELECT session_id, pos, sig FROM s")
def call_signatures(spark, sf_dir):
    return _signatures(spark, sf_dir).select("session_id", "pos", "sig")


@query(
    "loop_verdict",
    f"""{_CALLS}, e AS (SELECT session_id FROM s GROUP BY session_id HAVING count(*) >= 2), o AS (SELECT *, split_part(sig, '/', 1) AS short FROM s SEMI JOIN e USING (session_id)),
n AS (SELECT *, CASE WHEN short IS DISTINCT FROM lag(short) OVER w THEN 1 ELSE 0 END AS new FROM o WINDOW w AS (PARTITION BY session_id ORDER BY pos)), i AS (SELECT *, sum(new) OVER (PARTITION BY session_id ORDER BY pos) AS run FROM n),
u AS (SELECT session_id, run, any_value(name) AS name FROM i GROUP BY ALL HAVING count(*) >= 2), f AS (SELECT session_id, arg_min(name, run) AS name FROM u GROUP BY session_id),
l AS (SELECT session_id, list(short ORDER BY pos) AS t FROM o GROUP BY session_id), p AS (SELECT session_id, t, list_filter([2, 3, 4, 5], lambda n: len(t) >= 2 * n AND t[-n:] = t[-2 * n:-n - 1])[1] AS k FROM l)
SELECT session_id, CASE WHEN name IS NOT NULL THEN 'repeated' ELSE 'cycle' END AS verdict, coalesce(name, array_to_string(t[-k:], '>')) AS calls FROM p LEFT JOIN f USING (session_id) WHERE name IS NOT NULL OR k IS NOT NULL""",
)
def loop_verdict(spark, sf_dir):
    # Signatures by name alone, and runs of two, so that the table has loops.
    rows = _signatures(spark, sf_dir).withColumn("sig", F.split_part("sig", F.lit("/"), F.lit(1)))
    return S.loop_verdict(rows, 2)
