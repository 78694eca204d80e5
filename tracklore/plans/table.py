"""Queries of rules, quotas, profiles, joins, sets and sorts over the star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklore.operators import access, rules, tables
from tracklore.plans.kpi import LOG, events
from tracklore.plans.registry import query


def read(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("parquet_group_sizes", "SELECT lang, source, count(*) AS files, coalesce(sum(n_chars), 0)::BIGINT AS size FROM documents GROUP BY ALL")
def parquet_group_sizes(spark, sf_dir):
    return tables.groups_with_sizes(read(spark, sf_dir, "documents"), "lang", "source", F.col("n_chars"))


@query("split_groups", "WITH f AS (SELECT lang, source, min(doc_id) AS pos FROM documents GROUP BY ALL) SELECT lang, string_agg(source, ',' ORDER BY pos, source) AS splits FROM f GROUP BY lang")
def split_groups(spark, sf_dir):
    return tables.splits(read(spark, sf_dir, "documents"), "lang", "source", "doc_id")


@query("message_profile", "SELECT array_to_string(list_sort(list_distinct(list(role))), ',') AS roles, count(*) AS n, bool_or(role = 'tool') AS has_tool_results FROM conversations")
def message_profile(spark, sf_dir):
    return tables.message_profile(read(spark, sf_dir, "conversations"))


@query("topk_sort", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 25")
def topk_sort(spark, sf_dir):
    return tables.top(read(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), 25, F.desc("p_retailprice"), F.asc("p_partkey"))


@query("composite_sort", "SELECT p_partkey, p_brand, p_type, p_size FROM part ORDER BY p_size DESC, p_brand, p_type, p_partkey LIMIT 40")
def composite_sort(spark, sf_dir):
    return tables.top(read(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size"), 40, F.desc("p_size"), F.asc("p_brand"), F.asc("p_type"), F.asc("p_partkey"))


@query("topk_filtered", "SELECT s_suppkey, s_acctbal FROM supplier WHERE s_nationkey < 10 ORDER BY s_acctbal DESC, s_suppkey LIMIT 20")
def topk_filtered(spark, sf_dir):
    return tables.top(read(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey"), 20, F.desc("s_acctbal"), F.asc("s_suppkey"), keep=F.col("s_nationkey") < 10).select("s_suppkey", "s_acctbal")


@query(
    "quota_daily_counts",
    """WITH o AS (SELECT user_id, ts::DATE AS day, CASE WHEN event_type = 'error' THEN -1 ELSE 1 END AS d, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS i FROM events),
s AS (SELECT *, sum(d) OVER (PARTITION BY user_id, day ORDER BY i) AS run FROM o),
l AS (SELECT user_id, day, arg_max(run, i) AS last, min(run) AS low FROM s GROUP BY ALL)
SELECT user_id, day, (last - least(low, 0))::INT AS used FROM l""",
)
def quota_daily_counts(spark, sf_dir):
    ops = read(spark, sf_dir, "events").select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "error", "refund").otherwise("inc").alias("op"))
    return rules.daily_counts(ops)


@query(
    "charged_sessions",
    f"""WITH {LOG}, o AS (SELECT user_id, k % 7 AS session_id, ts::DATE AS day, min(ts) AS ts FROM log GROUP BY ALL)
SELECT user_id, day, session_id, row_number() OVER (PARTITION BY user_id, day ORDER BY ts, session_id) <= 2 AS admitted FROM o""",
)
def charged_sessions(spark, sf_dir):
    starts = events(spark, sf_dir).select("user_id", (F.col("k") % 7).alias("session_id"), "ts")
    return rules.charged_sessions(starts, 2)


@query("capacity_gate", "SELECT o_custkey AS user_id, count(*) AS live, count(*) < 10 AND (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') < 1000000 AS may_open FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey")
def capacity_gate(spark, sf_dir):
    live = read(spark, sf_dir, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("user_id"))
    return rules.capacity_gate(live, total=1_000_000)


_MESSAGE = "CASE doc_id % 9 WHEN 0 THEN 'HTTP 429 x' WHEN 1 THEN 'Maximum context length reached' WHEN 2 THEN 'Bad Gateway' WHEN 3 THEN 'request timed out' WHEN 4 THEN 'Overloaded' WHEN 5 THEN 'ThrottlingException' WHEN 6 THEN 'too many input tokens, timeout' WHEN 7 THEN 'Model x does not exist' ELSE 'no such file' END"


@query(
    "error_class",
    """WITH e AS (SELECT doc_id, (doc_id % 9)::INT AS c, (doc_id % 4)::INT AS attempt FROM documents),
k AS (SELECT doc_id, attempt, c, CASE WHEN c IN (1, 6) THEN 'context_overflow' WHEN c IN (0, 5) THEN 'rate_limit' WHEN c IN (2, 3, 4) THEN 'transient' ELSE 'other' END AS kind FROM e)
SELECT doc_id, kind, CASE WHEN kind = 'rate_limit' THEN ([30, 60])[attempt + 1] WHEN kind = 'transient' THEN ([5, 15, 30])[attempt + 1] END AS delay, CASE WHEN c = 7 THEN 'model' END AS advice FROM k""",
)
def error_class(spark, sf_dir):
    message = F.expr(_MESSAGE)
    rows = read(spark, sf_dir, "documents").select("doc_id", rules.error_class(message).alias("kind"), rules.friendly_class(message).alias("advice"))
    return rows.withColumn("delay", rules.retry_delay(F.col("kind"), (F.col("doc_id") % 4).cast("int")))


@query("effort_problem", "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'thinking' WHEN 1 THEN 'effort' WHEN 2 THEN 'effort' END AS problem FROM documents")
def effort_problem(spark, sf_dir):
    message = F.expr("CASE doc_id % 5 WHEN 0 THEN 'Thinking.type.enabled is not supported; see output_config.effort' WHEN 1 THEN 'effort must be one of low, high' WHEN 2 THEN 'Invalid output_config' WHEN 3 THEN 'effort was made' END")
    return read(spark, sf_dir, "documents").select("doc_id", rules.effort_problem(message).alias("problem"))


_WHO = """array(named_struct('name', 'acme', 'plan', CASE WHEN c_custkey % 3 = 0 THEN 'Enterprise Hub' END, 'type', cast(NULL AS string)), named_struct('name', 'beta', 'plan', '', 'type', CASE WHEN c_custkey % 5 = 0 THEN 'team' ELSE 'free' END),
  named_struct('name', '', 'plan', 'pro', 'type', cast(NULL AS string)))"""
_WHO_SQL = """w AS (SELECT c_custkey, c_name, (c_mktsegment = 'BUILDING' OR (c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 0)) AS pays,
  CASE WHEN c_custkey % 3 = 0 THEN ['acme'] ELSE [] END || CASE WHEN c_custkey % 5 = 0 THEN ['beta'] ELSE [] END AS orgs,
  CASE c_custkey % 4 WHEN 0 THEN 'acme' WHEN 1 THEN c_name WHEN 2 THEN 'beta' END AS asked FROM customer)"""


def whoami(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").selectExpr("c_custkey", "c_name", "CASE c_mktsegment WHEN 'BUILDING' THEN 'pro_annual' WHEN 'HOUSEHOLD' THEN 'basic' END AS plan", "c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 0 AS is_pro", f"{_WHO} AS orgs", "CASE c_custkey % 4 WHEN 0 THEN 'acme' WHEN 1 THEN c_name WHEN 2 THEN 'beta' END AS asked")
    none = F.lit(None).cast("string")
    return rows.withColumns({"personal": access.personal_plan(F.col("plan"), F.lit(""), none, F.col("is_pro")), "paid": access.paid_orgs(F.col("orgs"))})


@query("plan_tier", f"WITH {_WHO_SQL} SELECT c_custkey, CASE WHEN pays THEN 'pro' WHEN len(orgs) > 0 THEN 'org' ELSE 'free' END AS tier, CASE WHEN pays OR len(orgs) > 0 THEN 20 ELSE 1 END AS cap, array_to_string(CASE WHEN pays THEN [c_name] ELSE [] END || orgs, ',') AS eligible FROM w")
def plan_tier(spark, sf_dir):
    tier = access.plan_tier(F.col("personal"), F.col("paid"))
    eligible = access.eligible_namespaces(F.col("c_name"), F.col("personal"), F.col("paid"))
    return whoami(spark, sf_dir).select("c_custkey", tier.alias("tier"), rules.daily_cap(tier).alias("cap"), F.array_join(eligible, ",").alias("eligible"))


@query(
    "job_namespace",
    f"""WITH {_WHO_SQL}, e AS (SELECT *, CASE WHEN pays THEN [c_name] ELSE [] END || orgs AS eligible, c_custkey % 7 <> 0 AS known FROM w),
n AS (SELECT *, CASE WHEN NOT known THEN coalesce(asked, c_name) WHEN asked IS NOT NULL THEN CASE WHEN list_contains(eligible, asked) THEN asked END WHEN pays THEN c_name END AS namespace FROM e)
SELECT c_custkey, namespace, CASE WHEN namespace IS NOT NULL THEN NULL WHEN asked IS NOT NULL THEN 'not_allowed' WHEN len(orgs) > 0 THEN 'namespace_required' ELSE 'upgrade_required' END AS problem FROM n""",
)
def job_namespace(spark, sf_dir):
    found = access.namespace(F.col("asked"), F.col("c_name"), F.col("personal"), F.col("paid"), F.col("c_custkey") % 7 != 0)
    return whoami(spark, sf_dir).select("c_custkey", found.alias("x")).select("c_custkey", "x.namespace", "x.problem")


@query("org_member", "SELECT c_custkey, c_custkey % 3 = 0 AS member, CASE WHEN c_custkey % 4 = 3 THEN c_name WHEN c_custkey % 2 = 0 THEN 's' || c_custkey ELSE 'unknown' END AS user_id, CASE WHEN c_custkey % 4 = 3 THEN c_name ELSE 'unknown' END AS username FROM customer")
def org_member(spark, sf_dir):
    sub, preferred = F.expr("CASE WHEN c_custkey % 2 = 0 THEN concat('s', c_custkey) END"), F.expr("CASE WHEN c_custkey % 4 = 3 THEN c_name END")
    rows = whoami(spark, sf_dir).select("c_custkey", access.is_member(F.col("paid"), F.lit("acme")).alias("member"), access.normalised_user(sub, preferred).alias("u"))
    return rows.select("c_custkey", "member", "u.user_id", "u.username")


@query(
    "approval_join_default",
    "SELECT o_orderkey, coalesce(c_acctbal > 5000, false) AS approved FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey",
)
def approval_join_default(spark, sf_dir):
    pending = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"))
    answers = read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), (F.col("c_acctbal") > 5000).alias("approved"))
    return rules.decisions(pending, answers, "key").select("o_orderkey", "approved")


_CALL = "CASE p_partkey % 6 WHEN 0 THEN 'hf_jobs' WHEN 1 THEN 'sandbox_create' WHEN 2 THEN 'file_delete' WHEN 3 THEN 'hf_private_repos' WHEN 4 THEN 'hf_repo_files' ELSE 'hf_repo_git' END"
_DOES = "CASE p_size % 6 WHEN 0 THEN 'run' WHEN 1 THEN 'upload_file' WHEN 2 THEN 'upload' WHEN 3 THEN 'merge_pr' WHEN 4 THEN 'create_repo' ELSE 'logs' END"
_HARDWARE = "CASE p_partkey % 4 WHEN 0 THEN 'cpu-upgrade' WHEN 1 THEN 't4-small' WHEN 2 THEN '' END"
_NEEDS = f"""t AS (SELECT p_partkey, {_CALL} AS tool, {_DOES} AS does, {_HARDWARE} AS flavor, p_partkey % 5 = 0 AS no_cpu, p_partkey % 7 = 0 AS auto, p_partkey % 11 = 0 AS broken, p_partkey % 13 = 0 AS skip FROM part),
n AS (SELECT *, NOT broken AND NOT skip AND CASE tool WHEN 'sandbox_create' THEN true WHEN 'hf_jobs' THEN does = 'run' AND (coalesce(flavor, '') = 't4-small' OR NOT no_cpu)
  WHEN 'hf_private_repos' THEN (does = 'upload_file' AND NOT auto) OR does = 'create_repo' WHEN 'hf_repo_files' THEN does = 'upload' WHEN 'hf_repo_git' THEN does IN ('merge_pr', 'create_repo') ELSE false END AS needs FROM t)"""


def calls(spark, sf_dir):
    part = read(spark, sf_dir, "part").select("p_partkey", F.expr(_CALL).alias("tool"), F.expr(_DOES).alias("operation"), F.expr(_HARDWARE).alias("flavor"))
    key = F.col("p_partkey")
    return part, rules.needs_approval(F.col("tool"), F.col("operation"), F.col("flavor"), key % 11 != 0, key % 13 == 0, key % 5 != 0, key % 7 == 0)


@query("needs_approval", f"WITH {_NEEDS} SELECT p_partkey, needs FROM n")
def needs_approval(spark, sf_dir):
    part, needs = calls(spark, sf_dir)
    return part.select("p_partkey", needs.alias("needs"))


@query("split_by_approval", f"WITH {_NEEDS} SELECT tool, CASE WHEN needs THEN 'waiting' ELSE 'running' END AS state, count(*) AS n FROM n GROUP BY ALL")
def split_by_approval(spark, sf_dir):
    waiting, running = rules.split_by_approval(*calls(spark, sf_dir))
    both = waiting.select("tool", F.lit("waiting").alias("state")).union(running.select("tool", F.lit("running").alias("state")))
    return both.groupBy("tool", "state").agg(F.count(F.lit(1)).alias("n"))


@query("approved_pending", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)")
def approved_pending(spark, sf_dir):
    pending = read(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").select("o_orderkey")
    return pending.join(read(spark, sf_dir, "lineitem").filter("l_discount > 0.08").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi")


@query("model_id_format", "SELECT p_partkey, p_size % 6 IN (0, 3, 5) AS ok FROM part")
def model_id_format(spark, sf_dir):
    name = F.expr("CASE p_size % 6 WHEN 0 THEN concat(p_brand, '/', p_type, ':fast/x') WHEN 1 THEN p_brand WHEN 2 THEN concat(p_brand, '/:x') WHEN 3 THEN concat('legacy/', p_brand, '/b') WHEN 4 THEN '' ELSE concat('a/', p_type) END")
    return read(spark, sf_dir, "part").select("p_partkey", rules.model_id_ok(name).alias("ok"))


@query("job_list_filter", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'ERROR' END AS stage FROM orders WHERE (o_orderkey % 3 = 0 OR o_orderstatus = 'O') AND (o_orderkey % 5 <> 0 OR o_orderstatus = 'F')")
def job_list_filter(spark, sf_dir):
    jobs = read(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'RUNNING' ELSE 'ERROR' END AS stage")
    asked = F.when(F.col("o_orderkey") % 5 == 0, "complete")
    return jobs.filter(rules.stage_matches(F.col("stage"), F.col("o_orderkey") % 3 == 0, asked))


@query("tool_lists", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'LARGE') AND p_type <> 'LARGE'")
def tool_lists(spark, sf_dir):
    return rules.allowed_tools(read(spark, sf_dir, "part").select("p_partkey", "p_type"), ("ECONOMY", "SMALL", "LARGE"), ("LARGE",), "p_type")


@query("visible_sessions", "SELECT o_orderkey, u FROM orders, (VALUES ('dev'), ('7'), (NULL)) v(u) WHERE o_orderkey % 10 = 0 AND (u IS NULL OR u = 'dev' OR o_custkey::VARCHAR = u)")
def visible_sessions(spark, sf_dir):
    users = spark.createDataFrame([("dev",), ("7",), (None,)], "u string")
    rows = read(spark, sf_dir, "orders").filter("o_orderkey % 10 = 0").join(F.broadcast(users), rules.visible_to(F.col("o_custkey").cast("string"), F.col("u")))
    return rows.select("o_orderkey", "u")


@query("script_predicates", """WITH s AS (SELECT p_partkey, p_size % 5 AS c FROM part)
SELECT p_partkey, c = 1 AS pushes, CASE c WHEN 2 THEN 'unsaved' WHEN 1 THEN 'pushed' END AS saves, c = 3 AS is_path, CASE WHEN c = 4 THEN 'flag' ELSE 'env' END AS first_given FROM s""")
def script_predicates(spark, sf_dir):
    script = F.expr("CASE p_size % 5 WHEN 1 THEN 'm = X.from_pretrained(a, push_to_hub=True)' WHEN 2 THEN 'from_pretrained' WHEN 3 THEN './run.py' ELSE 'print(1) ' END")
    first = rules.first_given(F.expr("CASE WHEN p_size % 5 = 4 THEN 'flag' ELSE '' END"), F.lit(None).cast("string"), F.lit("env"))
    return read(spark, sf_dir, "part").select("p_partkey", rules.pushes_to_hub(script).alias("pushes"), rules.save_pattern(script).alias("saves"), rules.looks_like_path(script).alias("is_path"), first.alias("first_given"))


@query("ci_substring_filter", "SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'gear') OR contains(lower(p_type), 'econ') ORDER BY p_partkey LIMIT 60")
def ci_substring_filter(spark, sf_dir):
    keep = rules.holds_any(F.col("p_name"), ["gear"]) | rules.holds_any(F.col("p_type"), ["econ"])
    return tables.top(read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type"), 60, F.asc("p_partkey"), keep=keep).select("p_partkey", "p_name")


@query("tag_prefix_exclusion", "SELECT p_partkey, array_to_string(list_filter([p_brand, 'arxiv:' || p_size, p_type, 'region:x', p_name], lambda x: NOT (x LIKE 'arxiv:%' OR x LIKE 'region:%'))[1:2], ',') AS tags FROM part")
def tag_prefix_exclusion(spark, sf_dir):
    tags = F.array("p_brand", F.concat(F.lit("arxiv:"), F.col("p_size").cast("string")), "p_type", F.lit("region:x"), "p_name")
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(tables.without_prefixes(tags, ("arxiv:", "region:"), 2), ",").alias("tags"))


@query("catalog_fallback_lookup", "SELECT p_partkey, CASE WHEN p_size % 3 = 2 THEN 200000 ELSE (p_size % 5) * 1000 END::BIGINT AS value FROM part")
def catalog_fallback_lookup(spark, sf_dir):
    rows = read(spark, sf_dir, "part").selectExpr("p_partkey", "CASE p_size % 3 WHEN 0 THEN concat('m', p_size % 5) WHEN 1 THEN concat('org/m', p_size % 5, ':fast') ELSE 'none' END AS name")
    catalog = spark.range(5).selectExpr("concat('m', id) AS id", "id * 1000 AS value")
    return tables.lookup_first(rows, catalog, "name", 200000).select("p_partkey", "value")


@query("sorted_distinct_names", "SELECT n_regionkey, array_to_string(list_sort(list_distinct(list(n_name))), ',') AS names FROM nation GROUP BY n_regionkey")
def sorted_distinct_names(spark, sf_dir):
    return read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(tables.sorted_distinct(F.collect_list("n_name")), ",").alias("names"))


@query("endpoint_union", "SELECT 'customer' AS kind, c_custkey AS id, c_name AS name FROM customer WHERE c_acctbal < 0 UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier WHERE s_acctbal < 0")
def endpoint_union(spark, sf_dir):
    a = read(spark, sf_dir, "customer").filter("c_acctbal < 0").selectExpr("c_custkey AS id", "c_name AS name")
    b = read(spark, sf_dir, "supplier").filter("s_acctbal < 0").selectExpr("s_suppkey AS id", "s_name AS name")
    return tables.union_with_kind({"customer": a, "supplier": b})


@query("citation_edges", "SELECT o_custkey AS source, l_partkey AS target, count(*) AS intents, bool_or(l_discount > 0.05) AS influential FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY ALL")
def citation_edges(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_custkey").alias("source"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("target"), "l_discount")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey)
    return joined.groupBy("source", "target").agg(F.count(F.lit(1)).alias("intents"), F.bool_or(F.col("l_discount") > 0.05).alias("influential"))


@query("feature_flags", "SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_type = 'ECONOMY' THEN 'economy' END, CASE WHEN p_retailprice > 1000 THEN 'dear' END], lambda x: x IS NOT NULL), ',') AS flags FROM part")
def feature_flags(spark, sf_dir):
    flags = {"large": F.col("p_size") > 25, "economy": F.col("p_type") == "ECONOMY", "dear": F.col("p_retailprice") > 1000}
    return tables.unpivot_bits(read(spark, sf_dir, "part"), "p_partkey", flags)


@query("usage_normalised", f"WITH {LOG} SELECT event_id, k * 10 AS prompt, CASE WHEN k % 2 = 0 THEN k * 3 ELSE k END AS cache_read, CASE WHEN k % 4 = 0 THEN k * 20 ELSE k * 15 END AS total FROM log WHERE kind = 'llm_call'")
def usage_normalised(spark, sf_dir):
    calls = events(spark, sf_dir, placed=False).filter("kind = 'llm_call'").selectExpr("event_id", "k * 10 AS prompt", "k * 5 AS completion", "CASE WHEN k % 2 = 0 THEN k * 3 ELSE 0 END AS first_key", "k AS second_key", "CASE WHEN k % 4 = 0 THEN k * 20 END AS reported")
    found = tables.usage(F.col("prompt"), F.col("completion"), [F.col("first_key"), F.col("second_key")], F.col("reported"))
    return calls.select("event_id", found.alias("x")).select("event_id", "x.prompt", "x.cache_read", "x.total")
