"""Operators against small models in plain Python."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tracklore.functions import redact, text
from tracklore.operators import datasets, repos, rules, search, sequences, tags, trajectories
from tracklore.sources import event_log, readers, sinks
from tracklore.streaming import rollup


def _outcome(marks):
    base, failed = "ongoing", False
    for m in marks:
        if m == "complete" and not failed:
            base = "completed"
        elif m == "interrupted":
            base = "interrupted"
        elif m == "error":
            failed = True
    return "errored" if failed and base == "ongoing" else base


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["complete", "interrupted", "error", "other"]), min_size=1, max_size=8), min_size=1, max_size=30))
def test_outcome_fold(spark, sessions):
    rows = [(i, p, m) for i, marks in enumerate(sessions) for p, m in enumerate(marks)]
    got = {r.session_id: r.outcome for r in sequences.outcome(spark.createDataFrame(rows, "session_id long, pos int, mark string")).collect()}
    assert got == {i: _outcome(m) for i, m in enumerate(sessions)}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from("AB"), min_size=1, max_size=12), min_size=1, max_size=30))
def test_repeating_tail_and_runs(spark, sessions):
    rows = [(i, p, m) for i, marks in enumerate(sessions) for p, m in enumerate(marks)]
    df = spark.createDataFrame(rows, "session_id long, pos int, s string")
    tail = {r.session_id: r.pattern_length for r in sequences.repeating_tail(df, "s").collect()}
    assert tail == {i: next((n for n in range(2, 6) if len(m) >= 2 * n and m[-n:] == m[-2 * n : -n]), None) for i, m in enumerate(sessions)}
    runs = {r.session_id: r.signature for r in sequences.first_run(df, "s").collect()}
    want = {}
    for i, m in enumerate(sessions):
        found = [m[k] for k in range(len(m) - 2) if m[k] == m[k + 1] == m[k + 2]]
        if found:
            want[i] = found[0]
    assert runs == want


def test_first_action_is_first_in_position(spark):
    rows = [("s", 1, "2024-01-01 00:01:05", "tool_call"), ("s", 2, "2024-01-01 00:01:00", "tool_output")]
    log = spark.createDataFrame(rows, "session_id string, pos int, t string, kind string").selectExpr(
        "session_id", "1L AS user_id", "timestamp'2024-01-01 00:00:00' AS session_start", "pos", "cast(t AS timestamp) AS ts", "kind", "1 AS k", "1.0D AS value"
    )
    from tracklore.operators import kpis

    assert kpis.session_metrics(log).first().first_action_s == 65.0


CASES = [
    "token hf_" + "A" * 35, "sk-ant-" + "b" * 25, "sk-" + "C" * 45, "ghp_" + "d" * 36, "github_pat_" + "E" * 40, "key AKIA" + "F" * 16 + ".", "Authorization: bearer " + "g" * 24,
    "PASSWORD: hunter2 x", 'SECRET="quoted"', "MY_SECRET=x", "SECRET = x", "nothing", "",
]


def test_redaction_native_equals_walk_and_is_idempotent(spark):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, s string")
    once = df.withColumn("r", redact.redacted(F.col("s"))).withColumn("again", redact.redacted(F.col("r")))
    for r in once.collect():
        assert r.r == redact.scrub(r.s) == r.again
    nested = json.dumps({"a": ["SECRET=x\nnext", 3], "HF_TOKEN": {"b": CASES[0]}})
    out = json.loads(spark.createDataFrame([(nested,)], "j string").select(redact.scrub_json("j").alias("j")).first().j)
    assert out == {"a": ["SECRET=[REDACTED]\nnext", 3], "HF_TOKEN": {"b": "token [REDACTED_HF_TOKEN]"}}
    deep = "SECRET=x"
    for _ in range(5000):
        deep = [deep]
    deep = redact.scrub(deep)
    while isinstance(deep, list):
        deep = deep[0]
    assert deep == "SECRET=[REDACTED]"


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(text.last_segment(F.lit("10%\r50%\r100%\r"))) == "100%"
    assert one(text.last_segment(F.lit("\r"))) == ""
    assert one(text.size_label(F.lit(1536.0))) == "1.5 KB"
    assert one(text.strip_control(F.lit("a\x00b\nc\td"))) == "ab\nc\td"
    assert one(text.normalise(F.lit("‘a’ “b” –"))) == "'a' \"b\" -"
    assert one(tags.model_family(F.lit("x/Claude-Opus"))) == "opus" and one(tags.model_family(F.lit(None).cast("string"))) == "other"
    assert one(tags.out_of_memory(F.lit("a room"))) and one(tags.out_of_memory(F.lit("torch.OutOfMemoryError"))) and not one(tags.out_of_memory(F.lit("fine")))
    assert one(rules.retry_delay(F.lit("transient"), F.lit(1))) == 15 and one(rules.retry_delay(F.lit("transient"), F.lit(7))) is None
    lists = lambda *x: F.array(*map(F.lit, x)).cast("array<string>")
    task = lambda tools, *scripts: one(trajectories.task(lists(*tools), lists(*scripts)))
    assert [task(["plan"]), task(["plan", "edit"]), task([]), task(["hf_jobs"], "echo", "x = SFTTrainer()")] == ["research_only", None, None, "training"]
    assert [task(["generate"]), task(["generate", "sandbox_exec"]), task(["dataset_tools"]), task(["hf_inspect_dataset", "plan"])] == ["inference", None, "data_prep", "data_prep"]


def test_session_files_and_log(spark, tmp_path):
    day = tmp_path / "2024-01-01"
    day.mkdir()
    row = {"session_id": "a", "session_start_time": "2024-01-01T00:00:00", "model_name": "m", "messages": "[]", "tools": "{bad", "events": json.dumps([{"timestamp": "2024-01-01T00:00:01", "event_type": "error", "data": {"error": "x"}}, 5])}
    (day / "a.jsonl").write_text(json.dumps(row) + "\nignored")
    (day / "b.jsonl").write_text("\n" + json.dumps(row))
    (day / "c.jsonl").write_text("{broken")
    found = readers.session_files(spark, str(tmp_path), "2024-01-01")
    assert [r.session_id for r in found.select("session_id").collect()] == ["a"]
    events = event_log.log(found).select("pos", "kind", F.col("ts").cast("string").alias("ts")).orderBy("pos").collect()
    assert [(e.pos, e.kind, e.ts) for e in events] == [(1, "error", "2024-01-01 00:00:01"), (2, None, None)]


def test_readers(spark, tmp_path):
    (tmp_path / "session_1.json").write_text('{"session_id": "1", "upload_status": "failed"}')
    (tmp_path / "session_2.json").write_text('{"session_id": "2", "upload_status": "success"}')
    (tmp_path / "session_3.json").write_text("{")
    assert [r.session_id for r in readers.unsent_logs(spark, str(tmp_path)).collect()] == ["1"]
    tree = readers.file_tree(spark, str(tmp_path))
    assert tree.count() == 3 and tuple(readers.tree_size(tree).first()) == (3, sum(f.stat().st_size for f in tmp_path.iterdir()))
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "t.txt").write_text("é" * 9)
    (tmp_path / "b" / "b.bin").write_bytes(b"\xff\xfe\x00")
    assert {r.path.rsplit("/", 1)[1]: r.text for r in readers.text_files(spark, str(tmp_path / "b"), 5).collect()} == {"t.txt": "é" * 5, "b.bin": "[Binary file, 3 bytes]"}
    (tmp_path / "c.json").write_text('{"a": "${X_A:-d}", "b": ["${X_B}"]}')
    assert readers.config(str(tmp_path / "c.json"), {"X_B": "v"}) == {"a": "d", "b": ["v"]}
    spec = spark.createDataFrame([('{"paths": {"/a": {"get": {"summary": "s", "tags": ["x", "y"], "parameters": [{"name": "p"}, {"name": "q"}]}, "x-own": {}}}}',)], "value string")
    assert [(r.path, r.method, r.summary, r.tags, r.param_names) for r in readers.endpoints(spec).collect()] == [("/a", "get", "s", "x y", "p q")]
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(readers.base64_text(F.lit("aGk="))) == "hi"
    cells = F.from_json(F.lit('[{"type":"code","source":"x","tags":["hide"]},{"type":"markdown","source":"# t"},{"type":"code","source":"y"}]'), "array<struct<type:string,source:string,tags:array<string>>>")
    assert one(readers.notebook_text(cells)) == "# t\n\n```python\ny\n```"


def test_paged_source(spark):
    def fetch(page, size):
        return [(i,) for i in range(page * size, min(25, (page + 1) * size))]

    spark.dataSource.register(readers.paged_source("numbers", "n int", fetch, size=10))
    assert spark.read.format("numbers").load().count() == 25
    assert spark.read.format("numbers").option("limit", 12).load().count() == 12
    spark.dataSource.register(readers.paged_source("many", "n int", lambda page, size: [(i,) for i in range(page * size, min(20_000, (page + 1) * size))], size=10, stripes=3))
    assert spark.read.format("many").load().distinct().count() == 20_000


def test_sinks_replace_their_partitions(spark, tmp_path):
    out = str(tmp_path / "kpi")
    rows = spark.createDataFrame([("2024-01-01T00", 1, 'a,"b"'), ("2024-01-01T01", 2, "c")], "bucket string, n int, note string")
    sinks.write_kpis(rows, out)
    sinks.write_kpis(rows.filter("n = 2").withColumn("n", F.lit(5)), out)
    back = spark.read.option("header", True).option("escape", '"').csv(out)
    assert sorted((r.bucket, r.n, r.note) for r in back.collect()) == [("2024-01-01T00", "1", 'a,"b"'), ("2024-01-01T01", "5", "c")]
    session = spark.createDataFrame([("a", "2024-01-01T00:00:00", '[{"content": "SECRET=x"}]', "[]", "[]")], "session_id string, session_start_time string, messages string, events string, tools string")
    sinks.write_sessions(session, str(tmp_path / "s"))
    assert "REDACTED" in spark.read.json(str(tmp_path / "s")).first().messages
    sinks.save_one("x", str(tmp_path / "d" / "f"))
    assert (tmp_path / "d" / "f").read_text() == "x"


@pytest.fixture
def stream(spark, tmp_path):
    def start(folder, schema):
        return spark.readStream.schema(schema).parquet(folder)

    return start


def test_hourly_stream_equals_batch(spark, stream, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "value")
    events.write.parquet(str(tmp_path / "in"))
    q = rollup.hourly(stream(str(tmp_path / "in"), events.schema)).writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("hours").collect())) == sorted(map(tuple, rollup.hourly(events).collect()))


def test_counter_state(spark, stream, tmp_path):
    rows = [(1, i, f"2024-01-0{1 + i // 5} 00:00:0{i % 5}", "refund" if i in (0, 3) else "inc") for i in range(10)]
    df = spark.createDataFrame(rows, "user_id long, event_id long, t string, op string").selectExpr("user_id", "event_id", "cast(t AS timestamp) AS ts", "op")
    df.write.parquet(str(tmp_path / "in"))
    q = rollup.daily_counter(stream(str(tmp_path / "in"), df.schema)).writeStream.format("memory").queryName("used").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(tuple(r) for r in spark.table("used").collect()) == [(1, "2024-01-01", 2), (1, "2024-01-02", 5)]


def test_a_late_day_does_not_reset_a_later_one(spark, stream, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "user_id long, event_id long, t string, op string").selectExpr("user_id", "event_id", "cast(t AS timestamp) AS ts", "op")
    make([(1, i, "2024-01-02 00:00:00", "inc") for i in range(4)]).write.parquet(str(tmp_path / "in"))
    source, out = stream(str(tmp_path / "in"), make([(1, 0, "2024-01-01", "inc")]).schema), str(tmp_path / "state")
    for later in (None, make([(1, 9, "2024-01-01 00:00:00", "inc")]), make([(1, 10, "2024-01-02 00:00:00", "inc")])):
        if later is not None:
            later.write.mode("append").parquet(str(tmp_path / "in"))
        q = rollup.daily_counter(source).writeStream.foreachBatch(lambda b, i: b.write.mode("append").parquet(str(tmp_path / "seen"))).option("checkpointLocation", out).outputMode("update").trigger(availableNow=True).start()
        q.awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "seen")).collect()) == [(1, "2024-01-01", 1), (1, "2024-01-02", 4), (1, "2024-01-02", 5)]


def test_chunks_of_a_stream(spark, stream, tmp_path):
    kinds = "session_id string, pos long, event_type string, content string, call_id string, tool string, success boolean"
    rows = [
        ("s", 1, "processing", None, None, None, None), ("s", 2, "assistant_chunk", "he", None, None, None), ("s", 3, "assistant_chunk", "llo", None, None, None), ("s", 4, "tool_call", "{}", "c1", "search", None),
        ("s", 5, "tool_output", "bad", "c1", "search", False), ("s", 6, "tool_call", "{}", "c2", "plan_tool", None), ("s", 7, "assistant_message", "done", None, None, None), ("s", 8, "tool_state_change", "cancelled", "c3", "x", None), ("s", 9, "turn_complete", None, None, None, None),
    ]
    df = spark.createDataFrame(rows, kinds)
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    q = rollup.chunks(stream(str(tmp_path / "in"), df.schema)).writeStream.format("memory").queryName("chunks").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    got = [(r.type, r.id, r.body) for r in spark.table("chunks").orderBy("pos", "n").collect()]
    assert got == [
        ("start", "", ""), ("start-step", "", ""), ("text-start", "text-1", ""), ("text-delta", "text-1", "he"), ("text-delta", "text-1", "llo"), ("text-end", "text-1", ""), ("tool-input-start", "c1", "search"),
        ("tool-input-available", "c1", "{}"), ("tool-output-error", "c1", "bad"), ("text-start", "text-2", ""), ("text-delta", "text-2", "done"), ("text-end", "text-2", ""), ("tool-output-error", "c3", "Cancelled by user"), ("finish-step", "", ""), ("finish", "", "stop"),
    ]


def test_complete_hours_are_written(spark, stream, tmp_path):
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i // 3} 0{i % 3}:10:00", 1.0) for i in range(12)], "user_id long, t string, value double").selectExpr("user_id", "cast(t AS timestamp) AS ts", "value")
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        q = rollup.each_hour(rollup.hourly(stream(str(tmp_path / "in"), rows.schema)), str(tmp_path / "out"), str(tmp_path / "at"), {"availableNow": True})
        q.awaitTermination()
    done = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted(r.bucket for r in done.collect()) == [f"2024-01-0{d}T0{h}" for d in (1, 2) for h in range(3)][: done.count()] and done.count() >= 5


def test_fan_out_and_hours(spark, tmp_path):
    events = spark.createDataFrame([("a", 1), ("b", 2)], "session_id string, pos int")
    to = spark.createDataFrame([("a", "x"), ("a", "y")], "session_id string, subscriber string")
    rollup.write_each(rollup.fan_out(events, to), str(tmp_path / "out"))
    assert sorted((r.subscriber, r.pos) for r in spark.read.json(str(tmp_path / "out")).collect()) == [("x", 1), ("y", 1)]
    hours = spark.range(1).select(trajectories.hours_to_run(F.lit("2024-01-01 02:30:00").cast("timestamp"), 2).alias("h")).first().h
    assert [str(h) for h in hours] == ["2024-01-01 01:00:00", "2024-01-01 00:00:00"]


def test_status_spill_and_cache_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("a", "new", "2024-01-01"), ("b", "new", "2024-01-01"), ("c", "new", "2024-01-02")], "session_id string, status string, date string")
    folder = str(tmp_path / "t")
    rows.write.partitionBy("date").parquet(folder)
    sinks.write_status(rows, spark.createDataFrame([("a", "success")], "session_id string, status string"), folder)
    assert sorted((r.session_id, r.status) for r in spark.read.parquet(folder).collect()) == [("a", "success"), ("b", "new"), ("c", "new")]
    sinks.write_spills(spark.createDataFrame([(1, "x" * 9), (2, "y")], "id int, text string"), str(tmp_path / "s"), "id", "text", 5)
    assert [r.id for r in spark.read.parquet(str(tmp_path / "s")).collect()] == [1]
    cached = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, at int")
    assert sorted(r.k for r in sinks.newest(cached, 2, "at").collect()) == ["b", "c"]
    assert sorted((r.k, r["at"]) for r in sinks.rekeyed(cached, "k", "a", "b").collect()) == [("b", 1), ("c", 3)]
    shaped = spark.createDataFrame([("s", "2024-01-01", "[]"), ("t", None, "[]")], "session_id string, day string, tools string")
    sinks.write_sft(shaped, str(tmp_path / "sft"))
    assert [r.session_id for r in spark.read.json(str(tmp_path / "sft")).collect()] == ["s"]


def test_content_blocks(spark):
    kinds = "array<struct<kind:string,text:string,mime:string,blob:string,uri:string>>"
    rows = spark.createDataFrame([([("text", "a", None, None, None), ("image", None, "image/png", None, None), ("resource", "t", None, None, None), ("resource", None, "x/y", "QQ==", None), ("resource", "", None, None, "file:///z")],), (None,)], f"b {kinds}")
    assert [r.t for r in rows.select(readers.content_blocks(F.col("b")).alias("t")).collect()] == ["a\n[Image: image/png]\nt\n[Binary data: x/y]\n[Resource: file:///z]", None]


@settings(max_examples=60, deadline=None)
@given(st.text("ab_ ", max_size=9), st.text("ab_ ", max_size=9))
def test_likeness_against_a_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert repos.common(a, b) == row[-1]
    assert 0 <= repos.alike(a, b) <= 100 and repos.alike(a, a) == 100
    assert repos.alike_in_part(a, b) >= repos.alike(a, b) - 1e-9 or len(a) != len(b)


def test_example_files_by_likeness(spark):
    paths = ["examples/train.py", "src/scripts/run.py", "src/core.py", "notebooks/train_gpt.ipynb", "docs/guide/x.md"]
    files = spark.createDataFrame(list(enumerate(paths)), "i int, path string")
    assert [r.path for r in repos.example_files(files, "i", "path", 9).collect()] == ["examples/train.py", "src/scripts/run.py", "notebooks/train_gpt.ipynb", "docs/guide/x.md"]
    assert [r.path for r in repos.example_files(files, "i", "path", 9, "train").collect()] == ["examples/train.py", "notebooks/train_gpt.ipynb"]
    assert repos.alike_by_words("examples", "examples/train.py") == 100 and repos.alike_in_part("train", "xx train yy") == 100


def test_pages(spark):
    html = '<nav class="flex-auto"><a href="/a">A <b>one</b></a><a href="http://b">B</a></nav><nav><a href="/c">C</a></nav><h1>Title: T</h1><h2>Abstract</h2><p>short</p><h2>1.2 Method</h2><p>long</p><h3>3</h3>'
    pages = spark.createDataFrame([(1, html), (2, None)], "k long, html string")
    links = search.nav_links(pages, "k", "html", "http://x", "flex-auto")
    assert [(r.url, r.title) for r in links.orderBy("index").collect()] == [("http://x/a", "A one"), ("http://b", "B")]
    assert [(r.level, r.title, r.text, r.id) for r in search.sections(pages, "k", "html").orderBy("index").collect()] == [(1, "Title: T", "", ""), (2, "Abstract", "short", ""), (2, "1.2 Method", "long", "1.2"), (3, "3", "", "")]
    assert tuple(search.papers(pages, "k", "html").first()) == (1, " T", "short", 2)
    content = spark.createDataFrame([("http://x/a", "  " + "z" * 300)], "url string, content string")
    assert [r.glimpse for r in search.crawled(links, content).orderBy("index").collect()] == ["z" * 200 + "...", "[Could not fetch]"]


def test_endpoint_search(spark):
    rows = [("/a", "get", "list models", "listModels", "all of them", "hub", "limit"), ("/b", "post", "make a repository", "createRepo", "with models", "hub repos", ""), ("/c", "get", "who am i", "whoami", "", "auth", "token")]
    spec = spark.createDataFrame(rows, "path string, method string, summary string, operationId string, description string, tags string, param_names string")
    assert [r.path for r in search.endpoint_search(spec, "model", None).orderBy(F.desc("score")).collect()] == ["/a", "/b"]
    assert [r.path for r in search.endpoint_search(spec, "model", "repos").collect()] == ["/b"]
    assert [(r.path, r.score) for r in search.endpoint_search(spec, "nothing", "auth").collect()] == [("/c", None)]
    assert search.endpoint_search(spec, "nothing", None).count() == 0 and search.endpoint_search(spec, None, "hub").count() == 2


def test_schema_rows(spark):
    assert datasets.schema_rows(spark.createDataFrame([(1, ["a"])], "a int, b array<string>")) == [("a", "int"), ("b", "array<string>")]


def test_stream_shapes(spark):
    lines = spark.createDataFrame([('data: {"event_type": "a"}\nnoise\ndata: {bad\ndata: {"event_type": "b"}',)], "value string")
    assert sorted(r.event_type for r in rollup.server_events(lines).collect()) == ["a", "b"]
    parts = spark.createDataFrame([("s", 0, 1, "id", "n", '{"a"'), ("s", 0, 2, "", "", ": 1}")], "session_id string, index int, pos int, id string, name string, arguments string")
    assert tuple(rollup.deltas(parts).first())[2:] == ("id", "n", '{"a": 1}')
    events = spark.createDataFrame([("s", 1, "x"), ("s", 2, "error"), ("s", 3, "x")], "session_id string, pos int, event_type string")
    assert rollup.until_terminal(events).count() == 2
    saves = spark.createDataFrame([("s", 1, "old"), ("s", 2, "new")], "session_id string, last_save_time int, v string")
    assert rollup.latest_snapshots(saves).first().v == "new"


def test_edits():
    from tracklore.functions import edits

    body = "def f():\n    return ‘a’  \n\nx = 1"
    assert edits.find(body, "x = 1") == (3, 4)
    assert edits.find(body, "return 'a'") == (1, 2)
    assert edits.find(body, "missing") is None
    assert edits.apply_edit("a b a", "a", "c") is None
    assert edits.apply_edit("a b a", "a", "c", "replace_all") == "c b c"
    assert edits.apply_edit("a b", "a", "c", "append_after") == "ac b"
    assert edits.apply_edit("a b", "b", "c", "prepend_before") == "a cb"
    assert edits.apply_edit("  x  ", "x  ", "y") == "  y"
    assert edits.blocks("a\n\n```\nb\n\nc\n```\n\nd") == ["a", "```\nb\n\nc\n```", "d"]
    assert edits.syntax_error("x = 1") is None and edits.syntax_error("x = ") is not None


def test_markdown_blocks_counts_documents_with_fences_and_blank_lines(spark, tmp_path):
    from tracklore.plans import registry

    rows = [(1, "a\n\n```\nb\n\nc\n```\n\nd"), (2, "a\n\nb"), (3, "a. b"), (4, "```\na. b\n```")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(tuple(r) for r in registry.QUERIES["markdown_blocks"](spark, str(tmp_path)).collect()) == [(1, 3), (2, 2), (3, 2), (4, 1)]


def test_registered_functions(spark):
    from tracklore.functions import registered

    assert len(registered.register(spark)) == 9
    one = lambda q: spark.sql(f"SELECT {q} AS x").first().x
    assert one("""tl_scrub_json('{"a": "SECRET=x"}')""") == '{"a": "SECRET=[REDACTED]"}'
    assert one("tl_alike_by_words('examples', 'examples/train.py')") == 100 and one("tl_alike_in_part('ab', 'xaby')") == 100 and one("tl_alike('ab', 'cd')") == 0
    assert one("tl_syntax_error('x = ')") is not None and one("tl_syntax_error('x = 1')") is None
    assert spark.sql("SELECT tl_mean_of_positive(v) AS x FROM VALUES (-1.0D), (2.0D), (4.0D) AS t(v)").first().x == 3
    assert [r.url for r in spark.sql("""SELECT * FROM tl_nav_links('<nav><a href="/a">A</a></nav>')""").collect()] == ["/a"]
    assert [(r.level, r.title, r.text) for r in spark.sql("SELECT * FROM tl_page_sections('<h1>T</h1>x')").collect()] == [(1, "T", "x")]
    assert [r.block for r in spark.sql("SELECT * FROM tl_markdown_blocks('a\\n\\nb')").collect()] == ["a", "b"]


def test_dataset_report(spark):
    splits = spark.createDataFrame([("a", f"s{i}", i) for i in range(12)], "config string, split string, pos int")
    data = spark.createDataFrame([(i, "x" * 200) for i in range(5)], "i int, t string")
    text = datasets.report("d", {"viewer": True, "search": False}, splits, data, ["i"])
    assert "Valid (viewer)" in text and "(showing 10 of 12)" in text and "| i      | int    |" in text
    assert text.count("Row ") == 3 and "- t: " + "x" * 150 + "..." in text


def test_messages_of_parts_and_log_streams(spark, tmp_path):
    from tracklore.functions import formats
    from tracklore.operators import messages

    parts = spark.createDataFrame([("s", 1, 0, "text", "a", None), ("s", 1, 1, "result", "out", "c"), ("s", 1, 2, "text", "b", None)], "session_id string, message int, part int, kind string, text string, call_id string")
    assert sorted(((r.role, r.text, r.call_id) for r in messages.parts_to_messages(parts).collect()), key=repr) == [("assistant", "ab", None), ("tool", "out", "c")]
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.log").write_text("one\ntwo\n")
    q = readers.job_logs(spark, str(tmp_path / "logs")).writeStream.format("memory").queryName("logs").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.line for r in spark.table("logs").collect()) == ["one", "two"]
    shown = spark.range(1).select(formats.curl(F.lit("post"), F.lit("https://x/a"), F.lit(True)).alias("x"), formats.fallback_title(F.lit(" " + "y" * 50)).alias("t")).first()
    assert shown.x.startswith("curl -X POST") and "Content-Type" in shown.x and shown.t == "y" * 40 + "…"
