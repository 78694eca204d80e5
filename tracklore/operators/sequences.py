"""Operators on ordered events: folds, runs, repeating tails, pairing, and repair. Order is the column pos, never row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_pos():
    return Window.partitionBy("session_id").orderBy("pos")


def whole():
    return Window.partitionBy("session_id")


def outcome(log: DataFrame) -> DataFrame:
    """The order-sensitive fold: complete counts before any error only; interruptions always; errors at the end, if open.
    Extremes of positions decide, which combine before the shuffle; only positions of completed turns are a list."""
    at = lambda mark: F.when(F.col("mark") == mark, F.col("pos"))
    facts = log.groupBy("session_id").agg(F.min(at("error")).alias("e"), F.max(at("interrupted")).alias("i"), F.collect_list(at("complete")).alias("c"))
    done = F.array_max(F.filter("c", lambda p: F.col("e").isNull() | (p < F.col("e"))))
    found = (
        F.when(F.col("i").isNotNull() & (done.isNull() | (F.col("i") > done)), "interrupted")
        .when(done.isNotNull(), "completed").when(F.col("e").isNotNull(), "errored").otherwise("ongoing")
    )
    return facts.select("session_id", found.alias("outcome"))


def lookback(log: DataFrame, n: int) -> DataFrame:
    return log.withColumn("_back", F.row_number().over(Window.partitionBy("session_id").orderBy(F.desc("pos")))).filter(F.col("_back") <= n).drop("_back")


def signature(text: Column) -> Column:
    return F.left(F.md5(text), F.lit(12))


def first_run(log: DataFrame, signature_column: str, least: int = 3) -> DataFrame:
    """Per session, the signature of the first run of `least` or more equal ones; sessions without one are absent."""
    new = (~F.col(signature_column).eqNullSafe(F.lag(signature_column).over(by_pos()))) | (F.row_number().over(by_pos()) == 1)
    marked = log.withColumn("_run", F.sum(new.cast("int")).over(by_pos()))
    runs = marked.groupBy("session_id", "_run").agg(F.count(F.lit(1)).alias("length"), F.first(signature_column).alias("signature")).filter(F.col("length") >= least)
    return runs.groupBy("session_id").agg(F.min(F.struct("_run", "signature", "length")).alias("x")).select("session_id", "x.signature", F.col("x.length").alias("length"))


def repeating_tail(log: DataFrame, signature_column: str, longest: int = 5) -> DataFrame:
    """Per session, the shortest pattern of 2 to `longest` signatures that ends it twice in a row; null without one. Only the
    rows that two of the longest patterns take are gathered."""
    tail = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.col(signature_column).alias("s")))), lambda x: x.s)
    gathered = lookback(log, 2 * longest).groupBy("session_id").agg(tail.alias("t"))
    sizes = F.expr(f"filter(sequence(2, {longest}), n -> size(t) >= 2 * n AND slice(t, -n, n) = slice(t, -2 * n, n))")
    return gathered.select("session_id", F.try_element_at(sizes, F.lit(1)).alias("pattern_length"))


def call_signatures(log: DataFrame, recent: int = 30) -> DataFrame:
    """Of the last `recent` rows of each session, the calls in order with what tells them apart: name, digest of the arguments,
    and digest of the result that follows before the next message of a user or assistant, null without one.

    Rows: session_id, pos, kind (call, result or other), message (of a call, its position in the log), id, name, text."""
    last = log.withColumn("_back", F.dense_rank().over(Window.partitionBy("session_id").orderBy(F.desc("message")))).filter(F.col("_back") <= recent).drop("_back")
    key = Window.partitionBy("session_id", "id").orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    ahead = Window.partitionBy("session_id").orderBy("message").rangeBetween(1, Window.unboundedFollowing)
    turn = F.min(F.when(F.col("kind") != "result", F.col("message"))).over(ahead)
    reply = F.min(F.when(F.col("kind") == "result", F.struct("message", "text"))).over(key)
    marked = last.withColumns({"_turn": turn, "_reply": reply}).filter("kind = 'call'")
    inside = F.col("_turn").isNull() | (F.col("_reply.message") < F.col("_turn"))
    result = F.when(inside, signature(F.col("_reply.text")))
    return marked.select("session_id", "pos", "name", F.concat_ws("/", F.coalesce("name", F.lit("")), signature(F.coalesce("text", F.lit(""))), F.coalesce(result, F.lit("-"))).alias("sig"))


def loop_verdict(signatures: DataFrame, least: int = 3) -> DataFrame:
    """Per session with `least` calls or more, the name called that often in a row alike, or else the names of the pattern that
    ends it twice in a row; sessions without either are absent."""
    enough = signatures.withColumn("_n", F.count(F.lit(1)).over(whole())).filter(F.col("_n") >= least).drop("_n")
    same = first_run(enough, "sig", least).select("session_id", F.split_part("signature", F.lit("/"), F.lit(1)).alias("same"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("pos", "name"))), lambda x: x["name"])
    tails = repeating_tail(enough, "sig").filter("pattern_length IS NOT NULL")
    pattern = enough.groupBy("session_id").agg(names.alias("names")).join(tails, "session_id").select("session_id", F.array_join(F.expr("slice(names, -pattern_length, pattern_length)"), ">").alias("pattern"))
    both = same.join(pattern, "session_id", "full")
    return both.select("session_id", F.when(F.col("same").isNotNull(), "repeated").otherwise("cycle").alias("verdict"), F.coalesce("same", "pattern").alias("calls"))


def streak(rows: DataFrame, name: str, bad: str) -> DataFrame:
    """Per session, how many rows at its end are bad and of the same name, walking back."""
    back = Window.partitionBy("session_id").orderBy(F.desc("pos"))
    last = F.first(name).over(back)
    held = rows.withColumn("_ok", F.min((F.col(bad) & (F.col(name) == last)).cast("int")).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    return held.withColumn("_name", last).groupBy("session_id").agg(F.max("_name").alias("name"), F.sum("_ok").alias("streak"))


def pair_last(calls: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """Each call with the last result of its id, anywhere in the session."""
    last = results.groupBy("session_id", key).agg(F.max_by("result", "pos").alias("result"))
    return calls.join(last, ["session_id", key], "left")


def pair_next(log: DataFrame, is_call: Column, is_result: Column, is_turn: Column, key: str) -> DataFrame:
    """Each call with its first result before the next turn. Both sides of the join are the same shuffle."""
    ahead = by_pos().rowsBetween(1, Window.unboundedFollowing)
    marked = log.withColumn("next_turn", F.min(F.when(is_turn, F.col("pos"))).over(ahead))
    following = Window.partitionBy("session_id", key).orderBy("pos").rowsBetween(1, Window.unboundedFollowing)
    marked = marked.withColumn("result_pos", F.min(F.when(is_result, F.col("pos"))).over(following))
    found = F.when(F.col("next_turn").isNull() | (F.col("result_pos") < F.col("next_turn")), F.col("result_pos"))
    return marked.filter(is_call).withColumn("result_pos", found).drop("next_turn")


def blocks(log: DataFrame, is_head: Column) -> DataFrame:
    """Numbers the contiguous block after each head."""
    return log.withColumn("block", F.sum(F.when(is_head, 1).otherwise(0)).over(by_pos()))


def merge_roles(messages: DataFrame) -> DataFrame:
    """Consecutive rows of one role become one, texts in order."""
    new = F.coalesce((F.col("role") != F.lag("role").over(by_pos())).cast("int"), F.lit(1))
    marked = messages.withColumn("island", F.sum(new).over(by_pos()))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x.text)
    return marked.groupBy("session_id", "island").agg(F.first("role").alias("role"), F.count(F.lit(1)).alias("n"), F.array_join(texts, "\n").alias("text"))


def undo_last_turn(messages: DataFrame) -> DataFrame:
    """Drops from the last user row on, never position 0; without such a row only the first row stays."""
    cut = F.max(F.when((F.col("role") == "user") & (F.col("pos") > 0), F.col("pos"))).over(whole())
    return messages.withColumn("_cut", F.coalesce(cut, F.lit(1))).filter(F.col("pos") < F.col("_cut")).drop("_cut")


def truncate_before_user(messages: DataFrame, n: int) -> DataFrame:
    """Keeps what comes before the n-th user row (from 0, position 0 not counted); unchanged if there is none."""
    rank = F.sum(((F.col("role") == "user") & (F.col("pos") > 0)).cast("int")).over(by_pos())
    return messages.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def compaction(messages: DataFrame, keep: int = 5) -> DataFrame:
    """Labels rows head (system, first user), tail (from the last user row at or before size - keep, at least 1) or middle."""
    size = F.count(F.lit(1)).over(whole())
    first_user = F.min(F.when(F.col("role") == "user", F.col("pos"))).over(whole())
    edge = F.greatest(size - keep, F.lit(1))
    tail = F.coalesce(F.max(F.when((F.col("role") == "user") & (F.col("pos") <= F.col("_edge")) & (F.col("pos") >= 1), F.col("pos"))).over(whole()), F.lit(1))
    marked = messages.withColumns({"_edge": edge, "_first": first_user}).withColumn("_tail", tail)
    part = F.when((F.col("pos") == 0) & (F.col("role") == "system") | (F.col("pos") == F.col("_first")), "head").when(F.col("pos") >= F.col("_tail"), "tail").otherwise("middle")
    return marked.withColumn("part", part).drop("_edge", "_first", "_tail")


def snapshot_times(events: DataFrame, interval: float) -> DataFrame:
    """Times at which a snapshot fires: the first event arms the timer, and each firing arms it anew."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.array().cast("array<double>").alias("fired"))
    step = lambda s, t: F.when(s["last"].isNull(), F.struct(t.alias("last"), s.fired.alias("fired"))).when(
        t - s["last"] >= interval, F.struct(t.alias("last"), F.concat(s.fired, F.array(t)).alias("fired"))
    ).otherwise(s)
    return events.groupBy("session_id").agg(F.aggregate(F.array_sort(F.collect_list("at")), start, step, lambda s: s.fired).alias("fired"))
