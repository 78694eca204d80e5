"""Repositories: similar names, example files, discussions, references, and jobs with their nested descriptions."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folders that hold examples, the most wanted first. Fixed values.
EXAMPLES = (
    "scripts", "examples", "example", "notebooks", "notebook", "tutorials", "tutorial", "quickstart", "walkthroughs", "walkthrough",
    "cookbook", "cookbooks", "recipes", "recipe", "demos", "demo", "samples", "sample", "guides", "guide", "getting-started", "getting_started",
    "playground", "howto", "how-to", "use-cases", "usecases", "use_cases", "sandbox", "showcase",
)


def common(a: str, b: str) -> int:
    """Length of the longest common subsequence, with a bit for each character of a."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for c in b:
        hit = free & where.get(c, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def alike(a: str, b: str) -> float:
    """0 to 100: twice what two texts have in common by their lengths."""
    return 200.0 * common(a, b) / (len(a) + len(b)) if a or b else 100.0


def alike_in_part(a: str, b: str) -> float:
    """The best of the shorter text against windows of its length in the longer, shorter ones at the ends included."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 100.0 if not long else 0.0
    n = len(short)
    return max(alike(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))


def alike_by_words(a: str, b: str) -> float:
    """Sets of words: what is common against each with its rest, and the two against each other."""
    one, two = (set(re.sub(r"[\W_]", " ", x.lower()).split()) for x in (a, b))
    if not one or not two:
        return 0.0
    both = " ".join(sorted(one & two))
    left, right = (" ".join(filter(None, (both, " ".join(sorted(x))))) for x in (one - two, two - one))
    if both and (left == both or right == both):
        return 100.0
    scores = [alike(left, right)]
    return max([*scores, alike(both, left), alike(both, right)] if both else scores)


def example_score(path: str) -> Column:
    """How much a path looks like one of examples: the best of its words against EXAMPLES."""

    @F.pandas_udf("int")
    def score(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: max(round(alike_by_words(x, p.lower())) for x in EXAMPLES) if p else 0)

    return score(path)


def keyword_score(path: str, keyword: str) -> Column:
    """How much a path looks like a keyword, as a part or by words."""
    low = keyword.lower()

    @F.pandas_udf("int")
    def score(paths: pd.Series) -> pd.Series:
        return paths.map(lambda p: round(max(alike_in_part(low, p.lower()), alike_by_words(low, p.lower()))) if p else 0)

    return score(path)


def path_priority(path: Column) -> Column:
    """struct(outside, pattern, depth), smaller is better: 0 if the path begins in an example folder, the place in EXAMPLES
    of the deepest part that is one (999 for none), and the number of parts."""
    parts = F.split(F.lower(path), "/")
    places = F.create_map(*(F.lit(x) for i, name in enumerate(EXAMPLES) for x in (name, i)))
    hits = F.filter(F.transform(parts, lambda p: F.try_element_at(places, p)), lambda x: x.isNotNull())
    outside = F.when(F.get(parts, F.lit(0)).isin("examples", "example"), 0).otherwise(1)
    return F.struct(outside.alias("outside"), F.coalesce(F.try_element_at(hits, F.lit(-1)), F.lit(999)).alias("pattern"), F.size(parts).alias("depth"))


def example_files(files: DataFrame, key: str, path: str, k: int, keyword: str | None = None, least: int = 60, least_keyword: int = 60) -> DataFrame:
    """The k example files of most use: by likeness to a keyword, ties in the tree's order, or else by path_priority."""
    likely = files.withColumn("_example", example_score(path)).filter(F.col("_example") >= least)
    if keyword:
        scored = likely.withColumn("score", keyword_score(path, keyword)).filter(F.col("score") >= least_keyword)
        return scored.orderBy(F.desc("score"), key).limit(k).select(key, path, "score")
    ranked = likely.withColumn("_p", path_priority(F.col(path)))
    return ranked.orderBy("_p.outside", "_p.pattern", "_p.depth", path).limit(k).select(key, path, F.col("_example").alias("score"))


def similar_names(repos: DataFrame, key: str, wanted: str, name: str, stars: str, k: int = 10) -> DataFrame:
    """Repositories whose name holds one of the wanted words, most stars first, ties by name and then to the smaller key."""
    words = [w for w in re.split(r"[\W_]+", wanted.lower()) if w]
    hit = F.lit(False)
    for w in words:
        hit |= F.contains(F.lower(F.col(name)), F.lit(w))
    return repos.filter(hit).orderBy(F.desc(stars), name, key).limit(k)


def discussions(rows: DataFrame, wanted: Column, k: int = 20) -> DataFrame:
    """The first discussions of a status, each with its label and whether it is a pull request."""
    label = F.when(F.col("status").isin("draft", "open", "merged"), F.upper("status")).otherwise("CLOSED")
    kept = rows.filter((F.coalesce(wanted, F.lit("all")) == "all") | (F.col("status") == wanted))
    return kept.select("num", F.concat(F.lit("["), label, F.lit("]")).alias("label"), F.when(F.col("is_pull_request"), "PR").otherwise("D").alias("kind"), "title").orderBy("num").limit(k)


def references(refs: DataFrame, repo: str) -> DataFrame:
    """Names and numbers of branches and tags; `none` for neither."""
    names = lambda kind: F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.col("name"))))
    grouped = refs.groupBy(repo).agg(names("branch").alias("b"), names("tag").alias("t"))
    shown = lambda c: F.when(F.size(c) > 0, F.array_join(c, ", ")).otherwise("none")
    return grouped.select(repo, shown("b").alias("branches"), F.size("b").alias("n_branches"), shown("t").alias("tags"), F.size("t").alias("n_tags"))


def flat_jobs(jobs: DataFrame) -> DataFrame:
    """Jobs with nested status and owner as flat rows."""
    return jobs.select("id", F.col("status.stage").alias("stage"), F.col("status.message").alias("message"), "command", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"), "docker_image", "space_id", F.col("flavor").alias("hardware_flavor"), F.col("owner.name").alias("owner"))


def flat_scheduled(jobs: DataFrame) -> DataFrame:
    """Scheduled jobs: last and next run where there are any, no command as an empty one, and the plain hardware by default."""
    spec = lambda x: F.col(f"job_spec.{x}")
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return jobs.select(
        "id", "schedule", "suspend", iso("status.last_job.created_at").alias("last_run"), iso("status.next_job_run_at").alias("next_run"),
        spec("docker_image").alias("docker_image"), spec("space_id").alias("space_id"), F.coalesce(spec("command"), F.array().cast("array<string>")).alias("command"), F.coalesce(F.nullif(spec("flavor"), F.lit("")), F.lit("cpu-basic")).alias("hardware_flavor"),
    )
