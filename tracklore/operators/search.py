"""Ranked text search over weighted fields, close matches, and sections and links of HTML pages."""

from __future__ import annotations

import difflib
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklore.operators.papers import section_number


#: Endings that a word loses, the longest first, and what they become. A light stemmer: words that differ by these are one.
ENDINGS = (("sses", "ss"), ("ies", "y"), ("ing", ""), ("ed", ""), ("ly", ""), ("es", ""), ("s", ""))


def stem(word: Column) -> Column:
    """A word without its ending, if four characters or more stay; words that end in ss keep it."""
    out = word
    for ending, to in reversed(ENDINGS):
        cut = F.concat(F.left(word, F.length(word) - len(ending)), F.lit(to))
        fits = F.endswith(word, F.lit(ending)) & (F.length(word) - len(ending) + len(to) >= 4)
        out = F.when(fits & ~((ending == "s") & F.endswith(word, F.lit("ss"))), cut).otherwise(out)
    return out


def _words(text: Column, stemmed: bool) -> Column:
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z]+)"))
    return F.transform(words, lambda w: stem(w)) if stemmed else words


def _counted(term: Column):
    return lambda x: x == term


def fielded(docs: DataFrame, key: str, fields: dict[str, float], query: str, k: int, stemmed: bool = True, k1: float = 1.2, b: float = 0.75, keep: Column | None = None) -> DataFrame:
    """The k best documents for any of the query's words, over weighted fields. One scan tokenises each field once and keeps its
    length and its counts of the query's words; the figures of the whole corpus are one row, joined to it by broadcast, which
    its size bounds. `keep` limits what is returned, not what the figures are made of."""
    spark = docs.sparkSession
    if stemmed:
        asked = spark.range(1).select(F.array_distinct(_words(F.lit(query), True)).alias("w")).first()["w"]
    else:
        asked = list(dict.fromkeys(query.lower().split()))
    if not asked:
        return docs.select(key, F.lit(0.0).alias("score")).limit(0)
    names = [(i, j) for i in range(len(fields)) for j in range(len(asked))]
    words = docs.select(key, (F.lit(True) if keep is None else keep).alias("_keep"), *(_words(F.col(f), stemmed).alias(f"w{i}") for i, f in enumerate(fields)))
    counts = words.select(key, "_keep", *(F.size(f"w{i}").cast("double").alias(f"len{i}") for i in range(len(fields))), *(F.size(F.filter(f"w{i}", _counted(F.lit(asked[j])))).cast("double").alias(f"tf{i}_{j}") for i, j in names))
    corpus = counts.agg(*(F.count_if(F.col(f"len{i}") > 0).alias(f"docs{i}") for i in range(len(fields))), *(F.avg(F.when(F.col(f"len{i}") > 0, F.col(f"len{i}"))).alias(f"mean{i}") for i in range(len(fields))), *(F.count_if(F.col(f"tf{i}_{j}") > 0).alias(f"df{i}_{j}") for i, j in names))
    score, hits = F.lit(0.0), F.lit(False)
    for (i, weight), j in ((x, j) for x in enumerate(fields.values()) for j in range(len(asked))):
        tf, df = F.col(f"tf{i}_{j}"), F.col(f"df{i}_{j}")
        rarity = F.log(1 + (F.col(f"docs{i}") - df + 0.5) / (df + 0.5))
        score += F.when(tf > 0, weight * rarity * tf * (k1 + 1) / (tf + k1 * ((1 - b) + b * F.col(f"len{i}") / F.col(f"mean{i}")))).otherwise(0.0)
        hits |= tf > 0
    found = counts.filter(hits & F.col("_keep")).crossJoin(F.broadcast(corpus))
    return found.select(key, F.round(score, 4).alias("score")).orderBy(F.desc("score"), key).limit(k)


def bm25(docs: DataFrame, key: str, text: str, terms: list[str], k: int) -> DataFrame:
    """The k best documents by whole words of one field."""
    return fielded(docs, key, {text: 1.0}, " ".join(terms), k, stemmed=False)


def docs_search(pages: DataFrame, key: str, query: str, k: int = 20) -> DataFrame:
    """Pages by title (twice the weight) and content; where nothing matches, the first pages in order, with a score of null."""
    found = fielded(pages, key, {"title": 2.0, "content": 1.0}, query, k)
    rest = pages.select(key, F.lit(None).cast("double").alias("score")).orderBy(key).limit(k)
    none = found.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return found.unionByName(rest.crossJoin(F.broadcast(none)).filter("_n = 0").drop("_n"))


#: Weights of an endpoint's fields. Fixed values.
ENDPOINT = {"summary": 3.0, "operationId": 2.0, "description": 1.0, "tags": 1.5, "param_names": 1.0}


def endpoint_search(endpoints: DataFrame, query: str | None, tag: str | None, k: int = 20) -> DataFrame:
    """Endpoints (path, method and the fields of ENDPOINT) for a query, a tag that is part of their tags, or both; a query
    without a hit falls back to all of the tag. The whole endpoint comes back by its path and method."""
    tagged = F.contains(F.coalesce("tags", F.lit("")), F.lit(tag)) if tag else F.lit(True)
    of_tag = endpoints.filter(tagged).withColumn("score", F.lit(None).cast("double"))
    if not query:
        return of_tag if tag else of_tag.limit(0)
    named = endpoints.withColumn("_key", F.struct("path", "method"))
    best = fielded(named, "_key", ENDPOINT, query, k, keep=tagged)
    found = endpoints.join(best.select("_key.path", "_key.method", "score"), ["path", "method"])
    if not tag:
        return found
    none = best.limit(1).agg(F.count(F.lit(1)).alias("_n"))
    return found.unionByName(of_tag.crossJoin(F.broadcast(none)).filter("_n = 0").drop("_n"))


def close_matches(rows: DataFrame, key: str, text: str, wanted: str, k: int, least: float = 0.4) -> DataFrame:
    """The k texts most like the wanted one by the ratio of matching blocks; an Arrow-batched function scores them."""

    @F.pandas_udf("double")
    def ratio(texts: pd.Series) -> pd.Series:
        matcher = difflib.SequenceMatcher(autojunk=False)
        matcher.set_seq2(wanted)

        def one(x):
            matcher.set_seq1(x or "")
            return matcher.ratio() if matcher.real_quick_ratio() >= least else 0.0

        return texts.map(one)

    scored = rows.select(key, text, ratio(text).alias("score")).filter(F.col("score") >= least)
    return scored.orderBy(F.desc("score"), key).limit(k)


class _Sections(HTMLParser):
    """Title, abstract, links of the navigation, and text of what follows each heading up to the next."""

    def __init__(self, nav_class: str = ""):
        super().__init__()
        self.nav_class = nav_class
        self.sections, self.links = [], []
        self.heading = self.skip = self.nav = 0
        self.in_link = False

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == "nav" and (self.nav or self.nav_class in (given.get("class") or "")):
            self.nav += 1
        if self.nav and tag == "a" and given.get("href") is not None:
            self.links.append([given["href"], ""])
            self.in_link = True
        self.skip += tag in ("script", "style", "nav", "footer")
        if tag in ("h1", "h2", "h3"):
            self.heading = int(tag[1])
            self.sections.append([self.heading, "", ""])

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "nav", "footer") and self.skip > 0
        self.nav -= tag == "nav" and self.nav > 0
        if tag == "a":
            self.in_link = False
        if tag in ("h1", "h2", "h3"):
            self.heading = 0

    def handle_data(self, data):
        if self.in_link:
            self.links[-1][1] += data
        if self.sections and not self.skip and data.strip():
            self.sections[-1][1 if self.heading else 2] += data.strip() + " "


def _parsed(page: str | None, nav_class: str) -> _Sections:
    parser = _Sections(nav_class)
    parser.feed(page or "")
    parser.close()
    return parser


def _by_page(pages: DataFrame, key: str, html: str, columns: list[str], schema: str, rows_of, nav_class: str = "") -> DataFrame:
    def run(batches):
        for pdf in batches:
            rows = [(k, i, *row) for k, page in zip(pdf[key], pdf[html]) for i, row in enumerate(rows_of(_parsed(page, nav_class)))]
            yield pd.DataFrame(rows, columns=[key, "index", *columns])

    return pages.select(key, html).mapInPandas(run, f"{key} {dict(pages.dtypes)[key]}, index int, {schema}")


def sections(pages: DataFrame, key: str, html: str) -> DataFrame:
    """One row for each heading: index, level, title, text, and the number the title begins with."""
    rows = _by_page(pages, key, html, ["level", "title", "text"], "level int, title string, text string", lambda p: [(level, title.strip(), body.strip()) for level, title, body in p.sections])
    return rows.withColumn("id", section_number(F.col("title")))


def papers(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Title (of the first heading of level one), abstract (text of the section so called, else of the first), and the number
    of further sections of each page."""
    each = sections(pages, key, html)
    low = F.lower("title")
    return each.groupBy(key).agg(
        F.coalesce(F.min_by(F.when(F.col("level") == 1, F.regexp_replace("title", F.lit("^Title:"), F.lit(""))), F.when(F.col("level") == 1, F.col("index"))), F.lit("")).alias("title"),
        F.coalesce(F.min_by(F.when(low == "abstract", F.col("text")), F.when(low == "abstract", F.col("index"))), F.min_by("text", "index")).alias("abstract"),
        F.count_if((F.col("level") > 1) & (low != "abstract")).alias("n_sections"),
    )


def nav_links(pages: DataFrame, key: str, html: str, base: str = "", nav_class: str = "") -> DataFrame:
    """One row for each link within a navigation element, of a class where one is named: index, title, address; relative
    addresses after the base."""
    rows = _by_page(pages, key, html, ["url", "title"], "url string, title string", lambda p: [(href, text.strip()) for href, text in p.links], nav_class)
    return rows.withColumn("url", F.when(F.startswith("url", F.lit("/")), F.concat(F.lit(base), "url")).otherwise(F.col("url")))


def crawled(links: DataFrame, pages: DataFrame, most: int = 200) -> DataFrame:
    """Pages that a navigation names, by their address, with the start of their content; a page that is not there says so."""
    content = F.trim("content")
    found = links.join(pages.select("url", content.alias("content")), "url", "left")
    start = F.when(F.length("content") > most, F.concat(F.left("content", F.lit(most)), F.lit("..."))).otherwise(F.coalesce("content", F.lit("[Could not fetch]")))
    return found.select("index", "title", "url", start.alias("glimpse"), F.coalesce("content", F.lit("")).alias("content"))
