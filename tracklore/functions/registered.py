"""The library's functions under names that SQL can call: scalar ones in Arrow batches, an aggregate, and table functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tracklore.functions import edits, redact
from tracklore.operators.repos import alike, alike_by_words, alike_in_part


def _by_pairs(f):
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([f(x or "", y or "") for x, y in zip(a, b)], dtype=float)

    return run


def _table_functions() -> dict:
    class Links:
        """Links of a page's navigation, in order."""

        def eval(self, html: str) -> Iterator[tuple[int, str, str]]:
            from tracklore.operators.search import _parsed

            yield from ((i, href, text.strip()) for i, (href, text) in enumerate(_parsed(html, "").links))

    class Sections:
        """Headings of a page with what follows each."""

        def eval(self, html: str) -> Iterator[tuple[int, int, str, str]]:
            from tracklore.operators.search import _parsed

            yield from ((i, level, title.strip(), text.strip()) for i, (level, title, text) in enumerate(_parsed(html, "").sections))

    class Blocks:
        """Blocks of a Markdown text; a fenced one is whole."""

        def eval(self, text: str) -> Iterator[tuple[int, str]]:
            yield from enumerate(edits.blocks(text or ""))

    return {"nav_links": (Links, "index int, url string, title string"), "page_sections": (Sections, "index int, level int, title string, text string"), "markdown_blocks": (Blocks, "index int, block string")}


def register(spark: SparkSession, prefix: str = "tl_") -> list[str]:
    """Registers every function with the session and returns their names."""
    scalars = {
        "scrub_json": redact.scrub_json,
        "syntax_error": edits.script_error,
        "alike": F.pandas_udf(_by_pairs(alike), "double"),
        "alike_in_part": F.pandas_udf(_by_pairs(alike_in_part), "double"),
        "alike_by_words": F.pandas_udf(_by_pairs(alike_by_words), "double"),
    }
    for name, f in scalars.items():
        spark.udf.register(prefix + name, f)

    @F.pandas_udf("double")
    def mean_of_positive(values: pd.Series) -> float:
        return float(values[values >= 0].mean()) if (values >= 0).any() else 0.0

    spark.udf.register(f"{prefix}mean_of_positive", mean_of_positive)
    for name, (f, schema) in _table_functions().items():
        spark.udtf.register(prefix + name, F.udtf(f, returnType=schema))
    return [prefix + n for n in (*scalars, "mean_of_positive", *_table_functions())]
