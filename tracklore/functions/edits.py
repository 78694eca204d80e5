"""Text edits whose positions depend on earlier ones: fuzzy find, replacement modes, fenced blocks, syntax checks."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracklore.functions.text import PLAIN, TYPOGRAPHIC

_PLAIN = str.maketrans({a: (PLAIN[i] if i < len(PLAIN) else None) for i, a in enumerate(TYPOGRAPHIC)})
#: Forms under which lines are compared, from strict to lax.
FORMS = (lambda x: x, str.rstrip, str.strip, lambda x: x.translate(_PLAIN).strip())


def find(text: str, wanted: str) -> tuple[int, int] | None:
    """First and last line (from 0, end excluded) at which the wanted lines stand, under the strictest form that has them."""
    lines, want = text.split("\n"), wanted.split("\n")
    for form in FORMS:
        have, need = [form(x) for x in lines], [form(x) for x in want]
        for i in range(len(have) - len(need) + 1):
            if have[i : i + len(need)] == need:
                return i, i + len(need)
    return None


def apply_edit(text: str, old: str, new: str, mode: str = "replace") -> str | None:
    """The edited text; null where the old text is missing, or not the only one in mode replace."""
    count = text.count(old) if old else 0
    if mode == "replace_all" and count:
        return text.replace(old, new)
    if mode == "replace" and count > 1:
        return None
    if count:
        at = text.index(old)
        put = {"replace": new, "append_after": old + new, "prepend_before": new + old}.get(mode)
        return None if put is None else text[:at] + put + text[at + len(old) :]
    spot = find(text, old)
    if spot is None:
        return None
    lines = text.split("\n")
    held = "\n".join(lines[spot[0] : spot[1]])
    put = {"replace": new, "replace_all": new, "append_after": held + new, "prepend_before": new + held}.get(mode)
    return None if put is None else "\n".join([*lines[: spot[0]], *put.split("\n"), *lines[spot[1] :]])


def blocks(text: str) -> list[str]:
    """Paragraphs; a fenced block stays whole."""
    out, held, fenced = [], [], False
    for line in text.split("\n"):
        if line.lstrip().startswith("```"):
            fenced = not fenced
        if not line.strip() and not fenced:
            if held:
                out.append("\n".join(held))
            held = []
        else:
            held.append(line)
    return [*out, "\n".join(held)] if held else out


def syntax_error(script: str) -> str | None:
    try:
        ast.parse(script)
    except (SyntaxError, ValueError) as e:
        return str(e)
    return None


@F.pandas_udf(T.StringType())
def edited(texts: pd.Series, old: pd.Series, new: pd.Series, mode: pd.Series) -> pd.Series:
    return pd.Series([apply_edit(*x) for x in zip(texts, old, new, mode)])


@F.pandas_udf(T.ArrayType(T.StringType()))
def markdown_blocks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: blocks(x or ""))


@F.pandas_udf(T.StringType())
def script_error(texts: pd.Series) -> pd.Series:
    return texts.map(lambda x: syntax_error(x or ""))
