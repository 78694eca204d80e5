"""How values are shown: dates, commands, titles, tables, and job commands. Column expressions but for what one driver prints."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklore.operators.rules import first_given

#: Characters that a title loses. Fixed value.
TITLE_MARKS = "`*_~#[]()"


def date(text: Column) -> Column:
    """Date and time of day in the zone that is given; N/A for none, and what is no date as it is."""
    given = F.nullif(text, F.lit(""))
    whole = F.regexp_replace(given, F.lit(r"(\.\d+)?(Z|[+-]\d{2}:?\d{2})$"), F.lit(""))
    return F.coalesce(F.date_format(F.try_to_timestamp(whole), "yyyy-MM-dd HH:mm:ss"), given, F.lit("N/A"))


def command(parts: Column) -> Column:
    return F.when(F.coalesce(F.size(parts), F.lit(0)) > 0, F.array_join(parts, " ")).otherwise("N/A")


def image_or_space(space: Column, image: Column) -> Column:
    return F.coalesce(first_given(space, image), F.lit("N/A"))


def ellipsis(text: Column, most: int, mark: str = "...") -> Column:
    """At most so many characters, and then the mark."""
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(most)), F.lit(mark))).otherwise(text)


def title(text: Column, most: int = 50) -> Column:
    """A title without quotes around and markup, cut at so many characters."""
    bare = F.trim(F.trim(text), F.lit('"'))
    bare = F.trim(F.translate(F.trim(bare, F.lit("'")), TITLE_MARKS, ""))
    return F.when(F.length(bare) > most, F.concat(F.rtrim(F.left(bare, F.lit(most))), F.lit("…"))).otherwise(bare)


def fallback_title(text: Column, most: int = 40) -> Column:
    bare = F.trim(text)
    return F.when(F.length(bare) > most, F.concat(F.rtrim(F.left(bare, F.lit(most))), F.lit("…"))).otherwise(bare)


def counted(n: Column) -> Column:
    return F.format_number(n, 0)


def shortened(text: Column, most: int, head_share: float = 0.25) -> Column:
    """The first quarter and last three quarters of the room, and between them how much of the whole is left out."""
    head = int(most * head_share)
    note = F.concat(F.lit("\n\n... ("), counted(F.length(text) - most), F.lit(" of "), counted(F.length(text)), F.lit(f" chars omitted, showing first {head:,} + last {most - head:,}) ...\n"))
    return F.when(F.length(text) > most, F.concat(F.left(text, F.lit(head)), note, F.right(text, F.lit(most - head)))).otherwise(text)


def numbered(line: Column, n: Column, cap: int = 4000) -> Column:
    """A line as a numbered read shows it."""
    return F.concat(F.lpad(n.cast("string"), F.greatest(F.lit(6), F.length(n.cast("string"))), F.lit(" ")), F.lit("\t"), ellipsis(line, cap))


def unnumbered(text: Column) -> Column:
    """What a numbered read was made of: each line without what stands before its first tab."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.when(F.contains(x, F.lit("\t")), F.regexp_replace(x, F.lit(r"^[^\t]*\t"), F.lit(""))).otherwise(x))
    return F.array_join(lines, "\n")


def sorted_json(entries: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def uv_command(script: Column, packages: Column, python: Column, arguments: Column) -> Column:
    """The words of a run of a script: its packages, its version of Python, and its arguments."""
    none = F.array().cast("array<string>")
    extra = F.flatten(F.transform(F.coalesce(packages, none), lambda p: F.array(F.lit("--with"), p)))
    version = F.when(F.coalesce(python, F.lit("")) != "", F.array(F.lit("-p"), python)).otherwise(none)
    return F.concat(F.array(F.lit("uv"), F.lit("run")), extra, version, F.array(script), F.coalesce(arguments, none))


def with_transfer(packages: Column) -> Column:
    wanted = F.lit("hf-transfer")
    held = F.coalesce(packages, F.array().cast("array<string>"))
    return F.when(F.array_contains(held, wanted), held).otherwise(F.array_append(held, wanted))


def job_command(script: Column, packages: Column, python: Column, arguments: Column) -> Column:
    """A script of several lines travels encoded through a shell; an address or a path is run as it is."""
    address = F.startswith(script, F.lit("http://")) | F.startswith(script, F.lit("https://"))
    piped = F.concat(F.lit('echo "'), F.base64(F.encode(script, "UTF-8")), F.lit('" | base64 -d | '), F.array_join(uv_command(F.lit("-"), packages, python, arguments), " "))
    shell = F.array(F.lit("/bin/sh"), F.lit("-lc"), F.regexp_replace(piped, F.lit(r"\r\n"), F.lit("")))
    return F.when(~address & F.contains(script, F.lit("\n")), shell).otherwise(uv_command(script, packages, python, arguments))


def markdown_table(headers: list[str], rows: list[list], most: int = 40) -> str:
    """A table as wide as its cells need, each cut at `most`; for the few rows that one driver shows."""
    cells = [[str("" if x is None else x) for x in row] for row in [headers, *rows]]
    cells = [[x if len(x) <= most else x[: most - 3] + "..." for x in row] for row in cells]
    wide = [max(3, *(len(row[i]) for row in cells)) for i in range(len(headers))]
    lines = ["| " + " | ".join(x.ljust(w) for x, w in zip(row, wide)) + " |" for row in cells]
    return "\n".join([lines[0], "|" + "|".join("-" * (w + 2) for w in wide) + "|", *lines[1:]])


def curl(method: Column, address: Column, has_body: Column) -> Column:
    """The call of an endpoint on a command line."""
    body = F.when(has_body, F.lit(" \\\n  -H \"Content-Type: application/json\" \\\n  -d '{}'")).otherwise("")
    return F.concat(F.lit("curl -X "), F.upper(method), F.lit(" \\\n  '"), address, F.lit("' \\\n  -H \"Authorization: Bearer $TOKEN\""), body)
