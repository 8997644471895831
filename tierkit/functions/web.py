"""URL parts by plain text rules, so scheme-less URLs work too (``parse_url`` needs a scheme)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierkit.functions._columns import as_column


def _without(text: Column, *parts: str) -> Column:
    for part in parts:
        text = F.replace(text, F.lit(part), F.lit(""))
    return text


def _before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def url_host(url) -> Column:
    """Text after the scheme up to the first ``/`` or ``?``."""
    bare = _without(as_column(url), "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def url_path(url) -> Column:
    """Text after the first ``/`` up to ``?``; the whole text when there is neither."""
    bare = _without(as_column(url), "http://", "https://")
    slash, question = F.instr(bare, "/"), F.instr(bare, "?")
    start = F.when(slash > 0, slash + 1).when(question > 0, question).otherwise(1)
    return _before(F.substr(bare, start), "?")


def url_parameter(url, name: str) -> Column:
    """Text after the first ``name=`` up to ``&``; NULL when absent or empty."""
    value = F.split_part(as_column(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(value, "&"), F.lit(""))
