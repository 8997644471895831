"""Text clean-up."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierkit.functions._columns import as_column


def blank_to_null(field) -> Column:
    """Empty string becomes NULL; other text is left as it is."""
    return F.nullif(as_column(field), F.lit(""))


def squeeze_spaces(field) -> Column:
    """Runs of white space become one space, none at the ends."""
    return F.trim(F.regexp_replace(as_column(field), r"\s+", " "))


def slugify(name: str) -> str:
    """A name usable as a column: lower case, ``_`` for spaces and dashes, no leading digit."""
    slug = re.sub(r"[^a-z0-9_]", "", re.sub(r"[ -]+", "_", name.lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug
