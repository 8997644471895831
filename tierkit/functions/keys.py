"""Hashed surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierkit.functions._columns import as_column

# Every key already stored in a warehouse was hashed with these.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*fields: Column | str, nulls_as_empty: bool = False) -> Column:
    """md5 hex of the fields' text joined by ``-``; NULL hashes as a marker (or as '').

    Cast a floating key to BIGINT first: the text of a double differs between engines.
    """
    if not fields:
        raise ValueError("surrogate_key needs at least one field")
    stand_in = F.lit("" if nulls_as_empty else NULL_MARK)
    texts = [F.coalesce(as_column(f).cast("string"), stand_in) for f in fields]
    return F.md5(texts[0] if len(texts) == 1 else F.concat_ws(SEPARATOR, *texts))
