"""Compare each row with the one before it in an order, without one task per group.

A window over a group puts the whole group into one task, and a window without groups
puts the whole table there. Here the rows are range-partitioned by (group, order), so a
big group spreads over many tasks; each task looks back one row in its own sorted run,
and only the two outer rows of each run are matched up across runs afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _look_back(columns: list[str]):
    """Arrow batches of one sorted run, with the previous row's values and run-end flags added."""

    def shift(batches):
        import numpy as np
        import pyarrow as pa

        def finish(batch, before, is_first, is_last):
            n = batch.num_rows
            previous = [
                pa.concat_arrays([
                    before[c] if before else pa.nulls(1, batch.column(c).type),
                    batch.column(c).slice(0, n - 1),
                ])
                for c in columns
            ]
            first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
            first[0], last[-1] = is_first, is_last
            arrays = [*batch.columns, *previous, pa.array(first), pa.array(last)]
            names = [*batch.schema.names, *[f"_prev_{c}" for c in columns], "_run_first", "_run_last"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        held = before = None
        is_first = True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if held is not None:
                yield finish(held, before, is_first, False)
                before = {c: held.column(c).slice(held.num_rows - 1, 1) for c in columns}
                is_first = False
            held = batch
        if held is not None:
            yield finish(held, before, is_first, True)

    return shift


def compare_with_previous(
    df: DataFrame,
    group_by: Sequence[str],
    order_by: Sequence[Column],
    carry: Sequence[str],
    keep: Column,
) -> DataFrame:
    """Rows for which ``keep`` holds, given ``_prev_<c>`` for each carried column.

    ``_has_prev`` tells a first row of a group from one that follows NULLs. ``keep`` should
    be selective: kept rows are shuffled once more, spread by the run they come from.
    """
    group_by, carry = list(group_by), list(carry)
    looked_back = list(dict.fromkeys([*group_by, *carry]))
    order = [*[F.asc_nulls_first(g) for g in group_by], *order_by]
    runs = df.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = T.StructType([
        *df.schema.fields,
        *[T.StructField(f"_prev_{c}", df.schema[c].dataType) for c in looked_back],
        T.StructField("_run_first", T.BooleanType()),
        T.StructField("_run_last", T.BooleanType()),
    ])
    shifted = runs.mapInArrow(_look_back(looked_back), schema)

    first, at_end = F.col("_run_first"), F.col("_run_first") | F.col("_run_last")
    follows = ~first
    for g in group_by:
        follows = follows & F.col(f"_prev_{g}").eqNullSafe(F.col(g))
    local = shifted.select(
        *df.columns,
        *[F.when(follows, F.col(f"_prev_{c}")).alias(f"_prev_{c}") for c in carry],
        follows.alias("_has_prev"),
        "_run_first",
        "_run_last",
        F.spark_partition_id().alias("_run"),
    )

    # Ends of runs share a lane per group (at most two rows per run); all else stays apart.
    lane = F.when(at_end, F.lit(-1)).otherwise(F.col("_run"))
    ends = Window.partitionBy(*group_by, lane).orderBy("_run", "_run_last")
    joined = local.filter(at_end | keep).select(
        *df.columns,
        *[
            F.when(first, F.lag(c).over(ends)).otherwise(F.col(f"_prev_{c}")).alias(f"_prev_{c}")
            for c in carry
        ],
        F.when(first, F.lag(F.lit(True)).over(ends).isNotNull()).otherwise(F.col("_has_prev")).alias("_has_prev"),
    )
    return joined.filter(keep)
