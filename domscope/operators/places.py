"""Places of rows in an order over a whole table, without one task that sees all rows.

Rows are dealt to tasks by ranges of the order and sorted there; a row's place is its place in the task
plus the rows of the tasks before it. What the tasks number is written first, so a task that runs again
can't number its rows differently.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import kept_with, partitions, written

#: monotonically_increasing_id() counts a task's rows in so many bits, below the task's number.
_BITS = 33


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """df with its rows' places in the order, from 1 on, nulls first; of rows equal in it any comes first.

    An empty table gives an empty result; a column called ``name`` is replaced. The result can be
    discarded (``shared.discard``) once it has been read.
    """
    return given(df.drop(name).repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order), name)


def given(df: DataFrame, name: str) -> DataFrame:
    """df, which is in order already, as one that ends in an orderBy, with its rows' places. They are written as
    they come, so they are sorted once."""
    kept = df.drop(name)
    held = written(kept.withColumn("_place", F.monotonically_increasing_id()))
    task = F.shiftright("_place", _BITS).alias("_task")
    # One row for each task, so in general no more than there are shuffle partitions.
    sizes = sorted(tuple(r) for r in held.groupBy(task).agg(F.count("*")).collect())
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(task, n) for (task, _), n in zip(sizes, before, strict=False)], "_task long, _before long",
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << _BITS) - 1))
    out = held.withColumn("_task", F.shiftright("_place", _BITS)).join(F.broadcast(offsets), "_task")
    return kept_with(out.select(*kept.columns, (F.col("_before") + within + 1).alias(name)), held)
