"""Global order without a global task: running totals and dense numbers in two phases.

Rows are range-partitioned by a complete order, so a busy hour or key spreads over many
partitions. Each partition is summed up in the task that sorts it, batch by batch, and then
shifted by the total of the partitions before it; that offsets table has one row per partition.
The range shuffle is the only exchange of rows.
"""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamepulse.session import enable_checkpoints

PART, BEFORE, COPIES, WEIGHT, UP_TO = "_part", "_before", "_copies", "_weight", "_up_to"
COPY_BLOCK = 4096


def expand_copies(df: DataFrame, copies: str = COPIES, number: str | None = None) -> DataFrame:
    """Repeat each row `copies` times; with `number`, number the copies from 1.

    Large counts are first cut into blocks that are spread over the tasks.
    """
    blocks = F.explode(F.sequence(F.lit(0), F.floor((F.col(copies) - 1) / COPY_BLOCK).cast("int")))
    cut = df.select("*", blocks.alias("_block"))
    start = F.col("_block").cast("bigint") * COPY_BLOCK
    in_block = F.sequence(F.lit(1), F.least(F.lit(COPY_BLOCK), F.col(copies) - start).cast("int"))
    out = cut.select("*", F.explode(in_block).alias("_nth"))
    if number:
        out = out.withColumn(number, start + F.col("_nth"))
    return out.drop("_block", "_nth", copies)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the sum of the weights up to each row of a sorted partition; only that sum is kept between batches."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        if not batch.num_rows:
            continue
        up_to = pc.add_checked(pc.cumulative_sum_checked(batch.column(WEIGHT)), pa.scalar(total, pa.int64()))
        total = up_to[-1].as_py()
        parts = pa.array([part], pa.int32()).take(pa.array([0] * batch.num_rows))
        yield pa.RecordBatch.from_arrays([*batch.columns, up_to, parts], names=[*batch.schema.names, UP_TO, PART])


def _summed(df: DataFrame, order: list[Column]) -> DataFrame:
    """`df` with the sum of its column `_weight` over all rows up to each one, as `_up_to`.

    The checkpoint freezes which partition holds which row.
    """
    enable_checkpoints(df.sparkSession)
    types = [f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*types, f"{UP_TO} bigint", f"{PART} int"])
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_sum_up, schema).checkpoint()
    sums = ranged.groupBy(PART).agg(F.sum(WEIGHT).alias("_sum"))
    earlier = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sums.select(PART, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias(BEFORE))
    # Bounded by the partition count, not by the data.
    placed = ranged.join(F.broadcast(offsets), PART)
    return placed.withColumn(UP_TO, F.col(UP_TO) + F.col(BEFORE)).drop(PART, BEFORE)


def running_total(df: DataFrame, order: list[str], value: str, out: str, start: int | Column = 0) -> DataFrame:
    """`out` = `start` plus the sum of the integer `value` over all rows up to this one.

    Ties in `order` are settled by the remaining columns. Rows equal in every column are
    collapsed to one with a count before the shuffle and repeated at the end.
    """
    names = df.columns
    rest = [c for c in names if c not in order]
    each_value = F.coalesce(F.col(value), F.lit(0)).cast("bigint")
    unique = df.groupBy(*names).agg(F.count(F.lit(1)).alias(COPIES)).withColumn(WEIGHT, each_value * F.col(COPIES))
    summed = _summed(unique, [F.col(c) for c in [*order, *rest]])
    base = F.col(UP_TO) - F.col(WEIGHT) + (start if isinstance(start, Column) else F.lit(start))
    each = expand_copies(summed.select(*names, COPIES, base.alias("_base")), number="_n")
    return each.select(*names, (F.col("_base") + F.col("_n") * each_value).alias(out))


def dense_numbers(df: DataFrame, key: str, out: str) -> DataFrame:
    """(key, out): distinct keys numbered 0, 1, 2, ... in key order."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct().withColumn(WEIGHT, F.lit(1).cast("bigint"))
    return _summed(keys, [F.col(key)]).select(key, (F.col(UP_TO) - 1).alias(out))
