"""Shared column expressions and table access of the text operators."""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamepulse.session import new_folder

#: ASCII white space 0x20 and 0x09-0x0D, as characters and as a pattern.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """The frame, in a session whose record batches hold at most 4 MB.

    A worker holds a batch, its result and what is computed between, so this bounds them for rows of any length;
    one row may be longer. The setting changes no result.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return df


_SCOPES: list[list[str]] = []  # folders to delete at the end of each open `scratch`


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """The frame as a table in the shared folder, and its path."""
    spark = df.sparkSession
    path = new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe when executors are lost.

    It is deleted at the end of the `scratch` it was made in, and stays where there is none: a lazy result
    may still read it.
    """
    frame, path = stored(df, purpose)
    delete_later(path)
    return frame


def delete_later(path: str) -> None:
    """Hands a folder to the open `scratch`, if any."""
    if _SCOPES:
        _SCOPES[-1].append(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that `written` makes inside; what is computed from them must be stored before the end."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            delete_folder(spark, path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the frame has a column of that name in any case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only, so other letters keep their code points."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def two_hashes(key: Column) -> Column:
    """128 bits of a string as two independent 64-bit hashes."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def id_crc(ids: pa.Array) -> np.ndarray:
    """crc32 of every id as decimal text; -1 where it is null."""
    return np.array([-1 if i is None else zlib.crc32(str(i).encode()) for i in ids.to_pylist()], np.int64)


def blocks(batches: Iterator[pa.RecordBatch], column: str, budget: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts record batches into runs of rows with about `budget` bytes in a text column.

    A row is never cut: one very long text makes a block of its own. Memory that Arrow has freed goes back to
    the system at the end, so that a worker does not keep the most a task ever needed.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + budget, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    pa.default_memory_pool().release_unused()


def numbered(df: DataFrame, order: list[Column], group: list[str] | None = None) -> DataFrame:
    """The rows with their `rank` from 0 in the order, within each value of the group columns, and `of`, their number.

    Ranges of (group, order) are sorted and stored with their place in the range; what lies before a
    range is added per range and group, so a group of any size is spread over many tasks. The group columns
    must not be null. Rows that are equal in group and order get neighbouring ranks.
    """
    group = group or []
    keys = [*map(F.col, group), *order]
    placed = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)
    ranges = placed.groupBy(*group, part.alias("part")).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy(*group or [F.lit(0)])
    before = F.sum("n").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ranges = ranges.select(*group, "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("n").over(whole).alias("of"))
    if not group:
        ranges = F.broadcast(ranges)  # one row per shuffle partition
    out = placed.withColumn("part", part).join(ranges, [*group, "part"])
    return out.withColumn("rank", F.col("before") + F.col("at") - F.col("first")).drop("part", "at", "first", "before")
