"""Starting a micro-batch job on a stream of lines."""

from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BatchFn = Callable[[DataFrame, int], None]


def start(lines: DataFrame, process: BatchFn, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Run `process` on each micro-batch: every interval, or once over what has arrived.

    The position is kept in `checkpoint` and moves on after `process` returns; a batch that
    failed half-way comes again under the same id.
    """
    writer = lines.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def run_available(lines: DataFrame, process: BatchFn, checkpoint: str) -> None:
    start(lines, process, checkpoint).awaitTermination()


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep rows that several outputs of one batch read; lost blocks are recomputed."""
    kept = rows.persist()
    try:
        yield kept
    finally:
        kept.unpersist()


def together(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """Run writes that do not read each other's results at the same time, so that small ones share the cluster.

    Returns when all have ended; the first error is raised then, and the batch comes again as a whole.
    """
    with ThreadPoolExecutor(len(writes)) as pool:
        ended = [pool.submit(inheritable_thread_target(spark)(w)) for w in writes]
    for e in ended:
        e.result()
