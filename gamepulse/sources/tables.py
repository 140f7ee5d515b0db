"""Warehouse tables by name, read on first use."""

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession


class Tables(Mapping[str, DataFrame]):
    """Read-only name to DataFrame mapping over one way of opening a table."""

    def __init__(self, names: list[str], opener: Callable[[str], DataFrame]):
        self._names, self._open, self._opened = list(names), opener, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._opened:
            self._opened[name] = self._open(name)
        return self._opened[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def parquet_tables(spark: SparkSession, root: str, names: list[str], suffix: str = ".parquet") -> Tables:
    return Tables(names, lambda n: spark.read.parquet(f"{root}/{n}{suffix}"))


def catalog_tables(spark: SparkSession, database: str, names: list[str]) -> Tables:
    return Tables(names, lambda n: spark.table(f"{database}.{n}"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One `value` per line; Spark packs small files into splits by maxPartitionBytes."""
    return spark.read.text(path)
