"""Results by day: Spark's own partitioned parquet, where a rerun replaces the days it covers and no others.

A read of some days lists and scans their folders only. Use it for results that one job computes
whole; columns that several jobs or increments share belong into a merge table.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"


@dataclass(frozen=True)
class DayTable:
    path: str

    def _files(self, spark: SparkSession, start: str, end: str) -> dict[str, set[str]]:
        """Data files of each stored day of a range; as many entries as these days have files."""
        found: dict[str, set[str]] = {}
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{DAY}=*/*.parquet")
        for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []:
            folder, name = f.getPath().toString().rsplit("/", 1)
            if start <= folder.rsplit(f"{DAY}=", 1)[1] <= end:
                found.setdefault(folder, set()).add(name)
        return found

    def write(self, rows: DataFrame, time: str, start: str, end: str) -> None:
        """Replace the days `start` to `end` by the rows; `time` is a text that begins with the day.

        Days of the range that have no rows any more are removed. Rows of other days, or without a
        time, are an error, as they would replace what another run stored; nothing is written then. A run that died
        is repeated as it was. Runs over the same days must not overlap in time.
        """
        if not start <= end:
            raise ValueError(f"no days from {start} to {end}")
        spark = rows.sparkSession
        before = self._files(spark, start, end)
        day = F.substring(time, 1, 10)
        told = F.concat(F.lit(f"not a day from {start} to {end}: "), F.coalesce(F.col(time), F.lit("null")))
        inside = F.coalesce(day.between(start, end), F.lit(False))
        dated = rows.withColumn(DAY, F.when(inside, day).otherwise(F.raise_error(told).cast("string")))
        # Rebalancing cuts a large day into several files and puts a small one into one.
        out = dated.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(DAY).parquet(self.path)
        after = self._files(spark, start, end)
        for folder, names in before.items():
            if names & after.get(folder, set()):  # not rewritten
                path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def read(self, spark: SparkSession, schema: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """The stored rows of the days `start` to `end`; the bounds are partition filters of the scan."""
        rows = spark.read.schema(f"{schema}, {DAY} string").parquet(self.path)
        rows = rows if start is None else rows.filter(F.col(DAY) >= start)
        return rows if end is None else rows.filter(F.col(DAY) <= end)
