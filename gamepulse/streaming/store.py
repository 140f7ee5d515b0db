"""Merge tables: keyed results kept as one parquet folder per commit.

`writer=<job>/batch_id=<id>/seq=<n>` holds what one job wrote in one batch. Writing the same
batch again replaces its folder under its old number, so a replay changes nothing. Reading
folds the finished folders.
"""

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamepulse.operators.merge import OVERWRITE, as_delta, delta_columns, fold

BASE_WRITER = "_base"
MARK = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


@dataclass(frozen=True)
class Commit:
    writer: str
    batch_id: str
    seq: int

    def folder(self, root: str) -> str:
        return f"{root}/writer={self.writer}/batch_id={self.batch_id}/seq={self.seq}"


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [f.getPath().toString() for f in found] if found else []


def list_commits(spark: SparkSession, root: str, finished: bool = True) -> list[Commit]:
    pattern = f"{root}/writer=*/batch_id=*/seq=*" + ("/_SUCCESS" if finished else "")
    out = []
    for p in _glob(spark, pattern):
        parts = dict(x.split("=", 1) for x in p.split("/") if x.startswith(("writer=", "batch_id=", "seq=")))
        out.append(Commit(parts["writer"], parts["batch_id"], int(parts["seq"])))
    return out


@dataclass(frozen=True)
class MergeTable:
    path: str
    keys: Mapping[str, str]
    values: Mapping[str, str] = field(default_factory=dict)

    def _schema(self) -> str:
        cols = {**self.keys, **delta_columns(self.values), "writer": "string", "batch_id": "string", "seq": "bigint"}
        return ", ".join(f"{n} {t}" for n, t in cols.items())

    def write(
        self, batch: DataFrame, writer: str, batch_id: str | int, policy: Mapping[str, str], unique: bool = False
    ) -> None:
        """Store one batch under its writer and id. `policy` names the columns it touches.

        `unique` says that the batch holds each key once, which spares a grouping.
        """
        self._put(as_delta(batch, self.keys, self.values, policy, unique), writer, str(batch_id))

    def _put(self, delta: DataFrame, writer: str, batch_id: str, seq: int | None = None) -> None:
        known = list_commits(delta.sparkSession, self.path, finished=False)
        done = list_commits(delta.sparkSession, self.path)
        # A commit that died takes a new number: a base above its old one would hide the retry.
        own = [c.seq for c in done if (c.writer, c.batch_id) == (writer, batch_id)]
        if seq is None:
            seq = min(own) if own else 1 + max((c.seq for c in known), default=0)
        target = Commit(writer, batch_id, seq).folder(self.path)
        delta.write.mode("overwrite").options(**MARK).parquet(target)

    def deltas(self, spark: SparkSession) -> DataFrame:
        """Finished deltas not yet covered by the newest compacted base."""
        done = list_commits(spark, self.path)
        base = max((c.seq for c in done if c.writer == BASE_WRITER), default=-1)
        live = [c for c in done if c.seq > base or (c.writer == BASE_WRITER and c.seq == base)]
        if not live:
            return spark.createDataFrame([], self._schema())
        folders = [c.folder(self.path) for c in live]
        return spark.read.schema(self._schema()).option("basePath", self.path).parquet(*folders)

    def rows(self, spark: SparkSession, without: tuple[str, str | int] | None = None) -> DataFrame:
        """Keys as stored, with repeats across commits; `without` leaves out one (writer, batch id)."""
        rows = self.deltas(spark)
        if without:
            rows = rows.filter(~((F.col("writer") == without[0]) & (F.col("batch_id") == str(without[1]))))
        return rows.select(*self.keys)

    def read(self, spark: SparkSession, *names: str, where: Callable[[DataFrame], DataFrame] = lambda d: d) -> DataFrame:
        """The current table; with `names`, only those values are folded and scanned.

        `where` picks rows by their keys before they are folded.
        """
        values = {n: self.values[n] for n in names} if names else self.values
        return fold(where(self.deltas(spark)), self.keys, values)

    def compact(self, spark: SparkSession) -> None:
        """Fold all finished commits into one base folder. Run while no job is writing."""
        done = list_commits(spark, self.path)
        if not done:
            return
        newest = max(c.seq for c in done)
        base = as_delta(self.read(spark), self.keys, self.values, {c: OVERWRITE for c in self.values}, unique=True)
        self._put(base, BASE_WRITER, str(newest), newest)


    def drop_covered(self, spark: SparkSession) -> int:
        """Delete the folders a base covers; the count of them. Run while no job is writing.

        Each writer's newest one stays, because that is the batch it may still repeat.
        """
        done = list_commits(spark, self.path)
        base = max((c.seq for c in done if c.writer == BASE_WRITER), default=-1)
        newest: dict[str, int] = {}
        for c in done:
            newest[c.writer] = max(c.seq, newest.get(c.writer, -1))
        old = [c for c in done if c.seq <= base and c.seq < newest[c.writer]]
        for c in old:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(c.folder(self.path))
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        return len(old)


@dataclass(frozen=True)
class AppendTable:
    """Rows without a key, one folder per batch; a repeated batch replaces its own folder."""

    path: str
    schema: str

    def write(self, batch: DataFrame, writer: str, batch_id: str | int) -> None:
        names = [c.split()[0] for c in self.schema.split(",")]
        target = f"{self.path}/writer={writer}/batch_id={batch_id}"
        batch.select(*names).write.mode("overwrite").options(**MARK).parquet(target)

    def batch(self, spark: SparkSession, writer: str, batch_id: str | int) -> DataFrame:
        """The rows of one finished batch."""
        return spark.read.schema(self.schema).parquet(f"{self.path}/writer={writer}/batch_id={batch_id}")

    def read(self, spark: SparkSession, without: tuple[str, str | int] | None = None) -> DataFrame:
        """All finished rows; `without` leaves out one (writer, batch id)."""
        skip = f"/writer={without[0]}/batch_id={without[1]}" if without else None
        folders = [p.rsplit("/", 1)[0] for p in _glob(spark, f"{self.path}/writer=*/batch_id=*/_SUCCESS")]
        folders = [f for f in folders if skip is None or not f.endswith(skip)]
        if not folders:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*folders)
