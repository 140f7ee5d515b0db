"""Streaming inputs with one `value` column. Positions live in the query's checkpoint."""

from pyspark.sql import DataFrame, SparkSession


def kafka_lines(
    spark: SparkSession, brokers: str, topics: list[str], first_run: str = "earliest", **options: str
) -> DataFrame:
    """Values of several topics. `first_run` applies only where no checkpoint exists yet.

    Needs the Kafka connector on the classpath. Expired positions fall back to the oldest
    data still held instead of failing the query.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", first_run)
        .option("failOnDataLoss", "false")
    )
    return reader.options(**options).load().selectExpr("cast(value as string) as value", "topic", "timestamp")


def file_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
