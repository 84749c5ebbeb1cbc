"""Streaming sources. The event bus is pluggable: Kafka in production, a
folder of JSON text files in tests (the Kafka connector is optional)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None,
                 options: dict | None = None) -> DataFrame:
    """Subscribe to a topic. ``value`` holds the JSON payload. Needs the
    Kafka connector on the classpath; credentials go in ``options``.
    ``max_offsets_per_trigger`` bounds a micro-batch, so a backlog is
    drained in batches of a known size instead of one huge batch."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def text_file_source(spark: SparkSession, folder: str,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Each line of each new file in ``folder`` is one message (``value``)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(folder)


def table_stream(spark: SparkSession, folder: str, schema, fmt: str = "parquet",
                 glob: str | None = None) -> DataFrame:
    """New files of a stored table as a stream (schema must be given)."""
    r = spark.readStream.schema(schema).format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(folder)
