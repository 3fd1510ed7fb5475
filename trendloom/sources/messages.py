"""Message streams: a broker topic, or files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendloom.schemas import MESSAGE_SCHEMA

# A first start reads the topic from its beginning, lost offsets are an error, and a trigger takes
# all that has arrived.
KAFKA_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "true"}


def topic_stream(
    spark: SparkSession, topic: str, servers: str = "localhost:9092", **options: str
) -> DataFrame:
    """Stream of one topic; ``options`` override the defaults.

    Set ``maxOffsetsPerTrigger`` to bound a trigger and ``minPartitions`` to read one topic
    partition with several tasks. Needs Spark's Kafka connector on the class path.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    for key, value in {**KAFKA_DEFAULTS, "subscribe": topic, **options}.items():
        reader = reader.option(key, value)
    return reader.load()


def file_stream(
    spark: SparkSession, path: str, fmt: str = "parquet", max_files_per_trigger: int | None = None, once: bool = False
) -> DataFrame:
    """Stream of files holding messages, for replays and tests. With ``once`` a file is deleted when the
    trigger after that which read it begins, so that the messages need not be kept beside what they became.
    """
    reader = spark.readStream.format(fmt).schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if once:
        reader = reader.option("cleanSource", "delete")
    return reader.load(path)
