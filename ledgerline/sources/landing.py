"""The record log as a stream: a landing folder, or Kafka where its connector is present."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.schemas import DLQ_TOPIC, LANDED, ORDERS_PARTITIONS, ORDERS_TOPIC

# Header names on the dead-letter topic.
MESSAGE_HEADER = "kafka_dlt-exception-message"
ORIGIN_HEADER = "kafka_dlt-original-topic"


# Files that one micro-batch takes up at most, unless the stream is told otherwise.
FILES_PER_BATCH = 1

# Records that a file of the landing folder holds at most.
FILE_ROWS = 250_000


def files_for(rows: int) -> int:
    """How many files so many records take, one at least."""
    return max(1, -(-rows // FILE_ROWS))


def append(records: DataFrame, path: str) -> None:
    """Append numbered records (see ``with_offsets``) to the landing folder, as one file.

    A producer sends bounded pieces; the stream takes files in the order they were landed.
    """
    records.select(*LANDED.names).coalesce(1).write.mode("append").parquet(path)


def landed_stream(spark: SparkSession, path: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The landing folder as a stream of finished files, so many to a micro-batch."""
    reader = spark.readStream.schema(LANDED).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str = ORDERS_TOPIC,
    partitions: int = ORDERS_PARTITIONS,
    per_batch: int = 1_000_000,
) -> DataFrame:
    """A topic as a stream of landed records; needs the Kafka connector on the class path.

    Committed records only, from the earliest offset.  The log position interleaves the
    partitions and keeps each one's order, which is all that copies of one key need.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("kafka.isolation.level", "read_committed")
        .option("maxOffsetsPerTrigger", per_batch)
    )
    return reader.load().select(
        (F.col("offset") * partitions + F.col("partition")).alias("ingest_seq"),
        "topic",
        F.col("partition").alias("record_partition"),
        F.col("offset").alias("record_offset"),
        F.col("key").cast("string").alias("record_key"),
        F.col("timestamp").cast("timestamp_ntz").alias("appended_at"),
        F.col("value").cast("string").alias("payload"),
    )


def publish_dead_letters(quarantine: DataFrame, servers: str, topic: str = DLQ_TOPIC) -> None:
    """Original bytes to the dead-letter topic; needs the Kafka connector."""
    header = F.struct(
        F.lit(MESSAGE_HEADER).alias("key"),
        F.encode("exception_message", "UTF-8").alias("value"),
    )
    origin = F.struct(
        F.lit(ORIGIN_HEADER).alias("key"),
        F.encode("source_topic", "UTF-8").alias("value"),
    )
    quarantine.select(
        F.col("key_hint").alias("key"),
        F.unbase64("raw_base64").alias("value"),
        F.col("dlq_partition").alias("partition"),
        F.array(header, origin).alias("headers"),
    ).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).option("includeHeaders", "true").save()
