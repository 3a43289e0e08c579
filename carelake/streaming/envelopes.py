"""From message envelopes (``value`` bytes, ``timestamp``) to typed event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from carelake import schemas
from carelake.functions import records

WATERMARK = "10 minutes"


def broker_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
    fail_on_data_loss: bool = True,
    **extra: str,
) -> dict[str, str]:
    """Options of the Kafka source. By default every offset is read, nothing limits a trigger, and
    offsets that are gone end the query."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        **extra,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_broker(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """Envelope stream from Kafka; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**broker_options(servers, topic, **settings)).load()


def read_files(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of Parquet files arriving in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def parse(
    envelopes: DataFrame,
    schema: StructType = schemas.ENCOUNTER,
    watermark: str | None = WATERMARK,
) -> DataFrame:
    """Payload columns under the enforced schema, ``kafka_timestamp`` and the watermarked
    ``event_time`` read from the payload. A payload that is no JSON gives null columns."""
    payload = F.from_json(F.col("value").cast("string"), schema).alias("payload")
    rows = envelopes.select(payload, F.col("timestamp").alias("kafka_timestamp"))
    rows = rows.select("payload.*", "kafka_timestamp")
    rows = rows.withColumn("event_time", records.event_instant(F.col("timestamp")))
    return rows if watermark is None else rows.withWatermark("event_time", watermark)


def parse_simple(envelopes: DataFrame, schema: StructType = schemas.STREAM_EVENT) -> DataFrame:
    """Payload columns with the envelope's own time as ``event_time``; no watermark."""
    payload = F.from_json(F.col("value").cast("string"), schema).alias("payload")
    return envelopes.select(F.col("timestamp").cast("timestamp").alias("event_time"), payload).select(
        "event_time", "payload.*"
    )


def wrap(rows: DataFrame, event_time: str) -> DataFrame:
    """Rows as envelopes: the row's JSON text as bytes, and the given instant."""
    body = F.to_json(F.struct(*[F.col(c) for c in rows.columns]))
    return rows.select(body.cast("binary").alias("value"), F.col(event_time).cast("timestamp").alias("timestamp"))
