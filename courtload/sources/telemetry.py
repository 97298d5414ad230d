"""Telemetry messages: encode rows to (key, JSON value), decode them back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from courtload import config, schemas
from courtload.functions.exprs import epoch_seconds, in_range, utc_wallclock

FIELDS = tuple(f.name for f in schemas.TELEMETRY.fields)


def kafka_options(servers: str | Sequence[str], topic: str, starting: str = "earliest", max_per_trigger: int | None = None,
                  fail_on_data_loss: bool = True, **more: str) -> dict[str, str]:
    """Options of the Kafka source: brokers, topic, where a first run starts (``earliest``, ``latest`` or JSON of offsets),
    and how many messages a micro-batch takes at most.  ``more`` adds options of the connector, ``_`` standing for a dot
    (``kafka_security_protocol``)."""
    options = {"kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers), "subscribe": topic,
               "startingOffsets": starting, "failOnDataLoss": str(fail_on_data_loss).lower()}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options | {k.replace("_", "."): v for k, v in more.items()}


def telemetry_source(spark: SparkSession, fmt: str = "kafka", options: Mapping[str, str] | None = None,
                     schema: StructType | None = None, path: str | None = None) -> DataFrame:
    """The live feed.  ``fmt="kafka"`` needs the Kafka connector on the classpath
    (options: ``kafka_options``); file formats
    need ``schema`` and ``path``."""
    r = spark.readStream.format(fmt).options(**dict(options or {}))
    if schema is not None:
        r = r.schema(schema)
    return r.load(path) if path else r.load()


def tracking_messages(tracking: DataFrame, time_col: str = "timestamp") -> DataFrame:
    """Tracking rows as telemetry messages; rows whose time does not parse are dropped.

    ``event_time`` is the sample's own time (epoch seconds), where the
    reference replay stamped the producer's wall clock.
    """
    kind = tracking.schema[time_col].dataType.simpleString()
    if kind == "timestamp_ntz":
        ts = F.col(time_col)
    elif kind == "timestamp":
        ts = utc_wallclock(F.col(time_col))
    else:                                       # text from a raw file: unparseable -> NULL -> dropped
        ts = F.col(time_col).cast("string").try_cast("timestamp_ntz")
    t = tracking.withColumn("_ts", ts).filter(F.col("_ts").isNotNull())
    return t.select(
        F.col("game_id").cast("string").alias("game_id"),
        F.col("player_id").cast("string").alias("player_id"),
        F.col("team_id").cast("string").alias("team_id"),
        F.date_format("_ts", "yyyy-MM-dd HH:mm:ss").alias("game_timestamp"),
        epoch_seconds("_ts").alias("event_time"),
        "x_court_ft", "y_court_ft", "speed_mph", "acceleration",
        F.col("distance_covered_ft").alias("cumulative_distance"),
        "heart_rate_bpm",
    )


def telemetry_encode(messages: DataFrame, key: str = "player_id", fields: Sequence[str] = FIELDS) -> DataFrame:
    """(key, value) records ready for a Kafka or file sink; key keeps a player's events together."""
    return messages.select(F.col(key).cast("string").alias("key"),
                           F.to_json(F.struct(*[F.col(f) for f in fields])).alias("value"))


def write_messages(messages: DataFrame, path: str, key: str = "player_id", time_field: str = "event_time",
                   fields: Sequence[str] = FIELDS) -> None:
    """S11 as a job: (key, value) records in files, each player's in time order.

    Rows are range-sorted by player and time, so a player with a third of all messages spreads over
    several files that follow each other.
    """
    ordered = messages.repartitionByRange(F.col(key), F.col(time_field)).sortWithinPartitions(key, time_field)
    telemetry_encode(ordered, key, fields).write.mode("overwrite").parquet(path)


def telemetry_decode(records: DataFrame, schema: StructType = schemas.TELEMETRY, value: str = "value",
                     lo: float = config.HR_KEEP[0], hi: float = config.HR_KEEP[1],
                     time_field: str = "event_time") -> DataFrame:
    """bytes/string -> struct -> columns; event time in whole seconds; keep HR in [lo, hi].

    ``time_field`` names the message field that carries event time: epoch
    seconds (``event_time``, the default) or a timestamp string such as
    ``game_timestamp`` (read as UTC wall clock).  A malformed message parses
    to NULL fields and is dropped by the range filter.
    """
    parsed = records.select(F.from_json(F.col(value).cast("string"), schema).alias("data")).select("data.*")
    if isinstance(schema[time_field].dataType, StringType):
        secs = F.floor(epoch_seconds(F.col(time_field).try_cast("timestamp_ntz")))
    else:
        secs = F.floor(F.col(time_field))
    return (parsed.withColumn("event_timestamp", F.timestamp_seconds(secs))
                  .filter(in_range("heart_rate_bpm", lo, hi)))
