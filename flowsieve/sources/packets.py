"""Decoded packet rows as a table or as a stream; the IPv4 filter is part of the source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import PACKET_SCHEMA


def read_packets(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """IPv4 packets in ``PACKET_SCHEMA``; time is read as UTC when the files carry no zone.

    As a stream, files are taken in modification order; pass ``maxFilesPerTrigger`` to bound a batch.
    """
    if streaming:
        packets = spark.readStream.schema(PACKET_SCHEMA).options(**options).parquet(path)
    else:
        packets = spark.read.options(**options).parquet(path)
    return packets.where("is_ip").withColumn("ts", F.col("ts").cast("timestamp"))


def write_packets(packets: DataFrame, path: str, mode: str = "append") -> None:
    """Packets in the schema `read_packets` streams."""
    packets.select(*[F.col(f.name).cast(f.dataType) for f in PACKET_SCHEMA.fields]).write.mode(mode).parquet(path)
