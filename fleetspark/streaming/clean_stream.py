"""Structured Streaming entry for the row-wise part of the pipeline.

The reference is batch only.  Cleaning (class split, GPS flag, clipping,
projection) is stateless per ping, so the same operators run unchanged on a
stream of newly arriving telemetry files; the ordered ping pass and the
shift aggregates stay batch jobs over the cleaned output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_haulers
from ..params import Params
from ..sources.telemetry import conform


def cleaned_ping_stream(spark: SparkSession, source_dir: str, schema, p: Params = Params()) -> DataFrame:
    """New Parquet files under ``source_dir`` -> cleaned hauler pings."""
    raw = spark.readStream.schema(schema).parquet(source_dir)
    return clean_haulers(conform(raw), p)


def start_clean_sink(stream: DataFrame, out_path: str, checkpoint_path: str) -> StreamingQuery:
    """Append cleaned pings to Parquet, partitioned by date, exactly once via
    the stream checkpoint (a shared folder on a cluster)."""
    return (stream.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint_path).partitionBy("date_dpr").start(out_path))
