"""Streaming de-duplication of ids.

Without a watermark the state holds every key ever seen and grows with the data;
the RocksDB state store keeps it on disk. With one, a key is forgotten after the
delay, and may come again later than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def distinct_stream(
    rows: DataFrame, keys: Sequence[str], event_time: str | None = None, delay: str | None = None
) -> DataFrame:
    """First sighting of each key in a stream."""
    if delay is None:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_distinct_ids(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    keys: Sequence[str] = ("category", "id"),
    max_files: int | None = None,
    event_time: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Append ids from the files in ``source`` to ``target``, each key once over all runs.

    All columns of ``schema`` are kept. With ``event_time`` and ``delay`` the state is bounded: a
    key is remembered for the delay only.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        distinct_stream(reader.parquet(source), keys, event_time, delay)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(target)
