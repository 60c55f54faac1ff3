"""Incremental ingest: every micro-batch is merged into the review table.

The table is append-only, one folder per stream and micro-batch. A stream is known by the id
in its checkpoint, so a new checkpoint never writes into the folders of an earlier one. Which
reviews a stream has brought is kept in its state, one entry per review key: a micro-batch costs
what it brings and never reads the table. A batch that is replayed after a failure finds the
state as it was and overwrites its own folder with the same rows.

A new stream begins with the keys that the table has by then; they are read once. If other
streams have appended since, the keys of those folders alone are read by each batch.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hazardlens.operators.dedup import new_reviews
from hazardlens.sources.files import path_exists, read_optional
from hazardlens.streaming.keyed import BUCKETS, first_per_key, state_on_disk

_FOLDERS = "stream string, batch bigint"


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of this checkpoint."""
    line = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id"))
    return line.first()[0]


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return [status.getPath().toString() for status in found or []]


def last_batches(spark: SparkSession, target: str) -> dict[str, int]:
    """The last batch of each stream in the table, by the names of its folders."""
    last: dict[str, int] = {}
    for folder in _glob(spark, f"{target}/stream=*/batch=*"):
        stream, batch = (part.split("=", 1)[1] for part in folder.rsplit("/", 2)[1:])
        last[stream] = max(last.get(stream, -1), int(batch))
    return last


def _known_at_start(spark: SparkSession, target: str, checkpoint: str) -> dict[str, int]:
    """The batches that the table had when the stream of this checkpoint first started, written
    down beside the checkpoint's own files."""
    path = f"{checkpoint}/_known"
    if not path_exists(spark, path):
        lines = [(json.dumps([s, b]),) for s, b in sorted(last_batches(spark, target).items())]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(path)
    return dict(json.loads(r.value) for r in spark.read.text(path).collect())


def _of(batches: dict[str, int]) -> Column:
    """Whether a row is of one of these batches or an earlier one of its stream."""
    some = F.lit(False)
    for stream, last in batches.items():
        some = some | ((F.col("stream") == stream) & (F.col("batch") <= last))
    return some


def merge_batch(
    batch: DataFrame, stream: str, batch_id: int, target: str, later: DataFrame | None = None, key: str = "review_key"
) -> None:
    """Write the reviews that a micro-batch brings for the first time, without those that other
    streams have written ``later`` than this one started."""
    fresh = batch if later is None else new_reviews(batch, later, key)
    fresh.write.mode("overwrite").parquet(f"{target}/stream={stream}/batch={batch_id}")


def stream_merge(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    prepare=None,
    max_files: int | None = None,
    key: str = "review_key",
    order: str = "arrival",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Merge all review files that have landed in ``source``, stop and return the table.

    ``prepare`` maps the landed rows to reviews with ``review_key`` and ``arrival``. Running it
    again with the same checkpoint takes only files that are new. Rows keep the ``stream`` and
    ``batch`` that brought them; within a batch ``arrival`` is the order, and of rows with one key
    the first in it stays. Nothing landed gives an empty table. One stream writes at a time.
    """
    if not path_exists(spark, source):
        columns = (prepare or (lambda df: df))(spark.createDataFrame([], schema)).schema
        return read_optional(spark, target, f"{_ddl(columns)}, {_FOLDERS}")
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(source)
    reviews = prepare(rows) if prepare else rows
    ddl = f"{_ddl(reviews.schema)}, {_FOLDERS}"
    known = _known_at_start(spark, target, checkpoint)
    own = stream_id(spark, checkpoint) if path_exists(spark, f"{checkpoint}/metadata") else None
    begun = bool(_glob(spark, f"{checkpoint}/commits/0"))
    seen = spark.createDataFrame([], ddl) if begun or not known else read_optional(spark, target, ddl).where(_of(known))
    since = {s: b for s, b in last_batches(spark, target).items() if s != own and b > known.get(s, -1)}
    later = None
    if since:
        later = read_optional(spark, target, ddl).where(_of(since) & ~_of(known))

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        merge_batch(batch, stream_id(session, checkpoint), batch_id, target, later, key)

    with state_on_disk(spark):
        query = (
            first_per_key(reviews, key, [order], seen, buckets)
            .writeStream.foreachBatch(merge)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return read_optional(spark, target, ddl)
