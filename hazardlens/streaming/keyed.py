"""Streams with state per key.

Keys are dealt out by buckets, and a processor is called once per bucket and micro-batch; each key
has an entry of its own in the state store, which RocksDB keeps on disk. A micro-batch reads and
writes the entries of the keys it brings and no others, however many there are. How many
buckets there are is fixed for the life of a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

BUCKETS = 1024
BUCKET = "_bucket"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams that start in this block keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def bucketed(rows: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def ranked(value) -> tuple:
    """A value that compares with others of its column, NULL last, structs field by field."""
    if isinstance(value, dict):
        value = tuple(value.values())
    if isinstance(value, tuple):
        return (False, tuple(ranked(v) for v in value))
    return (value is None, 0 if value is None else value)


class FirstPerKey(StatefulProcessor):
    """Rows whose key no earlier micro-batch has brought; the first in order of several in one.

    Rows of the initial state are keys that count as brought before the stream began. A NULL key
    is a key.
    """

    def __init__(self, key: str, order: Sequence[str], columns: Sequence[str]):
        self.key, self.order, self.columns = key, list(order), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "missing boolean, value string", "seen boolean")

    def _entry(self, row: Row) -> tuple[bool, str]:
        value = row[self.key]
        return value is None, "" if value is None else str(value)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.seen.updateValue(self._entry(initialState), (True,))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        best: dict[tuple[bool, str], tuple] = {}
        for row in rows:
            entry, rank = self._entry(row), tuple(ranked(row[c]) for c in self.order)
            if entry not in best or rank < best[entry][0]:
                best[entry] = (rank, row)
        for entry, (_, row) in best.items():
            if not self.seen.containsKey(entry):
                self.seen.updateValue(entry, (True,))
                yield Row(**{c: row[c] for c in self.columns})

    def close(self) -> None:
        pass


def first_per_key(
    stream: DataFrame, key: str, order: Sequence[str], seen: DataFrame, buckets: int = BUCKETS
) -> DataFrame:
    """The rows of a stream whose ``key`` comes for the first time, and is not in ``seen`` when the
    stream starts; of several in a micro-batch the first in ``order``."""
    start = bucketed(seen.select(F.col(key).cast("string").alias(key)).distinct(), [key], buckets)
    rows = bucketed(stream, [key], buckets) if dict(stream.dtypes)[key] == "string" else stream.withColumn(
        BUCKET, F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    )
    processor = FirstPerKey(key, order, stream.columns)
    return rows.groupBy(BUCKET).transformWithState(
        processor, stream.schema, "Append", "None", start.groupBy(BUCKET)
    )
