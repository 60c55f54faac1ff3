"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A category or product may hold a third of all rows: joins split them at run time, also
    # where that takes another shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # One Arrow row carries a whole batch of review texts, so keep few per transfer.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    # Streaming de-duplication keeps every key it has seen; hold it off-heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(name: str = "hazardlens", **conf: str) -> SparkSession:
    """A session with the recommended settings; ``conf`` entries win."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it uses a folder beside its warehouse.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work")
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/hazardlens/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the working folder and read it back.

    For results of costly steps that several later branches read, each with its own
    columns. Lost executors do not bring the steps back.
    """
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing will read again.

    Only for tables whose results have been written themselves: a lost executor must not need
    them any more.
    """
    for table in tables:
        for folder in {name.rsplit("/", 1)[0] for name in table.inputFiles()}:
            if "/hazardlens/" not in folder:
                raise ValueError(f"not a working table: {folder}")
            jvm = table.sparkSession._jvm
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
