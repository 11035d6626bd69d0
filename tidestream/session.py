"""Session settings the results rely on, and the ones that size work to the data."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings: UTC makes dates and hours unambiguous; adaptive execution merges small
# shuffle partitions and splits the oversized ones of a skewed join.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Minutes of event ids or windows as state belong on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
SHUFFLE_TARGET_BYTES = 128 * 1024 * 1024


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", app: str = "tidestream", **settings) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    parallel = 8 if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Skips recording the Python call site of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parallel))
    )
    for name, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


# A micro-batch is small, but its rows may belong to many folders: let several tasks write them.
BATCH_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


@contextmanager
def batch_settings(spark: SparkSession) -> Iterator[None]:
    """Settings for what a stream does with one of its batches, in the session of the batch.

    A stateful stream plans without adaptive execution in that session; writing a batch needs it
    again, as hints to rebalance are ignored without.
    """
    before = {name: spark.conf.get(name) for name in BATCH_SETTINGS}
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def planned_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame; for a plain scan, the bytes on disk."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fit_shuffles(spark: SparkSession, *inputs: DataFrame) -> int:
    """Raise the shuffle partition count so that `inputs` shuffle in about 128 MB pieces.

    Only ever raises: adaptive execution merges partitions that turn out small, but it
    cannot add any beyond this count.
    """
    wanted = math.ceil(sum(planned_bytes(df) for df in inputs) / SHUFFLE_TARGET_BYTES)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, current)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the cluster's own setting wins.

    Without that setting a scratch folder is used on a local master only; on a cluster it
    would be lost with the machine, so that is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return shared
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidestream-checkpoint-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The frame written once as Parquet to the shared checkpoint folder and read back.

    Like a checkpoint it cuts the lineage and survives lost executors, but later steps read
    only the columns they need, and with `by` only the folders of the values they ask for. The files
    stay until `discard` or until the folder is cleaned.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).parquet(path)
    frame = df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    frame.stored_at = path
    return frame


def discard(frame: DataFrame) -> None:
    """Delete the files of a frame that `stored` has returned and nothing reads any more."""
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
