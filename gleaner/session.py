"""Session settings and the shared folder used for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package wants. Sizes (executors, memory, number
# of shuffle partitions) belong to the cluster and are left to spark-submit:
# with AQE a generous spark.sql.shuffle.partitions is coalesced at run time.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Pages and blobs are large rows: keep Arrow batches small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_base: str | None = None
_handed_out: list[str] = []


def build_session(app: str = "gleaner", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the recommended settings; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    A local-mode session without that setting gets a temporary folder; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with its executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    global _local_base
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="gleaner-")
    return _local_base


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_dir(spark)}/gleaner/{name}-{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def release(spark: SparkSession, name: str = "") -> None:
    """Remove the folders that this process was given (those of ``name``, if named): at the end of a job."""
    for path in [p for p in _handed_out if p.rsplit("/", 1)[1].startswith(name)]:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        _handed_out.remove(path)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Use it where several branches read the result of costly work (parsing,
    decoding): the work is done once, and a lost executor costs a re-read
    rather than a recomputation.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
