"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "gridtide", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect.

    Cluster-sized values (shuffle partitions, memory, checkpoint folder) belong in
    ``spark-defaults.conf`` or ``conf``; only semantics are fixed here.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # recording the Python call site of every column doubles the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Make the session compute dates and hours in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder path every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a local
    master, where driver and executors share one disk, may use a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="gridtide-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later reads survive lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint()
