"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings every job relies on. UTC makes day boundaries and text
# timestamps independent of the driver's zone; the skew settings let AQE split
# hot partitions of a sort-merge join.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_folder: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    builder = builder.config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def stream_session(spark: SparkSession, state_partitions: int) -> SparkSession:
    """A sibling session for one stateful stream.

    The number of state partitions is fixed by the checkpoint at first start, so
    it is set here and not shared with the caller's batch settings.
    """
    session = configure(spark.newSession())
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # Counting all rows of a state, for a metric alone, costs a look-up for every row written.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if sc.applicationId not in _local_folder:
        _local_folder[sc.applicationId] = tempfile.mkdtemp(prefix="tidewire-")
    return _local_folder[sc.applicationId]


def run_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for one run below the shared folder."""
    return f"{shared_folder(spark)}/tidewire/{name}-{uuid.uuid4().hex}"
