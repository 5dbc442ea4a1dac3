"""Session factory and cluster-safe checkpoint handling."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every query in this package relies on. The session zone must be UTC:
# test tables carry TIMESTAMP_NTZ columns that are read as UTC wall-clock time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Broadcast only what is proven small: no broadcast from plan-time size estimates
    # (they can be far off after explode/filters); AQE still converts a join to a
    # broadcast join once a side's shuffle output has been MEASURED under 64 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


# Cluster sizing: let AQE coalesce reduce partitions to the advisory size instead of keeping
# as many as there are cores. They apply only where the user has set nothing. The number of
# initial shuffle partitions stays with the job: for 30 TB shuffled,
# spark.sql.adaptive.coalescePartitions.initialPartitionNum=32768 keeps one near 1 GB; stateful
# streams are not coalesced and take spark.sql.shuffle.partitions as it is.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_spark(app_name: str = "kerbside", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    running = SparkSession.getActiveSession()
    for k, v in conf.items():
        # a session that runs already, or spark-submit --conf, has the last word on defaults
        if running is None or k in (extra or {}) or not running.sparkContext.getConf().contains(k):
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not is_local(spark):
        given = spark.sparkContext.getConf()
        for k, v in CLUSTER_CONF.items():
            if k not in (extra or {}) and not given.contains(k):
                spark.conf.set(k, v)
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session time zone to UTC (timestamps are compared as UTC wall-clock)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage (HDFS/S3/ABFS); we never
    invent a machine-local folder there. Only a local-mode session (tests) without
    the setting gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage for iterative jobs")
    path = tempfile.mkdtemp(prefix="kerbside-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def joined_as_laid_out(spark: SparkSession) -> None:
    """From now on a join takes rows as they are dealt by some of its keys: samples, laps and events that lie by (session,
    driver) meet by lap without a shuffle. Frames are planned when they are run, so this stays on in the session; it
    changes plans only."""
    if spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") != "false":
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Inside, the session has these settings; what it had before comes back."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def shuffles_removed(spark: SparkSession):
    """Inside, the shuffle files of a write go when it has ended, not when the driver's garbage collector finds them: what is
    stored, or landed by a stream that starts inside, does not lie on disk beside the shuffles that it came from."""
    return configured(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


@contextmanager
def joins_in_place(spark: SparkSession) -> Iterator[None]:
    """Inside, a join takes rows as they are dealt by some of its keys: what has been dealt by session once is joined on
    (session, driver) without another shuffle. Plans are fixed before they run, as a checkpoint keeps only a partitioning that is
    known then. Holds for what is planned inside, so results leave as checkpoints."""
    inside = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in inside}
    for k, v in inside.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def reliable_checkpoint(df):
    """Cut lineage with a reliable checkpoint into ``spark.checkpoint.dir``.

    The frame is persisted first: a reliable checkpoint otherwise computes the plan
    twice (once for the action, once for writing the files). Never ``localCheckpoint``:
    its blocks die with the executor that holds them.
    """
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
