"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on. Time zone is pinned because DATE()/HOUR()
# of an event depend on it; AQE re-plans joins and coalesces partitions at
# run time and splits skewed sort-merge join partitions. (Partition
# overwrite mode is chosen per write by the sinks, not session-wide.)
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A bucketed table with one file a bucket is read as sorted as it was
    # written, so a merge join on its keys needs no sort.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def build_session(master: str | None = None, app: str = "shelfline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators expect.

    On a cluster, ``master`` stays None and the launcher decides; in tests
    and the bench a ``local[N]`` master is passed.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.sql."):
            continue
        spark.conf.set(k, v)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session's executors, as
    ``--py-files`` would, so that functions run there whatever folder or path
    the driver was started with. Once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="shelfline-package-")
    path = os.path.join(folder, f"{os.path.basename(here)}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for root, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(root, name)
                z.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when nothing is configured and the master
    is ``local[...]`` (tests) is a private folder created and registered, so
    that later reads of the setting agree; on a cluster a missing setting
    is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    elif root and sc is not None and not sc.getCheckpointDir():
        # Named in the session conf after the context started: register it
        # so that DataFrame.checkpoint() writes there too.
        sc.setCheckpointDir(root)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            # A machine-local folder is not reachable from other executors
            # and is lost with them: on a cluster the shared folder is
            # mandatory.
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(HDFS/object store) for checkpoints and scratch tables")
        root = tempfile.mkdtemp(prefix="shelfline-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def sizing_conf(input_bytes: int, total_cores: int) -> dict:
    """Shuffle and scan sizing for a job reading ``input_bytes``.

    Shuffles start at about one partition per 128 MB of input (at least two
    per core, at most 200,000) and AQE coalesces them towards 128 MB each
    at run time, so partitions fit executor memory whatever the filter
    selectivity; scan splits grow to 256 MB on very large inputs to bound
    the task count. Skewed join partitions above 256 MB are split.
    """
    mb = 1 << 20
    shuffle = max(2 * total_cores, min(200_000, -(-input_bytes // (128 * mb))))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * mb),
        "spark.sql.files.maxPartitionBytes": str((256 if input_bytes > (1 << 40) else 128) * mb),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * mb),
    }
