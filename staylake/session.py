"""Session construction and the shared folder used for materialised data.

On a cluster the shared folder is the one named by ``spark.checkpoint.dir``;
it is read from the session and only set here when it is unset (tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Settings every staylake session wants. AQE re-plans joins from measured
# shuffle sizes, coalesces small partitions and splits skewed join partitions.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def cluster_conf(input_bytes: int, total_cores: int, shuffle_bytes: int | None = None) -> dict[str, str]:
    """Sizing for a large cluster run, from the input size and core count.

    Scan splits of 256 MiB keep task count manageable at 100 TB (about
    400k scan tasks). The initial shuffle width gives ~256 MiB per shuffle
    partition of ``shuffle_bytes``, what the largest exchange is expected to move,
    and never fewer than two waves of cores. Give that figure at 100 TB: every
    scan task writes a block per shuffle partition, and without it the width
    supposes that the whole input is moved (400k x 400k blocks), where scans of
    few columns and partial aggregates move a small part. AQE coalesces
    small partitions and splits skewed join partitions above 512 MiB. The
    automatic broadcast limit stays small: the code broadcasts explicitly
    only what it has checked.
    """
    split = 256 * 1024 * 1024
    moved = input_bytes if shuffle_bytes is None else shuffle_bytes
    partitions = max(2 * total_cores, -(-moved // split))
    return {
        **SESSION_CONF,
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * split),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }


def get_session(master: str | None = None, app_name: str = "staylake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session (e.g. the driver's)."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    shared_dir(spark)
    return spark


SHUFFLE_INPUT_BYTES = 8 * 1024 * 1024  # stored (compressed) input per shuffle partition, before AQE joins small ones
_SIZES: dict[tuple[str, str], int] = {}


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Stored bytes of the files under ``paths``, as listed; nothing is read."""
    files = spark.read.format("binaryFile").load(list(paths)).select("length")
    return files.agg(F.sum("length")).first()[0] or 0


def input_width(spark: SparkSession, *paths: str, unit: int = SHUFFLE_INPUT_BYTES) -> int:
    """How many parts of ``unit`` bytes the files under ``paths`` have, at least one; files are listed once per session."""
    key = (spark.sparkContext.applicationId, "|".join(paths))
    if key not in _SIZES:
        _SIZES[key] = input_bytes(spark, *paths)
    return max(1, -(-_SIZES[key] // unit))


def widen_shuffles(spark: SparkSession, partitions: int) -> None:
    """Start shuffles with at least ``partitions`` partitions. AQE joins small ones, so that a task's share
    is bounded by its advisory size and not by the input divided by a fixed number."""
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    held = int(spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if partitions > held:
        spark.conf.set(key, str(partitions))


_LOCAL_FALLBACK: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for checkpoints and materialised tables."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        key = spark.sparkContext.applicationId
        if key not in _LOCAL_FALLBACK:
            # One process: its own temporary folder is shared by all tasks.
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="staylake-ckpt-")
        path = _LOCAL_FALLBACK[key]
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique location under the shared folder."""
    return os.path.join(shared_dir(spark), "staylake", *parts, uuid.uuid4().hex)
