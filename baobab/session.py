"""Session builder and cluster-safe scratch locations.

The library never hard-codes a machine-local folder: anything that must survive
executor loss (checkpoints, streaming state, intermediate tables) goes under the
shared directory the cluster names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults chosen for correctness and for large inputs: ANSI on (Spark 4 default,
# made explicit), UTC so date_trunc/date_format do not depend on the host, AQE with
# partition coalescing and skew-join splitting, and no web UI.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "baobab",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is left to ``spark-submit`` when ``None``. ``shuffle_partitions``
    should be sized so one shuffle partition stays around 128-256 MB at the target
    scale; AQE coalesces the small ones at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def sizing_conf(input_bytes: int, cores: int, target_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` on ``cores`` executor cores.

    Scan splits and post-shuffle partitions both aim at ``target_bytes`` (small
    enough to sort or hash in executor memory without heavy spilling, large enough
    to keep task overhead low); the initial shuffle width is at least 2x the cores
    so every core gets work, and AQE coalesces or splits from there at run time.
    """
    by_size = -(-input_bytes // target_bytes)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(max(2 * cores, by_size)),
    }


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or where the session
    names none, the folder given to ``SparkContext.setCheckpointDir``.

    On a cluster a missing folder is an error. In local mode (``local[...]``: one
    process, so its own disk is what the executors share) a temporary one is set.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="baobab-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared directory for one job's output."""
    base = shared_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
