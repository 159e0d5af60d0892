"""Session settings and the shared folder for intermediate tables."""

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution picks join sides from measured sizes, merges small shuffle
# partitions and splits skewed ones; the joins in this package rely on it. The
# rows broadcast for frequent keys are few but come from whole-table aggregates,
# which may take longer than the default five minutes.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.broadcastTimeout": "7200",
    "spark.sql.session.timeZone": "UTC",
}

# Rows a shuffle's task is to sort at once; some hundred bytes each in memory.
ROWS_PER_TASK = 1 << 18

_local_dirs = {}


def build_session(app_name="trolley", master=None, **settings):
    """Return a session with the adaptive settings; extra settings win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ADAPTIVE_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def widen(spark, rows):
    """Let shuffles and scans of tables with so many rows have a task for every ``ROWS_PER_TASK`` of them.

    A fixed number makes tasks grow with the input until their sorts spill and their
    cached rows fill an executor. Both settings are only ever raised; adaptive
    execution merges shuffle partitions that turn out small.
    """
    wanted = math.ceil(rows / ROWS_PER_TASK)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
    if wanted > int(spark.conf.get("spark.sql.files.minPartitionNum", None) or spark.sparkContext.defaultParallelism):
        spark.conf.set("spark.sql.files.minPartitionNum", wanted)


def shared_dir(spark):
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    # "local-cluster" has executors of its own and needs the setting.
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="trolley-")
    return _local_dirs[context.applicationId]


def work_folder(spark, kind):
    """A new folder for intermediate tables of this application; no two calls return the same."""
    return f"{shared_dir(spark)}/work/{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def clean(spark):
    """Remove the intermediate tables of this application, once its results are written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/work/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def ensure_checkpoints(spark):
    """Give iterative training a checkpoint folder if the session has none."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")
