"""Session settings the jobs rely on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings. Times are UTC instants everywhere, so the zone is not a preference: date
# columns and year shards are derived with it. Skewed probe sides are split by AQE even when
# that costs another exchange.
# Wide parsing stages are generated as small methods the JIT compiles, instead of one it refuses.
RUNTIME = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


# Stored bytes a task reads at most: rows made of them are many times wider, and must be sorted in a task's memory
# where an aggregate keeps whole rows. A smaller setting is left alone.
SPLIT = 8 * 2**20


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > SPLIT:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT))
    return spark


def local_session(cpus: str | int = "*", memory: str = "8g", name: str = "filinglake") -> SparkSession:
    """A single-machine session for tests and the bench."""
    partitions = 8 if cpus == "*" else max(int(cpus), 1)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A machine-local folder is only ever chosen for a local master, once for the whole process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="filinglake-")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder for one written table."""
    return f"{shared_folder(spark)}/filinglake/{label}-{uuid.uuid4().hex}"
