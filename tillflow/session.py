"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache

from pyspark.sql import SparkSession

# Runtime SQL settings every tillflow job expects.  They can be changed on a
# running session, so they are also applied to sessions built elsewhere.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Sketch states go through ObjectHashAggregate.  The default of 128 groups
    # per task sends almost every state build into the sort-based fallback (10-15 %
    # slower here).  The largest groups are those of category_stats: two sketches of
    # 66 KB and one of 50 KB, so a thousand of them take about 185 MB of a task's heap.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "1024",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Keyed stream state (watermarked hours, remembered ids) can outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it.

    The number of shuffle partitions is left to the cluster: AQE coalesces
    from whatever ``spark.sql.shuffle.partitions`` says.
    """
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", partitions: int = 8, conf: dict[str, str] | None = None
) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tillflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RUNTIME_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tillflow-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the session's ``spark.checkpoint.dir``.

    Executors must all see it, so on a cluster the setting is required; only a
    local master falls back to a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors"
            )
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


#: Folders that jobs of an application have built, by application, input and purpose.
_BUILT: dict[tuple[str, str, str], str] = {}


def built(spark: SparkSession, source: str, purpose: str, build: Callable[[str], None]) -> str:
    """The folder that ``build`` fills from ``source``, at the first call in an application.

    Later calls read what is stored.  A build that fails isn't remembered.
    """
    key = (spark.sparkContext.applicationId, source, purpose)
    if key not in _BUILT:
        path = shared_dir(spark, purpose)
        build(path)
        discard_at_exit(spark, path)
        _BUILT[key] = path
    return _BUILT[key]


def discard_at_exit(spark: SparkSession, path: str) -> None:
    """Delete a folder that is there when this application's JVM ends."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`shared_dir` once it is no longer needed."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
