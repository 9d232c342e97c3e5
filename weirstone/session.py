"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings every job relies on. Sizes (shuffle partitions, split bytes) are left
# to the cluster; AQE merges small shuffle partitions and splits skewed ones.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
    # Rows that watermarks drop are summed over the micro-batches of a run.
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "weirstone", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword settings use `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the workers, once per application.

    Spark serves the archive to every executor that joins, so workers need no
    installed copy and no PYTHONPATH.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    source = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="weirstone-package-")) / "weirstone.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(source.rglob("*.py")):
            out.write(path, path.relative_to(source.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to a session somebody else made, and ship the package."""
    ship(spark)
    for key, value in DEFAULTS.items():
        if spark.conf.isModifiable(key) and spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    A local-mode session without the setting gets a fresh folder of its own; on
    a cluster a missing setting is an error, since executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="weirstone-")
    return _local_roots[context.applicationId]


def scratch(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/weirstone/{label}-{uuid.uuid4().hex}"
