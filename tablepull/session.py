"""Session settings and the shared folder for intermediate results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepull.functions.names import qcol

# Settings worth having on any cluster. A stage whose generated method is too long for
# the JVM to compile runs interpreted; below the limit Spark generates it in parts.
# Strict arithmetic also writes decimals plainly (0.0000000, not 0E-7). Adaptive execution
# merges small shuffle parts, so the number of parts may be set high: about the bytes of
# the largest shuffle by 128 MB.
RECOMMENDED_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}

# The folder for intermediate results of each application that names none.
_LOCAL_DIRS: dict[str, str] = {}

# Below this size a join side may be copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tablepull")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config(map=RECOMMENDED_CONF)
        .getOrCreate()
    )


def with_session(spark: SparkSession, conf: Mapping[str, str] | None = None, init: list[str] | None = None) -> SparkSession:
    """A child session with its own settings and views.

    ``conf`` and the ``init`` statements (for example ``SET TIME ZONE 'Asia/Manila'``)
    apply to the child only, so tables with different settings can be exported from
    one application.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            child.conf.set(key, value)
    for key, value in (conf or {}).items():
        child.conf.set(key, value)
    for statement in init or []:
        child.sql(statement)
    return child


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the folder that all executors see (``spark.checkpoint.dir``)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        application = spark.sparkContext.applicationId
        base = _LOCAL_DIRS.get(application) or tempfile.mkdtemp(prefix="tablepull-")
        _LOCAL_DIRS[application] = base
    return f"{base.rstrip('/')}/tablepull-{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def rename_path(spark: SparkSession, old: str, new: str) -> None:
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(path) for path in (old, new))
    if not source.getFileSystem(spark._jsc.hadoopConfiguration()).rename(source, target):
        raise RuntimeError(f"{old} could not be renamed to {new}.")


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES, measured: DataFrame | None = None) -> DataFrame:
    """Marks ``df`` for broadcast if its measured size allows it, else leaves it as it is.

    ``measured`` is a frame that is never smaller than ``df`` but cheaper to measure, such
    as the rows it was made distinct from.
    """
    source = df if measured is None else measured
    width = F.lit(8 * len(df.columns))
    for field in source.schema.fields:
        if field.dataType.simpleString() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(qcol(field.name)), F.lit(0))
        elif field.dataType.simpleString().startswith(("array", "map", "struct")):
            return df
    size = source.agg(F.sum(width).alias("size")).first()["size"]
    return F.broadcast(df) if (size or 0) <= limit else df
