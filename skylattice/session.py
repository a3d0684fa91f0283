"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from skylattice import files

# Runtime re-planning is what lets the joins below pick broadcast or skew-split
# from measured sizes, so the job needs it on; sizes are left to the cluster.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # A dimension of a million places or so still joins map-side; one whose files
    # are larger is shuffled, and its hot keys split.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # The marts are wide: fused into one generated method they pass the 8,000
    # bytes of bytecode up to which HotSpot compiles, and would be interpreted.
    # Above this limit Spark splits the work over smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str = "skylattice", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared one named in ``spark.checkpoint.dir``.

    Executors on other machines must see what is written here, so a temporary
    folder of this machine is used only when Spark itself runs locally.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="skylattice-")
    return f"{root.rstrip('/')}/skylattice-{uuid.uuid4().hex}"


#: Spark frees shuffle files when the driver happens to collect garbage; with this, when the job that wrote them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = threading.Lock()
_writing: dict[int, tuple[int, str | None]] = {}


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Writes in the block leave no shuffle files behind; the session's own setting comes back with the last of them."""
    key = spark._jsparkSession.hashCode()
    with _lock:
        count, own = _writing.get(key, (0, None))
        if not count:
            own = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writing[key] = count + 1, own
    try:
        yield
    finally:
        with _lock:
            count, own = _writing.pop(key)
            if count > 1:
                _writing[key] = count - 1, own
            elif own is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, own)


def materialize(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage in a way that survives lost executors, stops an input used
    several times from being computed several times, and gives the optimizer
    the true size, so a following join is broadcast only if it really is small.
    """
    spark = df.sparkSession
    path = path or scratch_dir(spark)
    with freed(spark):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """``materialize`` into a folder that is removed again at the end."""
    root, made = scratch_dir(spark), []

    def stage(df: DataFrame) -> DataFrame:
        made.append(df)
        return materialize(df, f"{root}/{len(made)}")

    try:
        yield stage
    finally:
        files.delete(spark, root)
