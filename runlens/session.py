"""Session settings the library relies on, and lineage cuts.

Only settings that change results are required (UTC session zone). The rest
are defaults for tests and the bench; on a cluster the job's own
configuration wins, since ``builder.config`` never overrides a running
session's settings here.
"""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

REQUIRED = {
    # Time text is produced and parsed in UTC, like the reference.
    "spark.sql.session.timeZone": "UTC",
}

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dimension lookups (clusters, notebooks, tracker) are broadcast only when
    # the optimizer's size estimate is under this bound; AQE re-checks with
    # the real shuffle sizes at run time.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
}


def build(master: str | None = None, shuffle_partitions: int | None = None, app: str = "runlens",
          extra: dict[str, str] | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {**DEFAULTS, **REQUIRED, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    for k, v in REQUIRED.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A fallback is applied only when the setting is unset (tests); a cluster
    must name a shared folder, never a machine-local one.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set; name a shared folder")
        d = fallback
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession) -> str:
    """:func:`checkpoint_dir`; where the setting is missing, a temporary folder
    if Spark runs in one process (tests), else a folder in the warehouse."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return checkpoint_dir(spark)
    if spark.sparkContext.master.split("[")[0] == "local":
        return checkpoint_dir(spark, tempfile.mkdtemp(prefix="runlens-shared-"))
    return checkpoint_dir(spark, spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives the
    loss of executors, unlike a local checkpoint)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, for rows that several steps read: a
    checkpoint holds whole rows uncompressed, and every later step reads all of their columns."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/runlens-stored/{name}-{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """Shuffle files of what runs inside are removed at its end: Spark keeps them else until the driver collects its
    garbage, beside those of all later steps."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def prepared(build):
    """Keep the columns that ``build`` makes, by its arguments. A column names
    what it reads and holds no data, so it serves any number of plans; making
    the hundreds of small expressions of a wide select takes seconds of calls
    to the JVM, more than small inputs take to run."""
    kept: dict = {}

    @functools.wraps(build)
    def run(*args):
        key = (SparkContext._active_spark_context, *args)  # columns live in their session's JVM
        if key not in kept:
            kept[key] = build(*args)
        return kept[key]
    return run
