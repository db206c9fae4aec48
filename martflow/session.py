"""Session helpers: the configuration the library expects, and the shared
folder used to cut lineage (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans are tuned for.  They are applied only where
# the session has not set them itself, so a cluster's own sizing wins.  (No
# time zone is needed: every timestamp is TIMESTAMP_NTZ, a wall-clock value.)
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "martflow", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def attach_session(app_name: str) -> SparkSession:
    """The session of a submitted job: master and sizes are the submitter's."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in RUNTIME_DEFAULTS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_defaults(spark: SparkSession) -> None:
    for key, value in RUNTIME_DEFAULTS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


#: Rows that one task aggregates where groups are nearly as many as rows.
ROWS_PER_TASK = 500_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` shuffled by ``keys`` into tasks of about ``ROWS_PER_TASK`` of its ``rows``.

    The number is fixed, so tasks are not joined into larger ones and what an
    aggregate or a sort on these keys holds does not grow with the table."""
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(least, -(-rows // ROWS_PER_TASK)), *keys)


#: Frees the shuffle files of a query when it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str | None) -> Iterator[None]:
    """A setting of the session for the queries begun inside (None: left as it is)."""
    before = spark.conf.get(key, None)
    if value is not None:
        spark.conf.set(key, value)
    try:
        yield
    finally:
        if value is not None and before is None:
            spark.conf.unset(key)
        elif value is not None:
            spark.conf.set(key, before)


@contextmanager
def shuffles_freed(*sessions: SparkSession) -> Iterator[None]:
    """The shuffle files of each query run inside go when it ends, not when the
    driver's garbage is collected: what a load writes or checkpoints needs them no more."""
    with ExitStack() as stack:
        for s in sessions:
            stack.enter_context(session_setting(s, CLEAN, "true"))
        yield


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Only when the session names none (a bare local test) do we create one
    and register it, so that ``DataFrame.checkpoint()`` works as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="martflow-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def _filesystem(spark: SparkSession, path: str):
    """The Hadoop filesystem a path belongs to - the one Spark itself reads
    and writes it with - and the path on it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there.  Any failure to find out (denied,
    throttled, unreachable) is raised: it must never pass for "absent"."""
    fs, p = _filesystem(spark, path)
    return fs.exists(p)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _filesystem(spark, path)
    fs.delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it is absent)."""
    fs, p = _filesystem(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def rename_path(spark: SparkSession, source: str, target: str) -> bool:
    fs, p = _filesystem(spark, source)
    return fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(target))


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, p = _filesystem(spark, path)
    fs.setTimes(p, millis, -1)


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _filesystem(spark, path)
    return fs.getContentSummary(p).getLength()


def input_identity(spark: SparkSession, path: str) -> str:
    """Length, number of files and time of the last change of a file or
    folder; constant work on the driver however many files there are."""
    fs, p = _filesystem(spark, path)
    summary = fs.getContentSummary(p)
    changed = fs.getFileStatus(p).getModificationTime()
    return f"{summary.getLength()}:{summary.getFileCount()}:{changed}"


def write_marker(spark: SparkSession, path: str, text: str = "") -> None:
    fs, p = _filesystem(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_marker(spark: SparkSession, path: str) -> str | None:
    """Text of a marker written by :func:`write_marker` (None if absent)."""
    fs, p = _filesystem(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
