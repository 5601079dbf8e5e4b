"""Session helpers: builder, shared folder, checkpoint and staged tables."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
PARTITIONS_CONF = "spark.sql.shuffle.partitions"
SPLIT_CONF = "spark.sql.files.maxPartitionBytes"
SPLIT_BYTES = 16 << 20
ROWS_PER_PARTITION = 250_000  # wide rows that a task sorts without spilling
_local_dirs: dict[str, str] = {}
_staged: dict[tuple[str, str, str], str] = {}


def local_session(cores: str = "8", app: str = "homespan") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its machine, so we refuse.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    already = sc.getCheckpointDir()
    if already:
        return already.rsplit("/", 1)[0] if "/" in already else already
    if not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="homespan-")
    return _local_dirs[sc.applicationId]


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, safe from executor loss, lineage cut."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/homespan/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs started inside."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def sized_shuffles(spark: SparkSession, rows: int):
    """Shuffles in proportion to ``rows``, so that the rows of one task do not grow with the table.

    Never fewer partitions than the session has; adaptive execution joins small ones.
    """
    least = int(spark.conf.get(PARTITIONS_CONF))
    return _settings(spark, {PARTITIONS_CONF: str(max(least, -(-rows // ROWS_PER_PARTITION)))})


def short_scans(spark: SparkSession):
    """Smaller file splits for model fits, which hold a task's rows as objects many times their stored size."""
    return _settings(spark, {SPLIT_CONF: str(SPLIT_BYTES)})


def is_staged(spark: SparkSession, source: str, name: str) -> bool:
    """Whether this session has written the stage."""
    return (spark.sparkContext.applicationId, hashlib.md5(source.encode()).hexdigest()[:12], name) in _staged


def staged(spark: SparkSession, source: str, name: str, build: Callable[[], DataFrame], rows: int = 0) -> DataFrame:
    """Stage boundary: write ``build()`` as parquet once per session, then read it.

    Readers get column pruning, pushdown and file statistics, and nothing
    upstream is computed twice. ``rows`` is the size by which its shuffles are cut.
    """
    digest = hashlib.md5(source.encode()).hexdigest()[:12]
    key = (spark.sparkContext.applicationId, digest, name)
    if key not in _staged:
        path = fresh_path(spark, f"{digest}-{name}")
        with sized_shuffles(spark, rows):
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
        _staged[key] = path
    return spark.read.parquet(_staged[key])
