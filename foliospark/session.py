"""Session settings and shared work folders."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on; cluster sizing (executors, memory) stays with the submitter.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Sessions merge in the map tasks first, so a busy key shuffles sessions instead of events.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

LOCAL_ROOTS: dict[str, str] = {}  # folder of each local test session


def build_session(master: str | None = None, app: str = "foliospark", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session without that setting (a test run) gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = LOCAL_ROOTS.setdefault(context.applicationId, "") or "file://" + tempfile.mkdtemp(prefix="foliospark-")
        LOCAL_ROOTS[context.applicationId] = root
    return root.rstrip("/")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared root."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def table(spark: SparkSession, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is run inside are removed as soon as it has ended.

    Otherwise they stay until the driver happens to collect garbage. For results that are read once; a frame run again
    after the block computes its shuffles again.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def materialise(df, purpose: str, codec: str | None = None, parts: tuple[str, ...] = ()):
    """Write a frame that several branches read to the shared folder and read it back.

    Unlike a cache the written table survives lost executors, so the shuffles behind it are released.
    ``codec`` is the session's unless given. ``parts`` are whole-number columns that get folders of their own.
    """
    folder = work_folder(df.sparkSession, purpose)
    with shuffles_released(df.sparkSession):
        df.write.parquet(folder, partitionBy=list(parts) or None, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(*tables, part: str = "") -> None:
    """Remove work tables that ``materialise`` wrote and nothing reads any more, or of each only the folder ``part``."""
    for df in tables:
        spark = df.sparkSession
        root = re.sub("^file:/+", "file:/", shared_root(spark)) + "/"
        for folder in {re.sub("^file:/+", "file:/", f).rsplit("/", 1)[0] for f in df.inputFiles()}:
            if folder.startswith(root) and folder.endswith(part and f"/{part}"):
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


SPREAD_BYTES = 1 << 20


def spread(df, *key: str):
    """Give per-row heavy work enough tasks when the input is too small to make them itself.

    One Parquet row group is one scan task, however costly the rows are. Inputs whose estimated size
    already fills the cluster with scan tasks are returned as they are, without a shuffle.
    """
    spark = df.sparkSession
    slots = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = min(2 * slots, -(-size // SPREAD_BYTES))
    return df if size >= slots * split or tasks < 2 else df.repartition(tasks, *key)
