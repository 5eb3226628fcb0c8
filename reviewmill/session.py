"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and the local benchmark; on a cluster use the one you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("reviewmill")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints.  Only a local session without one gets a
    temporary folder; on a cluster that folder would exist on one machine only."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="reviewmill-"))
    return context.getCheckpointDir()


#: Folders of the runs that are under way, innermost last; steps stored outside a run have none.
_RUN = [""]


@contextmanager
def stored_steps(spark: SparkSession) -> Iterator[str]:
    """A run: the steps stored inside go into one folder, which is deleted at the end."""
    _RUN.append(f"run-{uuid.uuid4().hex}/")
    folder = f"{shared_folder(spark).rstrip('/')}/reviewmill/{_RUN[-1]}"
    try:
        yield folder
    finally:
        _RUN.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write once, read many: for a table that several jobs below will scan.

    The copy is a plain Parquet table in the shared folder, so a lost executor costs a re-read
    and not a recomputation, and later readers still get column pruning.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/reviewmill/{_RUN[-1]}{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_parallel(calls: Sequence[Callable], at_once: int = 4) -> list:
    """Results of independent fits in order.  Their many short jobs share the cluster, so that one
    fit's driver work overlaps another's tasks; ``at_once`` bounds how many hold data in memory."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPool(max(1, min(at_once, len(calls)))) as pool:
        return pool.map(lambda call: call(), [inherit(call) for call in calls], chunksize=1)
