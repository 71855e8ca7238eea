"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Staged frames and the folder of the scope that owns them ("" outside of any scope).
_staged: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_owner: ContextVar[str] = ContextVar("owner", default="")


def local_session(app: str = "tallyloom", cores: str = "*") -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def split_methods(spark: SparkSession) -> None:
    """Have Spark split generated methods that HotSpot would never compile.

    A wide projection or merge in one method beyond 8,000 bytes of code is
    interpreted row by row. A limit that the session sets itself stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(limit, "65535") == "65535":
        spark.conf.set(limit, "8000")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only where the session names none (tests on one machine) a temporary
    folder is made, once per session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Own all frames staged within the scope; their folder is removed when it ends or fails.

    Frames that depend on them are of no use afterwards: what shall stay is
    written within the scope. An inner scope removes only what it staged.
    """
    folder = f"{shared_dir(spark)}/stage/{uuid.uuid4().hex}"
    token = _owner.set(folder)
    try:
        yield folder
    finally:
        _owner.reset(token)
        for frame in [f for f, owner in _staged.items() if owner == folder]:
            del _staged[frame]
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Have Spark remove the shuffle files of each execution in the scope when it ends.

    For writes and counts whose plan is not used again. Without it the files
    of a load's steps stay until the driver happens to collect its garbage,
    and together take several times the room of any one step.
    """
    flag = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(flag, "false")
    spark.conf.set(flag, "true")
    try:
        yield
    finally:
        spark.conf.set(flag, before)


def stage(df: DataFrame) -> DataFrame:
    """Write a frame that several branches of a load need, and read it back.

    The table lies in the shared folder: a lost executor costs nothing, later
    branches start from a scan with known size and prune its columns. A frame
    that is staged already is returned as it is. Within :func:`staging` the
    table belongs to the scope. It is read a few times and then removed, so it
    is written in the codec that takes least room.
    """
    if df in _staged:
        return df
    spark, owner = df.sparkSession, _owner.get()
    path = f"{owner or shared_dir(spark) + '/stage'}/{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    _staged[back] = owner
    return back
