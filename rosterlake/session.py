"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from types import MappingProxyType

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job here expects. Skew handling is left on, and AQE may add a shuffle
# to split a hot key, because one key may hold a third of the rows.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark's default, which reading sheet chunks changes; see ``sources.workbook``
    "spark.sql.parquet.enableNestedColumnVectorizedReader": "true",
}

#: Options to write rows of up to some megabytes each: the writer looks at the size of its page and row group after each
#: row, where it else holds a hundred of them first, and ends a row group at 16 MB.
LARGE_ROWS = {f"parquet.{kind}.row.check.{bound}": "1" for kind in ("page.size", "block.size") for bound in ("min", "max")} | {
    "parquet.block.size": str(16 << 20)
}


def build_session(
    app: str = "rosterlake", master: str | None = None, shared: str | None = None, **conf: str
) -> SparkSession:
    """A session with the settings above; ``shared`` is the folder for intermediate tables."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # Python workers import this package, also when the driver runs in another folder
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    paths = [home, *filter(None, [os.environ.get("PYTHONPATH")])]
    builder = builder.config("spark.executorEnv.PYTHONPATH", os.pathsep.join(paths))
    if master:
        builder = builder.master(master)
    if shared:
        builder = builder.config("spark.checkpoint.dir", shared)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can see, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is set and Spark runs in one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="rosterlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; ``end_run`` removes all of a run."""
    return f"{_run_root(spark)}/{label}-{uuid.uuid4().hex}"


def _run_root(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/rosterlake/{spark.sparkContext.applicationId}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def end_run(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Frames that read them are of no use afterwards."""
    discard(spark, _run_root(spark))


@contextlib.contextmanager
def held(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold for what is run inside; afterwards they are as before."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: Files that a task writes at once; beyond so many values of the columns ``by`` it sorts its rows.
FILES_AT_ONCE = 8


def settle(df: DataFrame, label: str, by: Sequence[str] = (), options: Mapping[str, str] = MappingProxyType({})) -> DataFrame:
    """Write an intermediate table to the shared folder once and go on from the written files.

    It cuts lineage, is computed once however often it is used, and gives Spark its true size: the
    join that follows broadcasts it if it is below the threshold and shuffles it otherwise. A reader that
    filters by the columns ``by``, which then come last, reads only the files concerned; rows are not sorted by them if
    their values are few. ``options`` are the writer's.
    """
    path = run_folder(df.sparkSession, label)
    with held(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(FILES_AT_ONCE)} if by else {}):
        df.write.options(**options).partitionBy(*by).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found.settled = path
    return found


def forget(*settled: DataFrame) -> None:
    """Delete settled tables that nothing reads any more, before ``end_run`` does."""
    for df in settled:
        discard(df.sparkSession, df.settled)
