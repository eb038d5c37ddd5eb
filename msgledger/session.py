"""Session settings and the shared folder for staged tables."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: dict[str, str] = {}
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def get_spark(app: str = "msgledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the package is planned for (AQE, UTC, Arrow)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Building a plan takes hundreds of column calls; do not record a call site for each.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOT:
        _LOCAL_ROOT[app] = tempfile.mkdtemp(prefix="msgledger-")
    return _LOCAL_ROOT[app]


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/msgledger/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files instead of repeating the work,
    and values fixed at run time (partition numbers) stay fixed for every later use.
    """
    path = stage_path(df.sparkSession, label)
    if (staged := _STAGED.get()) is not None:
        staged.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged inside when the block has ended, well or not.

    Nothing that reads them may be used afterwards.
    """
    mark = _STAGED.set(paths := [])
    try:
        yield
    finally:
        _STAGED.reset(mark)
        for path in paths:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever file system it lies; whether there was one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Spread a Parquet scan that would keep only some of the cores busy by a unique key, for CPU-heavy parsing.

    That is a scan of fewer splits than cores, or of one file with fewer row groups than that: splits in
    which no row group begins are empty. A scan for every core passes through without a shuffle.
    Use on plain scans only: asking for the partition count plans the frame.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if min(df.rdd.getNumPartitions(), _row_groups(df, cores)) >= cores:
        return df
    return df.repartition(cores, key)


def _row_groups(df: DataFrame, enough: int) -> int:
    """Row groups of a scan of one file, by its footer; of more files, ``enough``."""
    files = df.inputFiles()
    if len(files) != 1:
        return enough
    sc = df.sparkSession.sparkContext
    parquet = sc._jvm.org.apache.parquet.hadoop
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(
        sc._jvm.org.apache.hadoop.fs.Path(files[0]), sc._jsc.hadoopConfiguration()))
    try:
        return reader.getRowGroups().size()
    finally:
        reader.close()


def ship_package() -> None:
    """Send the package's own functions to the workers by value.

    For running from a checkout; not needed where the package is installed on all nodes.
    """
    import msgledger
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(msgledger)
