"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[str] = []


def build_session(app: str = "pagemart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; a cluster's own settings win where given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call sites are recorded for every column expression; building large jobs is faster without.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder all executors can reach.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session that names none gets a
    folder of its own, since driver and executors are then one process.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="pagemart-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, for a written table or a stream checkpoint."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    files, where = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in files.listStatus(where)) if files.exists(where) else []


def create_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that must not be there yet."""
    files, where = _file_system(spark, path)
    out = files.create(where, False)
    out.write(bytearray(text.encode()))
    out.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this process under the shared folder."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write the rows now to the shared folder and return a reader of them.

    For results that are read more than once and are costly to make, such as records parsed from
    page bodies: the bodies are then read and parsed once, and a lost executor only re-reads files.
    The files stay until ``discard`` or ``clear_scratch``, as the rows may be read at any later time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows._scratch = path
    _WRITTEN.append(path)
    return rows


def discard(*frames: DataFrame) -> None:
    """Delete the files of materialised rows that nothing reads any more."""
    for rows in frames:
        path = getattr(rows, "_scratch", None)
        if path in _WRITTEN:
            delete_path(rows.sparkSession, path)
            _WRITTEN.remove(path)


def clear_scratch(spark: SparkSession) -> int:
    """Delete all that ``materialise`` wrote in this process; call it once the results are stored."""
    for path in _WRITTEN:
        delete_path(spark, path)
    count = len(_WRITTEN)
    _WRITTEN.clear()
    return count
