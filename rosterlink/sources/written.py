"""Intermediate tables, written to the folder that all executors share."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Temporary folders of sessions in one process, by application.
_local: dict[str, str] = {}
#: The folder of the job that is running, if any.
_job: contextvars.ContextVar[str | None] = contextvars.ContextVar("job", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Only a session that runs in one process (tests, a laptop) may leave it unset: then a temporary folder serves, the
    same one for all of its jobs, deleted when Python ends. On a cluster a local folder would be another one on each
    machine, so there it is an error. No setting of the session is changed.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="rosterlink-shared-")
        atexit.register(shutil.rmtree, _local[app], ignore_errors=True)
    return _local[app]


@contextlib.contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """A folder for all that ``materialise`` writes inside; it is deleted at the end, whether the job fails or not.

    Read or write the results before it ends, or keep them with ``materialise(df, keep=True)``, which writes beside the
    folder (into that of the job around this one, if there is one).
    """
    path = f"{_job.get() or shared_dir(spark)}/job-{uuid.uuid4().hex}"
    token = _job.set(path)
    try:
        yield path
    finally:
        _job.reset(token)
        delete(spark, path)


def materialise(df: DataFrame, keep: bool = False, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again.

    This cuts lineage: what follows survives the loss of any executor without running what came before again, and a
    table that several results read is worked out once. Inside a ``job`` the table goes with it, unless ``keep`` is set.
    With ``partition_by``, readers of some values of that column read only their files.
    """
    at = _job.get()
    at = at.rpartition("/job-")[0] if at and keep else at
    path = f"{at or shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=partition_by)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, wherever Spark can write."""
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(conf).delete(at, True)


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``materialise`` that nothing reads any more; other frames and None are left alone."""
    for df in tables:
        path = getattr(df, "_written_to", None)
        if path:
            delete(df.sparkSession, path)
