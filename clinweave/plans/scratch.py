"""Cutting lineage by written tables in the folder that all executors share.

``spark.checkpoint.dir`` names that folder. Only where it is unset and Spark runs inside one process, as in
tests, a temporary folder of this machine is taken.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables; an error on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
    return _LOCAL[app]


def _drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _drop_at_end(spark: SparkSession, path: str) -> None:
    """Removes a table unless the session has ended before the process; then its folder is the cluster's to clear."""
    context = spark.sparkContext
    if getattr(context, "_jsc", None) is None or context._jsc.sc().isStopped():
        return
    try:
        _drop(spark, path)
    except Exception as e:
        warnings.warn(f"{path} was not removed: {e}", stacklevel=2)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder, removed when the driver's process ends."""
    path = f"{shared_folder(spark)}/clinweave-{name}-{uuid.uuid4().hex}"
    atexit.register(_drop_at_end, spark, path)
    return path


def materialize(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once and read it back: later uses neither recompute it nor depend on any executor.

    Empty tables keep their schema. The files are removed when the driver's process ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Removes tables made by ``materialize`` now. Only for tables from which nothing is still to be computed."""
    for df in tables:
        _drop(df.sparkSession, df._scratch_path)
