"""Durable intermediate tables in the folder that all executors share.

The cluster names the folder in ``spark.checkpoint.dir``; only in local mode, where that is unset, a temporary folder
is chosen here. Tables are Parquet, so a lost executor costs a re-read and not the lineage before it, and later
readers prune columns and see real sizes. Whoever knows that a table's last reader is done gives it back by
:func:`release`; the rest goes when the process ends.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, or one of our own in local mode where none is configured."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = getattr(spark, "_tamarack_shared", None)
    if own is None:
        own = spark._tamarack_shared = "file://" + tempfile.mkdtemp(prefix="tamarack-")
    return own


def _place(spark: SparkSession) -> str:
    path = f"{shared_dir(spark)}/tamarack-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def durable(df: DataFrame, rows: int | None = None, per_file: int = 200_000) -> DataFrame:
    """Write ``df`` to the shared folder and return it as read back: the lineage ends here.

    ``rows`` is a bound on its rows where one is known: a small table then takes one file for each ``per_file`` of them
    instead of one for each task of a shuffle.
    """
    path = _place(df.sparkSession)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // per_file)))
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._tamarack_path = path
    return back


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Like :func:`durable`, but dealt to ``buckets`` by ``key``: joins on ``key`` read it without a shuffle."""
    path = _place(df.sparkSession)
    name = "tamarack_" + path.rpartition("-")[2]
    df.repartition(buckets, key).write.option("path", path).bucketBy(buckets, key).saveAsTable(name)
    back = df.sparkSession.table(name)
    back._tamarack_path = path
    return back


def release(*frames: DataFrame | None) -> None:
    """Delete the tables behind frames that :func:`durable` or :func:`bucketed` returned; others are left alone."""
    for frame in frames:
        path = getattr(frame, "_tamarack_path", None)
        if path in _written:
            _delete(path, _written.pop(path))


def _delete(path: str, spark: SparkSession) -> None:
    jvm, jsc = spark._jvm, spark.sparkContext._jsc
    spark._jsparkSession.sql("DROP TABLE IF EXISTS tamarack_" + path.rpartition("-")[2])
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _forget() -> None:
    for path, spark in _written.items():
        try:
            _delete(path, spark)
        except Exception:  # the session is gone already
            pass
