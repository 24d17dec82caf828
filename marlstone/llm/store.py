"""Where intermediate tables go: the folder that the cluster shares.

The folder is the one named in ``spark.checkpoint.dir``. Where that setting is absent and the
master is local (unit tests on one machine) a temporary folder of the driver is used; on a
cluster its absence is an error, because executors can't read the driver's folders.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}
#: Tables that are still stored; what results may be read from stays until the driver ends.
_KEPT: set[str] = set()
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, made known to Spark's ``checkpoint()`` as well."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _FALLBACK:
        _FALLBACK[sc.applicationId] = tempfile.mkdtemp(prefix="marlstone-")
        sc.setCheckpointDir(_FALLBACK[sc.applicationId])
    return _FALLBACK[sc.applicationId]


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, keep it in the shared folder and cut its lineage (small tables)."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once as a compressed table in the shared folder and read it from there.

    The shuffle files of the computation go as soon as it has ended. ``discard`` removes the table,
    and ``sweep`` what is left when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marlstone-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    _KEPT.add(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove what ``stored`` wrote; only when nothing that is still to run reads it."""
    _remove(df.sparkSession.sparkContext, df._stored_at)


def _remove(sc: SparkContext, where: str) -> None:
    path = sc._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    _KEPT.discard(where)


@atexit.register
def sweep() -> None:
    """Remove all tables that are left when the driver ends."""
    sc = SparkContext._active_spark_context
    for where in sorted(_KEPT) if sc is not None and sc._jsc is not None else ():
        with contextlib.suppress(Exception):  # the store may be gone before the driver
            _remove(sc, where)
