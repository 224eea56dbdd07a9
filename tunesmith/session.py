"""Spark session and shared scratch space.

Every job that has to materialise data (positional indexes, round-trip
sources, sinks) writes below the checkpoint folder the cluster names in
``spark.checkpoint.dir``.  The folder is only chosen here when the session
has none, which is the local test situation.
"""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows per Arrow batch for the pandas UDFs: whole documents can be long
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tunesmith",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tunesmith`` importable on every executor (once per context).

    Python functions run by Arrow UDFs and ``mapInPandas`` are pickled by
    module reference, so executors must import this package: it is zipped
    on the driver and distributed with ``addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = tempfile.mkdtemp(prefix="tunesmith-pkg-")
    archive = shutil.make_archive(os.path.join(out, "tunesmith"), "zip",
                                  root_dir=os.path.dirname(pkg), base_dir="tunesmith")
    sc.addPyFile(archive)
    _SHIPPED.add(app)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; pick a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            configured = None
    if not configured and not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                           "executors share")
    if not configured:
        # Local runs and tests only: a cluster names a shared folder.
        configured = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: folders made by scopes that are still open, innermost last
_SCOPES: list[list[str]] = []
#: applications whose scratch folder is marked for removal
_MARKED: set[str] = set()


def _folder(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    It is removed when the innermost open :func:`scratch_scope` ends, and in any
    case when the driver's JVM does."""
    app = spark.sparkContext.applicationId
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tunesmith-{app}"
    if app not in _MARKED:
        folder, fs = _folder(spark, base)
        fs.mkdirs(folder)           # only a folder that exists can be marked
        fs.deleteOnExit(folder)
        _MARKED.add(app)
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders made inside as soon as the block ends: what is
    computed from them has to be written or fetched by then."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield made
    finally:
        _SCOPES.remove(made)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder."""
    folder, fs = _folder(spark, path)
    fs.delete(folder, True)


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back:
    later steps neither recompute it nor depend on the executors that made it."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


