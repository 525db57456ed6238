"""Session construction and shared-storage helpers.

Every job in the library runs on the session it is handed; ``get_spark`` is
only a convenience for scripts and tests.  Locations that must survive an
executor loss (checkpoints, vector stores, ledgers written by the examples)
are taken from ``spark.checkpoint.dir``: on a cluster that setting names a
shared folder.  Only when it is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # push IN lists of a few winner ids to Parquet as IN (bloom filter / stats),
    # not as a min..max range; longer ones would nest too deeply
    "spark.sql.parquet.pushdown.inFilterThreshold": "100",
    "spark.ui.enabled": "false",
    # deep expression trees (the chunker fold) need more than the default
    # thread stack when tasks deserialise them; on a cluster set the same in
    # spark.executor.extraJavaOptions
    "spark.driver.extraJavaOptions": "-Xss16m",
    "spark.executor.extraJavaOptions": "-Xss16m",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "vellum",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            root = None
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="vellum-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package known to the Python workers, wherever they were started:
    a zip that the driver's file server hands out, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="vellum-pkg-"), "vellum_pkg.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    keep = list(sys.path)
    spark.sparkContext.addPyFile(archive)
    sys.path[:] = keep                      # the driver goes on with its own copy
    _shipped.add(app)


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder (optionally made unique)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex)
    return "/".join([root, "vellum", *tail])


def spread(df):
    """Give CPU-heavy row work at least one partition per core.

    Only repartitions when the input has fewer splits than the default
    parallelism (small inputs stored as a few row groups); on a cluster
    reading many splits this is a no-op, so no extra shuffle of the corpus.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
