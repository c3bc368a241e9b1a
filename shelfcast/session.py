"""Session settings and the shared folder for written intermediate tables."""

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(app="shelfcast", cores="*", shuffle_partitions=8, memory="12g"):
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED = set()


def ship_package(spark):
    """Sends this package to the Python workers, once per application.

    Functions that run in tasks refer to its modules, which executors do not have unless
    the application was started with them. Spark's own file server carries the archive.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfcast-"), "shelfcast-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def shared_root(spark):
    """Folder every executor can read: the cluster's `spark.checkpoint.dir`.

    Only where neither that setting nor a checkpoint folder exists, and only in local mode,
    is a fresh temporary folder taken: on a cluster each machine would write to its own disk,
    and readers would miss rows without an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = sc.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="shelfcast-")
        sc.setCheckpointDir(configured)
    elif sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch_path(spark, name):
    """A new, never reused folder below the shared root."""
    return f"{shared_root(spark)}/shelfcast/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """The frame written once to the shared folder and read back.

    Unlike an RDD checkpoint the plan runs only once, and later reads prune columns and
    know the table's size. Lost executors lose nothing of it.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
