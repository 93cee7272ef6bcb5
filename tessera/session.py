"""Session construction and shared-folder resolution."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job of this package relies on. AQE re-plans joins and
# coalesces/splits shuffle partitions from runtime statistics; skew-join
# splitting handles hot keys in shuffled joins.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app: str = "tessera", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the package defaults.

    ``master`` is only applied when given (tests and bench use ``local[N]``);
    on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``. Only when it is unset *and* the master
    is local (tests, single-node bench) a private temp folder is created and
    registered; on a cluster an unset value is an error, because a
    machine-local folder would not survive executor loss.
    """
    conf = spark.sparkContext.getConf()
    d = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():     # each call makes a new subfolder
            spark.sparkContext.setCheckpointDir(d)
        return d
    jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jdir.isDefined():
        return jdir.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    d = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written intermediate table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table this package wrote under the shared
    folder (Hadoop FileSystem API, so it works for any cluster file system)."""
    base = checkpoint_dir(spark).rstrip("/")
    if not path.startswith(base + "/"):
        raise ValueError("only scratch tables under the shared folder can be removed")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python
    workers can import it wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tessera-ship-")      # read by the driver only
    target = os.path.join(folder, "tessera_package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, names in sorted(os.walk(root)):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(d, n)
                    z.write(p, os.path.relpath(p, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._tessera_shipped = True


def default_parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.sparkContext.defaultParallelism))


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["get_session", "checkpoint_dir", "scratch_path", "remove_scratch",
           "ship_package", "default_parallelism", "local_path", "BASE_CONF"]
