"""Session construction and the shared staging folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with the settings the library expects.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; the
    checkpoint folder must then be configured by the cluster.  Locally a
    fresh scratch folder is used when none is set.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only locally.

    The folder named by ``spark.checkpoint.dir`` is read from the session.  A
    machine-local folder is only acceptable for ``local`` masters (tests,
    benchmarks); on a cluster an unset value is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get(CHECKPOINT_KEY, None) or sc.getConf().get(CHECKPOINT_KEY, None)
    if not current:
        current = sc.getCheckpointDir()
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError(
            f"{CHECKPOINT_KEY} is not set; configure a shared folder for the cluster")
    scratch = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set(CHECKPOINT_KEY, scratch)
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir().rstrip("/")


_handed_out: list[tuple[SparkSession, str]] = []


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.  What is
    written there is for this process: :func:`remove_staged` deletes it when
    Python ends, or earlier if called."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    if not _handed_out:
        atexit.register(remove_staged)
    _handed_out.append((spark, path))
    return path


def remove_staged() -> None:
    """Delete the folders that :func:`staging_path` handed out.  Results that
    still read them must have been written elsewhere before."""
    while _handed_out:
        spark, path = _handed_out.pop()
        try:
            jvm = spark.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # the session has ended: its folder is the cluster's to clear
            return


def forget_staged(spark: SparkSession, paths: set[str]) -> None:
    """Delete folders that :func:`staging_path` handed out before the process ends."""
    names = {p.rstrip("/").rpartition("/")[2] for p in paths}
    for known in [x for x in _handed_out if x[1].rpartition("/")[2] in names]:
        jvm = spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(known[1])
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        _handed_out.remove(known)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
