"""Session helpers: a local session for tests/bench and a shared scratch area.

Operators never create sessions; they take DataFrames.  Anything written as an
intermediate (CSV fixtures, stream sinks, checkpoints) goes under the folder
named by ``spark.checkpoint.dir`` -- on a cluster that is shared storage, so
the files survive the loss of any executor.  Where the setting is absent a
local master gets a folder of its own; any other master is refused.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rivulet") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RIVULET_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def _plain(uri: str) -> str:
    """``file:/x`` / ``file:///x`` -> ``/x``; other schemes (hdfs, s3a, ...) unchanged."""
    if uri.startswith("file://"):
        return "/" + uri[len("file://"):].lstrip("/")
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    ``spark.checkpoint.dir`` is a core setting that cannot be changed at run
    time, so when it is absent (local tests) only the SparkContext's
    checkpoint directory is set.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return _plain(base)
    existing = sc.getCheckpointDir()
    if existing:
        return _plain(existing)
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = tempfile.mkdtemp(prefix="rivulet-ckpt-")  # a local master: one machine holds everything
    sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/rivulet-scratch/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in whatever store its path names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def materialize(df, name: str = "stage", compression: str | None = None):
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint
    folder and return the table read back.

    One job computes the frame (an RDD checkpoint computes it twice unless it
    is also cached), the copy is columnar, so later reads are pruned, and it
    lives on shared storage, so losing an executor loses nothing.
    ``compression`` names another codec than the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.parquet(path)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rivulet`` importable by executor Python workers (``--py-files``).

    Operators that run Python on executors (``mapInPandas``) pickle references
    to this package's functions, so workers must be able to import it.  The
    package is zipped once per SparkContext and handed to ``addPyFile``; Spark
    serves it to every executor, including ones started later.
    """
    import zipfile

    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="rivulet-pyfiles-"), "rivulet.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(id(sc))
