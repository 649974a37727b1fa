"""Session helpers: building a session for local runs and locating the shared scratch area."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all are plain Spark configuration.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "valuemill", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Return the active session or build one (local mode only when ``master`` is given)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor and the driver can reach). Only in
    local mode, when it is unset, a private temporary folder is created for the session.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        conf = tempfile.mkdtemp(prefix="valuemill-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/valuemill/{name}-{uuid.uuid4().hex[:12]}"


def sf_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()`` but computes the plan once (a reliable RDD checkpoint
    recomputes it in a second job unless cached), and the files survive executor loss.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def spread(df, min_partitions: int | None = None):
    """In local mode, round-robin ``df`` over the cores when its scan yields fewer partitions than cores.

    Row-wise work after a scan (regex parsing, hashing, Python batches) runs one task per input
    split; a small table stored as one row group would be parsed by a single core. On a cluster
    the scan's own splits are used and no shuffle is added; there, write tables as many files or row
    groups, or lower ``spark.sql.files.maxPartitionBytes``.
    """
    spark = df.sparkSession
    want = min_partitions or spark.sparkContext.defaultParallelism
    if not _is_local(spark) or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``valuemill`` importable on every executor (``addPyFile`` of a zip of the package).

    Python code run inside tasks (``mapInPandas`` batches) refers to library functions by module
    name, so executors need the package on their path; this is the ``--py-files`` mechanism. The
    zip is built in memory and written through the Hadoop FileSystem API into the shared
    checkpoint folder, from where Spark distributes it.
    """
    import io
    import zipfile

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    target = f"{scratch_path(spark, 'pyfiles')}/valuemill.zip"
    sc = spark.sparkContext
    jpath = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = jpath.getFileSystem(sc._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(buf.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    _SHIPPED.add(app)
