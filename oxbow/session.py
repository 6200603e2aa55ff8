"""Session construction and shared-storage helpers.

Every job in this package takes a ``SparkSession`` from the caller. The
helpers here only build one for tests / local runs and find the shared
folder for intermediate tables (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for every job here: adaptive execution (runtime
# coalescing, skew-join splitting, runtime broadcast of measured-small sides),
# a UTC session zone (replay arithmetic), and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files (ordinals) once their DataFrames are unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Upper bound (rows) for a join side that may be broadcast after an explicit
# bounded count. Override per session with this conf key.
BROADCAST_ROWS_CONF = "oxbow.broadcast.maxRows"
DEFAULT_BROADCAST_ROWS = 1_000_000
# Upper bound (estimated bytes) for the same side.
BROADCAST_BYTES_CONF = "oxbow.broadcast.maxBytes"
DEFAULT_BROADCAST_BYTES = 128 << 20


def build_session(master: str | None = None, app: str = "oxbow",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the package defaults.

    ``master`` defaults to ``local[$BENCH_CPUS]`` / ``local[*]`` for local runs;
    on a cluster pass ``None`` and let spark-submit decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only for a local master without one (tests) do we create one, so that
    ``DataFrame.checkpoint()`` and written intermediate tables have a home. On
    a cluster a machine-local folder would be lost, so that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if d:
        if not current:
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    d = tempfile.mkdtemp(prefix="oxbow-ckpt-")
    sc.setCheckpointDir(d)
    return d


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for any address that Spark reads."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for a written table. It is
    deleted when the application ends."""
    path = f"{shared_dir(spark)}/oxbow-{name}-{uuid.uuid4().hex[:12]}"
    fs, p = hadoop_path(spark, path)
    fs.mkdirs(p)  # only a path that exists can be marked
    fs.deleteOnExit(p)
    return f"{path}/data"


def broadcast_row_bound(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_ROWS_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_ROWS


def broadcast_byte_bound(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_BYTES_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def local_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '*')}]"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``oxbow`` importable in Python workers (data-source writers,
    Arrow-batched functions). On a cluster pass the package with
    ``--py-files``; this does the same for a session built elsewhere: the
    package is zipped once per application and added with ``addPyFile``."""
    import importlib.util
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    base = shared_dir(spark)
    local = base[len("file:"):] if base.startswith("file:") else base
    if "://" in local or not os.path.isdir(local):
        local = tempfile.mkdtemp(prefix="oxbow-pkg-")
    target = os.path.join(local, f"oxbow-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _dirs, files in os.walk(root):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.join("oxbow", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(key)
    assert importlib.util.find_spec("oxbow") is not None
