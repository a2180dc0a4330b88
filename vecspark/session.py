"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import shlex
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "vecspark") -> SparkSession:
    """A session configured for this library.

    On a cluster pass ``master=None`` and let spark-submit decide. The settings below are defaults: a
    value of the launch configuration stays, and the number of shuffle partitions is only set
    for local runs or when ``partitions`` asks for it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", os.environ.get("VECSPARK_DRIVER_MEMORY", "8g"))
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        # remove checkpoint files of intermediates once they are garbage collected
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # one task per core: NumPy/BLAS inside a task must not start its own thread pool
        "spark.executorEnv.OMP_NUM_THREADS": "1",
        "spark.executorEnv.OPENBLAS_NUM_THREADS": "1",
        "spark.executorEnv.MKL_NUM_THREADS": "1",
        "spark.ui.showConsoleProgress": "false",
    }
    launch = launch_conf()
    if (master or launch.get("spark.master", "local")).startswith("local"):
        defaults["spark.sql.shuffle.partitions"] = os.environ.get("VECSPARK_PARTITIONS", "8")
    for k, v in defaults.items():
        if k not in launch:
            b = b.config(k, v)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def launch_conf() -> dict[str, str]:
    """Settings this process was launched with (spark-submit, --conf, spark-defaults)."""
    from pyspark import SparkConf, SparkContext
    if SparkContext._active_spark_context is not None:
        return dict(SparkContext._active_spark_context.getConf().getAll())
    args = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    given = dict(a.split("=", 1) for f, a in zip(args, args[1:]) if f in ("--conf", "-c") and "=" in a)
    given |= {"spark.master": a for f, a in zip(args, args[1:]) if f == "--master"}
    if SparkContext._jvm is not None:
        given |= dict(SparkConf(loadDefaults=True).getAll())
    return given


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on every executor (the ``--py-files`` mechanism).

    Arrow/pandas kernels are pickled by value, but shipping the package as well keeps any
    import they perform working wherever the driver was started from. Done once per context.
    """
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="vecspark-py-"), "vecspark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster (and ship the package).

    The session's ``spark.checkpoint.dir`` (or a directory already set on the
    context) wins. Only when neither is set -- local runs and tests -- a fresh
    scratch folder is created.
    """
    sc = spark.sparkContext
    ship_package(spark)
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="vecspark-ckpt-", dir="/tmp")
    elif not sc.master.startswith("local") and str(d).startswith("file:"):
        raise RuntimeError(f"spark.checkpoint.dir must be shared by all machines, not {d}")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
