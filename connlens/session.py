"""SparkSession helpers.

The library never creates a session on its own inside an operator; these helpers
exist for tests, the bench and command-line use.  On a cluster the caller passes
its own session and the operators only read settings from it.
"""

from __future__ import annotations

import os
import re
import tempfile
import zipfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "connlens") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS")
    master = master or (f"local[{cpus}]" if cpus else "local[*]")
    parts = shuffle_partitions or int(cpus or 8)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.default.parallelism", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.worker.reuse", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  Only when
    neither is set and the master is local -- a test session -- a scratch folder is
    created and registered so that ``DataFrame.checkpoint()`` works.  On a cluster a
    missing setting is an error: a driver-local folder would be invisible to executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="connlens-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def run_folder(spark: SparkSession) -> str:
    """The one parent folder of everything this application writes for itself."""
    return f"{checkpoint_dir(spark).rstrip('/')}/connlens-{spark.sparkContext.applicationId}"


def drop_run_folder(spark: SparkSession) -> None:
    """Delete this application's intermediates (call when their readers are done)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_table(df) -> None:
    """Delete a table written by ``materialize`` that has no more readers."""
    spark = df.sparkSession
    for path in {os.path.dirname(f) for f in df.inputFiles()}:
        if f"/{os.path.basename(run_folder(spark))}/" in path:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, so that tasks find it wherever they run."""
    sc = spark.sparkContext
    if getattr(sc, "_connlens_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="connlens-zip-")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(folder, "connlens.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for base, dirs, names in os.walk(os.path.join(root, "connlens")):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for n in names:
                if n.endswith(".py"):
                    z.write(os.path.join(base, n), os.path.relpath(os.path.join(base, n), root))
    sc.addPyFile(archive)
    sc._connlens_shipped = True


def materialize(df, name: str = "table", spread: str | None = None, keep_spread: bool = True):
    """Cut lineage by writing ``df`` once as a parquet table under the shared
    checkpoint folder and reading it back.

    Unlike ``DataFrame.checkpoint()`` -- which runs the plan twice (an eager count,
    then the checkpoint write) unless cached -- the plan runs exactly once, and later
    readers get column pruning and filter pushdown on the written table.  A lost
    executor re-reads files from the shared folder; nothing lives on one machine.

    With ``spread`` (a column of many values) the rows are dealt evenly over several files a core.  Later tasks follow
    the files: a plan of one scan and broadcast joins has as many tasks with rows as its file has row groups.  The
    column itself is left out of the table without ``keep_spread``."""
    import uuid

    spark = df.sparkSession
    if spread is not None:
        df = df.repartition(4 * spark.sparkContext.defaultParallelism, spread)
        df = df if keep_spread else df.drop(spread)
    path = f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)
