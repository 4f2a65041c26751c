"""Session helpers: local sessions for tests, and the shared scratch folder."""

from __future__ import annotations

import os
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()

ROWS_PER_TASK = "spark.braidline.rowsPerTask"
MAX_TASKS = "spark.braidline.maxTasks"


def local_session(app: str = "braidline", cpus: int | str = "*", **conf: str) -> SparkSession:
    """A local session with the settings the operators assume (UTC, AQE on)."""
    n = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # call sites of every expression are only of use in error messages
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Operators with a Python part call it themselves; workers need not have the
    package installed.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = pathlib.Path(__file__).resolve().parent
    path = pathlib.Path(tempfile.mkdtemp(prefix="braidline-")) / f"{root.name}.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(path))
    _SHIPPED.add(context.applicationId)


def rows_per_task(spark: SparkSession) -> int:
    """Rows of one key that one task may order by itself."""
    return int(spark.conf.get(ROWS_PER_TASK, "2000000"))


def max_tasks(spark: SparkSession) -> int:
    """Upper bound on the pieces all hot keys together are cut into."""
    return int(spark.conf.get(MAX_TASKS, "32768"))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local session, as in tests, may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    root = tempfile.mkdtemp(prefix="braidline-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(spark: SparkSession, df, label: str = "cut"):
    """Write ``df`` to the shared folder and read it back, which cuts its lineage."""
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
