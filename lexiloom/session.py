"""Session helpers: a local session for tests and bench, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once for an application, so that they need no path to it.

    The archive is written on the driver and handed out by its file server.
    """
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="lexiloom-package-")) / "lexiloom.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, str(Path(package.name) / path.relative_to(package)))
    spark.sparkContext.addPyFile(str(archive))


def local_session(cpus: int = 8, memory: str = "8g", **conf: str) -> SparkSession:
    """A local session as tests and the bench use it; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lexiloom")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    root = str(Path(__file__).resolve().parents[1])
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):  # for the Python workers
        os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH", "")]))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure that ``DataFrame.checkpoint`` has a folder.

    The folder the cluster names in ``spark.checkpoint.dir`` is used.  Only where none is set, and
    only in local mode, a temporary one is made: on a cluster a machine-local folder would not be
    seen by the other executors, so there the absence is an error.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        context.setCheckpointDir(named)
    elif context.master.startswith("local[") or context.master == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="lexiloom-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there from now on."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
