"""Session helpers shared by the tests, the benchmark and the query book."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "ledgerlark") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can see.

    A cluster names it in ``spark.checkpoint.dir`` or by ``setCheckpointDir``.  A
    session whose executors are the driver's own process has a folder of its own
    where neither is set; it goes when the process ends.  Any other session must
    name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    checkpoints = context._jsc.sc().getCheckpointDir()
    if checkpoints.isDefined():
        return checkpoints.get().rstrip("/")
    if not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.TemporaryDirectory(prefix="ledgerlark-", ignore_cleanup_errors=True)
    return _LOCAL_FOLDERS[context.applicationId].name


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused output path below :func:`shared_folder`."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """The table written once to the shared folder and read back.

    For results of costly extraction that are read more than once.  The written
    table survives the loss of executors and cuts the lineage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors once, for functions that run in their Python workers."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        root = Path(__file__).resolve().parent
        folder = tempfile.TemporaryDirectory()  # on the driver, which serves the file as long as it runs
        atexit.register(folder.cleanup)
        target = Path(folder.name) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for path in sorted(root.rglob("*.py")):
                out.write(path, path.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))


_LOCAL_FOLDERS: dict[str, tempfile.TemporaryDirectory] = {}
_SHIPPED: set[str] = set()
