"""Session helpers: build a local session for tests and tools, resolve the checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings this library relies on; applied only where the session leaves them unset.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "censusflow") -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark (UI off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CENSUSFLOW_DRIVER_MEMORY", "8g"))
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def share_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed where the driver found it by its own search path only; on a cluster it is installed or sent
    along (``--py-files``), and a folder that isn't there does no harm.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a ``local`` master gets a scratch folder, once per application
    (tests, local runs).  Any other master raises: executors of a cluster do not share
    a machine-local folder.
    """
    share_package(spark)
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if path:
        return path
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = _LOCAL_DIRS.get(sc.applicationId)
    if path is None:
        path = tempfile.mkdtemp(prefix="censusflow-ckpt-")
        _LOCAL_DIRS[sc.applicationId] = path
        sc.setCheckpointDir(path)
    return path
