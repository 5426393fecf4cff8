"""Session settings and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_WORK: dict[str, str] = {}


def build_session(app: str = "stratalake", cpus: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The folder for staged tables and stream checkpoints.

    It is the one the cluster names in ``spark.checkpoint.dir``, which every
    executor can reach. Only a local-mode session without that setting gets a
    temporary folder of its own, removed when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK:
        _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="stratalake-")
        atexit.register(shutil.rmtree, _LOCAL_WORK[app], ignore_errors=True)
    return _LOCAL_WORK[app]


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below :func:`work_root`; never handed out twice."""
    return f"{work_root(spark)}/stratalake/{label}-{uuid.uuid4().hex}"
