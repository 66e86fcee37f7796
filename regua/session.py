"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """Session for tests and benchmarks. A cluster brings its own settings."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        # Small data: let a few megabytes already be worth a task of their own.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("regua")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.regua.scratch.dir`` or else by ``spark.checkpoint.dir``, which all executors share.

    A machine-local folder, removed when the application ends, is only acceptable when the whole application runs
    on one machine, so it is made for ``local`` masters alone.
    """
    shared = spark.conf.get("spark.regua.scratch.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="regua-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder nobody has used yet, so a retried write never meets old files."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/regua/{app}/{uuid.uuid4().hex}/{name}"
