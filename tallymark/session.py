"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "tallymark", cores: str = "*", **conf) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": f"{tempfile.gettempdir()}/tallymark-warehouse",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """This application's folder in the one all executors share (`spark.checkpoint.dir`).

    Only a local session may fall back to this machine's temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = f"{tempfile.gettempdir()}/tallymark-scratch"
    return f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the application's scratch folder."""
    return f"{scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application left in its scratch folder, once no result needs it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path, True)
