"""Session helpers. The caller normally brings the session; these are for
tests, tools and the bench."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "logsieve") -> SparkSession:
    """A local session with the settings the tests and bench assume."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LOGSIEVE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in spark.checkpoint.dir.

    Only a single-machine session (`local[...]`, as in tests) that has none gets a
    scratch folder, one per application; on a cluster a machine-local folder would be
    unreadable for the other machines, so there the missing setting is an error.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local($|\[)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = _LOCAL_SCRATCH.setdefault(sc.applicationId, "") or tempfile.mkdtemp(prefix="logsieve-ckpt-")
        _LOCAL_SCRATCH[sc.applicationId] = current
    sc.setCheckpointDir(current)
    return current
